import itertools
import random
from collections import Counter
from itertools import combinations


from vectrace.llm import chat, packing, quality

SPACE = " \t\n\x0b\x0c\r"


def brute_quality(text):
    import re

    words = [w for w in re.split(f"[{SPACE}]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(f"[^{SPACE}]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x\nx\n\nx \n", "é日🙂 # é日🙂 #|<", "a b c d", "the cat " * 400, "w" * 50_000]
    texts += [" ".join(rng.choice(["a", "b", "the", "#", "\n", "é"]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.score(df).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(text), repr(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_keep_good_keeps_rows_and_clashing_columns(spark):
    good = " ".join(f"the word{i} of" for i in range(40))
    rows = [(1, good, 7, "x"), (1, good, 7, "x"), (2, "short", 8, None), (3, None, 9, "y"), (4, "### $$$ " * 60, 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, _text string")
    out = quality.keep_good(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[1]]
    assert quality.keep_good(df.limit(0)).collect() == []


def test_collapse_keeps_maximal_conversations(spark):
    a = [("user", "hi"), ("assistant", "yo"), ("user", "more")]
    conversations = {10: a[:1], 11: a[:2], 12: a, 13: a, 14: a[:2] + [("user", "else")], 15: [("user", None)], 16: [("user", "")], 17: [(None, "hi")]}
    rows = [(c, i, r, t, "extra") for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, pos string"
    )
    got = {r.conv_id: r for r in chat.collapse(df).collect()}
    assert set(got) == {12, 14, 15, 16, 17}
    assert got[12].n_copies == 2 and got[12].n_turns == 3
    assert got[12].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    assert got[17].text == "<|im_start|>unknown\nhi<|im_end|>\n"


def test_collapse_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.collapse(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, 0, "user", "a<|im_end|>"), (None, 0, "user", "a<|im_end|>"), (1, None, "user", "x" * 100_000), (1, 1, "user", "b"), (1, 1, "user", "a")]
    got = {r.conv_id: r for r in chat.collapse(spark.createDataFrame(rows, schema)).collect()}
    assert got[None].n_turns == 2 and "a< |im_end|>" in got[None].text
    assert got[1].text.index("x" * 10) < got[1].text.index("\na<") < got[1].text.index("\nb<")


def test_bounds_are_optimal():
    rng = random.Random(0)
    for _ in range(400):
        hist = [(n, rng.randint(1, 9)) for n in rng.sample(range(40), rng.randint(1, 8))]
        k = rng.randint(1, 5)
        lengths = sorted(n for n, _ in hist)
        cost = lambda b, h=hist: sum(c * (min(x for x in b if x >= n) - n) for n, c in h)
        best = min(cost([*s, lengths[-1]]) for m in range(min(k, len(lengths))) for s in itertools.combinations(lengths[:-1], m))
        bounds = packing.optimal_bounds(hist, k)
        assert len(bounds) <= k and cost(bounds) == best
    assert packing.optimal_bounds([], 3) == []


def test_pack_fills_batches_without_overlap(spark):
    rng = random.Random(1)
    rows = [(i % 900, " ".join(["w"] * rng.choice([0, 1, 5, 30, 300, 900])), 1) for i in range(1000)] + [(5000, None, 2), (None, "a b", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    got = packing.pack(df, buckets=4, budget=1000).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got) == sorted((d is None, d or 0, len((t or "").split())) for d, t, _ in rows)
    assert len({(r.bucket, r.batch, r.slot) for r in got}) == len(got)
    per = Counter((r.bucket, r.batch) for r in got)
    for r in got:
        assert r.n_tokens <= r.padded_tokens
        assert per[r.bucket, r.batch] * r.padded_tokens <= 1000 or per[r.bucket, r.batch] == 1
    full = {b: max(x for (y, x) in per if y == b) for b in {r.bucket for r in got}}
    assert all(per[b, x] == max(1, 1000 // max(1, next(r.padded_tokens for r in got if r.bucket == b))) for b, n in full.items() for x in range(n))
    assert packing.pack(df.limit(0)).collect() == []


def test_bounds_are_real_lengths_above_4096_and_hot_rows_are_split(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN_ROWS", 7)
    lengths = [1, 1, 3, 4097, 4099, 4101, 5461, 5461, 5463, 9001, 20_020]
    rows = [(i, "w " * n) for i, n in enumerate(lengths)] + [(None, "a b")] * 40 + [(5, "same id")] * 9
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = packing.pack(df, buckets=4, budget=16_384).collect()
    sizes = [len(t.split()) for _, t in rows]
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted((-1 if d is None else d or -1, n) for (d, _), n in zip(rows, sizes, strict=True))
    best = min(
        sum(min(b for b in bounds if b >= n) - n for n in sizes)
        for bounds in ((*inner, max(sizes)) for inner in combinations(sorted(set(sizes))[:-1], 3))
    )
    assert sum(r.padded_tokens - r.n_tokens for r in got) == best
    assert {r.padded_tokens for r in got} <= set(sizes)
    assert len({(r.bucket, r.batch, r.slot) for r in got}) == len(got)
    for (bucket, batch), count in Counter((r.bucket, r.batch) for r in got).items():
        bound = next(r.padded_tokens for r in got if r.bucket == bucket)
        assert count == 1 or count * bound <= 16_384
