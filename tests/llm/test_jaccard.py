import random
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from vectrace.llm import jaccard
from vectrace.llm.common import components


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if len(words) >= n:
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    return {tuple(words)} if words else set()


def brute(rows, n, percent):
    """doc_id -> least id reachable by links; rows are (doc_id, text)."""
    sets = [(d, shingles(t, n)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: find(d) for d, _ in sets}


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        i, r = rng.randrange(len(words) + 1), rng.random()
        if r < 0.4 and i < len(words):
            words[i] = rng.choice(vocabulary)
        elif r < 0.7:
            words.insert(i, rng.choice(vocabulary))
        elif i < len(words) and len(words) > 1:
            del words[i]
    return " ".join(words)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_linked_sets_share_filed_grams_and_product_is_exact(n, percent):
    rng = random.Random(5)
    levels = np.random.default_rng(0).integers(0, 9, 1 << jaccard.SKETCH_BITS).astype(np.uint8)
    vocabulary = [f"w{i}" for i in range(400)]
    for size in (1, 2, 4, 6, 10, 15, 30, 60, 150):
        base = [rng.choice(vocabulary) for _ in range(size)]
        texts = [edited(rng, base, rng.choice([0, 0, 1, 2, 3, 4]), vocabulary) for _ in range(30)]
        sets = [shingles(t, n) for t in texts]
        grams = jaccard.gram_sets(pa.array(texts), n)
        assert [len(g) for g in grams] == [len(s) for s in sets]
        filed = [set(jaccard.rare_grams(g, levels, percent).tolist()) for g in grams]
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                if x and y and x != y and 100 * len(x & y) >= percent * len(x | y):
                    assert len(filed[i] & filed[j]) >= min(jaccard.EXTRA + 1, len(x & y))
        root = brute([(k, t) for k, t in enumerate(texts)], n, percent)
        expect = [root[k] if sets[k] else k for k in range(len(texts))]
        assert jaccard.links(grams, percent)[0].tolist() == expect


def test_split_product_only_crosses(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 4)  # many column blocks
    texts = ["a b c d e f g h i j k", "a b c d e f g h i j k l", "p q r s t u v w x y z", "a b c d e f g h i j k l m"]
    grams = jaccard.gram_sets(pa.array(texts), 3)
    assert jaccard.links(grams, 80)[0].tolist() == [0, 0, 2, 0]
    assert jaccard.links(grams, 80, split=2)[0].tolist() == [0, 0, 2, 0]
    assert jaccard.links(grams[:2], 80, split=2)[0].tolist() == [0, 1]


def corpus(rng):
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 20, 80, 200]))]
        rows += [edited(rng, base, rng.choice([0, 0, 1, 2, 5]), vocabulary) for _ in range(rng.choice([1, 2, 6]))]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows += [edited(rng, base, rng.randint(0, 3), vocabulary) for _ in range(140)]  # a large group of near copies
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows += [shared + " " + " ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(80)]  # a passage many share
    rows += [None, "", " \t\n", "", "one", "ONE", "two words", "Two Words", "x " * 30_000]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_join_equals_brute_force(spark, n, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 8192)  # several row blocks in the large group
    rows = corpus(random.Random(n))
    rows += rows[:20]  # repeated rows
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, n_shingles int").repartition(3)
    out = jaccard.join(df, n, percent).collect()
    expect = brute(dict(rows).items(), n, percent)
    assert len(out) == len(rows)
    text = dict(rows)
    for r in out:
        assert r.n_shingles == len(shingles(text[r.doc_id], n))
        assert r.component_id == expect[r.doc_id], (r.doc_id, r.component_id, expect[r.doc_id])
    sets = [(d, shingles(t, n)) for d, t in rows]
    linked = {d: sum(100 * len(x & y) >= percent * len(x | y) for _, y in sets if x and y) - bool(x) for d, x in sets}
    assert {r.doc_id: r.n_links for r in out} == linked


def test_join_edges(spark):
    schema = "doc_id long, text string"
    assert jaccard.join(spark.createDataFrame([], schema), 3, 90).collect() == []
    rows = [(None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (5, "a b c d"), (9, None), (8, None)]
    got = sorted((r.doc_id or 0, r.component_id) for r in jaccard.join(spark.createDataFrame(rows, schema), 3, 90).collect())
    assert got == [(0, None), (0, None), (5, 5), (7, 5), (8, 8), (9, 9)]


def test_keep_one_keeps_rows_and_clashing_columns(spark):
    copy = " ".join(f"w{i}" for i in range(50))
    rows = [(4, copy, "a"), (3, copy + " z", "b"), (3, copy + " z", "b"), (2, "other text here", "c"), (9, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = jaccard.keep_one(df)
    assert out.columns == df.columns
    assert sorted(tuple(r)[0::2] for r in out.collect()) == [(2, "c"), (3, "b"), (9, "d")]


def test_keep_one_decides_each_text_and_keeps_null_ids(spark):
    copy, clean, other = (" ".join(f"{x}{i}" for i in range(50)) for x in "cnk")
    rows = [
        (None, clean + " z"), (None, "no id"), (None, None),
        (3, copy), (5, copy + " z"), (5, clean), (5, clean.upper()),  # one text of id 5 is a near copy, the other is not
        (6, other), (6, other + " z"), (7, "seven one"), (7, "seven two"), (8, None), (8, ""),
    ]
    out = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    left = sorted((r.doc_id or 0, (r.text or "").lower().removesuffix(" z")) for r in out)
    assert left == [(0, ""), (0, clean), (0, "no id"), (3, copy), (5, clean), (6, other), (7, "seven one"), (7, "seven two"), (8, "")]


def test_files_of_a_step_go_when_nothing_reads_them_any_more(spark):
    """Without waiting for the driver to collect its garbage, so that the steps' files do not add up."""
    jaccard.checkpoint(spark.range(1))  # sets the folder
    shared = Path(spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:"))
    local = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    written = lambda: {p.name for p in shared.glob("rdd-*")}
    shuffled = lambda: {p.name for top in local for p in Path(top).rglob("shuffle_*.data")}
    rows = corpus(random.Random(3))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before, kept = (written(), shuffled()), jaccard.keep_one(df)
    for _ in range(40):  # files of shuffles go in the background
        if not shuffled() - before[1]:
            break
        time.sleep(0.25)
    assert not shuffled() - before[1]
    # The documents, their labels and the last state of each search for components.
    assert len(written() - before[0]) <= 4
    expect = brute(rows, 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in expect.items() if d == r)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(70, 70)] + [(300, 299), (299, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 1 for k in range(1, 40)} | {70: 70, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
