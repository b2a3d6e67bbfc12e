import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from vectrace.llm import hpyp


def tokens(text):
    return [*(text or "").encode().lower().split(), 1]


def base(rows):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score), by the formula."""
    out = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    count = Counter(w for d, t in rows if not out(d) for w in tokens(t))
    total, types = sum(count.values()), len(count)
    score = lambda w: math.log10((count[w] + 0.5) / (total + 0.5 * (types + 1)))
    return {d: (out(d), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total, sum(map(score, tokens(t)))) for d, t in rows}


def markov(rng, n):
    """Texts whose next word depends on the one before."""
    words = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(n):
        at, text = rng.randrange(60), []
        for _ in range(rng.randint(5, 80)):
            at = (at * 7 + rng.choice([0, 0, 0, 1, 5])) % 60
            text.append(words[at] if rng.random() < 0.95 else f"odd{rng.randrange(100000)}")
        rows.append((d, " ".join(text)))
    return rows


@pytest.mark.parametrize("tokens", [1 << 21, 3000])
def test_base_is_exact_and_the_model_beats_it_on_held_out_texts(spark, tokens):
    # 3,000 tokens a bucket make many units and buckets, and split the restaurants of the start and of w2.
    rows = markov(random.Random(1), 600) + [(1000, None), (1001, ""), (1002, "w1 W1 zzz"), (1003, "w2 " * 20_000)]
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, score double").repartition(5)
    got = {r.doc_id: r for r in hpyp.score(df, unit_tokens=tokens, bucket_tokens=tokens).collect()}
    expect = base(rows)
    assert set(got) == set(expect)
    for d, (held, n, known, total, score) in expect.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, score, rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    held = [d for d, e in expect.items() if e[0] and d < 1000]
    assert sum(got[d].score for d in held) > sum(got[d].base_score for d in held)


class Plain:
    """The model by the book: every customer is taken out and seated again, one at a time."""

    def __init__(self, texts, discount, seed):
        self.rng, self.d, self.rooms, self.root = random.Random(seed), discount, {}, {}
        self.types = len({w for t in texts for w in t})
        self.seen = [(c, w) for t in texts for c, w in zip([0, *t[:-1]], t, strict=True)]
        for c, w in self.seen:
            self.add(c, w)

    def share(self, tables, w, base):
        n, t = sum(sum(x) for x in tables.values()), sum(map(len, tables.values()))
        mine = tables.get(w, [])
        return (sum(mine) - self.d * len(mine) + (1 + self.d * t) * base) / (1 + n)

    def chance(self, c, w):
        base = self.share(self.root, w, 1 / (self.types + 1))
        return self.share(self.rooms.get(c, {}), w, base)

    def sit(self, tables, w, base):
        """Whether a new table was opened."""
        t, mine = sum(map(len, tables.values())), tables.setdefault(w, [])
        weights = [n - self.d for n in mine] + [(1 + self.d * t) * base]
        k = self.rng.choices(range(len(weights)), weights)[0]
        if k == len(mine):
            mine.append(1)
            return True
        mine[k] += 1
        return False

    def rise(self, tables, w):
        mine = tables[w]
        k = self.rng.choices(range(len(mine)), mine)[0]
        mine[k] -= 1
        if not mine[k]:
            del mine[k]
            return True
        return False

    def add(self, c, w):
        if self.sit(self.rooms.setdefault(c, {}), w, self.share(self.root, w, 1 / (self.types + 1))):
            self.sit(self.root, w, 1 / (self.types + 1))

    def sweep(self):
        for c, w in self.seen:
            if self.rise(self.rooms[c], w):
                self.rise(self.root, w)
            self.add(c, w)


def test_scores_equal_those_of_a_plain_sampler(spark):
    rows = markov(random.Random(4), 90)
    training = [tokens(t) for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1]
    pairs = Counter(p for t in training for p in zip([0, *t[:-1]], t, strict=True))
    ones, twos = (sum(n == k for n in pairs.values()) for k in (1, 2))
    plain = Plain(training, min(max(ones / (ones + 2 * twos), 0.2), 0.9), 3)
    total, kept = {d: [0.0] * len(tokens(t)) for d, t in rows}, 12
    for turn in range(8 + kept):
        plain.sweep()
        if turn >= 8:
            for d, t in rows:
                for i, (c, w) in enumerate(zip([0, *tokens(t)[:-1]], tokens(t), strict=True)):
                    total[d][i] += plain.chance(c, w) / kept
    expect = {d: sum(math.log10(p) for p in ps) for d, ps in total.items()}
    got = {r.doc_id: r.score for r in hpyp.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert abs(sum(got.values()) / sum(expect.values()) - 1) < 0.01
    for d, value in expect.items():
        assert math.isclose(got[d], value, rel_tol=0.06, abs_tol=0.5), (d, got[d], value)


def test_few_customers_are_drawn_from_their_conditional():
    d, root, others, n = 0.6, 0.03, 40.0, 5
    weights = hpyp.stirling(n, d)[n, 1:] * [math.prod((1 + d * (others + j)) * root for j in range(t)) for t in range(1, n + 1)]
    expect = (weights * range(1, n + 1)).sum() / weights.sum()
    room = np.zeros(1, dtype=np.int64)
    draws = [hpyp.Seats(room, np.array([n]), 1, d, np.random.default_rng(i)).sweep(np.array([root]), np.array([others]), np.ones(1))[0] - others for i in range(3000)]
    assert abs(np.mean(draws) - expect) < 0.06
    assert math.isclose(hpyp.stirling(3, 0.5)[3, 1], 0.5 * 1.5) and math.isclose(hpyp.stirling(3, 0.5)[3, 2], 3 * 0.5)


def test_many_customers_are_drawn_from_their_conditional():
    d, root, others, n = 0.4, 0.05, 30.0, hpyp.EXACT_CUSTOMERS + 16
    weights = hpyp.stirling(n, d)[n, 1:] * np.cumprod([(1 + d * (others + j)) * root for j in range(n)])
    expect = (weights * range(1, n + 1)).sum() / weights.sum()
    size = 400
    seats = hpyp.Seats(np.arange(size), np.full(size, n), size, d, np.random.default_rng(5))
    draws = [seats.sweep(np.full(size, root), np.full(size, others), np.ones(size)).mean() - others for _ in range(40)][10:]
    assert abs(np.mean(draws) / expect - 1) < 0.05


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    room, count = np.repeat(np.arange(50), 6), rng.integers(2, 90, 300)
    alone = rng.integers(0, 4, 50).astype(float)
    mean, total, tables = hpyp.restaurants(room, count, np.full(300, 0.01), alone, np.ones(50), 0.6, rng, 2, 3)
    seated = hpyp.CONCENTRATION + np.bincount(room, count, 50) + alone
    own = np.bincount(room, count - 0.6 * mean, 50) + alone * (1 - 0.6)
    assert np.allclose(own + hpyp.CONCENTRATION + 0.6 * total, seated)
    assert ((tables >= 1) & (tables <= count)).all()
    classes = [(1, 400), (2, 60), (9, 5), (700, 3)]
    root = hpyp.seat_root(classes, 468, 0.6, 0)
    chances = root.of(np.array([c for c, _ in classes]))
    assert math.isclose(sum(p * k for p, (_, k) in zip(chances, classes, strict=True)) + root.chance[0], 1, rel_tol=0.01)


def test_arrays_come_back_from_their_bytes():
    arrays = [np.arange(5, dtype=np.uint64), np.empty(0, dtype=np.uint32), np.array([0.5, -1.0]), np.array([7], dtype=np.uint8)]
    for a, b in zip(arrays, hpyp.unpack(hpyp.pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()


def test_edges(spark):
    schema = "doc_id long, text string"
    assert hpyp.score(spark.createDataFrame([], schema)).collect() == []
    out = [d for d in range(50) if zlib.crc32(str(d).encode()) % 5 == 1]
    only_held = hpyp.score(spark.createDataFrame([(d, "a b") for d in out], schema)).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in only_held)
    twice = hpyp.score(spark.createDataFrame([(1, "a a"), (1, "a a"), (None, "a")], schema)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.held_out) for r in twice) == [(0, 2, False), (1, 3, False), (1, 3, False)]
    report = hpyp.perplexity(hpyp.score(spark.createDataFrame([(d, "a b c") for d in range(20)], schema))).collect()
    assert {r.held_out for r in report} == {True, False}


def test_rare_contexts_have_restaurants_of_their_own(spark):
    # 6,000 contexts of three tokens each, every one followed by its own word: far below 1/4096 of the tokens.
    rows = [(d, f"a{d % 6000} b{d % 6000}") for d in range(24_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = hpyp.score(df).filter("held_out").collect()
    seen = Counter(d % 6000 for d, _ in rows if zlib.crc32(str(d).encode()) % 5 != 1)
    trained = [r for r in got if seen[r.doc_id % 6000] >= 2]
    # The first word costs about 1/6000; the second and the end follow from what is before them.
    assert len(trained) > 1000 and sum(r.score for r in trained) / len(trained) > -5.5
