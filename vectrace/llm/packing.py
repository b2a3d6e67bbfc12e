"""Packing: optimal length buckets and token-budget batches.

The exact global histogram of lengths goes to the driver, where dynamic programming with a convex hull
of lines finds the bucket bounds of least padding.  Different lengths number at most the square root of
twice all tokens, and a step is linear in them.  Inside a bucket, documents are numbered without
gathering the bucket anywhere: they are spread over ``SHARDS`` hash shards, numbered in their shard, and
shifted by the counts of the shards before it.  Rows of one id and length are numbered as one row with
their count and dealt out again in runs, so that a third of all rows may share an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectrace.llm.common import checkpoint, words

BUCKETS = 16
TOKEN_BUDGET = 16_384
SHARDS = 1024
#: Rows of one id and length that are numbered by one task.
RUN_ROWS = 1 << 16


def optimal_bounds(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets minimising the sum of (bound - length) over all documents.

    ``histogram`` holds (length, count), lengths distinct.  The last bound is the greatest length; no
    documents give no bounds.  Of equally good choices one is taken by a fixed rule.
    """
    rows = sorted((n, c) for n, c in histogram if c > 0)
    lengths = [n for n, _ in rows]
    before = [0]
    for _, c in rows:
        before.append(before[-1] + c)
    size = len(rows)
    if not size:
        return []
    cost = [n * before[j + 1] for j, n in enumerate(lengths)]
    choices: list[list[int]] = []
    for _ in range(min(buckets, size) - 1):
        # cost'[j] = min over i < j of cost[i] + lengths[j] * (before[j + 1] - before[i + 1]), or one bucket less.
        hull: list[tuple[int, int, int]] = []
        new, pick, at = cost.copy(), [-1] * size, 0
        for j in range(1, size):
            slope, height = -before[j], cost[j - 1]
            while len(hull) >= 2:
                (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                if (height - b1) * (m1 - m2) <= (b2 - b1) * (m1 - slope):
                    hull.pop()
                else:
                    break
            hull.append((slope, height, j - 1))
            at = min(at, len(hull) - 1)
            x = lengths[j]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            best = hull[at][0] * x + hull[at][1] + x * before[j + 1]
            if best < new[j]:
                new[j], pick[j] = best, hull[at][2]
        choices.append(pick)
        cost = new
    bounds, j = [], size - 1
    for pick in reversed(choices):
        if pick[j] >= 0:
            bounds.append(lengths[j])
            j = pick[j]
    bounds.append(lengths[j])
    return bounds[::-1]


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """One row per input row: (doc_id, n_tokens, bucket, padded_tokens, batch, slot).

    Tokens are words.  ``padded_tokens`` is the bucket's bound, ``batch`` numbers the bucket's batches
    from 0 and ``slot`` the documents in a batch; slots times bound never exceed ``budget`` unless one
    document alone does.  Null and empty texts have 0 tokens and lie in the first bucket.  Rows equal
    in every column share no slot.  An empty table gives no rows.
    """
    sized = df.select(F.col(id_col).alias("doc_id"), F.size(words(F.col(text_col))).cast("long").alias("n_tokens"))
    alike = checkpoint(sized.groupBy("doc_id", "n_tokens").agg(F.count("*").alias("rows")))
    counts = alike.groupBy("n_tokens").agg(F.sum("rows").alias("n")).collect()
    bounds = optimal_bounds([(r["n_tokens"], r["n"]) for r in counts], buckets) or [0]
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = F.size(F.filter(edges, lambda b: b < F.col("n_tokens")))
    placed = alike.withColumn("bucket", bucket).withColumns({
        "padded_tokens": F.get(edges, F.col("bucket")),
        "shard": F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SHARDS)).cast("int"),
    })
    before = lambda w: F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # At most BUCKETS x SHARDS rows, whatever the input: small enough to broadcast.
    offsets = (
        placed.groupBy("bucket", "shard").agg(F.sum("rows").alias("rows"))
        .select("bucket", "shard", before(Window.partitionBy("bucket").orderBy("shard")).alias("offset"))
    )
    numbered = checkpoint(
        placed.join(F.broadcast(offsets), ["bucket", "shard"])
        .withColumn("place", F.col("offset") + before(Window.partitionBy("bucket", "shard").orderBy("doc_id", "n_tokens")))
        .drop("offset", "shard")
    )
    runs = numbered.filter(F.col("rows") > RUN_ROWS).withColumn("from", F.explode(F.sequence(F.lit(0), F.col("rows") - 1, F.lit(RUN_ROWS))))
    runs = runs.withColumns({"place": F.col("place") + F.col("from"), "rows": F.least(F.col("rows") - F.col("from"), F.lit(RUN_ROWS))}).drop("from")
    every = numbered.filter(F.col("rows") <= RUN_ROWS).unionByName(runs.repartition("place"))
    place = F.col("place") + F.col("step")
    capacity = F.greatest(F.floor(F.lit(budget) / F.greatest(F.col("padded_tokens"), F.lit(1))), F.lit(1)).cast("long")
    return every.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).select(
        "doc_id", "n_tokens", "bucket", "padded_tokens",
        F.floor(place / capacity).cast("long").alias("batch"), (place % capacity).cast("long").alias("slot"),
    )
