"""Chat formatting: cumulative snapshots collapsed, maximal conversations rendered.

Logs often hold a conversation once per turn, each snapshot repeating the turns before it.  A rolling
hash over (position, role, text) marks every prefix; a conversation whose whole hash is a proper
prefix of another is dropped by an anti-join, equal ones keep the least id, and the rest are
rendered.  Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_MASK = (1 << 31) - 1
_HASHES = ("h0", "h1", "h2", "h3")


def _parts() -> dict[str, Column]:
    """Four 31-bit hashes of a turn at its position; sums of them mark a prefix with 124 bits."""
    turn = [F.col("pos"), F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    out = {}
    for i in range(2):
        mixed = F.xxhash64(F.lit(i + 1), *turn)
        out[f"h{2 * i}"] = mixed.bitwiseAND(F.lit(_MASK))
        out[f"h{2 * i + 1}"] = F.shiftrightunsigned(mixed, 32).bitwiseAND(F.lit(_MASK))
    return out


def rendered(role: Column, text: Column) -> Column:
    """One turn in chat markup; marker openings inside the text are broken up so that it stays one turn."""
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(START), F.coalesce(role, F.lit("unknown")), F.lit("\n"), safe, F.lit(END + "\n"))


def collapse(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per maximal conversation: (conv_id, n_turns, n_copies, text).

    Turns are ordered by (turn, role, text), nulls first, so ties have a defined order; rows that
    repeat are turns of their own.  Rows with a null conv_id form one conversation.  Of equal
    conversations the least id stays and ``n_copies`` counts them.  Null roles render as "unknown",
    null texts as empty; null and empty texts are different turns.  An empty table gives no rows.

    A conversation is numbered, hashed and rendered by one task and becomes one text, so its turns must
    stay below what a cell holds (2 GB); that goes for all rows with a null id together.  Turns that many
    conversations share meet only as hashes.
    """
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    by = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    prefix = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = Window.partitionBy("conv_id")
    placed = rows.withColumn("pos", F.row_number().over(by))
    hashed = placed.withColumns(_parts())
    rolled = hashed.select(
        "conv_id", "pos", F.count(F.lit(1)).over(last).alias("n"), *[F.sum(h).over(prefix).alias(h) for h in _HASHES]
    )
    whole = (
        rolled.filter("pos = n").groupBy("n", *_HASHES)
        .agg(F.min(F.struct(F.col("conv_id").isNotNull().alias("known"), F.col("conv_id"))).alias("first"), F.count(F.lit(1)).alias("n_copies"))
    )
    inner = rolled.filter("pos < n").select(F.col("pos").cast("long").alias("n"), *_HASHES).distinct()
    kept = whole.join(inner, ["n", *_HASHES], "left_anti").select(
        F.col("first.conv_id").alias("kept_id"), F.col("n").alias("n_turns"), "n_copies"
    )
    full = placed.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
    return full.groupBy("conv_id", "n_turns", "n_copies").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", rendered(F.col("role"), F.col("text")).alias("t")))), lambda x: x["t"]
            ), "",
        ).alias("text")
    )
