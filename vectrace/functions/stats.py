"""Statistics: guarded correlations, ranks, z-scores, closed-edge histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectrace.functions.exprs import col


def pearson(x: Column | str, y: Column | str) -> Column:
    """Aggregate: correlation, null where either side is constant (the built-in one would fail or give NaN)."""
    x, y = col(x).cast("double"), col(y).cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def average_rank(x: Column | str, keys: list[str]) -> Column:
    """Window: rank within ``keys``, ties at their mean."""
    x = col(x)
    first = F.rank().over(Window.partitionBy(*keys).orderBy(x))
    return first + (F.count(F.lit(1)).over(Window.partitionBy(*keys, x)) - 1) / 2.0


def with_ranks(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """df with rank_x and rank_y over the rows where both are present."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns(
        {"rank_x": average_rank(x, keys), "rank_y": average_rank(y, keys)}
    )


def zscore(x: Column | str, keys: list[str]) -> Column:
    """Window: population z-score within ``keys``, 0 for a constant series."""
    x, w = col(x).cast("double"), Window.partitionBy(*keys)
    return F.coalesce(F.try_divide(x - F.avg(x).over(w), F.stddev_pop(x).over(w)), F.lit(0.0))


def quantile(x: Column | str, q: float, keys: list[str]) -> Column:
    """Window: exact linear quantile within ``keys``."""
    return F.percentile(col(x).cast("double"), F.lit(q)).over(Window.partitionBy(*keys))


def robust_unit(x: Column | str, keys: list[str]) -> Column:
    """Window: x from its 1st to its 99th percentile as 0..1; the range where these meet; 0 if constant."""
    x = col(x).cast("double")
    w = Window.partitionBy(*keys)
    low, high = quantile(x, 0.01, keys), quantile(x, 0.99, keys)
    flat = high <= low
    low, high = F.when(flat, F.min(x).over(w)).otherwise(low), F.when(flat, F.max(x).over(w)).otherwise(high)
    unit = F.try_divide(x - low, high - low)
    return F.when(x.isNotNull(), F.coalesce(F.least(F.greatest(unit, F.lit(0.0)), F.lit(1.0)), F.lit(0.0)))


#: 41 edges of 40 equal bins over [-1, 1]; the last bin is closed at both ends.
EDGES = [i * 0.05 - 1.0 for i in range(40)] + [1.0]


def histogram_bin(x: Column | str) -> Column:
    """Bin 0..39 of a correlation; null outside [-1, 1] and for NaN."""
    x = col(x)
    below = F.size(F.filter(F.array(*map(F.lit, EDGES)), lambda e: e <= x))
    return F.when(x.between(-1.0, 1.0) & ~F.isnan(x), F.least(below, F.lit(40)) - 1)


def histogram(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """(keys, bin, n) with every bin of every key, empty ones 0."""
    bins = df.sparkSession.range(40).select(F.col("id").cast("int").alias("bin"))
    counts = df.withColumn("bin", histogram_bin(x)).groupBy(*keys, "bin").agg(F.count("*").alias("n")).filter("bin is not null")
    spine = df.select(*keys).distinct().crossJoin(F.broadcast(bins))  # 40 rows to the key
    return spine.join(counts, [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def bhattacharyya(p: Column, q: Column) -> Column:
    """Aggregate: distance of two distributions from their bins' shares."""
    return -F.ln(F.greatest(F.sum(F.sqrt(p * q)), F.lit(1e-12)))
