"""Runs of true rows: gaps and islands over an ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_runs(df: DataFrame, active: Column, keys: list[str], order: list[str], name: str = "run") -> DataFrame:
    """df with the length of the run of active rows that each active row belongs to, 0 elsewhere.

    Rows follow ``order`` within ``keys``; gaps in its values do not end a run.
    """
    flag = F.coalesce(active, F.lit(False))
    island = F.sum(F.when(flag, 0).otherwise(1)).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    length = F.sum(F.when(flag, 1).otherwise(0)).over(Window.partitionBy(*keys, "_island"))
    return df.withColumn("_island", island).withColumn(name, F.when(flag, length).otherwise(F.lit(0)).cast("long")).drop("_island")


def longest_run(df: DataFrame, active: Column, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, longest_run): runs do not cross the keys."""
    return with_runs(df, active, keys, order, "_run").groupBy(*keys).agg(F.max("_run").alias("longest_run"))
