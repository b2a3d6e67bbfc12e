"""Shared pieces: table access, shared-folder checkpoints, word rules, distributed components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space, tab, newline, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
#: Rows handed to a Python worker at once; bounds its memory when texts are long.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_top(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; a temporary one only where the master is local."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if top:
        return top.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries planned meanwhile delete their shuffle files when they end.

    Else Spark deletes them when the driver happens to collect its garbage, and on a quiet driver those of
    all steps add up.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back, cutting lineage.

    The shuffle files that it took go at once; the written files stay until ``release`` or Spark's cleaner.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(_shared_top(df.sparkSession))
    with shuffles_dropped(df.sparkSession):
        # Planned anew: a plan that ran before has its shuffle files still to be read.
        return df.select("*").checkpoint(eager=True)


def release(*frames: DataFrame) -> None:
    """Delete the files of checkpoints that nothing reads any more, frames derived from them included."""
    for df in frames:
        written = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if written.isDefined():
            delete_folder(df.sparkSession, written.get())


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(column: pa.Array) -> list[str]:
    """The column's strings, nulls as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space, as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), lambda w: w != "")


def _settled(state: DataFrame) -> bool:
    """Whether every node of edges (a > b) points at one node, which points nowhere."""
    twice = state.groupBy("a").count().filter("count > 1")
    onward = state.join(state.select(F.col("a").alias("b")), "b", "left_semi")
    return twice.isEmpty() and onward.isEmpty()


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """Connected components of ``edges(a, b)`` (comparable ids): one row (node, root), root the least id.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), which re-hang each
    neighbourhood on its least node; a node's neighbours are only aggregated to a minimum, never
    gathered, so hubs cost no more than their edges.  Each round is a checkpoint in the shared
    folder, which goes when the next one is written; ``edges`` are read again by the result.  No edges
    give no rows; loops (a = a) give a single node of its own.
    """
    spent: list[DataFrame] = []

    def star(df: DataFrame, large: bool) -> DataFrame:
        both = df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else df
        # Written first, so that the join below has plain exchanges on both sides and a hub's edges can be split.
        low = checkpoint(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        spent.append(low)
        out = both.join(low, "a")
        if large:
            return out.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        hung = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hung.unionByName(low.select("a", F.col("m").alias("b"))).filter("a > b").distinct()

    loops = edges.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    state = checkpoint(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = None
    for _ in range(rounds):
        spent.append(state)
        state = checkpoint(star(star(state, True), False))
        release(*spent)
        spent.clear()
        with shuffles_dropped(state.sparkSession):
            # Stable exactly when every node points at a node that points nowhere.
            mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003)).first()
            if mark == seen and _settled(state):
                break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = state.groupBy("a").agg(F.min("b").alias("b"))
    roots = stars.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return (
        stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        .unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("root").alias("root"))
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder; nothing is created yet."""
    import uuid

    return f"{_shared_top(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written and is read no more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
