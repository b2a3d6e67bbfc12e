"""Structured Streaming: bins, latest rows, runs and lag state over unbounded input."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vectrace.functions.exprs import bin_index


def bins(stream: DataFrame, keys: list[str], seconds: float, late: str | None = None, event_time: str | None = None) -> DataFrame:
    """Per key and bin: frames, summed energy, most active vectors.

    Bins are the batch tables' floor of the quotient.  With ``event_time`` and ``late`` a watermark
    bounds the state: the time joins the group by its window of one bin.
    """
    by = [*[F.col(k) for k in keys], bin_index("time_seconds", seconds).alias("bin_index")]
    if event_time and late:
        stream = stream.withWatermark(event_time, late)
        by.append(F.window(event_time, f"{int(seconds * 1000)} milliseconds").alias("window"))
    return stream.groupBy(*by).agg(
        F.count("*").alias("n_frames"), F.sum("raw_motion_energy").alias("energy_sum"), F.max("mv_active_vectors").alias("active_vectors_max")
    )


def latest(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row of every key, by ``order`` as a whole; one row of state to the key."""
    newest = F.struct(*order)
    rest = [c for c in stream.columns if c not in keys]
    return stream.groupBy(*keys).agg(*[F.max_by(c, newest).alias(c) for c in rest])


def runs(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of active frames: (keys, first_frame, last_frame, run_frames).

    State is one open run to the key; rows of a key must arrive in frame order from batch to batch.
    A run still open when a batch ends is given as it stands and again once it has grown, so of rows
    with one first_frame the longest holds (``longest``).
    """
    kinds = dict(stream.dtypes)
    names = ", ".join(f"{k} {kinds[k]}" for k in keys)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, n = state.get if state.exists else (-1, -1, 0)
        out = []
        rows = pd.concat(list(parts)).sort_values("frame_index", kind="stable")
        for frame, active in zip(rows["frame_index"].tolist(), rows["active"].tolist(), strict=True):
            if active:
                first, last, n = (first, frame, n + 1) if n else (frame, frame, 1)
            elif n:
                out.append((*key, first, last, n))
                n = 0
        if n:
            out.append((*key, first, last, n))
        state.update((first, last, n))
        yield pd.DataFrame(out, columns=[*keys, "first_frame", "last_frame", "run_frames"])

    return stream.groupBy(*keys).applyInPandasWithState(
        step, f"{names}, first_frame long, last_frame long, run_frames long", "first long, last long, n long", "append", GroupStateTimeout.NoTimeout
    )


def longest(found: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows that ``runs`` gave for one run, the last."""
    return found.groupBy(*keys, "first_frame").agg(F.max("last_frame").alias("last_frame"), F.max("run_frames").alias("run_frames"))


def change_from_last(stream: DataFrame, keys: list[str], threshold: int = 10) -> DataFrame:
    """Changed pixels of every frame against the one before, whose plane is the state; a new size starts anew."""
    import numpy as np

    kinds = dict(stream.dtypes)
    names = ", ".join(f"{k} {kinds[k]}" for k in keys)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, width, height = state.get if state.exists else (b"", 0, 0)
        out = []
        for row in pd.concat(list(parts)).sort_values("frame_index", kind="stable").itertuples(index=False):
            gray, changed = bytes(row.gray), 0
            if before and (row.width, row.height) == (width, height):
                a, b = (np.frombuffer(x, dtype=np.uint8).astype(np.int16) for x in (gray, before))
                changed = int((np.abs(a - b) > threshold).sum())
            out.append((*key, int(row.frame_index), changed))
            before, width, height = gray, int(row.width), int(row.height)
        state.update((before, width, height))
        yield pd.DataFrame(out, columns=[*keys, "frame_index", "changed_pixels"])

    return stream.groupBy(*keys).applyInPandasWithState(
        step, f"{names}, frame_index long, changed_pixels long", "gray binary, width int, height int", "append", GroupStateTimeout.NoTimeout
    )


def run_to_end(df: DataFrame, folder: str, mode: str = "complete") -> DataFrame:
    """Run a streaming table over all its present input and return its result as a batch table.

    Complete results replace one another in ``folder``; appended ones add up, each batch in a folder
    of its own so that a batch that is run again replaces itself.
    """
    spark, schema = df.sparkSession, df.schema
    out = f"{folder}/out"
    spark.createDataFrame([], schema).write.parquet(f"{out}/batch=-1")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={0 if mode == 'complete' else number}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(keep)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out).select(*schema.names)
