"""Streaming queries run to the end of their input; their results equal the batch ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrace.plans import records, views
from vectrace.plans.catalog import query
from vectrace.session import shared_folder
from vectrace.streaming import state


def _shared(spark: SparkSession) -> str:
    return shared_folder(spark, "stream")


def _source(spark: SparkSession, df: DataFrame, files: int = 4) -> DataFrame:
    """The rows as a file stream of several files, read one by one."""
    folder = _shared(spark)
    df.repartition(files).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query(
    "stream_bins", "video:s well:s bin_index:l n_frames:l energy_sum active_vectors_max:l", "tr", "",
    """SELECT video, well, floor(time_seconds / 1.0::DOUBLE)::BIGINT AS bin_index, count(*) AS n_frames, sum(raw_motion_energy) AS energy_sum, max(mv_active_vectors) AS active_vectors_max
 FROM tr GROUP BY ALL""",
)
def stream_bins(spark, d):
    rows = views.traces(spark, d).select("video", "well", "time_seconds", "raw_motion_energy", "mv_active_vectors")
    return state.run_to_end(state.bins(_source(spark, rows), ["video", "well"], 1.0), _shared(spark))


@query(
    "stream_latest", "clip_id:l annotator_id:s annotation_id:l created_at:s", "ann", "",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clip_id, annotator_id ORDER BY created_at DESC, annotation_id DESC) AS rn FROM ann) WHERE rn = 1",
)
def stream_latest(spark, d):
    rows = views.annotations(spark, d).select("clip_id", "annotator_id", "annotation_id", "created_at")
    return state.run_to_end(state.latest(_source(spark, rows), ["clip_id", "annotator_id"], ["created_at", "annotation_id"]), _shared(spark))


@query(
    "stream_runs", "video:s well:s first_frame:l last_frame:l run_frames:l", "tr",
    """ri AS (SELECT *, sum(CASE WHEN mv_active_vectors >= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY video, well ORDER BY frame_index) AS isl FROM tr)""",
    "SELECT video, well, min(frame_index) AS first_frame, max(frame_index) AS last_frame, count(*) AS run_frames FROM ri WHERE mv_active_vectors >= 1 GROUP BY video, well, isl",
)
def stream_runs(spark, d):
    rows = views.traces(spark, d).select("video", "well", "frame_index", (F.col("mv_active_vectors") >= 1).alias("active"))
    # One file holds a whole trace in frame order; later files never reach back.
    folder = _shared(spark)
    rows.repartition(4, "video", "well").sortWithinPartitions("video", "well", "frame_index").write.parquet(folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    found = state.run_to_end(state.runs(stream, ["video", "well"]), _shared(spark), mode="append")
    return state.longest(found, ["video", "well"])


@query(
    "stream_change", "clip:s frame_index:l changed_pixels:l", "", records.SQUARE + f", ch AS (SELECT t, {records.CHANGED.format(k=1)} AS n FROM sq)",
    "SELECT 'square' AS clip, t AS frame_index, n AS changed_pixels FROM ch",
)
def stream_change(spark, d):
    frames, folder = records.moving_square(spark), _shared(spark)
    for low in (0, 25):
        # Files are read in the order they were written; a trace's frames never reach back.
        frames.filter((F.col("frame_index") >= low) & (F.col("frame_index") < low + 25)).coalesce(1).write.mode("append").parquet(folder)
    live = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return state.run_to_end(state.change_from_last(live, ["clip"]), _shared(spark), mode="append")
