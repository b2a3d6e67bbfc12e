"""Annotation logs: history, current label by scope, clip summaries, labels against features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectrace.functions.exprs import elapsed_ms, label_path, truthy

SCOPES = {
    "presentation_annotator_task": ["presentation_id", "annotator_id", "task_id"],
    "presentation_annotator": ["presentation_id", "annotator_id"],
    "clip_annotator": ["clip_id", "annotator_id"],
    "presentation": ["presentation_id"],
    "clip": ["clip_id"],
}
ORDER = ["created_at", "annotation_id"]


def last_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the last in ``order``: where a lookup table repeats a key, its last row holds."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _value(df: DataFrame, column: str, fallback: Column) -> Column:
    """The column where the table has it, even if null there; else the fallback."""
    return F.col(column) if column in df.columns else fallback


def history(
    events: DataFrame, presentations: DataFrame | None = None, clips: DataFrame | None = None, sessions: DataFrame | None = None, inner: bool = False
) -> DataFrame:
    """Normalised annotation events with what their presentation, clip and session add.

    ``inner`` drops events without presentation or clip, as the database import does; otherwise they
    stay.  Labels are parsed from JSON lists or from text parted by slashes, and anything else gives
    no label.  An empty primary label is made from the path.
    """
    out = events
    how = "inner" if inner else "left"
    for side, key, kind in ((presentations, "presentation_id", how), (clips, "clip_id", how), (sessions, "annotation_session_id", "left")):
        if side is not None:
            extra = [c for c in side.columns if c == key or c not in out.columns]
            out = out.join(side.select(*extra), key, kind)
    path = label_path(_value(out, "label_path_json", F.lit(None).cast("string")))
    out = out.withColumn("label_path", path)
    joined = F.array_join("label_path", " / ")
    primary = F.col("primary_label_path") if "primary_label_path" in out.columns else F.lit("")
    at = lambda i: F.coalesce(F.get("label_path", F.lit(i)), F.lit(""))
    return out.withColumns({
        "primary_label_path": F.when(F.coalesce(primary, F.lit("")) == "", joined).otherwise(primary),
        "label_depth": F.size("label_path"), "label_0": at(0), "label_1": at(1), "label_2": at(2),
        "decision_elapsed_ms": elapsed_ms(_value(out, "decision_timestamps_json", F.lit(None).cast("string"))),
        "skipped": truthy(_value(out, "skipped", F.lit("0"))),
        "was_review_flagged": truthy(_value(out, "was_review_flagged", F.lit("0"))),
    })


def chosen(rows: DataFrame, task: str | None = None, annotator: str | None = None, taxonomy: str | None = None) -> DataFrame:
    """Rows of a task, annotator and taxonomy; an empty option asks for nothing."""
    for column, value in (("task_id", task), ("annotator_id", annotator), ("taxonomy_version", taxonomy)):
        if value:
            rows = rows.filter(F.col(column).cast("string") == value)
    return rows


def current(rows: DataFrame, scope: str = "presentation_annotator_task") -> DataFrame:
    """The latest row of each key of the scope, by (created_at, annotation_id) as text."""
    if scope not in SCOPES:
        raise ValueError(f"unknown latest scope {scope!r}")
    rank = F.row_number().over(Window.partitionBy(*SCOPES[scope]).orderBy(*[F.desc(c) for c in ORDER]))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def clip_summary(rows: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Per clip: counts, its annotators and labels as text, consensus, disagreement; ``carry`` from the last row."""
    kept = F.col("skipped") == 0
    labels = F.array_sort(F.collect_set(F.when(kept, F.col("primary_label_path"))))
    newest = F.struct(*ORDER)
    out = rows.groupBy("clip_id").agg(
        F.count("*").alias("n_current_annotations"), F.count(F.when(kept, 1)).alias("n_non_skipped_annotations"),
        F.sum("was_review_flagged").alias("n_review_flagged"),
        F.array_join(F.array_sort(F.collect_set("annotator_id")), ";").alias("annotator_ids"), labels.alias("_labels"),
        F.max("created_at").alias("latest_created_at"), *[F.max_by(c, newest).alias(c) for c in carry or []],
    )
    return out.withColumns({
        "primary_label_paths": F.array_join("_labels", ";"),
        "consensus_primary_label_path": F.when(F.size("_labels") == 1, F.col("_labels")[0]).otherwise(F.lit("")),
        "has_label_disagreement": (F.size("_labels") > 1).cast("int"),
        "all_skipped": (F.col("n_non_skipped_annotations") == 0).cast("int"),
    }).drop("_labels")


def label_feature_summary(clips: DataFrame, features: DataFrame, names: list[str], label: str = "consensus_primary_label_path") -> DataFrame:
    """Count and medians of clip features by label, most frequent first; a missing label is a group of its own."""
    both = clips.select("clip_id", F.col(label).alias("label")).join(features, "clip_id")
    out = both.groupBy("label").agg(
        F.count("*").alias("n_clips"), *[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(f"{c}_median") for c in names]
    )
    return out.orderBy(F.desc("n_clips"), "label")


def feature_bin_summary(bins: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """Per key: number of bins and the mean and maximum of each feature."""
    return bins.groupBy(*keys).agg(
        F.count("*").alias("n_feature_bins"), *[f(c).alias(f"{c}_{n}") for c in names for n, f in (("mean", F.avg), ("max", F.max))]
    )


def label_intervals(labels: DataFrame, features: DataFrame, keys: list[str], bucket: float = 10.0) -> DataFrame:
    """Feature rows inside the labelled time windows [start_time_s, end_time_s) of their trace.

    Windows and rows meet by (keys, bucket of seconds), so the range test only runs within a bucket.
    """
    first, last = F.floor(F.col("start_time_s") / bucket).cast("long"), F.floor(F.col("end_time_s") / bucket).cast("long")
    spread = labels.filter(F.col("end_time_s") > F.col("start_time_s")).withColumn("_bucket", F.explode(F.sequence(first, last)))
    rows = features.withColumn("_bucket", F.floor(F.col("time_seconds") / bucket).cast("long"))
    inside = (F.col("time_seconds") >= F.col("start_time_s")) & (F.col("time_seconds") < F.col("end_time_s"))
    return rows.join(spread, [*keys, "_bucket"]).filter(inside).drop("_bucket")
