"""Quality-control features: plate context, window summaries, derived ratios, spatial shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectrace.functions.exprs import ratio


def plate_context(rows: DataFrame, value: str, active: Column, keys: list[str]) -> DataFrame:
    """Per plate and frame: share of active wells, median activity and its median absolute deviation."""
    median = lambda c: F.percentile(c, F.lit(0.5))
    x = F.col(value).cast("double")
    centred = rows.withColumns({"_active": active, "_median": median(x).over(Window.partitionBy(*keys))})
    return centred.groupBy(*keys).agg(
        F.count("*").alias("n_wells"), F.avg(F.when(F.col("_active"), 1.0).otherwise(0.0)).alias("plate_well_active_fraction"),
        F.max("_median").alias("plate_activity_median"), median(F.abs(x - F.col("_median"))).alias("plate_activity_dispersion"),
    )


def directional_resultant(rows: DataFrame, dx: str, dy: str, keys: list[str]) -> DataFrame:
    """Length of the mean direction of the wells' motion: 1 where all move alike, 0 without motion."""
    length = F.hypot(F.col(dx).cast("double"), F.col(dy).cast("double"))
    unit = lambda c: F.when(length > 0, F.col(c) / length)
    return rows.groupBy(*keys).agg(F.coalesce(F.hypot(F.avg(unit(dx)), F.avg(unit(dy))), F.lit(0.0)).alias("plate_motion_directional_resultant"))


def window_summary(rows: DataFrame, value: str, active: Column, keys: list[str], seconds: float = 1.0) -> DataFrame:
    """Per window: median, p95, max, trapezoid area to the next frame of the window, active share."""
    by = [*keys, "window_index"]
    work = rows.withColumn("window_index", F.floor(F.col("time_seconds") / seconds).cast("long"))
    ahead = Window.partitionBy(*by).orderBy("time_seconds", "frame_index")
    step = (F.lead("time_seconds").over(ahead) - F.col("time_seconds")) * (F.lead(value).over(ahead) + F.col(value)) / 2.0
    work = work.withColumns({"_area": step, "_active": active})
    x = F.col(value).cast("double")
    return work.groupBy(*by).agg(
        F.percentile(x, F.lit(0.5)).alias("median"), F.percentile(x, F.lit(0.95)).alias("p95"), F.max(x).alias("max"),
        F.coalesce(F.sum("_area"), F.lit(0.0)).alias("auc"), F.avg(F.when(F.col("_active"), 1.0).otherwise(0.0)).alias("active_frame_fraction"),
    )


def floored_ratio(top: Column | str, bottom: Column | str, floor: float) -> Column:
    """top over bottom, the bottom no smaller than the versioned floor."""
    bottom = F.col(bottom) if isinstance(bottom, str) else bottom
    return ratio(top, F.greatest(bottom.cast("double"), F.lit(floor)))


def centroid_displacement(rows: DataFrame, keys: list[str], x: str = "motion_centroid_x_norm", y: str = "motion_centroid_y_norm") -> DataFrame:
    """Distance of each frame's centroid from the one before; null where either is missing."""
    w = Window.partitionBy(*keys).orderBy("frame_index")
    return rows.withColumn("motion_centroid_displacement", F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)))


def duplicate_like(rows: DataFrame, keys: list[str], change: str = "sum_absdiff") -> DataFrame:
    """Share of frames after the first that do not differ from the one before at all."""
    later = F.row_number().over(Window.partitionBy(*keys).orderBy("frame_index")) > 1
    flags = rows.withColumn("_same", F.when(later, F.when(F.col(change) == 0, 1.0).otherwise(0.0)))
    return flags.groupBy(*keys).agg(F.coalesce(F.avg("_same"), F.lit(0.0)).alias("duplicate_like_frame_fraction"))


def synchronous_fraction(rows: DataFrame, active: Column, plate: list[str], well: list[str], share: float = 0.5) -> DataFrame:
    """Per well: share of its active frames in which at least ``share`` of the plate's wells are active."""
    work = rows.withColumn("_active", F.when(active, 1.0).otherwise(0.0))
    work = work.withColumn("_plate", F.avg("_active").over(Window.partitionBy(*plate)))
    hit = F.when((F.col("_active") > 0) & (F.col("_plate") >= share), 1).otherwise(0)
    return work.groupBy(*well).agg(ratio(F.sum(hit), F.sum("_active")).alias("plate_synchronous_active_frame_fraction"))


def wall_fraction(gridded: DataFrame, keys: list[str], rows: int = 4, cols: int = 4) -> DataFrame:
    """Share of the vectors in border cells of the grid, per frame."""
    r, c = F.floor(F.col("grid_bin") / cols), F.col("grid_bin") % cols
    wall = (r == 0) | (r == rows - 1) | (c == 0) | (c == cols - 1)
    return gridded.groupBy(*keys, "frame_index").agg(F.avg(F.when(wall, 1.0).otherwise(0.0)).alias("motion_wall_fraction"))


def radial_shares(gridded: DataFrame, keys: list[str], rings: int = 4) -> DataFrame:
    """Vectors by ring of normalised distance from the centre: (keys, ring, n, share)."""
    r = F.hypot(F.col("dst_x_norm") - 0.5, F.col("dst_y_norm") - 0.5) / 0.7071067811865476
    ring = F.least(F.floor(r * rings), F.lit(rings - 1)).cast("int").alias("ring")
    counts = gridded.groupBy(*keys, ring).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))
