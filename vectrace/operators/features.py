"""Frame features and temporal bins: the flagship plan.

One aggregation on (keys, frame) holds all per-vector figures, the grid cells included, as filtered
aggregates, and meets the frames in a left join on the same keys; runs of active frames are a window
over the clip; all bin widths come from one expansion.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrace.functions.exprs import EPS, bin_index, in_source, normalised, ratio
from vectrace.operators.runs import with_runs


#: Extents of up to so many clips are broadcast (five numbers each, some 8 MB); of more, joined by shuffle.
BROADCAST_CLIPS = 100_000
#: Grids of up to so many cells are counted inside the aggregation of a frame.
INLINE_CELLS = 64


def spatial_extent(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x0, x1, y0, y1): bounds of all blocks, 0..1 where they have no width."""
    sides = {}
    for axis, size in (("x", "w"), ("y", "h")):
        half = F.greatest(F.coalesce(F.col(size).cast("double"), F.lit(1.0)), F.lit(1.0)) / 2.0
        at = F.col(f"dst_{axis}").cast("double")
        sides |= {f"{axis}0": F.min(at - half), f"{axis}1": F.max(at + half)}
    out = vectors.groupBy(*keys).agg(*[c.alias(n) for n, c in sides.items()])
    for axis in "xy":
        good = F.col(f"{axis}1") > F.col(f"{axis}0")
        out = out.withColumns({
            f"{axis}0": F.when(good, F.col(f"{axis}0")).otherwise(F.lit(0.0)),
            f"{axis}1": F.when(good, F.col(f"{axis}1")).otherwise(F.lit(1.0)),
        })
    return out


def with_grid(vectors: DataFrame, extent: DataFrame, keys: list[str], rows: int = 4, cols: int = 4) -> DataFrame:
    """Vectors with dst_x_norm, dst_y_norm and the row-major grid_bin."""
    if keys:
        found = extent.limit(BROADCAST_CLIPS + 1).collect()
        small = extent.sparkSession.createDataFrame(found[:BROADCAST_CLIPS], extent.schema)
        out = vectors.join(F.broadcast(small) if len(found) <= BROADCAST_CLIPS else extent, keys)
    else:
        out = vectors.crossJoin(F.broadcast(extent))  # one row
    out = out.withColumns({
        "dst_x_norm": normalised(F.col("dst_x"), F.col("x0"), F.col("x1")),
        "dst_y_norm": normalised(F.col("dst_y"), F.col("y0"), F.col("y1")),
    })
    cell = F.floor(F.col("dst_y_norm") * rows) * cols + F.floor(F.col("dst_x_norm") * cols)
    return out.withColumn("grid_bin", cell.cast("int")).drop("x0", "x1", "y0", "y1")


def grid_counts(vectors: DataFrame, keys: list[str]) -> DataFrame:
    return vectors.groupBy(*keys, "frame_index", "grid_bin").agg(F.count("*").alias("bin_count"))


def _shares(table: DataFrame, cells: int) -> DataFrame:
    """Spatial features from (by, t, sx, sy, ns): vectors, summed coordinates and the counts of the occupied cells."""
    p = lambda n: n / F.greatest(F.col("t").cast("double"), F.lit(EPS))
    entropy = -F.aggregate("ns", F.lit(0.0), lambda acc, n: acc + p(n) * F.ln(p(n) + EPS)) / max(math.log(cells), EPS)
    return table.withColumns({
        "active_spatial_bin_fraction": F.size("ns") / F.lit(float(cells)), "spatial_entropy": entropy, "max_bin_fraction": p(F.array_max("ns")),
        "motion_centroid_x_norm": F.col("sx") / F.col("t"), "motion_centroid_y_norm": F.col("sy") / F.col("t"),
    }).drop("t", "sx", "sy", "ns")


def spatial_features(active: DataFrame, keys: list[str], rows: int = 4, cols: int = 4) -> DataFrame:
    """Per frame with an active vector: occupied share of cells, normalised entropy, largest cell's share, centroid.

    The entropy's divisor is ln(cells), but at least 1e-12 so that a single cell is defined.
    """
    by = [*keys, "frame_index"]
    counted = active.groupBy(*by, "grid_bin").agg(
        F.count("*").alias("n"), F.sum("dst_x_norm").alias("sx"), F.sum("dst_y_norm").alias("sy")
    )
    total = counted.groupBy(*by).agg(
        F.sum("n").alias("t"), F.sum("sx").alias("sx"), F.sum("sy").alias("sy"), F.collect_list("n").alias("ns"),  # at most rows x cols
    )
    return _shares(total, rows * cols)


def frame_features(
    frames: DataFrame, vectors: DataFrame, keys: list[str], source: str = "past", threshold: float = 0.0,
    min_blocks: int = 2, min_run: int = 2, grid: tuple[int, int] = (4, 4), capped: int = 6, spatial: bool = True,
) -> DataFrame:
    """Every frame with its columns and the derived motion features; frames without vectors are 0.

    Frames are ordered by frame_index within ``keys``.  Centroids stay null without active vectors.
    """
    by = [*keys, "frame_index"]
    mag, active = F.col("magnitude_px").cast("double"), F.col("magnitude_px") > threshold
    chosen = vectors.filter(in_source("source", source))
    cells = grid[0] * grid[1]
    inline = spatial and cells <= INLINE_CELLS
    gridded = with_grid(chosen, spatial_extent(chosen, keys), keys, *grid) if spatial else chosen
    counted = []
    if inline:
        cell = lambda i: F.count(F.when(active & (F.col("grid_bin") == i), 1))
        sums = [F.sum(F.when(active, F.col(f"dst_{a}_norm"))).alias(f"s{a}") for a in "xy"]
        counted = [*sums, F.filter(F.array(*map(cell, range(cells))), lambda n: n > 0).alias("ns")]
    agg = (gridded if inline else chosen).groupBy(*by).agg(
        F.count("*").alias("analysis_n_vectors"), F.sum(mag).alias("analysis_motion_energy"),
        F.avg(mag).alias("analysis_mean_magnitude_px"), F.percentile(mag, F.lit(0.95)).alias("analysis_p95_magnitude_px"),
        F.sum(F.col("dx_px").cast("double")).alias("analysis_sum_dx_px"), F.sum(F.col("dy_px").cast("double")).alias("analysis_sum_dy_px"),
        F.count(F.when(active, 1)).alias("mv_active_vectors"), F.sum(F.when(active, mag)).alias("mv_active_motion_energy"),
        F.avg(F.when(active, mag)).alias("mv_active_mean_magnitude_px"), *counted,
    )
    plain = [(c, t) for c, t in agg.dtypes if c not in (*by, "sx", "sy", "ns")]
    if inline:
        agg = _shares(agg.withColumn("t", F.col("mv_active_vectors")), cells)
    out = frames.join(agg, by, "left")
    counts = ("analysis_n_vectors", "mv_active_vectors")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(t)).cast("long" if c in counts else "double") for c, t in plain})
    n, a = F.col("analysis_n_vectors"), F.col("mv_active_vectors")
    share = lambda x: F.when(n > 0, ratio(x, n)).otherwise(F.lit(0.0))
    out = out.withColumns({"mvaf": share(a), "mv_active_frame": a >= min_blocks})
    out = with_runs(out, F.col("mv_active_frame"), keys, ["frame_index"], "mv_active_run_frames")
    bout = F.col("mv_active_run_frames") >= min_run
    out = out.withColumns({
        "mv_bout_frame": bout,
        "mv_bout_active_vectors": F.when(bout, a).otherwise(F.lit(0)).cast("long"),
        "mv_bout_motion_energy": F.when(bout, F.col("mv_active_motion_energy")).otherwise(F.lit(0.0)),
    })
    out = out.withColumns({
        "mv_bout_fraction": share(F.col("mv_bout_active_vectors")),
        "mv_capped_active_fraction": share(F.least(a, F.lit(capped))),
        "mv_log_active_fraction": F.when(n > 0, ratio(F.log1p(a), F.log1p(n))).otherwise(F.lit(0.0)),
        "mv_inverse_saturation_fraction": F.col("mvaf") * F.pow(F.greatest(1.0 - F.col("mvaf"), F.lit(0.0)), F.lit(2.0)),
    })
    if spatial:
        if not inline:
            out = out.join(spatial_features(gridded.filter(active), keys, *grid), by, "left")
        zero = ("active_spatial_bin_fraction", "spatial_entropy", "max_bin_fraction")
        out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in zero})
    return out.withColumn("vector_source_filter", F.lit(source))


def temporal_bins(features: DataFrame, keys: list[str], bin_ms: list[int] | tuple[int, ...] = (50, 100, 250)) -> DataFrame:
    """One row per (keys, bin_ms, bin_index) with a frame in it; all widths in one aggregation."""
    rows = features.withColumn("bin_ms", F.explode(F.array(*[F.lit(b) for b in bin_ms])))
    width = F.col("bin_ms") / F.lit(1000.0)
    rows = rows.withColumn("bin_index", bin_index("time_seconds", width))
    active, bout = F.col("mv_active_frame"), F.col("mv_bout_frame")
    median = lambda c: F.percentile(F.col(c).cast("double"), F.lit(0.5))
    share = lambda flag: F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0)))
    aggs: dict[str, Column] = {
        "frame_index_start": F.min("frame_index"), "frame_index_end": F.max("frame_index"), "n_frames": F.count("*"),
        "analysis_n_vectors_median": median("analysis_n_vectors"),
        "analysis_motion_energy_sum": F.sum("analysis_motion_energy"), "analysis_motion_energy_mean": F.avg("analysis_motion_energy"),
        "mv_active_vectors_sum": F.sum("mv_active_vectors"), "mv_active_vectors_max": F.max("mv_active_vectors"),
        "mvaf_mean": F.avg("mvaf"), "mvaf_peak": F.max("mvaf"),
        "mv_active_frame_fraction": share(active), "mv_active_frames": F.count(F.when(active, 1)),
        "mv_longest_active_run_frames": F.max("mv_active_run_frames"),
        "mv_bout_fraction_mean": F.avg("mv_bout_fraction"), "mv_bout_fraction_peak": F.max("mv_bout_fraction"),
        "mv_bout_active_vectors_sum": F.sum("mv_bout_active_vectors"), "mv_bout_frame_fraction": share(bout),
    }
    aggs |= {f"{c}_mean": F.avg(c) for c in ("mv_capped_active_fraction", "mv_log_active_fraction", "mv_inverse_saturation_fraction", "coherence")}
    aggs |= {
        "coherence_active_mean": F.coalesce(F.avg(F.when(active, F.col("coherence"))), F.lit(0.0)),
        "resultant_magnitude_px_mean": F.avg("resultant_magnitude_px"), "p95_magnitude_px_peak": F.max("analysis_p95_magnitude_px"),
        "active_spatial_bin_fraction_mean": F.avg("active_spatial_bin_fraction"),
        "active_spatial_bin_fraction_peak": F.max("active_spatial_bin_fraction"),
        "spatial_entropy_mean": F.avg("spatial_entropy"), "max_bin_fraction_mean": F.avg("max_bin_fraction"),
    }
    for axis in "xy":
        c = f"motion_centroid_{axis}_norm"
        aggs |= {f"{c}_mean": F.avg(c), f"{c}_sd": F.coalesce(F.stddev_pop(c), F.lit(0.0))}
    out = rows.groupBy(*keys, "bin_ms", "bin_index").agg(*[c.alias(n) for n, c in aggs.items()])
    return out.withColumns({"time_start_seconds": F.col("bin_index") * width, "time_end_seconds": (F.col("bin_index") + 1) * width})
