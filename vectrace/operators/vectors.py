"""Motion vectors: derivation, sampling, frame summaries, report queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrace.functions.exprs import in_range, in_source, on_lattice, ratio

EPSILON = 1e-12


def derive(vectors: DataFrame) -> DataFrame:
    """dx_px, dy_px and magnitude_px from the block's two positions."""
    wide = {c: F.col(c).cast("int") for c in ("src_x", "src_y", "dst_x", "dst_y")}  # 16-bit columns overflow
    out = vectors.withColumns({"dx_px": wide["dst_x"] - wide["src_x"], "dy_px": wide["dst_y"] - wide["src_y"]})
    return out.withColumn("magnitude_px", F.hypot(F.col("dx_px").cast("double"), F.col("dy_px").cast("double")))


def sampled(
    source: str = "all", frame_stride: int = 1, spatial_stride: int = 1, min_magnitude: float = 0.0, block: int = 16
) -> Column:
    """The sampling predicate: direction, every n-th frame, every k-th block, least magnitude."""
    in_range("frame_stride", frame_stride, 1, 4096)
    in_range("spatial_stride", spatial_stride, 1, 4096)
    in_range("block", block, 1, 4096)
    in_range("min_magnitude", min_magnitude, 0.0, float("inf"))
    return (
        in_source("source", source)
        & (F.col("frame_index") % frame_stride == 0)
        & on_lattice("dst_x", "dst_y", block, spatial_stride)
        & (F.col("magnitude_px") >= min_magnitude)
    )


def output(vectors: DataFrame, mode: str = "all", **dials) -> DataFrame:
    """The vectors written in a mode: all of them (no dial applies), the sampled ones, or none."""
    if mode == "all":
        return vectors
    if mode == "none":
        return vectors.filter(F.lit(False))
    if mode == "sampled":
        return vectors.filter(sampled(**dials))
    raise ValueError(f"unknown output mode {mode!r}")


def counters(vectors: DataFrame, mode: str = "all", frame_stride: int = 1, **dials) -> DataFrame:
    """One row: raw_vectors, candidate_vectors, written_vectors, sampled_frames, frames_with_vectors."""
    picked = sampled(frame_stride=frame_stride, **dials)
    written = {"all": F.lit(True), "sampled": picked, "none": F.lit(False)}[mode]
    count = lambda test: F.count(F.when(test, 1))
    return vectors.agg(
        F.count("*").alias("raw_vectors"), count(picked).alias("candidate_vectors"), count(written).alias("written_vectors"),
        F.count_distinct(F.when(F.col("frame_index") % frame_stride == 0, F.col("frame_index"))).alias("sampled_frames"),
        F.count_distinct("frame_index").alias("frames_with_vectors"),
    )


def frame_summary(vectors: DataFrame, frames: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per frame: n_vectors, means, exact quantiles, sum, resultant and coherence of the magnitudes.

    With ``frames`` (its keys and frame_index) every frame has a row, zero where it has no vector.
    """
    by = [*keys, "frame_index"]
    mag = F.col("magnitude_px").cast("double")
    out = vectors.groupBy(*by).agg(
        F.count("*").cast("long").alias("n_vectors"),
        F.avg("dx_px").alias("mean_dx_px"), F.avg("dy_px").alias("mean_dy_px"), F.avg(mag).alias("mean_magnitude_px"),
        F.percentile(mag, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.95))).alias("_q"),
        F.max(mag).alias("max_magnitude_px"), F.sum(mag).alias("sum_magnitude_px"),
        F.hypot(F.sum("dx_px").cast("double"), F.sum("dy_px").cast("double")).alias("resultant_magnitude_px"),
    )
    out = out.withColumns({
        "median_magnitude_px": F.col("_q")[0], "p90_magnitude_px": F.col("_q")[1], "p95_magnitude_px": F.col("_q")[2],
        "coherence": F.when(F.col("sum_magnitude_px") > 0, F.col("resultant_magnitude_px") / (F.col("sum_magnitude_px") + EPSILON)).otherwise(F.lit(0.0)),
    }).drop("_q")
    if frames is None:
        return out
    filled = frames.select(*by).join(out, by, "left")
    return filled.select(*by, *[F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c) for c, t in out.dtypes if c not in by])


def overlay_filter(
    vectors: DataFrame, frames: DataFrame | None, keys: tuple[str, ...] = (), magnitude: tuple[float, float | None] = (0.0, None),
    energy: tuple[float | None, float | None] = (None, None), coherence: tuple[float | None, float | None] = (None, None),
) -> DataFrame:
    """Vectors in a magnitude band, of frames whose summary lies in the given bands; frames without one pass."""
    low, high = magnitude
    out = vectors.filter(F.col("magnitude_px") >= low)
    if high is not None:
        out = out.filter(F.col("magnitude_px") <= high)
    tests = [(c, b, up) for c, band in (("sum_magnitude_px", energy), ("coherence", coherence)) for b, up in zip(band, (False, True), strict=True) if b is not None]
    if not tests:
        return out
    if frames is None:
        raise ValueError("frame gates need the frame summary")
    by = [*keys, "frame_index"]
    gate = F.lit(True)
    for c, bound, up in tests:
        gate = gate & F.coalesce(F.col(f"_{c}") <= bound if up else F.col(f"_{c}") >= bound, F.lit(True))
    side = frames.select(*by, F.col("sum_magnitude_px").alias("_sum_magnitude_px"), F.col("coherence").alias("_coherence"))
    return out.join(side, by, "left").filter(gate).drop("_sum_magnitude_px", "_coherence")


def local_gate(blocks: DataFrame, mean_diff: float = 0.0, max_diff: float = 0.0, changed: int = 0) -> DataFrame:
    """Vectors whose block differs enough from the frame before; a first frame passes only if nothing is asked."""
    if mean_diff <= 0 and max_diff <= 0 and changed <= 0:
        return blocks
    tests = (F.col("block_mean_diff") >= mean_diff) & (F.col("block_max_diff") >= max_diff) & (F.col("block_cd_pixels") >= changed)
    return blocks.filter(F.coalesce(tests, F.lit(False)))


def top_motion_frames(frames: DataFrame, n: int = 25, keys: tuple[str, ...] = ()) -> DataFrame:
    return frames.orderBy(F.desc("sum_magnitude_px"), *keys, "frame_index").limit(n)


def report(frames: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row over each sidecar's frame summary: counts, medians, p95 and the share of frames without vectors.

    Percentiles are exact, so a task holds the distinct values of one sidecar; without keys the table is one.
    """
    q = lambda c, p: F.percentile(F.col(c).cast("double"), F.lit(p))
    return frames.groupBy(*keys).agg(
        F.count("*").alias("frames"), F.sum("n_vectors").cast("long").alias("vectors"),
        q("n_vectors", 0.5).alias("median_vectors_per_frame"), q("sum_magnitude_px", 0.5).alias("median_frame_energy"),
        q("sum_magnitude_px", 0.95).alias("p95_frame_energy"),
        ratio(F.sum(F.when(F.col("n_vectors") == 0, 1).otherwise(0)), F.count("*")).alias("zero_vector_fraction"),
    )


def invariants(frames: DataFrame, vectors: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Frames whose n_vectors disagrees with their rows: (keys, frame_index, n_vectors, rows)."""
    by = [*keys, "frame_index"]
    rows = vectors.groupBy(*by).agg(F.count("*").alias("rows"))
    return (
        frames.select(*by, F.col("n_vectors").cast("long").alias("n_vectors")).join(rows, by, "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long")).filter("n_vectors <> rows")
    )
