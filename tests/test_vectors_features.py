import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vectrace.functions import exprs, stats
from vectrace.operators import features, runs, vectors

MAGNITUDES = {0: (0, 0), 1: (1, 0), 2: (1, 1), 3: (1, 0), 4: (0, 0)}


@pytest.fixture
def clip(spark):
    """Five frames with two past vectors each and one future vector."""
    frames = [("c", f, f, f * 0.01, 0.2 * f, 0.0) for f in range(5)]
    rows = [("c", f, -1, i, 16, 16, 8 + 16 * i, 8 + 16 * f, m, 0, float(m)) for f, ms in MAGNITUDES.items() for i, m in enumerate(ms)]
    rows.append(("c", 2, 1, 99, 16, 16, 64, 64, 100, 0, 100.0))
    return (
        spark.createDataFrame(frames, "clip string, frame_index long, pts long, time_seconds double, coherence double, resultant_magnitude_px double"),
        spark.createDataFrame(rows, "clip string, frame_index long, source int, vector_index int, w int, h int, dst_x int, dst_y int, dx_px int, dy_px int, magnitude_px double"),
    )


def test_frame_features_of_the_fixture(clip):
    out = features.frame_features(*clip, ["clip"], min_blocks=1, grid=(2, 2)).orderBy("frame_index").collect()
    assert out[2].analysis_n_vectors == 2  # the future vector is left out
    assert [r.mv_active_vectors for r in out] == [0, 1, 2, 1, 0]
    assert [r.mv_active_run_frames for r in out] == [0, 3, 3, 3, 0]
    assert [r.mv_bout_active_vectors for r in out] == [0, 1, 2, 1, 0]
    assert out[2].mvaf == 1.0 and out[0].motion_centroid_x_norm is None and out[0].spatial_entropy == 0.0


def test_temporal_bins_of_the_fixture(clip):
    ff = features.frame_features(*clip, ["clip"], min_blocks=1, grid=(2, 2), capped=1)
    bins = {r.bin_index: r for r in features.temporal_bins(ff, ["clip"], [20]).collect()}
    first, second = bins[0], bins[1]
    assert (first.n_frames, first.frame_index_start, first.frame_index_end, first.mv_active_vectors_sum, first.mv_active_frame_fraction) == (2, 0, 1, 1, 0.5)
    assert (second.mv_active_vectors_sum, second.mvaf_peak) == (3, 1.0)
    assert len(bins[0].asDict()) == 35 + 2


def test_frames_without_vectors_and_empty_tables(spark, clip):
    frames, vecs = clip
    alone = features.frame_features(frames, vecs.limit(0), ["clip"]).collect()
    assert all(r.analysis_n_vectors == 0 and r.mvaf == 0.0 and not r.mv_active_frame for r in alone) and len(alone) == 5
    summary = vectors.frame_summary(vecs.limit(0), frames, ("clip",)).collect()
    assert all(r.n_vectors == 0 and r.coherence == 0.0 for r in summary)


def test_one_cell_entropy_is_defined(clip):
    out = features.frame_features(*clip, ["clip"], min_blocks=1, grid=(1, 1)).filter("frame_index = 2").first()
    assert math.isclose(out.spatial_entropy, -1.000089, abs_tol=1e-4)


def test_runs_count_whole_runs(spark):
    rows = [("a", i, x) for i, x in enumerate([False, True, True, False, True])] + [("b", 0, True), ("b", 9, None), ("b", 12, True)]
    df = spark.createDataFrame(rows, "k string, i long, on boolean")
    out = {(r.k, r.i): r.run for r in runs.with_runs(df, F.col("on"), ["k"], ["i"]).collect()}
    assert [out["a", i] for i in range(5)] == [0, 2, 2, 0, 1] and [out["b", i] for i in (0, 9, 12)] == [1, 0, 1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.booleans(), min_size=1, max_size=30))
def test_run_lengths_add_up(spark, flags):
    df = spark.createDataFrame(list(enumerate(flags)), "i long, on boolean").withColumn("k", F.lit(1))
    lengths = [r.run for r in runs.with_runs(df, F.col("on"), ["k"], ["i"]).orderBy("i").collect()]
    assert all((x > 0) == f for x, f in zip(lengths, flags, strict=True))
    assert math.isclose(sum(1 / x for x in lengths if x), sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags)))


def test_sampling_dials(spark, clip):
    _, vecs = clip
    assert vectors.output(vecs, "all", source="past").count() == 11  # no dial applies
    assert vectors.output(vecs, "none").count() == 0
    assert vectors.output(vecs, "sampled", source="future").count() == 1
    assert vectors.output(vecs, "sampled", frame_stride=2, min_magnitude=1.0).count() == 3
    for bad in (dict(source="up"), dict(frame_stride=0), dict(min_magnitude=-1.0)):
        with pytest.raises(ValueError):
            vectors.output(vecs, "sampled", **bad)
    with pytest.raises(ValueError):
        vectors.output(vecs, "some")
    lattice = spark.createDataFrame([(-20, 0), (-10, 0), (16, 0), (32, 48)], "x int, y int").filter(exprs.on_lattice("x", "y", 16, 2))
    assert [tuple(r) for r in lattice.collect()] == [(-10, 0)]  # division truncates toward zero


def test_derivation_does_not_overflow(spark):
    df = spark.createDataFrame([(-30000, 30000, 0, 0)], "src_x short, dst_x short, src_y short, dst_y short")
    assert vectors.derive(df).first().dx_px == 60000


def test_bins_follow_ieee_division(spark):
    df = spark.createDataFrame([(0.15,), (0.3,)], "t double")
    assert df.select(exprs.bin_index("t", 0.05)).first()[0] == 2


def test_guarded_statistics(spark):
    df = spark.createDataFrame([("c", 1.0, 5.0), ("c", 2.0, 5.0), ("d", 1.0, 2.0), ("d", 2.0, 4.0), ("d", 3.0, 6.0), ("e", 1.0, 1.0)], "k string, x double, y double")
    r = {x.k: x.r for x in df.groupBy("k").agg(stats.pearson("x", "y").alias("r")).collect()}
    assert r["c"] is None and r["e"] is None and math.isclose(r["d"], 1.0)
    z = df.withColumn("z", stats.zscore("y", ["k"])).collect()
    assert all(x.z == 0 for x in z if x.k in "ce")
    ties = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, 3.0)], "k int, x double").withColumn("r", stats.average_rank("x", ["k"]))
    assert sorted(x.r for x in ties.collect()) == [1.5, 1.5, 3.0]


def test_histogram_is_closed_on_the_right(spark):
    import numpy as np

    values = [-1.0, -0.9, -0.8, 0.0, 0.05, 0.95, 1.0, 1.5, float("nan"), -0.95]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(stats.histogram_bin("x").alias("b")).collect()
    counts = np.histogram([v for v in values if v == v], bins=np.linspace(-1, 1, 41))[0]
    assert np.bincount([r.b for r in got if r.b is not None], minlength=40).tolist() == counts.tolist()


def test_overlay_and_reports(clip):
    frames, vecs = clip
    summary = vectors.frame_summary(vecs, frames, ("clip",))
    assert vectors.overlay_filter(vecs, summary, ("clip",), (1.0, 50.0), (1.5, None)).count() == 2
    assert vectors.overlay_filter(vecs, summary.filter("frame_index = 9"), ("clip",), (0.0, None), (1.5, None)).count() == 11
    with pytest.raises(ValueError):
        vectors.overlay_filter(vecs, None, energy=(1.0, None))
    assert vectors.invariants(summary, vecs, ("clip",)).count() == 0
    report = vectors.report(summary).first()
    assert (report.frames, report.vectors, report.zero_vector_fraction) == (5, 11, 0.0)
    assert vectors.top_motion_frames(summary, 1).first().frame_index == 2
