import math
import re

import pytest
from pyspark.sql import functions as F

from vectrace.functions import exprs
from vectrace.operators import annotations, manifests, profiles, qc, traces


def test_greedy_peaks_equal_a_loop(spark):
    import random

    rng = random.Random(2)
    rows = [(v, t, round(rng.uniform(-1, 3), 1)) for v in "ab" for t in range(60)]
    got = traces.greedy_peaks(spark.createDataFrame(rows, "video string, second_bin long, score double"), ["video"], "second_bin", "score", 4, 5.0)
    for video in "ab":
        taken = []
        for _, t, s in sorted((x for x in rows if x[0] == video), key=lambda x: (-x[2], x[1])):
            if s > 0 and len(taken) < 4 and all(abs(t - u) >= 5 for u in taken):
                taken.append(t)
        picked = sorted(r.second_bin for r in got.filter(F.col("video") == video).collect())
        assert picked == sorted(taken) and all(b - a >= 5 for a, b in zip(picked, picked[1:], strict=False))


def test_later_labels_win(spark):
    points = [(c / 10, m / 10) for c in range(0, 21) for m in range(0, 21)]

    def loop(cd, mv):
        label = "low_both"
        for test, name in (
            (cd >= 1.5 and mv >= 1.5, "high_both_absolute"), (cd >= 1.5 and mv <= 0.5, "cd10_only_strong"), (mv >= 1.5 and cd <= 0.5, "mv_only_strong"),
            (mv >= 1.0 and 0.9 <= cd < 1.0, "cd10_boundary_mv_high"), (cd >= 1.0 and 0.9 <= mv < 1.0, "mv_boundary_cd10_high"),
        ):
            label = name if test else label
        if cd >= 1.0 and mv >= 1.0 and label == "low_both":
            label = "high_both_boundary"
        label = "cd10_high_mv_mid" if cd >= 1.0 and 0.5 < mv < 0.9 else label
        return "mv_high_cd10_mid" if mv >= 1.0 and 0.5 < cd < 0.9 else label

    df = spark.createDataFrame(points, "cd double, mv double")
    got = df.withColumn("c", exprs.ratio_category(F.col("cd"), F.col("mv"), 1.5, 0.5, 0.9, 1.0)).collect()
    assert all(r.c == loop(r.cd, r.mv) for r in got)


@pytest.fixture
def events(spark):
    rows = [
        ("ann-old", "p1", "c1", "rater-a", "t", '["multiple_fish","quiet"]', '[{"at_ms": 10}, {"at_ms": 30}]', "0", "2026-01-01T00:00:01"),
        ("ann-new", "p1", "c1", "rater-a", "t", '["multiple_fish","plausibly_behavioral","stimulus_like_weak"]', '[{"at_ms": 10}, {"at_ms": 40}, {"at_ms": 90}]', "true", "2026-01-01T00:00:02"),
        ("ann-b", "p1", "c1", "rater-b", "t", '"multiple_fish / artifact_dominant"', "", "0", "2026-01-01T00:00:03"),
    ]
    return spark.createDataFrame(rows, "annotation_id string, presentation_id string, clip_id string, annotator_id string, task_id string, label_path_json string, decision_timestamps_json string, was_review_flagged string, created_at string")


def test_annotations_of_the_fixture(spark, events):
    clips = spark.createDataFrame([("c1", "A01")], "clip_id string, well_label string")
    rows = annotations.history(events, clips=clips)
    now = annotations.current(rows).orderBy("created_at").collect()
    assert [r.annotation_id for r in now] == ["ann-new", "ann-b"]
    assert (now[0].label_2, now[0].decision_elapsed_ms, now[0].well_label, now[0].was_review_flagged) == ("stimulus_like_weak", 80.0, "A01", 1)
    assert now[1].decision_elapsed_ms is None and now[1].primary_label_path == "multiple_fish / artifact_dominant"
    summary = annotations.clip_summary(annotations.current(rows), ["well_label"]).collect()
    assert len(summary) == 1 and summary[0].has_label_disagreement == 1 and summary[0].annotator_ids == "rater-a;rater-b" and summary[0].n_review_flagged == 1
    only = annotations.chosen(rows, annotator="rater-a")
    assert (only.count(), annotations.current(only).count()) == (2, 1)
    assert annotations.current(rows, "clip").count() == 1
    with pytest.raises(ValueError):
        annotations.current(rows, "plate")


def test_bad_json_gives_no_label(spark):
    df = spark.createDataFrame([("nope",), (None,), ("[broken",), ('"a / b"',), ('["x"]',)], "j string")
    assert [r.l for r in df.select(exprs.label_path("j").alias("l")).collect()] == [[], [], [], ["a", "b"], ["x"]]


def test_label_intervals_are_half_open(spark):
    marks = spark.createDataFrame([("v", 0.5, 1.5, "x"), ("v", 9.0, 31.0, "y")], "video string, start_time_s double, end_time_s double, label string")
    rows = spark.createDataFrame([("v", t) for t in (0.4, 0.5, 1.5, 9.0, 20.0, 30.9, 31.0)], "video string, time_seconds double")
    got = sorted((r.time_seconds, r.label) for r in annotations.label_intervals(marks, rows, ["video"]).collect())
    assert got == [(0.5, "x"), (9.0, "y"), (20.0, "y"), (30.9, "y")]


def test_manifests_of_the_fixture(spark):
    catalog = spark.createDataFrame([("runA", "", "800"), ("runB", "/b.mkv", "")], "source_video_id string, source_path string, video_width string")
    roi = spark.createDataFrame(
        [("runB", "A01", 0, "1", "2", "31", "42", "", "", "", 1), ("runA", "A01", 1, "10", "20", "30", "40", "20.0", "20.0", "/archive/runA.mkv", 2), ("runA", "A02", 2, "31", "20", "51", "40", "20", "20", "", 3)],
        "source_video_id string, well_label string, well_index int, roi_x0 string, roi_y0 string, roi_x1 string, roi_y1 string, roi_width string, roi_height string, source_path string, row_pos int",
    )
    rows = {(r.source_video_id, r.well_label): r for r in manifests.wells(catalog, roi).collect()}
    assert rows["runB", "A01"].plate_task_id == 1 and rows["runA", "A02"].plate_task_id == 2
    assert rows["runA", "A01"].source_path == "/archive/runA.mkv" and rows["runB", "A01"].source_path == "/b.mkv"
    assert (rows["runB", "A01"].crop_width, rows["runB", "A01"].crop_height) == (30, 40)
    assert rows["runA", "A01"].well_archive_path.endswith("runs/runA/video/runA_A01.av1.mkv")
    kept = manifests.wells(catalog, roi, skip_missing=True)
    assert kept.count() == 2 and {r.n_wells for r in manifests.plates(kept).collect()} == {1}
    assert manifests.missing_sources(catalog, roi).first()[0] == 1
    manifests.check_catalog(catalog, roi)
    for bad_catalog in (catalog.union(catalog), catalog.limit(1)):
        with pytest.raises(manifests.ManifestError):
            manifests.check_catalog(bad_catalog, roi)
    renamed = manifests.normalise_roi(roi.withColumnRenamed("roi_x0", "analysis_roi_x0"))
    assert "roi_x0" in renamed.columns and "analysis_roi_x0" not in renamed.columns
    text = manifests.crop_filter(manifests.wells(catalog, roi), ["source_video_id"], "row_pos").filter("source_video_id = 'runA'").first().crop_filter
    assert text == "[0:v]format=gray,split=2[s0][s1];[s0]crop=20:20:10:20[v0];[s1]crop=20:20:31:20[v1]"


def test_paging_partition_and_sentinels(spark):
    rows = spark.range(1, 6).withColumnRenamed("id", "plate_task_id")
    assert [r[0] for r in manifests.page(rows, 2, 2).collect()] == [3, 4]
    with pytest.raises(IndexError):
        manifests.page(rows, 2, 4)
    sizes = manifests.balanced(spark.range(10).withColumn("k", F.lit(1)), 3, ["k"], ["id"]).groupBy("group").count().orderBy("group").collect()
    assert [r["count"] for r in sizes] == [4, 3, 3]
    at = lambda n, k: spark.range(1).select(exprs.sentinels(F.lit(n), k)).first()[0]
    assert at(96, 5) == [0, 24, 48, 71, 95] and at(2, 5) == [0, 1] and at(96, 0) == [] and at(9, 1) == [4] and at(0, 3) == []


def test_validation_rules(spark):
    wells = spark.createDataFrame([("p", i, 20, 20) for i in range(5)], "plate string, well int, crop_width int, crop_height int")
    probe = spark.createDataFrame([(0, "av1", 20, 20, 100), (1, "h264", 20, 20, 100), (2, "av1", 22, 20, 100), (3, "av1", 20, 20, 0)], "well int, codec_name string, width int, height int, packet_count long")
    got = {(r.well, r.rule) for r in manifests.violations(wells, probe, "well", "plate").collect()}
    assert {(1, "codec"), (2, "geometry"), (3, "empty"), (4, "missing")} <= got
    assert {w for w, r in got if r == "counts_differ"} == set(range(5))


def test_task_status_order(spark):
    facts = spark.createDataFrame([(1, False, 1.0, 2, 0, True, True, True), (2, True, 99.0, 2, 2, True, True, True), (3, True, 1.0, 2, 2, True, True, True), (4, True, 1.0, 2, 1, True, True, True), (5, True, 1.0, 2, 0, False, True, True), (6, True, 1.0, 2, 0, True, False, True), (7, True, 1.0, 2, 0, True, True, True)],
                                  "t int, source_exists boolean, duration_s double, n_wells int, n_existing int, encoder_ok boolean, copied boolean, valid boolean")
    names = lambda **k: [r.status for r in manifests.task_status(facts, 4, **k).orderBy("t").collect()]
    assert names(max_seconds=50.0) == ["missing_source", "source_duration_exceeds_limit", "skipped_existing", "partial_existing_outputs", "ffmpeg_failed", "output_rsync_failed", "validated"]
    assert set(names(threads=5)) == {"encoder_cpu_request_exceeds_sge_slots"}
    assert names(force=True, dry_run=True) == ["missing_source"] + ["dry_run"] * 6


def test_tasks_keep_layout_and_rows_override(spark):
    inputs = spark.createDataFrame([("/data/b/x.mkv",), ("/data/a.mkv",), ("/else/y.mkv",)], "input_path string")
    rows = manifests.tasks(inputs, "/out/", "/data", vector_output="", method="epzs")
    assert [(r.task_id, r.output_dir) for r in rows.orderBy("task_id").collect()] == [(1, "/out/a"), (2, "/out/b/x"), (3, "/out/y")]
    assert manifests.task_row(rows, 2, vector_output="sampled", method="full").first().asDict()["vector_output"] == "sampled"
    assert manifests.task_row(rows, 2, method="full").first().method == "epzs"


def test_profile_distance_equals_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 4))
    x[:, 3] = 2.0  # constant
    df = spark.createDataFrame([(i, i % 3, x[i].tolist()) for i in range(30)], "profile long, stage int, features array<double>")
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    got = profiles.pair_distance(profiles.standardised(df)).collect()
    assert len(got) == 435
    assert all(np.isclose(r.distance, np.linalg.norm(z[r.left] - z[r.right])) and r.same_label == (r.left % 3 == r.right % 3) for r in got)


def test_pairs_of_blocks_are_shuffled_little(spark, monkeypatch):
    monkeypatch.setattr(profiles, "LEAST_BLOCK", 20)
    rows = [(f"p{i}", None if i % 4 == 0 else i % 3, [float(i), float(i % 7)] if i % 50 else [1.0, None] if i else [1.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "profile string, stage int, features array<double>").repartition(4)
    pairs = profiles.pair_distance(df.unionAll(df.limit(1)).unionAll(df.limit(1).withColumn("profile", F.lit(None).cast("string"))))
    assert pairs.dropDuplicates(["left", "right"]).count() == 200 * 199 // 2 and pairs.count() == 200 * 199 // 2 + 199
    by = {r[0]: r for r in rows}
    for r in pairs.collect():
        (_, la, a), (_, lb, b) = by[r.left], by[r.right]
        assert r.left < r.right and r.same_label == (la == lb)
        if None in a or None in b or len(a) != len(b):
            assert r.distance is None
        else:
            assert abs(r.distance - math.dist(a, b)) < 1e-9
    monkeypatch.undo()
    # 10,000 profiles once lay in 40 blocks, and so were copied 80 times.
    wide = spark.range(10_000).selectExpr("id as profile", "id % 3 as stage", "array(double(id)) as features")
    plan = profiles.pair_distance(wide)._jdf.queryExecution().toString()
    assert max(int(n) for n in re.findall(r"sequence\([^)]*?, (\d+)", plan)) < 12


def test_a_block_is_written_once_for_all_others(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(profiles, "BLOCK_PROFILES", 20)
    df = spark.range(600).selectExpr("id as profile", "id % 3 as stage", "array(double(id), rand(1), rand(2), rand(3), rand(4), rand(5)) as features")
    for most in (256, 4):  # parts of a block and of several
        monkeypatch.setattr(profiles, "BLOCK_PARTS", most, raising=False)
        pairs = profiles.pair_distance(df)
        pairs.write.parquet(f"{tmp_path}/{most}")
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" in plan and "Exchange" not in plan
        got = spark.read.parquet(f"{tmp_path}/{most}")
        assert got.count() == got.dropDuplicates(["left", "right"]).count() == 600 * 599 // 2
        assert got.filter("left >= right or distance < right - left or same_label <> (left % 3 = right % 3)").isEmpty()


def test_a_block_meets_itself_in_any_order():
    import pyarrow as pa

    rows = [{"k": i, "l": 0, "f": [float(i)]} for i in range(9)]
    batch = pa.RecordBatch.from_pydict({"x": [3], "y": [3], "lr": [rows], "rr": [rows[::-1]]})
    (got,) = profiles._block_distances([batch])
    pairs = {frozenset(p) for p in zip(got["a"].to_pylist(), got["b"].to_pylist(), strict=True)}
    assert got.num_rows == 36 == len(pairs) and all(len(p) == 2 for p in pairs)


def test_separability_learns_a_clear_label(spark):
    rows = [(v, s, float(s + v % 2 * 0.1), float(s % 2), "even" if s % 2 == 0 else "odd") for v in range(4) for s in range(20)]
    df = spark.createDataFrame(rows, "video int, second_bin int, a double, b double, well string")
    conf = profiles.separability(df, ["a", "b"], "well", ["video"], folds=None, trees=10).cache()
    scores = profiles.accuracy(conf).collect()
    assert len(scores) == 4 and all(r.balanced_accuracy > 0.9 and r.chance == 0.5 for r in scores)
    shares = profiles.row_normalised(conf).groupBy("label").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in shares)
    assert profiles.importances(df, ["a", "b"], "well", trees=10).first().feature == "b"
    assert profiles.pca2(df, ["a", "b"], ["video"]).count() == 80


def test_quality_control_figures(spark):
    rows = [("v", w, f, f * 0.5, float(w * f), 0 if f == 2 else 5) for w in range(3) for f in range(4)]
    df = spark.createDataFrame(rows, "video string, well int, frame_index long, time_seconds double, e double, change int")
    ctx = {r.frame_index: r for r in qc.plate_context(df, "e", F.col("e") > 0, ["video", "frame_index"]).collect()}
    assert (ctx[3].plate_activity_median, ctx[3].plate_activity_dispersion, round(ctx[3].plate_well_active_fraction, 3)) == (3.0, 3.0, 0.667)
    auc = {(r.well, r.window_index): r.auc for r in qc.window_summary(df, "e", F.col("e") > 0, ["video", "well"]).collect()}
    assert auc[2, 0] == 0.5 and auc[2, 1] == 2.5
    assert all(abs(r[2] - 1 / 3) < 1e-9 for r in qc.duplicate_like(df, ["video", "well"], "change").collect())
    sync = {r.well: r[1] for r in qc.synchronous_fraction(df, F.col("e") > 0, ["video", "frame_index"], ["well"]).collect()}
    assert sync == {0: 0.0, 1: 1.0, 2: 1.0}
    assert manifests.capacity(10, 2, 3.0, 1, 1, 1, 1) == {"shared_peak_gb": 8, "wall_hours": 15.0}
