import gzip
import json
import sqlite3
import struct
import time

import pytest
from pyspark.sql import functions as F

from vectrace import schemas
from vectrace.operators import imgdiff, vectors
from vectrace.plans.records import moving_square
from vectrace.sources import contracts, files, sinks
from vectrace.streaming import progress, state

RECORD = (7, 70, 0.7, 3, -1, 16, 16, 1, 2, 4, 6, 12, 16, 4, 0, 3, 4, 5.0)


def stream(records, magic=b"MSCVB1\0\0"):
    code = "<qqfiiIIhhhhiiIQiif"
    return gzip.compress(struct.pack("<8s6I", magic, 1, 0x01020304, 32, 76, 18, 0) + b"".join(struct.pack(code, *r) for r in records))


def test_binary_vectors(spark, tmp_path):
    late = (8, -(1 << 63), float("nan"), 0, 2, *RECORD[5:])
    (tmp_path / "a.vectors.bin.gz").write_bytes(stream([RECORD, late]))
    df = files.read_binary(spark, str(tmp_path / "*.bin.gz"), "vectors")
    row, second = df.orderBy("frame_index").collect()
    assert (row.frame_index, row.source, row.dx_px, row.dy_px, row.magnitude_px) == (7, -1, 3, 4, 5.0)
    assert second.pts is None and second.time_seconds is None
    assert files.read_binary(spark, str(tmp_path), "vectors", frames=(0, 7)).count() == 1
    assert files.read_binary(spark, str(tmp_path), "vectors", source="future").first().frame_index == 8
    for bad in (stream([RECORD], b"MSCFB1\0\0"), gzip.compress(gzip.decompress(stream([RECORD]))[:-1]), b"x"):
        with pytest.raises(files.FormatError):
            files.decode_binary(bad, "vectors")


def test_streams_round_trip(spark, tmp_path):
    columns = dict(zip(schemas.VECTORS.names, RECORD, strict=True))
    df = spark.createDataFrame([tuple(columns.values()), (9, None, None, *RECORD[3:])], schemas.VECTORS).withColumn("clip", F.lit("c.bin.gz"))
    made = sinks.binary_streams(df, "vectors", ["clip"])
    assert sinks.save_streams(made, str(tmp_path / "out"), "clip").collect()[0].file == "c.bin.gz"
    back = files.read_binary(spark, str(tmp_path / "out"), "vectors").orderBy("frame_index").collect()
    assert [r.frame_index for r in back] == [7, 9] and back[1].pts is None and back[0].magnitude_px == 5.0


def test_long_streams_are_built_and_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MEMBER_ROWS", 100)
    monkeypatch.setattr(sinks, "DEALT_ROWS", 250)
    monkeypatch.setattr(files, "WHOLE_BYTES", 1 << 12)
    rows = [((i * 37) % 499, None if i % 9 == 0 else i, 0.5, i // 499, *RECORD[4:], "b.bin.gz" if i % 50 == 0 else "a.bin.gz") for i in range(3000)]
    df = spark.createDataFrame(rows, "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schemas.VECTORS) + ",clip:string>").repartition(3)
    made = sinks.binary_streams(df, "vectors", ["clip"])
    parts = made.selectExpr("clip", "part", "length(content) as n").collect()
    assert sum(r.clip == "a.bin.gz" for r in parts) > 20 and {r.part for r in parts if r.clip == "b.bin.gz"} == {0}
    saved = sinks.save_streams(made, str(tmp_path / "out"), "clip").collect()
    assert {r.file: r.bytes for r in saved} == {c: (tmp_path / "out" / c).stat().st_size for c in ("a.bin.gz", "b.bin.gz")}
    for c in ("a.bin.gz", "b.bin.gz"):
        data = (tmp_path / "out" / c).read_bytes()
        assert (len(data) > files.WHOLE_BYTES) == (c == "a.bin.gz")
        got = files.decode_binary(data, "vectors")
        want = sorted((r[0], r[3], files.NO_PTS if r[1] is None else r[1]) for r in rows if r[-1] == c)
        assert list(zip(got["frame_index"].tolist(), got["vector_index"].tolist(), got["pts"].tolist(), strict=True)) == want
    back = files.read_binary(spark, str(tmp_path / "out"), "vectors")
    assert back.count() == 3000
    want = df.drop("clip").withColumn("time_seconds", F.expr("if(pts is null, null, time_seconds)"))
    assert back.drop("_file").exceptAll(want).count() == 0
    assert files.read_binary(spark, str(tmp_path / "out"), "vectors", frames=(10, 20)).count() == sum(10 <= r[0] <= 20 for r in rows)
    with pytest.raises(Exception, match="does not follow"):
        sinks.save_streams(made.filter("part <> 1"), str(tmp_path / "bad"), "clip").collect()


def test_a_slice_of_a_long_stream_is_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "WHOLE_BYTES", 0)
    records = [(i, i, 0.5, 0, -1 if i % 3 else 1, *RECORD[5:]) for i in range(1000)]
    (tmp_path / "a.vectors.bin.gz").write_bytes(stream(records))
    with open(tmp_path / "a.vectors.bin.gz", "rb") as f:
        assert [len(part) for part in files.stream_records(f, "vectors", rows=300)] == [300, 300, 300, 100]
    got = files.read_binary(spark, str(tmp_path), "vectors", frames=(100, 900), source="past")
    assert sorted(r.frame_index for r in got.collect()) == [i for i in range(100, 901) if i % 3]


def test_csv_round_trip_and_header_check(spark, tmp_path):
    rows = [(i, i, i * 0.01, 2, *[1 / 3] * 9, 0.5, 10, 0, 0.0, 0, 123456789.0) for i in range(3)]
    df = spark.createDataFrame(rows, schemas.FRAMES)
    sinks.write_csv(df, str(tmp_path / "f"), "frames")
    back = files.read_csv(spark, str(tmp_path / "f"), "frames").orderBy("frame_index").collect()
    assert back[1].mean_dx_px == 0.333333 and back[0].frame_diff_abs_mean == 1.23457e8
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_csv(df, str(tmp_path / "f"), "frames")
    (tmp_path / "bad.csv").write_text("frame_index,nope\n1,2\n")
    with pytest.raises(Exception):  # noqa: B017
        files.read_csv(spark, str(tmp_path / "bad.csv"), "frames").collect()


def test_significant_digits_equal_printf(spark):
    values = [0.0, 1.0, -1.5, 1 / 3, 123456.0, 1234567.0, 0.0001234567, 0.00001234567, 1e20, 99999.96, 999999.5, -2.4e-7, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (1, 6, 9):
        assert [r[0] for r in df.select(sinks.significant("x", digits)).collect()] == [f"%.{digits}g" % v for v in values]


def test_tree_discovery(spark, tmp_path):
    for name in ("A01/A01.v1.frames.csv.gz", "A01/A01.v1.vectors.csv.gz", "A01/A01.v1.vectors.bin.gz", "A01/A01.v1.metadata.json", "A03/frames.csv.gz", "A03/vectors.bin.gz", "A02/A02.frames.csv.gz", "A02/notes.txt"):
        path = tmp_path / "run" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    got = {r.folder.rsplit("/", 1)[1]: r for r in files.discover(spark, str(tmp_path / "run")).collect()}
    assert set(got) == {"A01", "A02", "A03"} and got["A02"].missing == "vectors"
    assert got["A01"].vectors.endswith("vectors.csv.gz") and got["A01"].metadata and got["A01"].stem == "A01.v1"
    assert got["A03"].vectors.endswith("vectors.bin.gz") and got["A03"].metadata is None
    assert files.list_videos(spark, str(tmp_path), ("txt",)).count() == 1


def test_manifest_list_metadata_and_bundle(spark, tmp_path):
    (tmp_path / "m.csv").write_text("source_video_id,source_path\nrunA,\nrunB,/b\n")
    df = files.read_manifest(spark, str(tmp_path / "m.csv"), ("source_video_id",))
    assert [tuple(r) for r in df.orderBy("source_video_id").collect()] == [("runA", ""), ("runB", "/b")]
    with pytest.raises(schemas.SchemaError):
        files.read_manifest(spark, str(tmp_path / "m.csv"), ("well_label",))
    (tmp_path / "l.txt").write_text("# head\n\n /a.mkv \n/b.mkv\n")
    assert [r[0] for r in files.read_list(spark, str(tmp_path / "l.txt")).collect()] == ["/a.mkv", "/b.mkv"]
    (tmp_path / "x.metadata.json").write_text(json.dumps({"schema_name": "s", "input": {"path": "p", "width": 83}}, indent=1))
    assert files.read_metadata(spark, str(tmp_path / "x.metadata.json")).first().input.width == 83
    (tmp_path / "bundle").mkdir()
    (tmp_path / "bundle/manifest.csv").write_text("clip_id\nc1\n")
    assert files.read_bundle(spark, str(tmp_path / "bundle"), "manifest").first().clip_id == "c1"
    assert files.read_bundle(spark, str(tmp_path / "bundle"), "sessions", required=False) is None
    with pytest.raises(FileNotFoundError):
        files.read_bundle(spark, str(tmp_path / "bundle"), "sessions")


def test_sqlite(spark, tmp_path):
    with sqlite3.connect(tmp_path / "a.db") as db:
        db.execute("create table clips (clip_id text, n int)")
        db.executemany("insert into clips values (?, ?)", [("c1", 1), ("c2", None)])
    rows = files.read_sqlite(spark, str(tmp_path / "a.db"), "clips", ["clip_id", "n"]).collect()
    assert [tuple(r) for r in rows] == [("c1", "1"), ("c2", None)]
    with pytest.raises(Exception, match="lacks columns"):
        files.read_sqlite(spark, str(tmp_path / "a.db"), "clips", ["nope"]).collect()
    assert files.file_hashes(spark, str(tmp_path / "a.db")).count() == 1


def test_square_moves_where_it_should(spark):
    frames = moving_square(spark)
    diff = {r.frame_index: r for r in imgdiff.frame_difference(frames, ["clip"]).collect()}
    moving = {t for t, r in diff.items() if r.changed_pixels}
    assert moving == set(range(10, 21)) | set(range(30, 41)) and diff[0].abs_sum == 0
    shift = {r.frame_index: (r.shift_x_px, r.shift_y_px) for r in imgdiff.phase_shift(frames, ["clip"]).collect()}
    assert shift[5] == (0.0, 0.0)
    found = vectors.derive(imgdiff.block_motion(frames.filter("frame_index between 9 and 12"), ["clip"], 12, 4))
    assert found.filter("dx_px = 2 and dy_px = 0").count() > 0 and found.filter("dx_px < 0").count() == 0
    blocks = imgdiff.block_differences(found, frames, ["clip"])
    assert blocks.count() == found.count() and blocks.filter("block_cd_pixels > 0").count() > 0
    assert vectors.local_gate(blocks, changed=1).count() < blocks.count() == vectors.local_gate(blocks).count()
    lags = imgdiff.lag_differences(frames, ["clip"], (1, 3)).filter("frame_index = 21").first()
    assert lags.imgdiff_l1_changed_fraction == 0 and lags.imgdiff_l3_changed_fraction > 0


def test_change_of_size_starts_anew(spark):
    rows = [("c", 0, 2, 1, b"\x00\x00"), ("c", 1, 2, 1, b"\xff\x00"), ("c", 2, 1, 1, b"\x00"), ("c", 3, 1, 1, b"\x10")]
    df = spark.createDataFrame(rows, "clip string, frame_index long, width int, height int, gray binary")
    assert [r.changed_pixels for r in imgdiff.frame_difference(df, ["clip"]).orderBy("frame_index").collect()] == [0, 1, 0, 1]


def test_streamed_change_equals_batch(spark, tmp_path):
    frames = moving_square(spark).filter("frame_index < 14")
    folder = str(tmp_path / "in")
    for low in (0, 7):
        frames.filter((F.col("frame_index") >= low) & (F.col("frame_index") < low + 7)).coalesce(1).write.mode("append").parquet(folder)
    live = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = state.run_to_end(state.change_from_last(live, ["clip"]), str(tmp_path / "out"), mode="append")
    batch = imgdiff.frame_difference(frames, ["clip"]).select("clip", "frame_index", "changed_pixels")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_watermarked_bins_are_accepted(spark, tmp_path):
    df = spark.createDataFrame([("v", 0.5, 1.0, 2), ("v", 1.5, 2.0, 3)], "video string, time_seconds double, raw_motion_energy double, mv_active_vectors long").withColumn("ts", F.timestamp_seconds("time_seconds"))
    df.write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    out = state.run_to_end(state.bins(live, ["video"], 1.0, "10 seconds", "ts"), str(tmp_path / "out"))
    assert sorted((r.bin_index, r.n_frames) for r in out.collect()) == [(0, 1), (1, 1)]


CONTRACT = {
    "feature_set": "bridge_v1", "decision_semantics": {"automatic_rejection": False},
    "image_dynamics": {"lags_frames": [1, 3, 10], "changed_pixel_thresholds": [10]},
    "motion_vectors": {"active_vector_threshold_px": "versioned_parameter_required", "preaggregate_spatial_grid": [4, 4]},
    "temporal": {"bins_ms": [50, 100, 250]},
    "transcode_trace_features": {"well": ["imgdiff_l1_changed_fraction", "imgdiff_l10_abs_mean", "mv_active_fraction"], "plate_context": ["plate_activity_dispersion"]},
    "derived_after_transcode": {"window_summaries": ["median", "p95", "max", "auc", "active_frame_fraction"], "features": ["mv_bout_fraction"], "ratio_floor_policy": "versioned_robust_floor_required"},
}


def test_contract_builds_its_plans(spark, tmp_path):
    (tmp_path / "qc.json").write_text(json.dumps(CONTRACT, indent=2))
    found = contracts.read_contract(spark, str(tmp_path / "qc.json"))
    assert (found.name, found.lags, found.grid, found.rejects) == ("bridge_v1", (1, 3, 10), (4, 4), False)
    assert found.versioned == ("derived_after_transcode.ratio_floor_policy", "motion_vectors.active_vector_threshold_px")
    made = found.image_features(moving_square(spark), ["clip"])
    assert found.missing(made) == ["mv_active_fraction"] and made.count() == 50
    rows = spark.createDataFrame([("v", i, i * 0.25, float(i)) for i in range(8)], "video string, frame_index long, time_seconds double, x double")
    windows = found.windows(rows, "x", F.col("x") > 2, ["video"])
    assert windows.columns == ["video", "window_index", *found.summaries] and windows.count() == 2
    for broken in ("[]", "{}", json.dumps({**CONTRACT, "temporal": {"bins_ms": [0]}}), json.dumps({**CONTRACT, "derived_after_transcode": {"window_summaries": ["mode"], "features": []}})):
        with pytest.raises(contracts.ContractError):
            contracts.parse(broken)


def test_progress_documents(spark, tmp_path):
    path = str(tmp_path / "status.json")
    progress.write_document(spark, path, status="running", done=1)
    progress.write_document(spark, path, status="validated", done=2)
    document = json.loads((tmp_path / "status.json").read_text())
    assert document["status"] == "validated" and document["done"] == 2 and document["updated_at"].endswith("Z")
    assert not (tmp_path / "status.json.partial").exists()
    listener = progress.ProgressDocuments(spark, str(tmp_path / "queries"))
    spark.streams.addListener(listener)
    try:
        spark.range(5).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination()
        document = tmp_path / "queries" / f"{query.id}.json"
        for _ in range(100):
            if document.exists() and json.loads(document.read_text())["status"] == "ended":
                break
            time.sleep(0.1)
        assert json.loads(document.read_text())["status"] == "ended"
    finally:
        spark.streams.removeListener(listener)


def test_colour_planes_and_wrong_lengths(spark):
    rows = [("c", 0, 2, 1, bytes([255, 0, 0, 0, 0, 255])), ("c", 1, 2, 1, bytes([0, 255, 0, 255, 255, 255])), ("c", 2, 2, 1, None)]
    df = spark.createDataFrame(rows, "clip string, frame_index long, width int, height int, bgr binary")
    gray = imgdiff.to_gray(df).orderBy("frame_index").collect()
    assert [r.gray and list(r.gray) for r in gray] == [[29, 76], [150, 255], None]
    for bad in (df.withColumn("width", F.lit(3)), ):
        with pytest.raises(Exception, match="colour plane"):
            imgdiff.to_gray(bad).collect()
    with pytest.raises(Exception, match="no 3 x 1 plane"):
        imgdiff.frame_difference(imgdiff.to_gray(df).withColumn("width", F.lit(3)), ["clip"]).collect()


def test_manifest_document_and_provenance(spark, tmp_path):
    (tmp_path / "in.csv").write_text("x")
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "source_video_id string")
    code = sinks.provenance(str(tmp_path))
    assert code == {"commit": None, "modified": None}
    document = json.loads(sinks.manifest_document(rows, files.file_hashes(spark, str(tmp_path / "in.csv")), code, name="m").first().json)
    assert (document["n_wells"], document["n_plates"], document["name"], len(document["inputs"])) == (3, 2, "m", 1)
    assert document["inputs"][0]["sha256"] == "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"


def test_comparison_tables_have_given_types(spark, tmp_path):
    for video in ("run_a", "run_b"):
        (tmp_path / video).mkdir()
        (tmp_path / video / "all_wells_comparison.csv").write_text("well,frame_index,cd10\nA01,1,2.5\n")
    got = files.read_comparisons(spark, str(tmp_path), "well string, frame_index long, cd10 double")
    assert sorted(map(tuple, got.collect())) == [("A01", 1, 2.5, "run_a"), ("A01", 1, 2.5, "run_b")]
