"""Queries that write tables in a format, read them back and aggregate: sources and sinks against plain SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrace import schemas
from vectrace.operators import manifests
from vectrace.plans import views
from vectrace.plans.catalog import query
from vectrace.session import shared_folder
from vectrace.sources import files, sinks

_VECTOR_SUMS = "clip:l n:l pts:l no_time:l past:l w:l src:l dst:l motion:l dx:l dy:l magnitude:l"
_VECTOR_STEPS = """vt AS (SELECT *, CASE WHEN frame_index % 9 = 0 THEN NULL ELSE frame_index * 512 END AS pts FROM vec)"""
_VECTOR_FINAL = """SELECT clip, count(*) AS n, sum(pts) AS pts, count(*) FILTER (WHERE pts IS NULL) AS no_time, count(*) FILTER (WHERE source < 0) AS past, sum(w) AS w,
 sum(src_x + 1000 * src_y) AS src, sum(dst_x + 1000 * dst_y) AS dst, sum(dx_px * 4 + dy_px * 4000) AS motion, sum(dx_px) AS dx, sum(dy_px) AS dy,
 sum(round(magnitude_px * 1000)) AS magnitude FROM vt GROUP BY clip"""


def _vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of a vector file; every ninth frame has no time."""
    v = views.vectors(spark, sf_dir)
    pts = F.when(F.col("frame_index") % 9 != 0, F.col("frame_index") * 512)
    made = {
        "pts": pts, "time_seconds": pts / 10240.0, "w": F.col("w"), "h": F.col("h"), "motion_x": F.col("dx_px") * 4, "motion_y": F.col("dy_px") * 4,
        "motion_scale": F.lit(4), "flags": F.lit(0),
    }
    full = v.withColumns(made)
    return full.select("clip", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.VECTORS])


def _vector_sums(df: DataFrame) -> DataFrame:
    return df.groupBy((F.col("frame_index") % 6).alias("clip")).agg(
        F.count("*").alias("n"), F.sum("pts").alias("pts"), F.count(F.when(F.col("pts").isNull() & F.col("time_seconds").isNull(), 1)).alias("no_time"),
        F.count(F.when(F.col("source") < 0, 1)).alias("past"), F.sum("w").alias("w"), F.sum(F.col("src_x") + 1000 * F.col("src_y")).alias("src"),
        F.sum(F.col("dst_x") + 1000 * F.col("dst_y")).alias("dst"), F.sum(F.col("motion_x") + 1000 * F.col("motion_y")).alias("motion"),
        F.sum("dx_px").alias("dx"), F.sum("dy_px").alias("dy"), F.sum(F.round(F.col("magnitude_px") * 1000)).alias("magnitude"),
    )


@query("vector_csv_round_trip", _VECTOR_SUMS, "vec", _VECTOR_STEPS, _VECTOR_FINAL)
def vector_csv_round_trip(spark, d):
    folder = shared_folder(spark, "csv")
    sinks.write_csv(_vector_table(spark, d).drop("clip"), folder, "vectors")
    return _vector_sums(files.read_csv(spark, folder, "vectors"))


@query("vector_binary_round_trip", _VECTOR_SUMS, "vec", _VECTOR_STEPS, _VECTOR_FINAL)
def vector_binary_round_trip(spark, d):
    folder = shared_folder(spark, "bin")
    table = _vector_table(spark, d).withColumn("file", F.concat(F.lit("clip"), F.col("clip").cast("string"), F.lit(".vectors.bin.gz")))
    sinks.save_streams(sinks.binary_streams(table.drop("clip"), "vectors", ["file"]), folder, "file").collect()  # a row a file
    return _vector_sums(files.read_binary(spark, folder, "vectors"))


@query(
    "vector_binary_slice", _VECTOR_SUMS, "vec", _VECTOR_STEPS, _VECTOR_FINAL.replace("FROM vt", "FROM vt WHERE frame_index BETWEEN 100 AND 900 AND source < 0"),
)
def vector_binary_slice(spark, d):
    folder = shared_folder(spark, "bin")
    table = _vector_table(spark, d).withColumn("file", F.concat(F.col("clip").cast("string"), F.lit(".vectors.bin.gz")))
    sinks.save_streams(sinks.binary_streams(table.drop("clip"), "vectors", ["file"]), folder, "file").collect()
    return _vector_sums(files.read_binary(spark, folder, "vectors", frames=(100, 900), source="past"))


def _frame_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.frames(spark, sf_dir).withColumns({"pts": F.col("frame_index") * 512, "frame_diff_threshold": F.lit(10), "frame_diff_changed_pixels": F.col("n_vectors") * 3})
    have = [F.coalesce(F.col(c.name), F.lit(0)) if c.name in f.columns else F.lit(0) for c in schemas.FRAMES]
    return f.select("clip", *[x.cast(c.dataType).alias(c.name) for x, c in zip(have, schemas.FRAMES, strict=True)])


_FRAME_SUMS = "clip:l n:l pts:l vectors:l energy coherence changed:l"
_FRAME_FINAL = """SELECT clip, count(*) AS n, sum(frame_index * 512) AS pts, sum(n_vectors) AS vectors, sum(sum_magnitude_px) AS energy, sum(coherence) AS coherence, sum(n_vectors * 3) AS changed
 FROM fr GROUP BY clip"""


def _frame_sums(df: DataFrame) -> DataFrame:
    return df.groupBy((F.col("frame_index") % 6).alias("clip")).agg(
        F.count("*").alias("n"), F.sum("pts").alias("pts"), F.sum("n_vectors").alias("vectors"), F.sum(F.round("sum_magnitude_px", 3)).alias("energy"),
        F.sum(F.round("coherence", 3)).alias("coherence"), F.sum("frame_diff_changed_pixels").alias("changed"),
    )


@query("frame_csv_round_trip", _FRAME_SUMS, "fr", "", _FRAME_FINAL)
def frame_csv_round_trip(spark, d):
    folder = shared_folder(spark, "csv")
    sinks.write_csv(_frame_table(spark, d).drop("clip"), folder, "frames")
    return _frame_sums(files.read_csv(spark, folder, "frames"))


@query("frame_binary_round_trip", _FRAME_SUMS, "fr", "", _FRAME_FINAL)
def frame_binary_round_trip(spark, d):
    folder = shared_folder(spark, "bin")
    table = _frame_table(spark, d).withColumn("file", F.concat(F.lit("clip"), F.col("clip").cast("string"), F.lit(".frames.bin.gz")))
    sinks.save_streams(sinks.binary_streams(table.drop("clip"), "frames", ["file"]), folder, "file").collect()
    return _frame_sums(files.read_binary(spark, folder, "frames"))


@query(
    "tree_discovery", "stem:s frames:s vectors:s metadata:s missing:s", "", "cl AS (SELECT range AS i FROM range(6))",
    """SELECT 'clip' || i AS stem, 'clip' || i || CASE WHEN i % 2 = 0 THEN '.frames.csv.gz' ELSE '.frames.bin.gz' END AS frames,
 CASE WHEN i % 3 > 0 THEN 'clip' || i || '.vectors.bin.gz' END AS vectors, CASE WHEN i < 4 THEN 'clip' || i || '.metadata.json' END AS metadata, CASE WHEN i % 3 = 0 THEN 'vectors' END AS missing FROM cl""",
)
def tree_discovery(spark, d):
    folder = shared_folder(spark, "tree")
    names = [f"clip{i}.frames.{'csv' if i % 2 == 0 else 'bin'}.gz" for i in range(6)]
    names += [f"clip{i}.vectors.bin.gz" for i in range(6) if i % 3] + [f"clip{i}.metadata.json" for i in range(4)] + ["notes.txt"]
    sinks.save_streams(spark.createDataFrame([(n, b"x") for n in names], "name string, content binary"), folder, "name").collect()
    name = lambda c: F.regexp_extract(c, "[^/]*$", 0)
    found = files.discover(spark, folder)
    return found.select("stem", *[F.when(F.col(c).isNotNull(), name(c)).alias(c) for c in ("frames", "vectors", "metadata")], "missing")


@query(
    "manifest_csv_round_trip", "source_video_id:s n_wells:l named:l width:l", "roi", "",
    "SELECT source_video_id, count(*) AS n_wells, count(*) FILTER (WHERE source_path <> '') AS named, sum(width) AS width FROM roi GROUP BY source_video_id",
)
def manifest_csv_round_trip(spark, d):
    folder = shared_folder(spark, "manifest")
    sinks.write_report(views.roi_rows(spark, d), folder)
    rows = manifests.geometry(files.read_manifest(spark, folder, ("source_video_id", "well_label")))
    return rows.groupBy("source_video_id").agg(
        F.count("*").alias("n_wells"), F.count(F.when(F.col("source_path") != "", 1)).alias("named"), F.sum("crop_width").alias("width")
    )


@query(
    "list_and_hashes", "input_path:s files:l sha256:s", "",
    "ls AS (SELECT '/data/run' || range || '.mkv' AS p FROM range(20))",
    "SELECT p AS input_path, 1 AS files, sha256('# head' || chr(10) || chr(10) || (SELECT string_agg(' ' || p || chr(10), '' ORDER BY length(p), p) FROM ls)) AS sha256 FROM ls",
)
def list_and_hashes(spark, d):
    folder = shared_folder(spark, "list")
    body = "# head\n\n" + "".join(f" /data/run{i}.mkv\n" for i in range(20))
    sinks.save_streams(spark.createDataFrame([("inputs.txt", body.encode())], "name string, content binary"), folder, "name").collect()
    hashes = files.file_hashes(spark, folder).agg(F.count("*").alias("files"), F.max("sha256").alias("sha256"))
    return files.read_list(spark, folder).crossJoin(F.broadcast(hashes))  # one row


@query(
    "directory_scan", "name:s", "", "ds AS (SELECT range AS i FROM range(8))",
    "SELECT 'run' || i || CASE i % 4 WHEN 0 THEN '.mkv' WHEN 1 THEN '.MP4' ELSE '.avi' END AS name FROM ds WHERE i % 4 <> 3",
)
def directory_scan(spark, d):
    folder = shared_folder(spark, "videos")
    names = [f"run{i}{('.mkv', '.MP4', '.avi', '.txt')[i % 4]}" for i in range(8)]
    sinks.save_streams(spark.createDataFrame([(n, b"x") for n in names], "name string, content binary"), folder, "name").collect()
    return files.list_videos(spark, folder).select(F.regexp_extract("input_path", "[^/]*$", 0).alias("name"))


@query(
    "bundle_scan", "annotator_id:s n:l clips:l", "ann", "", "SELECT annotator_id, count(*) AS n, count(DISTINCT clip_id) AS clips FROM ann GROUP BY annotator_id",
)
def bundle_scan(spark, d):
    folder = shared_folder(spark, "bundle")
    sinks.write_features(views.annotations(spark, d), f"{folder}/annotations.parquet")
    rows = files.read_bundle(spark, folder, "annotations")
    return rows.groupBy("annotator_id").agg(F.count("*").alias("n"), F.countDistinct("clip_id").alias("clips"))


@query(
    "sqlite_scan", "label:s n:l total:l", "", "sl AS (SELECT range AS i FROM range(500))",
    "SELECT 'label' || (i % 7) AS label, count(*) AS n, sum(i) AS total FROM sl GROUP BY i % 7",
)
def sqlite_scan(spark, d):
    import sqlite3

    folder = shared_folder(spark, "sqlite")
    with sqlite3.connect(":memory:") as db:
        db.execute("create table clips (clip_id integer, label text)")
        db.executemany("insert into clips values (?, ?)", [(i, f"label{i % 7}") for i in range(500)])
        content = db.serialize()
    sinks.save_streams(spark.createDataFrame([("a.db", content)], "name string, content binary"), folder, "name").collect()
    rows = files.read_sqlite(spark, folder, "clips", ["clip_id", "label"])
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("clip_id").cast("long")).alias("total"))


@query(
    "metadata_documents", "path:s width:i stride:i vectors:s", "", "md AS (SELECT range AS i FROM range(5))",
    "SELECT '/in/' || i AS path, 83 + i AS width, 1 + i % 2 AS stride, 'hash' || i AS vectors FROM md",
)
def metadata_documents(spark, d):
    folder = shared_folder(spark, "metadata")
    made = [
        (f"{i}.metadata.json", json.dumps({
            "schema_name": "s", "input": {"path": f"/in/{i}", "width": 83 + i}, "vector_sampling": {"frame_stride": 1 + i % 2}, "outputs": {"vectors": f"hash{i}"},
        }, indent=1).encode()) for i in range(5)
    ]
    sinks.save_streams(spark.createDataFrame(made, "name string, content binary"), folder, "name").collect()
    rows = files.read_metadata(spark, folder)
    return rows.select("input.path", "input.width", F.col("vector_sampling.frame_stride").alias("stride"), F.col("outputs")["vectors"].alias("vectors"))


@query(
    "features_by_folder", "clip:l n:l energy", "fr", "", "SELECT clip, count(*) AS n, sum(sum_magnitude_px) AS energy FROM fr WHERE clip IN (1, 4) GROUP BY clip",
)
def features_by_folder(spark, d):
    folder = shared_folder(spark, "features")
    sinks.write_features(views.frames(spark, d), folder, by=("clip",))
    rows = spark.read.parquet(folder).filter("clip in (1, 4)")
    return rows.groupBy("clip").agg(F.count("*").alias("n"), F.sum("sum_magnitude_px").alias("energy"))


@query(
    "rows_numbered", "event_id:l number:l", "", "nm AS (SELECT event_id, value, row_number() OVER (ORDER BY value DESC, event_id) AS number FROM events)", "SELECT event_id, number FROM nm",
)
def rows_numbered(spark, d):
    return sinks.numbered(views.read(spark, d, "events").select("event_id", "value"), "number", [F.desc("value"), F.col("event_id")])
