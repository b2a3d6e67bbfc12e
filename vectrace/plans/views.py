"""Domain tables projected from the driver's tables, as DataFrames and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as motion vectors: six clips, 16-pixel blocks on an 83-pixel well."""
    dx, dy = F.col("l_linenumber") - 4, (F.floor(F.col("l_quantity") / 10) - 2).cast("int")
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("frame_index"), (F.col("l_orderkey") % 6).alias("clip"), F.col("l_linenumber").alias("vector_index"),
        F.when(F.col("l_returnflag") == "N", 1).otherwise(-1).alias("source"), F.lit(16).alias("w"), F.lit(16).alias("h"),
        (F.col("l_partkey") % 83).cast("int").alias("dst_x"), (F.col("l_suppkey") % 83).cast("int").alias("dst_y"),
        ((F.col("l_partkey") % 83).cast("int") - dx).alias("src_x"), ((F.col("l_suppkey") % 83).cast("int") - dy).alias("src_y"),
        dx.alias("dx_px"), dy.alias("dy_px"), F.sqrt((dx * dx + dy * dy).cast("double")).alias("magnitude_px"),
        (F.col("l_partkey") % 20).cast("int").alias("block_cd_pixels"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the frames of six clips, 20 a second."""
    clip = F.col("o_orderkey") % 6
    number = F.row_number().over(Window.partitionBy(clip).orderBy("o_orderkey")) - 1
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("frame_index"), clip.alias("clip"), (number * F.lit(0.05)).alias("time_seconds"),
        (F.col("o_orderkey") % 100 / F.lit(100.0)).alias("coherence"), (F.col("o_custkey") % 50 / F.lit(10.0)).alias("resultant_magnitude_px"),
        (F.col("o_custkey") % 40).cast("int").alias("n_vectors"), (F.col("o_custkey") % 997 / F.lit(4.0)).alias("sum_magnitude_px"),
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as frames of 25 traces (five videos, a well to each event type), 20 a second."""
    video, k = F.col("user_id") % 5, F.get_json_object("props", "$.k").cast("long")
    number = F.row_number().over(Window.partitionBy(video, "event_type").orderBy("ts", "event_id")) - 1
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("run_S"), video.cast("string")).alias("video"), F.col("event_type").alias("well"),
        number.cast("long").alias("frame_index"), (number * F.lit(0.05)).alias("time_seconds"), F.lit(42).cast("long").alias("analysis_n_vectors"),
        F.least(F.lit(42), F.floor(F.col("value") / 8.0)).cast("long").alias("mv_active_vectors"), F.greatest(k - 20, F.lit(0)).alias("cd10"),
        (k * 7).alias("cd10_sum_absdiff"), (k * 11 + 3).alias("sum_absdiff"), (F.col("event_id") % 100 / F.lit(100.0)).alias("coherence"),
        F.col("value").alias("raw_motion_energy"), F.col("event_id"),
    )


def motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces(spark, sf_dir).drop("cd10", "cd10_sum_absdiff", "sum_absdiff")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces(spark, sf_dir).select("video", "well", "frame_index", "cd10", "cd10_sum_absdiff", "sum_absdiff")


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as annotation events on 50 clips."""
    length = F.length("text")
    label = (
        F.when(length % 4 == 0, '["fish","quiet"]').when(length % 4 == 1, '["fish","active","weak"]')
        .when(length % 4 == 2, '"artifact"').otherwise("not json")
    )
    at = lambda k: F.concat(F.lit('{"at_ms": '), (length * k).cast("string"), F.lit("}"))
    times = F.when(length % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("["), at(1), F.lit(","), at(3), F.lit("]")))
    return read(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("annotation_id"), F.col("conv_id").alias("presentation_id"),
        (F.col("conv_id") % 50).alias("clip_id"), F.col("role").alias("annotator_id"), (F.col("conv_id") % 7).alias("annotation_session_id"),
        F.concat(F.lit("t"), (F.col("conv_id") % 3).cast("string")).alias("task_id"), F.lit("v1").alias("taxonomy_version"),
        label.alias("label_path_json"), times.alias("decision_timestamps_json"),
        F.when(F.col("turn") % 7 == 6, "yes").otherwise("0").alias("skipped"),
        F.format_string("2026-01-01T00:%02d:%02d", (F.col("turn") % 60).cast("int"), (F.col("conv_id") % 60).cast("int")).alias("created_at"),
    )


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the source catalogue; some paths are empty."""
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("source_video_id"), F.when(F.col("s_nationkey") % 5 == 0, "").otherwise(F.col("s_name")).alias("source_path")
    )


def roi_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as regions of interest in file order, a few wells to each source."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return read(spark, sf_dir, "part").select(
        ((key * 37) % 120 + 1).cast("string").alias("source_video_id"), key.alias("row_pos"),
        F.concat(F.lit("W"), F.lpad((key % 96).cast("string"), 2, "0")).alias("well_label"), (key % 96).cast("string").alias("well_index"),
        size.cast("string").alias("roi_x0"), (size * 2).cast("string").alias("roi_y0"), (size + 20).cast("string").alias("roi_x1"), (size * 2 + 21).cast("string").alias("roi_y1"),
        F.when(size % 3 == 0, "").otherwise("20.0").alias("roi_width"), F.when(size % 3 == 0, "").otherwise("21.0").alias("roi_height"),
        F.when(size % 7 == 0, F.concat(F.lit("/roi/"), key.cast("string"))).otherwise("").alias("source_path"),
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe facts of the well outputs, some of them wrong."""
    key = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        key.alias("row_pos"), F.when(key % 11 == 0, "h264").otherwise("av1").alias("codec_name"), F.lit(20).alias("width"),
        F.when(key % 13 == 0, 22).otherwise(21).alias("height"), F.when(key % 17 == 0, 0).otherwise(F.when(key % 19 == 0, 99).otherwise(100)).cast("long").alias("packet_count"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("profile"), F.col("label").alias("stage"), F.col("embedding").alias("features"))


SQL = {
    "vec": """vec AS (SELECT l_orderkey AS frame_index, l_orderkey % 6 AS clip, l_linenumber AS vector_index,
 CASE WHEN l_returnflag = 'N' THEN 1 ELSE -1 END AS source, 16 AS w, 16 AS h, (l_partkey % 83)::INT AS dst_x, (l_suppkey % 83)::INT AS dst_y,
 l_linenumber - 4 AS dx_px, (floor(l_quantity / 10) - 2)::INT AS dy_px, (l_partkey % 83)::INT - (l_linenumber - 4) AS src_x,
 (l_suppkey % 83)::INT - (floor(l_quantity / 10) - 2)::INT AS src_y, (l_partkey % 20)::INT AS block_cd_pixels,
 sqrt(((l_linenumber - 4) * (l_linenumber - 4) + (floor(l_quantity / 10) - 2) * (floor(l_quantity / 10) - 2))::DOUBLE) AS magnitude_px FROM lineitem)""",
    "fr": """fr AS (SELECT o_orderkey AS frame_index, o_orderkey % 6 AS clip, (row_number() OVER (PARTITION BY o_orderkey % 6 ORDER BY o_orderkey) - 1) * 0.05::DOUBLE AS time_seconds,
 (o_orderkey % 100) / 100.0::DOUBLE AS coherence, (o_custkey % 50) / 10.0::DOUBLE AS resultant_magnitude_px, (o_custkey % 40)::INT AS n_vectors,
 (o_custkey % 997) / 4.0::DOUBLE AS sum_magnitude_px FROM orders)""",
    "tr": """tr AS (SELECT 'run_S' || (user_id % 5) AS video, event_type AS well, row_number() OVER p - 1 AS frame_index, (row_number() OVER p - 1) * 0.05::DOUBLE AS time_seconds,
 42::BIGINT AS analysis_n_vectors, least(42, floor(value / 8.0::DOUBLE))::BIGINT AS mv_active_vectors, greatest(json_extract_string(props, '$.k')::BIGINT - 20, 0) AS cd10,
 json_extract_string(props, '$.k')::BIGINT * 7 AS cd10_sum_absdiff, json_extract_string(props, '$.k')::BIGINT * 11 + 3 AS sum_absdiff,
 (event_id % 100) / 100.0::DOUBLE AS coherence, value AS raw_motion_energy, event_id FROM events WINDOW p AS (PARTITION BY user_id % 5, event_type ORDER BY ts, event_id))""",
    # Rows as comparison_rows gives them with its defaults.
    "cmp": """isl AS (SELECT *, mv_active_vectors >= 1 AS act, sum(CASE WHEN mv_active_vectors >= 1 THEN 0 ELSE 1 END) OVER (PARTITION BY video, well ORDER BY frame_index) AS isl FROM tr),
run AS (SELECT *, CASE WHEN act THEN sum(act::INT) OVER (PARTITION BY video, well, isl) ELSE 0 END AS mv_active_run_frames FROM isl),
met AS (SELECT *, mv_active_run_frames >= 1 AS mv_bout_frame, CASE WHEN mv_active_run_frames >= 1 THEN mv_active_vectors ELSE 0 END AS mv_bout_active_vectors,
 mv_active_vectors / 42.0::DOUBLE AS mv_active_fraction, CASE WHEN mv_active_run_frames >= 1 THEN mv_active_vectors ELSE 0 END / 42.0::DOUBLE AS mv_bout_fraction,
 CASE WHEN mv_active_run_frames >= 1 THEN mv_active_vectors ELSE 0 END / 42.0::DOUBLE AS motion_metric, raw_motion_energy AS motion_energy, 'bout fraction' AS motion_metric_label FROM run),
cmp AS (SELECT *, """ + ", ".join(
        f"coalesce(({c} - avg({c}::DOUBLE) OVER w) / nullif(stddev_pop({c}::DOUBLE) OVER w, 0), 0) AS {c}_z" for c in ("motion_energy", "motion_metric", "cd10", "sum_absdiff")
    ) + " FROM met WINDOW w AS (PARTITION BY video, well))",
    "ann": """ann AS (SELECT conv_id * 1000 + turn AS annotation_id, conv_id AS presentation_id, conv_id % 50 AS clip_id, role AS annotator_id, conv_id % 7 AS annotation_session_id,
 't' || (conv_id % 3) AS task_id, 'v1' AS taxonomy_version, length(text) AS len, CASE WHEN turn % 7 = 6 THEN 1 ELSE 0 END AS skipped,
 CASE length(text) % 4 WHEN 0 THEN ['fish', 'quiet'] WHEN 1 THEN ['fish', 'active', 'weak'] WHEN 2 THEN ['artifact'] ELSE []::VARCHAR[] END AS labels,
 CASE WHEN length(text) % 3 <> 0 THEN length(text) * 2.0::DOUBLE END AS decision_elapsed_ms,
 printf('2026-01-01T00:%02d:%02d', (turn % 60)::INT, (conv_id % 60)::INT) AS created_at FROM conversations)""",
    "src": "src AS (SELECT s_suppkey::VARCHAR AS source_video_id, CASE WHEN s_nationkey % 5 = 0 THEN '' ELSE s_name END AS source_path FROM supplier)",
    "roi": """roi AS (SELECT ((p_partkey * 37) % 120 + 1)::VARCHAR AS source_video_id, p_partkey AS row_pos, 'W' || lpad((p_partkey % 96)::VARCHAR, 2, '0') AS well_label, (p_partkey % 96)::VARCHAR AS well_index,
 p_size AS x0, p_size * 2 AS y0, 20 AS width, 21 AS height, CASE WHEN p_size % 7 = 0 THEN '/roi/' || p_partkey ELSE '' END AS source_path FROM part)""",
    "prb": """prb AS (SELECT p_partkey AS row_pos, CASE WHEN p_partkey % 11 = 0 THEN 'h264' ELSE 'av1' END AS codec_name, 20 AS width, CASE WHEN p_partkey % 13 = 0 THEN 22 ELSE 21 END AS height,
 (CASE WHEN p_partkey % 17 = 0 THEN 0 WHEN p_partkey % 19 = 0 THEN 99 ELSE 100 END)::BIGINT AS packet_count FROM part)""",
}
#: Views that a view builds on.
_ON = {"cmp": ("tr",)}


def sql(views: str, steps: str, final: str, spec: str) -> str:
    """One statement: the named views, further WITH steps, the final query, tidied by ``spec``."""
    names: list[str] = []
    for v in views.split():
        names += [x for x in (*_ON.get(v, ()), v) if x not in names]
    parts = [SQL[n] for n in names] + ([steps] if steps else []) + [f"_final AS ({final})"]
    kinds = {"l": '"{0}"::BIGINT AS "{0}"', "i": '"{0}"::INTEGER AS "{0}"', "d": 'round("{0}"::DOUBLE, 6) + 0.0 AS "{0}"', "s": '"{0}"::VARCHAR AS "{0}"', "b": '"{0}"::BOOLEAN AS "{0}"'}
    cols = ", ".join(kinds[k].format(c) for c, k in columns(spec))
    return "WITH RECURSIVE " + ",\n".join(parts) + f"\nSELECT {cols} FROM _final"


def columns(spec: str) -> list[tuple[str, str]]:
    """(name, kind) of "name:kind" words; a bare name is a double."""
    return [(c.split(":") + ["d"])[:2] for c in spec.split()]


def tidy(df: DataFrame, spec: str) -> DataFrame:
    """The columns of ``spec`` in its types, doubles rounded to six places."""
    kinds = {
        "l": lambda c: c.cast("long"), "i": lambda c: c.cast("int"), "d": lambda c: F.round(c.cast("double"), 6) + F.lit(0.0),
        "s": lambda c: c.cast("string"), "b": lambda c: c.cast("boolean"),
    }
    return df.select(*[kinds[k](F.col(c)).alias(c) for c, k in columns(spec)])
