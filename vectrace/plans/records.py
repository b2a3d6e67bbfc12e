"""Queries over profiles, annotations, manifests, quality control and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrace.operators import annotations, imgdiff, manifests, profiles, qc
from vectrace.plans import catalog, views
from vectrace.plans.catalog import query

_FEATS = ("cd10", "sum_absdiff", "raw_motion_energy", "coherence", "mv_active_fraction", "mv_active_vectors", "mv_bout_fraction", "mv_bout_active_vectors")
_SEC_COLUMNS = "video:s well:s second_bin:l stage:s cd10_sum:l cd10_peak:l cd10_active_fraction " + " ".join(f"{c}_mean {c}_p95 {c}_max" for c in _FEATS) + " mv_bout_frame_fraction mv_bout_longest_run_frames:l"
_SEC_SQL = """ps0 AS (SELECT *, floor(time_seconds)::BIGINT AS second_bin FROM cmp),
ps1 AS (SELECT *, sum(CASE WHEN mv_bout_frame THEN 0 ELSE 1 END) OVER (PARTITION BY video, well, second_bin ORDER BY frame_index) AS bi FROM ps0),
ps2 AS (SELECT *, CASE WHEN mv_bout_frame THEN sum(mv_bout_frame::INT) OVER (PARTITION BY video, well, second_bin, bi) ELSE 0 END AS br FROM ps1),
ps AS (SELECT video, well, second_bin, regexp_extract(video, '_S(\\d+)$', 1) AS stage, sum(cd10) AS cd10_sum, max(cd10) AS cd10_peak, avg((cd10 > 0)::INT) AS cd10_active_fraction, """ + ", ".join(
    f"avg({c}::DOUBLE) AS {c}_mean, quantile_cont({c}::DOUBLE, 0.95) AS {c}_p95, max({c}) AS {c}_max" for c in _FEATS
) + ", avg(mv_bout_frame::INT) AS mv_bout_frame_fraction, max(br) AS mv_bout_longest_run_frames FROM ps2 GROUP BY video, well, second_bin)"


@query("profile_seconds", _SEC_COLUMNS, "cmp", _SEC_SQL, "SELECT * FROM ps")
def profile_seconds(spark, d):
    return profiles.profile_seconds(catalog.compared(spark, d))


_WELL_FEATS = ("cd10_sum", "cd10_active_fraction", "raw_motion_energy_mean", "mv_bout_fraction_max")


@query(
    "profile_wells", "video:s stage:s well:s " + " ".join(f"{c}_mean {c}_p95 {c}_max {c}_median" for c in _WELL_FEATS), "cmp", _SEC_SQL,
    "SELECT video, stage, well, " + ", ".join(f"avg({c}::DOUBLE) AS {c}_mean, quantile_cont({c}::DOUBLE, 0.95) AS {c}_p95, max({c}) AS {c}_max, median({c}::DOUBLE) AS {c}_median" for c in _WELL_FEATS) + " FROM ps GROUP BY ALL",
)
def profile_wells(spark, d):
    return profiles.profile_wells(profiles.profile_seconds(catalog.compared(spark, d)), list(_WELL_FEATS), ["video", "stage", "well"])


@query(
    "profile_pair_distance", "left:l right:l same_label:b distance", "",
    """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
z AS (SELECT vec_id, label, i, (x - avg(x) OVER w) / CASE WHEN stddev_pop(x) OVER w > 0 THEN stddev_pop(x) OVER w ELSE 1 END AS z FROM e WINDOW w AS (PARTITION BY i)),
f AS (SELECT vec_id, any_value(label) AS label, list(z ORDER BY i) AS z FROM z GROUP BY vec_id)""",
    'SELECT a.vec_id AS "left", b.vec_id AS "right", a.label IS NOT DISTINCT FROM b.label AS same_label, list_distance(a.z, b.z) AS distance FROM f a JOIN f b ON a.vec_id < b.vec_id',
)
def profile_pair_distance(spark, d):
    return profiles.pair_distance(profiles.standardised(views.profiles(spark, d)))


_ML = ["raw_motion_energy_mean", "mv_active_fraction_mean", "mv_active_fraction_max", "mv_bout_fraction_p95", "coherence_mean"]


@query("rf_leave_video", "fold:s label:s predicted:s n:l")
def rf_leave_video(spark, d):
    return profiles.separability(profiles.profile_seconds(catalog.compared(spark, d)), _ML, "well", ["video"], folds=None, trees=20)


@query("rf_group_folds", "fold:s accuracy balanced_accuracy chance")
def rf_group_folds(spark, d):
    sec = profiles.profile_seconds(catalog.compared(spark, d))
    return profiles.accuracy(profiles.separability(sec, _ML, "stage", ["video", "second_bin"], folds=3, trees=20))


@query("rf_importance", "feature:s importance")
def rf_importance(spark, d):
    return profiles.importances(profiles.profile_seconds(catalog.compared(spark, d)), _ML, "stage", trees=20)


@query("pca2", "video:s well:s second_bin:l pc1 pc2 explained_1 explained_2")
def pca2(spark, d):
    return profiles.pca2(profiles.profile_seconds(catalog.compared(spark, d)), _ML, ["video", "well", "second_bin"])


def history(spark: SparkSession, d: str) -> DataFrame:
    """Events with task ids from presentations and strata from clips, both required."""
    rows = views.annotations(spark, d)
    shown = rows.select("presentation_id", "task_id").distinct()
    clips = views.read(spark, d, "documents").select(F.col("doc_id").alias("clip_id"), F.col("source").alias("sampling_stratum"))
    return annotations.history(rows.drop("task_id"), shown, clips, inner=True)


_HISTORY_COLUMNS = (
    "annotation_id:l presentation_id:l clip_id:l annotator_id:s task_id:s created_at:s primary_label_path:s label_depth:i label_0:s label_1:s label_2:s "
    "decision_elapsed_ms skipped:i sampling_stratum:s"
)
_HISTORY = """h AS (SELECT ann.*, array_to_string(labels, ' / ') AS primary_label_path, len(labels) AS label_depth, coalesce(labels[1], '') AS label_0, coalesce(labels[2], '') AS label_1,
 coalesce(labels[3], '') AS label_2, documents.source AS sampling_stratum FROM ann JOIN documents ON doc_id = clip_id)"""


@query("annotation_history", _HISTORY_COLUMNS, "ann", _HISTORY, "SELECT * FROM h")
def annotation_history(spark, d):
    return history(spark, d)


@query("annotation_filtered", _HISTORY_COLUMNS, "ann", _HISTORY, "SELECT * FROM h WHERE task_id = 't1' AND annotator_id = 'user'")
def annotation_filtered(spark, d):
    return annotations.chosen(history(spark, d), task="t1", annotator="user", taxonomy="")


def _latest_sql(scope: str) -> str:
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(annotations.SCOPES[scope])} ORDER BY created_at DESC, annotation_id DESC) AS rn FROM h) WHERE rn = 1"


for _scope in annotations.SCOPES:
    query(f"annotation_current_{_scope}", _HISTORY_COLUMNS, "ann", _HISTORY, _latest_sql(_scope))(
        lambda spark, d, s=_scope: annotations.current(history(spark, d), s)
    )

_CLIPS = _HISTORY + f""",
cu AS ({_latest_sql('clip_annotator')}),
cl AS (SELECT clip_id, count(*) AS n_current_annotations, count(*) FILTER (WHERE skipped = 0) AS n_non_skipped_annotations, string_agg(DISTINCT annotator_id, ';' ORDER BY annotator_id) AS annotator_ids,
 list_sort(list(DISTINCT primary_label_path) FILTER (WHERE skipped = 0)) AS ls, max(created_at) AS latest_created_at, arg_max(sampling_stratum, created_at || lpad(annotation_id::VARCHAR, 12, '0')) AS sampling_stratum FROM cu GROUP BY clip_id),
cs AS (SELECT *, coalesce(array_to_string(ls, ';'), '') AS primary_label_paths, CASE WHEN len(ls) = 1 THEN ls[1] ELSE '' END AS consensus_primary_label_path,
 (coalesce(len(ls), 0) > 1)::INT AS has_label_disagreement, (n_non_skipped_annotations = 0)::INT AS all_skipped FROM cl)"""


def clips(spark: SparkSession, d: str) -> DataFrame:
    return annotations.clip_summary(annotations.current(history(spark, d), "clip_annotator"), ["sampling_stratum"])


@query(
    "clip_label_summary",
    "clip_id:l n_current_annotations:l n_non_skipped_annotations:l annotator_ids:s primary_label_paths:s consensus_primary_label_path:s has_label_disagreement:i all_skipped:i "
    "latest_created_at:s sampling_stratum:s", "ann", _CLIPS, "SELECT * FROM cs",
)
def clip_label_summary(spark, d):
    return clips(spark, d)


@query(
    "label_feature_summary", "label:s n_clips:l raw_motion_energy_median cd10_median", "cmp ann",
    _CLIPS + ", fe AS (SELECT frame_index AS clip_id, raw_motion_energy, cd10 FROM cmp WHERE video = 'run_S0' AND well = 'click')",
    """SELECT consensus_primary_label_path AS label, count(*) AS n_clips, median(raw_motion_energy::DOUBLE) AS raw_motion_energy_median, median(cd10::DOUBLE) AS cd10_median
 FROM cs JOIN fe USING (clip_id) GROUP BY 1""",
)
def label_feature_summary(spark, d):
    feats = catalog.compared(spark, d).filter("video = 'run_S0' AND well = 'click'").select(F.col("frame_index").alias("clip_id"), "raw_motion_energy", "cd10")
    return annotations.label_feature_summary(clips(spark, d), feats, ["raw_motion_energy", "cd10"])


@query(
    "feature_bin_summary", "video:s well:s n_feature_bins:l smvo_mean smvo_max coherence_mean coherence_max", "cmp", catalog._REGIME,
    "SELECT video, well, count(*) AS n_feature_bins, avg(smvo) AS smvo_mean, max(smvo) AS smvo_max, avg(coherence) AS coherence_mean, max(coherence) AS coherence_max FROM rs GROUP BY ALL",
)
def feature_bin_summary(spark, d):
    return annotations.feature_bin_summary(catalog.binary(spark, d), ["smvo", "coherence"], ["video", "well"])


@query(
    "label_feature_interval_join", "video:s well:s frame_index:l clip_id:l label_0:s", "tr ann",
    _HISTORY + """, w AS (SELECT clip_id, annotation_id, label_0, 'run_S' || (clip_id % 5) AS video, 'click' AS well, (clip_id % 17) * 0.9::DOUBLE AS start_time_s, (clip_id % 17) * 0.9::DOUBLE + 1.3::DOUBLE AS end_time_s FROM h)""",
    "SELECT tr.video, tr.well, tr.frame_index, w.clip_id, w.label_0 FROM tr JOIN w ON tr.video = w.video AND tr.well = w.well AND time_seconds >= start_time_s AND time_seconds < end_time_s",
)
def label_feature_interval_join(spark, d):
    start = F.col("clip_id") % 17 * F.lit(0.9)
    marks = history(spark, d).select(
        "clip_id", "label_0", F.concat(F.lit("run_S"), (F.col("clip_id") % 5).cast("string")).alias("video"), F.lit("click").alias("well"),
        start.alias("start_time_s"), (start + F.lit(1.3)).alias("end_time_s"),
    )
    return annotations.label_intervals(marks, views.traces(spark, d), ["video", "well"])


# Manifests: regions whose source is in the catalogue.
_WELLS = """ok AS (SELECT roi.* FROM roi JOIN src USING (source_video_id)),
mg AS (SELECT ok.* EXCLUDE (source_path), coalesce(nullif(trim(src.source_path), ''), nullif(trim(ok.source_path), ''), '') AS source_path FROM ok JOIN src USING (source_video_id)),
sk AS (SELECT * FROM mg WHERE source_path <> ''),
fi AS (SELECT source_video_id, row_number() OVER (ORDER BY min(row_pos)) AS plate_task_id FROM sk GROUP BY source_video_id),
wl AS (SELECT sk.*, plate_task_id, 'runs/' || source_video_id AS output_dir, 'runs/' || source_video_id || '/video/' || source_video_id || '_' || well_label || '.av1.mkv' AS well_archive_path
 FROM sk JOIN fi USING (source_video_id)),
pl AS (SELECT plate_task_id, source_video_id, max(source_path) AS source_path, max(output_dir) AS output_dir, count(*) AS n_wells FROM wl GROUP BY ALL)"""


def known_roi(spark: SparkSession, d: str) -> DataFrame:
    return views.roi_rows(spark, d).join(views.catalog_rows(spark, d).select("source_video_id"), "source_video_id", "left_semi")


def wells(spark: SparkSession, d: str) -> DataFrame:
    return manifests.wells(views.catalog_rows(spark, d), known_roi(spark, d), skip_missing=True)


def plates(spark: SparkSession, d: str) -> DataFrame:
    return manifests.plates(wells(spark, d))


_PLATE_COLUMNS = "plate_task_id:l source_video_id:s source_path:s output_dir:s n_wells:l"


@query("well_manifest", "plate_task_id:l source_video_id:s source_path:s row_pos:l well_label:s well_archive_path:s crop_width:i crop_height:i", "src roi", _WELLS, "SELECT *, width AS crop_width, height AS crop_height FROM wl")
def well_manifest(spark, d):
    return wells(spark, d)


@query("plate_manifest", _PLATE_COLUMNS, "src roi", _WELLS, "SELECT * FROM pl")
def plate_manifest(spark, d):
    return plates(spark, d)


@query("missing_sources", "skipped_missing_source_path:l", "src roi", _WELLS, "SELECT count(*) AS skipped_missing_source_path FROM mg WHERE source_path = ''")
def missing_sources(spark, d):
    return manifests.missing_sources(views.catalog_rows(spark, d), known_roi(spark, d))


@query("roi_without_source", "source_video_id:s row_pos:l", "src roi", "", "SELECT source_video_id, row_pos FROM roi WHERE source_video_id NOT IN (SELECT source_video_id FROM src)")
def roi_without_source(spark, d):
    return manifests.incomplete(views.roi_rows(spark, d), views.catalog_rows(spark, d), ["source_video_id"])


@query("chunk_page", _PLATE_COLUMNS, "src roi", _WELLS, "SELECT * FROM pl WHERE plate_task_id > 2 AND plate_task_id <= 4")
def chunk_page(spark, d):
    return manifests.page(plates(spark, d), 2, 2)


@query("balanced_partition", "plate_task_id:l row_pos:l group:i", "src roi", _WELLS, 'SELECT plate_task_id, row_pos, ntile(3) OVER (PARTITION BY plate_task_id ORDER BY row_pos) AS "group" FROM wl')
def balanced_partition(spark, d):
    return manifests.balanced(wells(spark, d), 3, ["plate_task_id"], ["row_pos"])


@query(
    "sentinels", "plate_task_id:l row_pos:l position:i is_sentinel:b", "src roi", _WELLS + """,
sp AS (SELECT plate_task_id, row_pos, row_number() OVER (PARTITION BY plate_task_id ORDER BY row_pos) - 1 AS position, count(*) OVER (PARTITION BY plate_task_id) AS n FROM wl)""",
    """SELECT plate_task_id, row_pos, position, CASE WHEN n <= 5 THEN true ELSE list_contains(list_transform(range(5), lambda i: round_even(i * (n - 1) / 4.0::DOUBLE, 0)::BIGINT), position) END AS is_sentinel FROM sp""",
)
def sentinels(spark, d):
    return manifests.sentinel_rows(wells(spark, d), 5, ["plate_task_id"], "row_pos")


@query(
    "crop_filters", "plate_task_id:l crop_filter:s", "src roi", _WELLS + """,
cr AS (SELECT plate_task_id, row_pos, row_number() OVER (PARTITION BY plate_task_id ORDER BY row_pos) - 1 AS i, x0, y0, width, height FROM wl)""",
    """SELECT plate_task_id, '[0:v]format=gray,split=' || count(*) || string_agg('[s' || i || ']', '' ORDER BY i) || ';' ||
 string_agg('[s' || i || ']crop=' || width || ':' || height || ':' || x0 || ':' || y0 || '[v' || i || ']', ';' ORDER BY i) AS crop_filter FROM cr GROUP BY plate_task_id""",
)
def crop_filters(spark, d):
    return manifests.crop_filter(wells(spark, d), ["plate_task_id"], "row_pos")


@query(
    "validation_violations", "plate_task_id:l row_pos:l rule:s", "src roi prb", _WELLS + """,
vj AS (SELECT wl.plate_task_id, wl.row_pos, wl.width AS cw, wl.height AS ch, prb.* EXCLUDE (row_pos), max(packet_count) OVER w AS hi, min(packet_count) OVER w AS lo FROM wl LEFT JOIN prb USING (row_pos) WINDOW w AS (PARTITION BY plate_task_id)),
vr AS (SELECT plate_task_id, row_pos, unnest([CASE WHEN codec_name <> 'av1' THEN 'codec' END, CASE WHEN width <> cw OR height <> ch THEN 'geometry' END, CASE WHEN packet_count <= 0 THEN 'empty' END, CASE WHEN hi <> lo THEN 'counts_differ' END]) AS rule FROM vj)""",
    "SELECT * FROM vr WHERE rule IS NOT NULL",
)
def validation_violations(spark, d):
    return manifests.violations(wells(spark, d), views.probes(spark, d), "row_pos", "plate_task_id")


def _staged(spark, d):
    return plates(spark, d).filter("plate_task_id % 4 = 1").select("source_video_id")


def _checked(spark, d):
    return plates(spark, d).select("source_video_id", F.when(F.col("plate_task_id") % 3 == 0, "validated").otherwise("encoding").alias("status"))


@query("stage_budget", _PLATE_COLUMNS, "src roi", _WELLS, "SELECT * FROM pl WHERE plate_task_id % 4 <> 1 ORDER BY plate_task_id LIMIT (SELECT greatest(0, 40 - count(*)) FROM pl WHERE plate_task_id % 4 = 1)")
def stage_budget(spark, d):
    return manifests.stage_plan(plates(spark, d), _staged(spark, d), 40)


@query("validated_semi", _PLATE_COLUMNS, "src roi", _WELLS, "SELECT * FROM pl WHERE plate_task_id % 3 = 0")
def validated_semi(spark, d):
    return manifests.collect_plan(plates(spark, d), _checked(spark, d))


@query("retire_plan", _PLATE_COLUMNS, "src roi", _WELLS, "SELECT * FROM pl WHERE plate_task_id % 3 = 0 AND plate_task_id % 4 = 1")
def retire_plan(spark, d):
    return manifests.retire_plan(plates(spark, d), _checked(spark, d), _staged(spark, d))


@query(
    "plate_task_status", "plate_task_id:l status:s", "src roi", _WELLS,
    """SELECT plate_task_id, CASE WHEN plate_task_id % 11 = 0 THEN 'missing_source' WHEN plate_task_id * 10 > 800 THEN 'source_duration_exceeds_limit' WHEN plate_task_id % 5 = n_wells THEN 'skipped_existing'
 WHEN plate_task_id % 5 > 0 THEN 'partial_existing_outputs' WHEN plate_task_id % 7 = 0 THEN 'ffmpeg_failed' WHEN plate_task_id % 2 = 0 THEN 'validated' ELSE 'encoding' END AS status FROM pl""",
)
def plate_task_status(spark, d):
    n = F.col("plate_task_id")
    facts = plates(spark, d).select(
        "plate_task_id", "n_wells", (n % 11 != 0).alias("source_exists"), (n * 10.0).alias("duration_s"), (n % 5).alias("n_existing"), (n % 7 != 0).alias("encoder_ok"),
        F.lit(True).alias("copied"), (n % 2 == 0).alias("valid"),
    )
    return manifests.task_status(facts, slots=8, threads=2, processes=4, max_seconds=800.0)


@query(
    "sidecar_tasks", "task_id:l input_path:s output_dir:s vector_output:s vector_frame_stride:i", "", "",
    """SELECT row_number() OVER (ORDER BY '/data/' || c_mktsegment || '/' || c_name || '.mkv') AS task_id, '/data/' || c_mktsegment || '/' || c_name || '.mkv' AS input_path,
 '/out/' || c_mktsegment || '/' || c_name AS output_dir, 'sampled' AS vector_output, 2 AS vector_frame_stride FROM customer""",
)
def sidecar_tasks(spark, d):
    paths = views.read(spark, d, "customer").select(F.concat(F.lit("/data/"), "c_mktsegment", F.lit("/"), "c_name", F.lit(".mkv")).alias("input_path"))
    return manifests.tasks(paths, "/out", "/data", vector_output="sampled", vector_frame_stride=2)


@query(
    "plate_template", "well_label:s well_index:l roi_x0 roi_y0 roi_x1 roi_y1", "", "",
    "SELECT chr((65 + i // 12)::INT) || lpad((i % 12 + 1)::VARCHAR, 2, '0') AS well_label, i AS well_index, (i % 12) * 83.0 AS roi_x0, (i // 12) * 83.0 AS roi_y0, (i % 12) * 83.0 + 83 AS roi_x1, (i // 12) * 83.0 + 83 AS roi_y1 FROM range(96) AS t(i)",
)
def plate_template(spark, d):
    return manifests.plate_template(spark)


@query(
    "batch_status", "status:s n:l input_bytes:l output_bytes:l output_to_input_ratio", "", "",
    "SELECT o_orderstatus AS status, count(*) AS n, sum(o_custkey) AS input_bytes, sum(o_orderkey % 100) AS output_bytes, sum(o_orderkey % 100) / nullif(sum(o_custkey), 0)::DOUBLE AS output_to_input_ratio FROM orders GROUP BY 1",
)
def batch_status(spark, d):
    items = views.read(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("input_bytes"), (F.col("o_orderkey") % 100).alias("output_bytes"))
    return manifests.batch_summary(items)


@query(
    "benchmark_arms", "arm:s median_s relative", "", "m AS (SELECT o_orderpriority AS arm, median(o_totalprice) AS median_s FROM orders GROUP BY 1)",
    "SELECT arm, median_s, median_s / (SELECT median_s FROM m WHERE arm = '1-URGENT') AS relative FROM m",
)
def benchmark_arms(spark, d):
    return manifests.arm_medians(views.read(spark, d, "orders").select(F.col("o_orderpriority").alias("arm"), F.col("o_totalprice").alias("seconds")), "1-URGENT")


@query(
    "qc_plate_context", "video:s frame_index:l n_wells:l plate_well_active_fraction plate_activity_median plate_activity_dispersion", "tr",
    "pm AS (SELECT *, median(raw_motion_energy) OVER (PARTITION BY video, frame_index) AS m FROM tr)",
    """SELECT video, frame_index, count(*) AS n_wells, avg((mv_active_vectors >= 1)::INT) AS plate_well_active_fraction, max(m) AS plate_activity_median,
 median(abs(raw_motion_energy - m)) AS plate_activity_dispersion FROM pm GROUP BY ALL""",
)
def qc_plate_context(spark, d):
    return qc.plate_context(views.traces(spark, d), "raw_motion_energy", F.col("mv_active_vectors") >= 1, ["video", "frame_index"])


@query(
    "qc_window_auc", "video:s well:s window_index:l median p95 max auc active_frame_fraction", "tr",
    """wa AS (SELECT *, floor(time_seconds)::BIGINT AS window_index FROM tr),
wb AS (SELECT *, (lead(time_seconds) OVER w - time_seconds) * (lead(raw_motion_energy) OVER w + raw_motion_energy) / 2.0 AS a FROM wa WINDOW w AS (PARTITION BY video, well, window_index ORDER BY time_seconds, frame_index))""",
    """SELECT video, well, window_index, median(raw_motion_energy) AS median, quantile_cont(raw_motion_energy, 0.95) AS p95, max(raw_motion_energy) AS max, coalesce(sum(a), 0) AS auc,
 avg((mv_active_vectors >= 1)::INT) AS active_frame_fraction FROM wb GROUP BY video, well, window_index""",
)
def qc_window_auc(spark, d):
    return qc.window_summary(views.traces(spark, d), "raw_motion_energy", F.col("mv_active_vectors") >= 1, ["video", "well"])


@query(
    "qc_synchronous", "video:s well:s plate_synchronous_active_frame_fraction", "tr",
    "sy AS (SELECT *, mv_active_vectors >= 3 AS act, avg((mv_active_vectors >= 3)::INT) OVER (PARTITION BY video, frame_index) AS p FROM tr)",
    "SELECT video, well, coalesce(count(*) FILTER (WHERE act AND p >= 0.5) / nullif(count(*) FILTER (WHERE act), 0)::DOUBLE, 0) AS plate_synchronous_active_frame_fraction FROM sy GROUP BY ALL",
)
def qc_synchronous(spark, d):
    return qc.synchronous_fraction(views.traces(spark, d), F.col("mv_active_vectors") >= 3, ["video", "frame_index"], ["video", "well"])


@query(
    "qc_duplicate_like", "video:s well:s duplicate_like_frame_fraction", "tr",
    "dl AS (SELECT *, row_number() OVER (PARTITION BY video, well ORDER BY frame_index) AS rn FROM tr)",
    "SELECT video, well, coalesce(avg((cd10 = 0)::INT) FILTER (WHERE rn > 1), 0) AS duplicate_like_frame_fraction FROM dl GROUP BY ALL",
)
def qc_duplicate_like(spark, d):
    return qc.duplicate_like(views.traces(spark, d), ["video", "well"], "cd10")


@query(
    "qc_wall_fraction", "clip:l frame_index:l motion_wall_fraction", "vec", catalog._GRID,
    "SELECT clip, frame_index, avg((grid_bin // 4 IN (0, 3) OR grid_bin % 4 IN (0, 3))::INT) AS motion_wall_fraction FROM gr GROUP BY ALL",
)
def qc_wall_fraction(spark, d):
    return qc.wall_fraction(catalog._gridded(spark, d), ["clip"])


@query(
    "qc_radial_shares", "clip:l ring:i n:l share", "vec", catalog._GRID + """,
ra AS (SELECT clip, least(floor(sqrt(pow(xn - 0.5, 2) + pow(yn - 0.5, 2)) / 0.7071067811865476 * 4), 3)::INT AS ring, count(*) AS n FROM gr GROUP BY ALL)""",
    "SELECT *, n / sum(n) OVER (PARTITION BY clip) AS share FROM ra",
)
def qc_radial_shares(spark, d):
    return qc.radial_shares(catalog._gridded(spark, d), ["clip"])


@query(
    "qc_centroid_displacement", "clip:l frame_index:l motion_centroid_displacement", "vec", catalog._CELLS,
    "SELECT clip, frame_index, sqrt(pow(motion_centroid_x_norm - lag(motion_centroid_x_norm) OVER w, 2) + pow(motion_centroid_y_norm - lag(motion_centroid_y_norm) OVER w, 2)) AS motion_centroid_displacement FROM cen WINDOW w AS (PARTITION BY clip ORDER BY frame_index)",
)
def qc_centroid_displacement(spark, d):
    from vectrace.operators.features import spatial_features

    return qc.centroid_displacement(spatial_features(catalog._gridded(spark, d).filter("magnitude_px > 0"), ["clip"]), ["clip"])


@query(
    "qc_derived_ratios", "video:s well:s frame_index:l mv_to_change well_to_plate", "tr",
    "dr AS (SELECT *, median(raw_motion_energy) OVER (PARTITION BY video, frame_index) AS m FROM tr)",
    "SELECT video, well, frame_index, raw_motion_energy / greatest(sum_absdiff::DOUBLE, 5) AS mv_to_change, raw_motion_energy / greatest(m, 1) AS well_to_plate FROM dr",
)
def qc_derived_ratios(spark, d):
    from pyspark.sql import Window

    median = F.percentile("raw_motion_energy", F.lit(0.5)).over(Window.partitionBy("video", "frame_index"))
    return views.traces(spark, d).withColumns({
        "mv_to_change": qc.floored_ratio("raw_motion_energy", "sum_absdiff", 5.0), "well_to_plate": qc.floored_ratio("raw_motion_energy", median, 1.0),
    })


@query(
    "qc_directional_resultant", "clip:l plate_motion_directional_resultant", "vec",
    "un AS (SELECT clip, dx_px / nullif(magnitude_px, 0) AS ux, dy_px / nullif(magnitude_px, 0) AS uy FROM vec)",
    "SELECT clip, coalesce(sqrt(pow(avg(ux), 2) + pow(avg(uy), 2)), 0) AS plate_motion_directional_resultant FROM un GROUP BY clip",
)
def qc_directional_resultant(spark, d):
    return qc.directional_resultant(views.vectors(spark, d), "dx_px", "dy_px", ["clip"])


def moving_square(spark: SparkSession) -> DataFrame:
    """Fifty grey frames of 83 x 83: a bright square that rests, moves right, rests, moves up, rests."""
    import numpy as np

    rows = []
    for t in range(50):
        plane = np.full((83, 83), 18, dtype=np.uint8)
        plane[12, 8:75], plane[15:72, 66] = 55, 48
        x, y = 18 + 2 * min(max(t - 9, 0), 11), 36 - 2 * min(max(t - 29, 0), 11)
        plane[y : y + 12, x : x + 12] = 220
        rows.append(("square", t, 83, 83, plane.tobytes()))
    return spark.createDataFrame(rows, "clip string, frame_index long, width int, height int, gray binary")


_SEPARATED = [c for c in profiles.SEPARABILITY_FEATURES if c != "mv_active_fraction"]


@query(
    "separability_seconds", "clip:l second_bin:l cd10_sum:l cd10_active_fraction " + " ".join(f"{c}_mean {c}_p95 {c}_max" for c in _SEPARATED), "vec fr",
    catalog.FRAME_SUMMARY + ", ss AS (SELECT fs.*, CASE WHEN fs.sum_magnitude_px > 0 THEN fs.resultant_magnitude_px / (fs.sum_magnitude_px + 1e-12) ELSE 0 END AS coherence, floor(fr.time_seconds)::BIGINT AS second_bin, greatest(frame_index % 37 - 12, 0) AS cd10 FROM fs JOIN fr USING (clip, frame_index))",
    "SELECT clip, second_bin, sum(cd10) AS cd10_sum, avg((cd10 > 0)::INT) AS cd10_active_fraction, " + ", ".join(
        f"avg({c}::DOUBLE) AS {c}_mean, quantile_cont({c}::DOUBLE, 0.95) AS {c}_p95, max({c}) AS {c}_max" for c in _SEPARATED
    ) + " FROM ss GROUP BY clip, second_bin",
)
def separability_seconds(spark, d):
    from vectrace.operators import vectors

    summary = vectors.frame_summary(views.vectors(spark, d), keys=("clip",))
    timed = summary.join(views.frames(spark, d).select("clip", "frame_index", "time_seconds"), ["clip", "frame_index"])
    return profiles.separability_seconds(timed.withColumn("cd10", F.greatest(F.col("frame_index") % 37 - 12, F.lit(0))), ("clip",))


#: The square's moves in SQL: pixels it has moved over the last k frames; the lines are never under it.
MOVED = "(least(greatest(t - 9, 0), 11) - least(greatest(t - {k} - 9, 0), 11) + least(greatest(t - 29, 0), 11) - least(greatest(t - {k} - 29, 0), 11)) * 2"
CHANGED = "CASE WHEN t >= {k} THEN 24 * least(" + MOVED + ", 12) ELSE 0 END"
SQUARE = "sq AS (SELECT range AS t FROM range(50))"


@query(
    "image_diff_square", "clip:s frame_index:l changed_pixels:l changed_sum:l changed_fraction abs_sum:l abs_mean signed_mean", "",
    SQUARE + f", ch AS (SELECT t, {CHANGED.format(k=1)} AS n FROM sq)",
    "SELECT 'square' AS clip, t AS frame_index, n AS changed_pixels, n * 202 AS changed_sum, n / 6889.0::DOUBLE AS changed_fraction, n * 202 AS abs_sum, n * 202 / 6889.0::DOUBLE AS abs_mean, 0 AS signed_mean FROM ch",
)
def image_diff_square(spark, d):
    return imgdiff.frame_difference(moving_square(spark), ["clip"])


@query(
    "image_lags_square", "clip:s frame_index:l " + " ".join(f"imgdiff_l{k}_changed_fraction imgdiff_l{k}_abs_mean" for k in (1, 3, 10)), "", SQUARE,
    "SELECT 'square' AS clip, t AS frame_index, " + ", ".join(
        f"{CHANGED.format(k=k)} / 6889.0::DOUBLE AS imgdiff_l{k}_changed_fraction, {CHANGED.format(k=k)} * 202 / 6889.0::DOUBLE AS imgdiff_l{k}_abs_mean" for k in (1, 3, 10)
    ) + " FROM sq",
)
def image_lags_square(spark, d):
    return imgdiff.lag_differences(moving_square(spark), ["clip"])


def _pixel(t: str, y: str, x: str) -> str:
    left, top = f"(18 + 2 * least(greatest({t} - 9, 0), 11))", f"(36 - 2 * least(greatest({t} - 29, 0), 11))"
    inside = f"{x} >= {left} AND {x} < {left} + 12 AND {y} >= {top} AND {y} < {top} + 12"
    return f"CASE WHEN {inside} THEN 220 WHEN {x} = 66 AND {y} BETWEEN 15 AND 71 THEN 48 WHEN {y} = 12 AND {x} BETWEEN 8 AND 74 THEN 55 ELSE 18 END"


@query(
    "block_motion_square", "clip:s frame_index:l vector_index:i dx_px:i dy_px:i magnitude_px block_cd_pixels:i", "",
    f"""bl AS (SELECT b.range AS i, 16 * (b.range // 5) AS y, 16 * (b.range % 5) AS x FROM range(25) b), px AS (SELECT p.range // 16 AS v, p.range % 16 AS u FROM range(256) p),
sh AS (SELECT a.range AS dy, b.range AS dx FROM range(-7, 8) a, range(-7, 8) b),
co AS (SELECT t.range AS t, i, dy, dx, sum(abs({_pixel('t.range', 'y + v', 'x + u')} - {_pixel('(t.range - 1)', 'y + v + dy', 'x + u + dx')})) AS cost
 FROM range(1, 50) t, bl, px, sh WHERE y + dy >= 0 AND y + dy + 16 <= 83 AND x + dx >= 0 AND x + dx + 16 <= 83 GROUP BY ALL),
be AS (SELECT *, row_number() OVER (PARTITION BY t, i ORDER BY cost, dy * dy + dx * dx, dy, dx) AS rn FROM co),
cd AS (SELECT t.range AS t, i, count(*) FILTER (WHERE abs({_pixel('t.range', 'y + v', 'x + u')} - {_pixel('(t.range - 1)', 'y + v', 'x + u')}) > 10) AS n FROM range(1, 50) t, bl, px GROUP BY ALL)""",
    """SELECT 'square' AS clip, t AS frame_index, i AS vector_index, -dx AS dx_px, -dy AS dy_px, sqrt((dx * dx + dy * dy)::DOUBLE) AS magnitude_px, n AS block_cd_pixels
 FROM be JOIN cd USING (t, i) WHERE rn = 1""",
)
def block_motion_square(spark, d):
    from vectrace.operators import vectors

    frames = moving_square(spark)
    found = vectors.derive(imgdiff.block_motion(frames, ["clip"]))
    return imgdiff.block_differences(found, frames, ["clip"])


@query(
    "local_gate_square", "clip:s frame_index:l vector_index:i block_mean_diff block_max_diff block_cd_pixels:i", "",
    f"""bl AS (SELECT b.range AS i, 16 * (b.range // 5) AS y, 16 * (b.range % 5) AS x FROM range(25) b), px AS (SELECT p.range // 16 AS v, p.range % 16 AS u FROM range(256) p),
df AS (SELECT t.range AS t, i, abs({_pixel('t.range', 'y + v', 'x + u')} - {_pixel('(t.range - 1)', 'y + v', 'x + u')}) AS d FROM range(1, 50) t, bl, px),
bd AS (SELECT t, i, avg(d) AS m, max(d) AS x, count(*) FILTER (WHERE d > 10) AS n FROM df GROUP BY ALL)""",
    "SELECT 'square' AS clip, t AS frame_index, i AS vector_index, m AS block_mean_diff, x AS block_max_diff, n AS block_cd_pixels FROM bd WHERE m >= 1 AND x >= 50 AND n >= 8",
)
def local_gate_square(spark, d):
    from vectrace.operators import vectors

    frames = moving_square(spark)
    blocks = imgdiff.block_differences(imgdiff.block_motion(frames, ["clip"]), frames, ["clip"])
    return vectors.local_gate(blocks, mean_diff=1.0, max_diff=50.0, changed=8)


@query("phase_shift_square", "clip:s frame_index:l shift_x_px shift_y_px shift_px response")
def phase_shift_square(spark, d):
    return imgdiff.phase_shift(moving_square(spark), ["clip"])


@query(
    "colour_diff_square", "clip:s frame_index:l changed_pixels:l abs_sum:l", "",
    SQUARE + f", ch AS (SELECT t, {CHANGED.format(k=1)} AS n FROM sq)",
    # Blue 220 - t % 3, green 18, red 55 inside the square and 18 outside, in fixed-point grey.
    """SELECT 'square' AS clip, t AS frame_index, CASE WHEN t > 0 THEN greatest(n, 0) ELSE 0 END AS changed_pixels,
 CASE WHEN t > 0 THEN n // 2 * ((1868 * (220 - t % 3) + 9617 * 18 + 4899 * 55 + 8192) // 16384 + (1868 * (220 - (t - 1) % 3) + 9617 * 18 + 4899 * 55 + 8192) // 16384 - 36)
  + (144 - n // 2) * abs((1868 * (220 - t % 3) + 9617 * 18 + 4899 * 55 + 8192) // 16384 - (1868 * (220 - (t - 1) % 3) + 9617 * 18 + 4899 * 55 + 8192) // 16384) ELSE 0 END AS abs_sum FROM ch""",
)
def colour_diff_square(spark, d):
    import numpy as np

    rows = []
    for t in range(50):
        plane = np.full((83, 83, 3), 18, dtype=np.uint8)
        x, y = 18 + 2 * min(max(t - 9, 0), 11), 36 - 2 * min(max(t - 29, 0), 11)
        plane[y : y + 12, x : x + 12] = (220 - t % 3, 18, 55)
        rows.append(("square", t, 83, 83, plane.tobytes()))
    frames = spark.createDataFrame(rows, "clip string, frame_index long, width int, height int, bgr binary")
    return imgdiff.frame_difference(imgdiff.to_gray(frames), ["clip"])


@query(
    "plate_layout_24", "well_label:s well_index:l roi_x0:i roi_y0:i roi_x1:i roi_y1:i", "",
    "pl AS (SELECT range AS i, [138, 400, 662, 925, 1187, 1450][range % 6 + 1] AS x, [137, 400, 663, 927][range // 6 + 1] AS y FROM range(24))",
    "SELECT chr((65 + i // 6)::INT) || lpad((i % 6 + 1)::VARCHAR, 2, '0') AS well_label, i AS well_index, x - 128 AS roi_x0, y - 128 AS roi_y0, x + 128 AS roi_x1, y + 128 AS roi_y1 FROM pl",
)
def plate_layout_24(spark, d):
    return manifests.plate_layout(spark, manifests.layout_of(1664, 1440))


@query(
    "plate_layout_96", "well_label:s well_index:l roi_x0:i roi_y0:i roi_x1:i roi_y1:i", "",
    "pl AS (SELECT range AS i, 22 + 131 * (range % 12) AS x, 16 + 132 * (range // 12) AS y FROM range(96))",
    "SELECT chr((65 + i // 12)::INT) || lpad((i % 12 + 1)::VARCHAR, 2, '0') AS well_label, i AS well_index, x AS roi_x0, y AS roi_y0, x + 112 AS roi_x1, y + 109 AS roi_y1 FROM pl",
)
def plate_layout_96(spark, d):
    return manifests.plate_layout(spark, manifests.layout_of(1600, 1068))


@query(
    "routed_rows", "row_pos:l well_archive_path:s", "roi", "", "SELECT row_pos, '/scratch/' || source_video_id || '/video/' || well_label || '.av1.mkv' AS well_archive_path FROM roi",
)
def routed_rows(spark, d):
    rows = views.roi_rows(spark, d).withColumn("well_archive_path", F.concat(F.lit("/old/"), "source_video_id", F.lit("/video/"), "well_label", F.lit(".av1.mkv")))
    return manifests.routed(rows, "/scratch/")


@query(
    "incomplete_work", "row_pos:l source_video_id:s", "roi prb", "",
    "SELECT row_pos, source_video_id FROM roi WHERE row_pos NOT IN (SELECT row_pos FROM prb WHERE codec_name = 'av1' AND packet_count > 0)",
)
def incomplete_work(spark, d):
    done = views.probes(spark, d).filter("codec_name = 'av1' and packet_count > 0")
    return manifests.incomplete(views.roi_rows(spark, d), done.select("row_pos"), ["row_pos"])


@query(
    "roi_normalised", "source_video_id:s n:l x0:l y1:l", "roi", "", "SELECT source_video_id, count(*) AS n, sum(x0) AS x0, sum(y0 + height) AS y1 FROM roi GROUP BY source_video_id",
)
def roi_normalised(spark, d):
    rows = views.roi_rows(spark, d)
    named = rows.select(*[F.col(c).alias(f"analysis_{c}" if c.startswith("roi_") else c) for c in rows.columns])
    return manifests.normalise_roi(named).groupBy("source_video_id").agg(
        F.count("*").alias("n"), F.sum(F.col("roi_x0").cast("long")).alias("x0"), F.sum(F.col("roi_y1").cast("long")).alias("y1")
    )


@query(
    "campaign_capacity", "shared_peak_gb wall_hours", "src", "", "SELECT 20 * (9 + 5 + 2 + 0.5) AS shared_peak_gb, count(*) * 1.5 / 20 AS wall_hours FROM src",
)
def campaign_capacity(spark, d):
    plates = views.catalog_rows(spark, d).count()
    return spark.createDataFrame([manifests.capacity(plates, 20, 1.5, 9.0, 5.0, 2.0, 0.5)])
