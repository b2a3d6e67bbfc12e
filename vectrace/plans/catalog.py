"""Registered queries over the projected tables, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrace.functions import stats
from vectrace.functions.exprs import CANDIDATES, SCREENED, in_source
from vectrace.operators import features, runs, traces, vectors
from vectrace.plans import views
from vectrace.plans.views import sql, tidy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, spec: str, use: str | None = None, steps: str = "", final: str = "") -> Callable:
    """Register a function of (spark, sf_dir) with its columns and, if given, its SQL."""

    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(f(spark, sf_dir), spec)
        if use is not None:
            SQL[name] = sql(use, steps, final, spec)
        return f

    return add


VECTOR = "frame_index:l vector_index:i source:i dst_x:i dst_y:i dx_px:i dy_px:i magnitude_px"


@query("vector_derive", VECTOR, "vec", "", "SELECT * FROM vec")
def vector_derive(spark, d):
    return vectors.derive(views.vectors(spark, d).drop("dx_px", "dy_px", "magnitude_px"))


for _which, _test in (("past", "source < 0"), ("future", "source > 0"), ("all", "true")):
    query(f"vector_source_filter_{_which}", VECTOR, "vec", "", f"SELECT * FROM vec WHERE {_test}")(
        lambda spark, d, w=_which: views.vectors(spark, d).filter(in_source("source", w))
    )

_DIALS = dict(source="past", frame_stride=2, spatial_stride=2, min_magnitude=1.5)
_PICK = "source < 0 AND frame_index % 2 = 0 AND (dst_x // 16) % 2 = 0 AND (dst_y // 16) % 2 = 0 AND magnitude_px >= 1.5"


@query("vector_sampling", VECTOR, "vec", "", f"SELECT * FROM vec WHERE {_PICK}")
def vector_sampling(spark, d):
    return vectors.output(views.vectors(spark, d), "sampled", **_DIALS)


@query(
    "sampling_counters", "raw_vectors:l candidate_vectors:l written_vectors:l sampled_frames:l frames_with_vectors:l", "vec", "",
    f"""SELECT count(*) AS raw_vectors, count(*) FILTER (WHERE {_PICK}) AS candidate_vectors, count(*) FILTER (WHERE {_PICK}) AS written_vectors,
 count(DISTINCT frame_index) FILTER (WHERE frame_index % 2 = 0) AS sampled_frames, count(DISTINCT frame_index) AS frames_with_vectors FROM vec""",
)
def sampling_counters(spark, d):
    return vectors.counters(views.vectors(spark, d), "sampled", **_DIALS)


FRAME_SUMMARY = """fs AS (SELECT clip, frame_index, count(*) AS n_vectors, avg(dx_px) AS mean_dx_px, avg(dy_px) AS mean_dy_px, avg(magnitude_px) AS mean_magnitude_px,
 quantile_cont(magnitude_px, 0.5) AS median_magnitude_px, quantile_cont(magnitude_px, 0.9) AS p90_magnitude_px, quantile_cont(magnitude_px, 0.95) AS p95_magnitude_px,
 max(magnitude_px) AS max_magnitude_px, sum(magnitude_px) AS sum_magnitude_px, sqrt(pow(sum(dx_px), 2) + pow(sum(dy_px), 2)) AS resultant_magnitude_px FROM vec GROUP BY ALL)"""
FRAME_SUMMARY_COLUMNS = (
    "clip:l frame_index:l n_vectors:l mean_dx_px mean_dy_px mean_magnitude_px median_magnitude_px p90_magnitude_px p95_magnitude_px "
    "max_magnitude_px sum_magnitude_px resultant_magnitude_px coherence"
)


@query(
    "frame_summary", FRAME_SUMMARY_COLUMNS, "vec fr", FRAME_SUMMARY,
    "SELECT fr.clip, fr.frame_index, " + ", ".join(f"coalesce(fs.{c.split(':')[0]}, 0) AS {c.split(':')[0]}" for c in FRAME_SUMMARY_COLUMNS.split()[2:-1])
    + ", coalesce(CASE WHEN fs.sum_magnitude_px > 0 THEN fs.resultant_magnitude_px / (fs.sum_magnitude_px + 1e-12) END, 0) AS coherence FROM fr LEFT JOIN fs USING (clip, frame_index)",
)
def frame_summary(spark, d):
    return vectors.frame_summary(views.vectors(spark, d), views.frames(spark, d), ("clip",))


@query(
    "top_motion_frames", "clip:l frame_index:l sum_magnitude_px n_vectors:l", "vec", FRAME_SUMMARY,
    "SELECT * FROM fs ORDER BY round(sum_magnitude_px, 9) DESC, frame_index LIMIT 25",
)
def top_motion_frames(spark, d):
    made = vectors.frame_summary(views.vectors(spark, d), keys=("clip",)).withColumn("sum_magnitude_px", F.round("sum_magnitude_px", 9))
    return made.orderBy(F.desc("sum_magnitude_px"), "frame_index").limit(25)


@query(
    "sidecar_report", "clip:l frames:l vectors:l median_vectors_per_frame median_frame_energy p95_frame_energy zero_vector_fraction", "vec fr", FRAME_SUMMARY + """,
al AS (SELECT fr.clip, coalesce(fs.n_vectors, 0) AS n, coalesce(fs.sum_magnitude_px, 0) AS e FROM fr LEFT JOIN fs USING (clip, frame_index))""",
    """SELECT clip, count(*) AS frames, sum(n) AS vectors, median(n::DOUBLE) AS median_vectors_per_frame, median(e) AS median_frame_energy,
 quantile_cont(e, 0.95) AS p95_frame_energy, avg((n = 0)::INT) AS zero_vector_fraction FROM al GROUP BY clip""",
)
def sidecar_report(spark, d):
    return vectors.report(vectors.frame_summary(views.vectors(spark, d), views.frames(spark, d), ("clip",)), ("clip",))


@query(
    "summary_invariants", "clip:l frame_index:l n_vectors:l rows:l", "vec fr", "c AS (SELECT clip, frame_index, count(*) AS rows FROM vec GROUP BY ALL)",
    "SELECT clip, frame_index, n_vectors, coalesce(rows, 0) AS rows FROM fr LEFT JOIN c USING (clip, frame_index) WHERE n_vectors <> coalesce(rows, 0)",
)
def summary_invariants(spark, d):
    return vectors.invariants(views.frames(spark, d), views.vectors(spark, d), ("clip",))


@query(
    "overlay_filter", VECTOR, "vec fr", "",
    """SELECT vec.* FROM vec LEFT JOIN fr USING (clip, frame_index) WHERE magnitude_px BETWEEN 1 AND 3
 AND coalesce(sum_magnitude_px >= 20, true) AND coalesce(sum_magnitude_px <= 200, true) AND coalesce(coherence >= 0.2, true)""",
)
def overlay_filter(spark, d):
    return vectors.overlay_filter(views.vectors(spark, d), views.frames(spark, d), ("clip",), (1.0, 3.0), (20.0, 200.0), (0.2, None))


_EXTENT = """ext AS (SELECT clip, min(dst_x - 8.0::DOUBLE) AS x0, max(dst_x + 8.0::DOUBLE) AS x1, min(dst_y - 8.0::DOUBLE) AS y0, max(dst_y + 8.0::DOUBLE) AS y1
 FROM vec WHERE source < 0 GROUP BY clip)"""
_GRID = _EXTENT + """,
gn AS (SELECT vec.*, least(greatest((dst_x - x0) / greatest(x1 - x0, 1e-12), 0), 0.999999) AS xn, least(greatest((dst_y - y0) / greatest(y1 - y0, 1e-12), 0), 0.999999) AS yn
 FROM vec JOIN ext USING (clip) WHERE source < 0),
gr AS (SELECT *, (floor(yn * 4) * 4 + floor(xn * 4))::INT AS grid_bin FROM gn)"""
_CELLS = _GRID + """,
cc AS (SELECT clip, frame_index, grid_bin, count(*)::DOUBLE AS n FROM gr WHERE magnitude_px > 0 GROUP BY ALL),
ct AS (SELECT *, n / sum(n) OVER (PARTITION BY clip, frame_index) AS p FROM cc),
ce AS (SELECT clip, frame_index, count(*) / 16.0::DOUBLE AS active_spatial_bin_fraction, -sum(p * ln(p + 1e-12)) / ln(16) AS spatial_entropy, max(p) AS max_bin_fraction FROM ct GROUP BY ALL),
cen AS (SELECT clip, frame_index, avg(xn) AS motion_centroid_x_norm, avg(yn) AS motion_centroid_y_norm FROM gr WHERE magnitude_px > 0 GROUP BY ALL)"""


def _past(spark, d):
    return views.vectors(spark, d).filter(in_source("source", "past"))


def _gridded(spark, d):
    past = _past(spark, d)
    return features.with_grid(past, features.spatial_extent(past, ["clip"]), ["clip"])


@query("spatial_extent", "clip:l x0 x1 y0 y1", "vec", _EXTENT, "SELECT * FROM ext")
def spatial_extent(spark, d):
    return features.spatial_extent(_past(spark, d), ["clip"])


@query(
    "spatial_grid_counts", "clip:l frame_index:l grid_bin:i bin_count:l", "vec", _GRID,
    "SELECT clip, frame_index, grid_bin, count(*) AS bin_count FROM gr GROUP BY ALL",
)
def spatial_grid_counts(spark, d):
    return features.grid_counts(_gridded(spark, d), ["clip"])


@query(
    "spatial_entropy", "clip:l frame_index:l active_spatial_bin_fraction spatial_entropy max_bin_fraction", "vec", _CELLS, "SELECT * FROM ce"
)
def spatial_entropy(spark, d):
    return features.spatial_features(_gridded(spark, d).filter("magnitude_px > 0"), ["clip"])


@query("motion_centroid", "clip:l frame_index:l motion_centroid_x_norm motion_centroid_y_norm", "vec", _CELLS, "SELECT * FROM cen")
def motion_centroid(spark, d):
    return features.spatial_features(_gridded(spark, d).filter("magnitude_px > 0"), ["clip"])


_FEATURES = _CELLS + """,
ag AS (SELECT clip, frame_index, count(*) AS n, sum(magnitude_px) AS e, avg(magnitude_px) AS m, quantile_cont(magnitude_px, 0.95) AS p95, sum(dx_px)::DOUBLE AS sdx, sum(dy_px)::DOUBLE AS sdy,
 count(*) FILTER (WHERE magnitude_px > 0) AS a, coalesce(sum(magnitude_px) FILTER (WHERE magnitude_px > 0), 0) AS ae, coalesce(avg(magnitude_px) FILTER (WHERE magnitude_px > 0), 0) AS am
 FROM vec WHERE source < 0 GROUP BY ALL),
f0 AS (SELECT fr.*, coalesce(n, 0) AS analysis_n_vectors, coalesce(e, 0) AS analysis_motion_energy, coalesce(m, 0) AS analysis_mean_magnitude_px, coalesce(p95, 0) AS analysis_p95_magnitude_px,
 coalesce(sdx, 0) AS analysis_sum_dx_px, coalesce(sdy, 0) AS analysis_sum_dy_px, coalesce(a, 0) AS mv_active_vectors, coalesce(ae, 0) AS mv_active_motion_energy,
 coalesce(am, 0) AS mv_active_mean_magnitude_px, coalesce(a, 0) >= 2 AS mv_active_frame FROM fr LEFT JOIN ag USING (clip, frame_index)),
f1 AS (SELECT *, coalesce(mv_active_vectors / nullif(analysis_n_vectors, 0)::DOUBLE, 0) AS mvaf,
 sum(CASE WHEN mv_active_frame THEN 0 ELSE 1 END) OVER (PARTITION BY clip ORDER BY frame_index) AS isl FROM f0),
f2 AS (SELECT *, CASE WHEN mv_active_frame THEN sum(mv_active_frame::INT) OVER (PARTITION BY clip, isl) ELSE 0 END AS mv_active_run_frames FROM f1),
f3 AS (SELECT *, mv_active_run_frames >= 2 AS mv_bout_frame, CASE WHEN mv_active_run_frames >= 2 THEN mv_active_vectors ELSE 0 END AS mv_bout_active_vectors,
 CASE WHEN mv_active_run_frames >= 2 THEN mv_active_motion_energy ELSE 0 END AS mv_bout_motion_energy FROM f2),
ff AS (SELECT f3.*, coalesce(mv_bout_active_vectors / nullif(analysis_n_vectors, 0)::DOUBLE, 0) AS mv_bout_fraction,
 coalesce(least(mv_active_vectors, 6) / nullif(analysis_n_vectors, 0)::DOUBLE, 0) AS mv_capped_active_fraction,
 coalesce(ln(1 + mv_active_vectors) / nullif(ln(1 + analysis_n_vectors), 0), 0) AS mv_log_active_fraction, mvaf * pow(greatest(1 - mvaf, 0), 2) AS mv_inverse_saturation_fraction,
 coalesce(ce.active_spatial_bin_fraction, 0) AS active_spatial_bin_fraction, coalesce(ce.spatial_entropy, 0) AS spatial_entropy, coalesce(ce.max_bin_fraction, 0) AS max_bin_fraction,
 cen.motion_centroid_x_norm, cen.motion_centroid_y_norm, 'past' AS vector_source_filter
 FROM f3 LEFT JOIN ce USING (clip, frame_index) LEFT JOIN cen USING (clip, frame_index))"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame features of every clip: the plan behind ``frame_features`` and the temporal bins."""
    return features.frame_features(views.frames(spark, sf_dir), views.vectors(spark, sf_dir), ["clip"])


query(
    "frame_features",
    "clip:l frame_index:l time_seconds analysis_n_vectors:l analysis_motion_energy analysis_mean_magnitude_px analysis_p95_magnitude_px analysis_sum_dx_px "
    "analysis_sum_dy_px mv_active_vectors:l mv_active_motion_energy mv_active_mean_magnitude_px mvaf mv_active_frame:b mv_active_run_frames:l mv_bout_frame:b "
    "mv_bout_active_vectors:l mv_bout_motion_energy mv_bout_fraction mv_capped_active_fraction mv_log_active_fraction mv_inverse_saturation_fraction "
    "active_spatial_bin_fraction spatial_entropy max_bin_fraction motion_centroid_x_norm motion_centroid_y_norm vector_source_filter:s",
    "vec fr", _FEATURES, "SELECT * FROM ff",
)(flagship)

_BIN_COLUMNS = (
    "clip:l bin_ms:i bin_index:l time_start_seconds time_end_seconds frame_index_start:l frame_index_end:l n_frames:l analysis_n_vectors_median analysis_motion_energy_sum "
    "analysis_motion_energy_mean mv_active_vectors_sum:l mv_active_vectors_max:l mvaf_mean mvaf_peak mv_active_frame_fraction mv_active_frames:l "
    "mv_longest_active_run_frames:l mv_bout_fraction_mean mv_bout_fraction_peak mv_bout_active_vectors_sum:l mv_bout_frame_fraction "
    "mv_capped_active_fraction_mean mv_log_active_fraction_mean mv_inverse_saturation_fraction_mean coherence_mean coherence_active_mean "
    "resultant_magnitude_px_mean p95_magnitude_px_peak active_spatial_bin_fraction_mean active_spatial_bin_fraction_peak spatial_entropy_mean "
    "max_bin_fraction_mean motion_centroid_x_norm_mean motion_centroid_y_norm_mean motion_centroid_x_norm_sd motion_centroid_y_norm_sd"
)


def _bins_sql(widths: tuple[int, ...]) -> str:
    return f"""SELECT clip, bin_ms, floor(time_seconds / (bin_ms / 1000.0::DOUBLE))::BIGINT AS bin_index, bin_index * (bin_ms / 1000.0::DOUBLE) AS time_start_seconds,
 (bin_index + 1) * (bin_ms / 1000.0::DOUBLE) AS time_end_seconds, min(frame_index) AS frame_index_start, max(frame_index) AS frame_index_end, count(*) AS n_frames,
 median(analysis_n_vectors::DOUBLE) AS analysis_n_vectors_median, sum(analysis_motion_energy) AS analysis_motion_energy_sum, avg(analysis_motion_energy) AS analysis_motion_energy_mean,
 sum(mv_active_vectors) AS mv_active_vectors_sum, max(mv_active_vectors) AS mv_active_vectors_max, avg(mvaf) AS mvaf_mean, max(mvaf) AS mvaf_peak,
 avg(mv_active_frame::INT) AS mv_active_frame_fraction, sum(mv_active_frame::INT) AS mv_active_frames, max(mv_active_run_frames) AS mv_longest_active_run_frames,
 avg(mv_bout_fraction) AS mv_bout_fraction_mean, max(mv_bout_fraction) AS mv_bout_fraction_peak, sum(mv_bout_active_vectors) AS mv_bout_active_vectors_sum,
 avg(mv_bout_frame::INT) AS mv_bout_frame_fraction, avg(mv_capped_active_fraction) AS mv_capped_active_fraction_mean, avg(mv_log_active_fraction) AS mv_log_active_fraction_mean,
 avg(mv_inverse_saturation_fraction) AS mv_inverse_saturation_fraction_mean, avg(coherence) AS coherence_mean,
 coalesce(avg(coherence) FILTER (WHERE mv_active_frame), 0) AS coherence_active_mean, avg(resultant_magnitude_px) AS resultant_magnitude_px_mean,
 max(analysis_p95_magnitude_px) AS p95_magnitude_px_peak, avg(active_spatial_bin_fraction) AS active_spatial_bin_fraction_mean,
 max(active_spatial_bin_fraction) AS active_spatial_bin_fraction_peak, avg(spatial_entropy) AS spatial_entropy_mean, avg(max_bin_fraction) AS max_bin_fraction_mean,
 avg(motion_centroid_x_norm) AS motion_centroid_x_norm_mean, avg(motion_centroid_y_norm) AS motion_centroid_y_norm_mean,
 coalesce(stddev_pop(motion_centroid_x_norm), 0) AS motion_centroid_x_norm_sd, coalesce(stddev_pop(motion_centroid_y_norm), 0) AS motion_centroid_y_norm_sd
 FROM ff, (SELECT unnest([{', '.join(map(str, widths))}]) AS bin_ms) GROUP BY clip, bin_ms, 3"""


for _name, _widths in (("temporal_bins_50", (50,)), ("temporal_bins_100", (100,)), ("temporal_bins_250", (250,)), ("multi_width_bins", (50, 100, 250))):
    query(_name, _BIN_COLUMNS, "vec fr", _FEATURES, _bins_sql(_widths))(
        lambda spark, d, w=_widths: features.temporal_bins(flagship(spark, d), ["clip"], w)
    )


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.comparison_rows(views.motion(spark, sf_dir), views.pixels(spark, sf_dir))


@query("active_runs", "video:s well:s frame_index:l mv_active_run_frames:l", "cmp", "", "SELECT * FROM cmp")
def active_runs(spark, d):
    t = views.traces(spark, d)
    return runs.with_runs(t, F.col("mv_active_vectors") >= 1, traces.TRACE, ["frame_index"], "mv_active_run_frames")


@query(
    "longest_run_per_second", "video:s well:s second_bin:l longest_run:l", "tr",
    """i AS (SELECT *, floor(time_seconds)::BIGINT AS second_bin, mv_active_vectors >= 1 AS act FROM tr),
j AS (SELECT *, sum(CASE WHEN act THEN 0 ELSE 1 END) OVER (PARTITION BY video, well, second_bin ORDER BY frame_index) AS isl FROM i),
k AS (SELECT *, CASE WHEN act THEN sum(act::INT) OVER (PARTITION BY video, well, second_bin, isl) ELSE 0 END AS r FROM j)""",
    "SELECT video, well, second_bin, max(r) AS longest_run FROM k GROUP BY ALL",
)
def longest_run_per_second(spark, d):
    t = views.traces(spark, d).withColumn("second_bin", F.floor("time_seconds").cast("long"))
    return runs.longest_run(t, F.col("mv_active_vectors") >= 1, [*traces.TRACE, "second_bin"], ["frame_index"])


@query(
    "comparison_rows", "video:s well:s frame_index:l time_seconds cd10:l mv_active_fraction mv_bout_fraction mv_bout_frame:b motion_energy motion_metric motion_metric_label:s",
    "cmp", "", "SELECT * FROM cmp",
)
def comparison_rows(spark, d):
    return compared(spark, d)


@query("zscore_traces", "video:s well:s frame_index:l motion_energy_z motion_metric_z cd10_z sum_absdiff_z", "cmp", "", "SELECT * FROM cmp")
def zscore_traces(spark, d):
    return compared(spark, d)


def _rank(x: str, by: str) -> str:
    return f"rank() OVER (PARTITION BY {by} ORDER BY {x}) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0::DOUBLE"


def _corr(x: str, y: str) -> str:
    return f"covar_pop({x}::DOUBLE, {y}::DOUBLE) / nullif(stddev_pop({x}::DOUBLE) * stddev_pop({y}::DOUBLE), 0)"


_MEDIANS = ("motion_energy", "raw_motion_energy", "analysis_n_vectors", "mv_active_fraction", "mv_bout_fraction", "motion_metric", "cd10", "cd10_sum_absdiff")


@query(
    "per_well_metrics", "video:s well:s n_aligned_frames:l " + " ".join(f"{c}_median" for c in _MEDIANS) + " mv_bout_frame_fraction pearson_r spearman_r", "cmp",
    f"rk AS (SELECT *, {_rank('motion_metric', 'video, well')} AS rx, {_rank('cd10', 'video, well')} AS ry FROM cmp)",
    "SELECT video, well, count(*) AS n_aligned_frames, " + ", ".join(f"median({c}::DOUBLE) AS {c}_median" for c in _MEDIANS)
    + f", avg(mv_bout_frame::INT) AS mv_bout_frame_fraction, {_corr('motion_metric', 'cd10')} AS pearson_r, {_corr('rx', 'ry')} AS spearman_r FROM rk GROUP BY video, well",
)
def per_well_metrics(spark, d):
    return traces.per_well_metrics(compared(spark, d))


NAMES = list(CANDIDATES)


def _candidate_sql() -> dict[str, str]:
    a, b, c, v, w, n = "mv_active_fraction", "mv_bout_fraction", "coherence", "mv_active_vectors", "mv_bout_active_vectors", "42.0::DOUBLE"
    log = f"(ln(1 + {w}) / ln(1 + {n}))"
    only = lambda t, x=b: f"CASE WHEN {t} THEN {x} ELSE 0.0::DOUBLE END"
    out = {b: b} | {f"mv_bout_no_global_{p}": only(f"{a} < {p / 100}::DOUBLE") for p in (50, 35, 25)}
    out |= {"mv_bout_inverse_saturation": f"{b} * greatest(1 - {a}, 0)", "mv_bout_inverse_saturation_sq": f"{b} * greatest(1 - {a}, 0) * greatest(1 - {a}, 0)"}
    out |= {f"mv_bout_midrange_{i}_{j}_blocks": only(f"{v} BETWEEN {i} AND {j}") for i, j in ((2, 10), (2, 6), (3, 10))}
    out |= {f"mv_bout_low_coherence_{p:03d}": only(f"{c} <= {p / 100}::DOUBLE") for p in (75, 60)}
    out |= {f"mv_bout_capped_{k}_blocks": f"least({w}, {k}) / {n}" for k in (6, 10)}
    return out | {"mv_bout_log_vectors": log, "mv_bout_log_vectors_no_global_35": only(f"{a} < 0.35::DOUBLE", log)}


_CAND = "cf AS (SELECT video, well, frame_index, time_seconds, cd10, raw_motion_energy, coherence AS coh, mv_active_fraction AS maf, " + ", ".join(f"{e} AS {n}" for n, e in _candidate_sql().items()) + " FROM cmp)"
_SECONDS = _CAND + """,
cs AS (SELECT video, well, floor(time_seconds)::BIGINT AS second_bin, sum(cd10) AS cd10, count(*) FILTER (WHERE cd10 > 0) AS cd10_active_frames, max(cd10) AS cd10_max,
 avg(raw_motion_energy) AS raw_mv_energy, avg(coh) AS coherence, max(maf) AS max_active_fraction, avg(maf) AS mean_active_fraction, """ + ", ".join(
    f"round(avg(cf.{n}), 12) AS {n}, max({n}) AS {n}_max, count(*) FILTER (WHERE {n} > 0) AS {n}_active_frames" for n in NAMES
) + " FROM cf GROUP BY video, well, 3)"
_LONG = _SECONDS + f""",
lg AS (SELECT video, well, second_bin, cd10, candidate, value FROM (UNPIVOT (SELECT video, well, second_bin, cd10, {', '.join(NAMES)} FROM cs) ON {', '.join(NAMES)} INTO NAME candidate VALUE value))"""


def seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.candidate_seconds(traces.add_candidates(compared(spark, sf_dir)), NAMES)


def long_table(spark: SparkSession, sf_dir: str, names: list[str] | tuple[str, ...] = NAMES) -> DataFrame:
    return traces.long_candidates(seconds(spark, sf_dir), list(names))


@query("candidate_features", "video:s well:s frame_index:l " + " ".join(NAMES), "cmp", _CAND, "SELECT * FROM cf")
def candidate_features_query(spark, d):
    return traces.add_candidates(compared(spark, d))


@query(
    "candidate_seconds",
    "video:s well:s second_bin:l cd10:l cd10_active_frames:l cd10_max:l raw_mv_energy coherence max_active_fraction mean_active_fraction "
    + " ".join(f"{n} {n}_max {n}_active_frames:l" for n in NAMES), "cmp", _SECONDS, "SELECT * FROM cs",
)
def candidate_seconds(spark, d):
    return seconds(spark, d)


_CORR = _LONG + f""",
lr AS (SELECT *, {_rank('value', 'candidate, video, well')} AS rx, {_rank('cd10', 'candidate, video, well')} AS ry FROM lg),
co AS (SELECT candidate, video, well, {_corr('value', 'cd10')} AS pearson_r, {_corr('rx', 'ry')} AS spearman_r, count(*) FILTER (WHERE value > 0) AS candidate_nonzero_seconds,
 count(*) FILTER (WHERE cd10 > 0) AS cd10_nonzero_seconds FROM lr GROUP BY candidate, video, well)"""
_CATS = """,
th AS (SELECT *, greatest(quantile_cont(cd10::DOUBLE, 0.9) OVER w, 1) AS tc, greatest(quantile_cont(value::DOUBLE, 0.9) OVER w, 1.0::DOUBLE / 4200) AS tv FROM lg WINDOW w AS (PARTITION BY candidate, video, well)),
rt AS (SELECT candidate, cd10 / tc AS cd, value / tv AS mv FROM th),
ca AS (SELECT candidate, CASE WHEN cd < 1.5 AND mv < 1.5 THEN 'not_strong' WHEN mv >= 1.5 AND cd <= 0.5 THEN 'mv_only_strong' WHEN cd >= 1.5 AND mv <= 0.5 THEN 'cd10_only_strong'
 WHEN cd >= 1.5 AND mv >= 1.5 THEN 'high_both_absolute' ELSE 'other' END AS category FROM rt),
cn AS (SELECT candidate, """ + ", ".join(f"count(*) FILTER (WHERE category = '{x}') AS {x}" for x in ("high_both_absolute", "cd10_only_strong", "mv_only_strong", "not_strong", "other")) + " FROM ca GROUP BY candidate)"


@query("candidate_correlations", "candidate:s video:s well:s pearson_r spearman_r candidate_nonzero_seconds:l cd10_nonzero_seconds:l", "cmp", _CORR, "SELECT * FROM co")
def candidate_correlations(spark, d):
    return traces.candidate_correlations(long_table(spark, d))


@query(
    "candidate_summary",
    "candidate:s mean_pearson_r median_pearson_r mean_spearman_r median_spearman_r n_valid_pearson:l mean_candidate_nonzero_seconds high_both_absolute:l "
    "cd10_only_strong:l mv_only_strong:l not_strong:l other:l strong_discordance_total:l", "cmp",
    _CORR + _CATS + """,
sm AS (SELECT candidate, avg(pearson_r) AS mean_pearson_r, median(pearson_r) AS median_pearson_r, avg(spearman_r) AS mean_spearman_r, median(spearman_r) AS median_spearman_r,
 count(pearson_r) AS n_valid_pearson, avg(candidate_nonzero_seconds) AS mean_candidate_nonzero_seconds FROM co GROUP BY candidate)""",
    "SELECT *, cd10_only_strong + mv_only_strong AS strong_discordance_total FROM sm LEFT JOIN cn USING (candidate)",
)
def candidate_summary(spark, d):
    return traces.candidate_summary(long_table(spark, d))


_REGIME = """rs AS (SELECT video, well, floor(time_seconds)::BIGINT AS second_bin, sum(cd10) AS cd10, round(avg(motion_metric), 12) AS smvo, avg(raw_motion_energy) AS raw_mv_energy, avg(coherence) AS coherence,
 max(motion_metric) AS max_smvo, sum(cd10_sum_absdiff) AS cd10_sum_absdiff, arg_min(motion_metric_label, frame_index) AS metric_label FROM cmp GROUP BY video, well, 3),
rq AS (SELECT *, quantile_cont(cd10::DOUBLE, 0.9) OVER w AS cd10_threshold, quantile_cont(smvo, 0.9) OVER w AS smvo_threshold FROM rs WINDOW w AS (PARTITION BY video, well)),
rb AS (SELECT *, cd10 > cd10_threshold AS cd10_high, smvo > smvo_threshold AS smvo_high, CASE WHEN cd10 > cd10_threshold AND smvo > smvo_threshold THEN 'high_both'
 WHEN cd10 > cd10_threshold THEN 'high_cd10_only' WHEN smvo > smvo_threshold THEN 'high_smvo_only' ELSE 'low_both' END AS regime FROM rq)"""
_RATIO = _REGIME + """,
re AS (SELECT * EXCLUDE (regime), regime AS binary_regime, greatest(cd10_threshold, 1.0) AS effective_cd10_threshold, greatest(smvo_threshold, 1.0::DOUBLE / 4200) AS effective_smvo_threshold FROM rb),
rc AS (SELECT *, cd10 / effective_cd10_threshold AS cd10_ratio, smvo / effective_smvo_threshold AS smvo_ratio FROM re),
ra AS (SELECT *, CASE WHEN smvo_ratio >= 1 AND cd10_ratio > 0.5 AND cd10_ratio < 0.95 THEN 'mv_high_cd10_mid' WHEN cd10_ratio >= 1 AND smvo_ratio > 0.5 AND smvo_ratio < 0.95 THEN 'cd10_high_mv_mid'
 WHEN cd10_ratio >= 1 AND smvo_ratio >= 0.95 AND smvo_ratio < 1 THEN 'mv_boundary_cd10_high' WHEN smvo_ratio >= 1 AND cd10_ratio >= 0.95 AND cd10_ratio < 1 THEN 'cd10_boundary_mv_high'
 WHEN smvo_ratio >= 1.5 AND cd10_ratio <= 0.5 THEN 'mv_only_strong' WHEN cd10_ratio >= 1.5 AND smvo_ratio <= 0.5 THEN 'cd10_only_strong'
 WHEN cd10_ratio >= 1.5 AND smvo_ratio >= 1.5 THEN 'high_both_absolute' WHEN cd10_ratio >= 1 AND smvo_ratio >= 1 THEN 'high_both_boundary' ELSE 'low_both' END AS regime FROM rc)"""


def binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.binary_regimes(traces.regime_seconds(compared(spark, sf_dir)))


def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.ratio_regimes(binary(spark, sf_dir))


_KEY = "video:s well:s second_bin:l"


@query("regime_seconds", f"{_KEY} cd10:l smvo raw_mv_energy coherence max_smvo cd10_sum_absdiff:l metric_label:s", "cmp", _REGIME, "SELECT * FROM rs")
def regime_seconds(spark, d):
    return traces.regime_seconds(compared(spark, d))


@query("regimes_binary", f"{_KEY} cd10:l smvo cd10_threshold smvo_threshold cd10_high:b smvo_high:b regime:s", "cmp", _REGIME, "SELECT * FROM rb")
def regimes_binary(spark, d):
    return binary(spark, d)


@query("regimes_ratio", f"{_KEY} cd10_ratio smvo_ratio binary_regime:s regime:s", "cmp", _RATIO, "SELECT * FROM ra")
def regimes_ratio(spark, d):
    return ratios(spark, d)


_REGIMES = ("high_both", "high_cd10_only", "high_smvo_only", "low_both")


@query(
    "regime_counts_pivot", "video:s " + " ".join(f"{r}:l" for r in _REGIMES), "cmp", _REGIME,
    "SELECT video, " + ", ".join(f"count(*) FILTER (WHERE regime = '{r}') AS {r}" for r in _REGIMES) + " FROM rb GROUP BY video",
)
def regime_counts_pivot(spark, d):
    return binary(spark, d).groupBy("video").pivot("regime", list(_REGIMES)).count().fillna(0)


def _score_sql(only_cd: str, only_mv: str, both: str) -> str:
    return f"""CASE WHEN regime IN ('high_cd10_only', 'cd10_only_strong') THEN {only_cd} WHEN regime IN ('high_smvo_only', 'mv_only_strong') THEN {only_mv}
 WHEN regime IN ('high_both', 'high_both_absolute', 'high_both_boundary') THEN {both} WHEN regime = 'cd10_boundary_mv_high' THEN smvo_ratio - abs(cd10_ratio - 1)
 WHEN regime = 'mv_boundary_cd10_high' THEN cd10_ratio - abs(smvo_ratio - 1) WHEN regime = 'cd10_high_mv_mid' THEN cd10_ratio - smvo_ratio
 WHEN regime = 'mv_high_cd10_mid' THEN smvo_ratio - cd10_ratio ELSE -(cd10 + smvo) END"""


@query(
    "representative_bins", f"regime:s rank:l {_KEY} score", "cmp",
    _RATIO + ", sc AS (SELECT *, " + _score_sql(
        "cd10 - cd10_threshold", "smvo - smvo_threshold",
        "(CASE WHEN abs(effective_cd10_threshold) > 1e-6 THEN cd10 / effective_cd10_threshold ELSE cd10 - cd10_threshold END) + (CASE WHEN abs(effective_smvo_threshold) > 1e-6 THEN smvo / effective_smvo_threshold ELSE smvo - smvo_threshold END)",
    ) + " AS score FROM ra)",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY regime ORDER BY round(score, 9) DESC, video, well, second_bin) AS rank FROM sc) WHERE rank <= 5",
)
def representative_bins(spark, d):
    return traces.representative_bins(ratios(spark, d))


_CONS = _LONG + f""",
cz AS (SELECT *, coalesce((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 0) AS z, value > quantile_cont(value::DOUBLE, 0.9) OVER w AS hit FROM lg
 WHERE candidate IN ({', '.join(f"'{n}'" for n in SCREENED)}) WINDOW w AS (PARTITION BY candidate, video, well)),
cg AS (SELECT candidate, video, second_bin, avg(z) AS mean_z, max(z) AS max_z, count(*) FILTER (WHERE hit) AS active_wells, count(*) AS n_wells, avg(value) AS mean_value FROM cz GROUP BY ALL),
cq AS (SELECT *, greatest(mean_z, 0) AS positive_mean_z, active_wells / n_wells::DOUBLE AS active_well_fraction, greatest(mean_z, 0) * (0.5 + active_wells / n_wells::DOUBLE) AS stimulus_like_score FROM cg)"""
_PEAKS = _CONS + """,
pr AS (SELECT *, row_number() OVER (PARTITION BY candidate, video ORDER BY stimulus_like_score DESC, second_bin) AS rn FROM cq),
pk(candidate, video, rn, acc) AS (SELECT candidate, video, 1::BIGINT, CASE WHEN stimulus_like_score <= 0 THEN []::BIGINT[] ELSE [second_bin] END FROM pr WHERE rn = 1
 UNION ALL SELECT p.candidate, p.video, p.rn, CASE WHEN p.stimulus_like_score <= 0 OR len(k.acc) >= 8 OR len(list_filter(k.acc, lambda t: abs(t - p.second_bin) < 5)) > 0 THEN k.acc
 ELSE list_append(k.acc, p.second_bin) END FROM pk k JOIN pr p ON p.candidate = k.candidate AND p.video = k.video AND p.rn = k.rn + 1),
pl AS (SELECT candidate, video, unnest(arg_max(acc, rn)) AS second_bin FROM pk GROUP BY candidate, video),
pp AS (SELECT cq.* FROM cq JOIN pl USING (candidate, video, second_bin))"""


def screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.consensus(long_table(spark, sf_dir, SCREENED))


_CONS_COLUMNS = "candidate:s video:s second_bin:l mean_z max_z active_wells:l n_wells:l mean_value active_well_fraction stimulus_like_score"


@query("consensus_by_second", _CONS_COLUMNS, "cmp", _CONS, "SELECT * FROM cq")
def consensus_by_second(spark, d):
    return screened(spark, d)


@query("peaks_nms", _CONS_COLUMNS, "cmp", _PEAKS, "SELECT * FROM pp")
def peaks_nms(spark, d):
    return traces.peaks(screened(spark, d))


@query(
    "peak_recurrence", "candidate:s second_bin:l video_count:l mean_peak_score", "cmp", _PEAKS,
    """SELECT DISTINCT a.candidate, a.second_bin, (SELECT count(DISTINCT b.video) FROM pp b WHERE b.candidate = a.candidate AND abs(b.second_bin - a.second_bin) <= 2) AS video_count,
 (SELECT avg(b.stimulus_like_score) FROM pp b WHERE b.candidate = a.candidate AND abs(b.second_bin - a.second_bin) <= 2) AS mean_peak_score FROM pp a""",
)
def peak_recurrence(spark, d):
    return traces.recurrence(traces.peaks(screened(spark, d)))


@query(
    "recurrence_summary",
    "candidate:s best_recurrent_second:l best_recurrent_video_count:l best_recurrent_video_fraction mean_top_peak_score mean_top_active_well_fraction n_peaks:l", "cmp",
    _PEAKS + """,
rr AS (SELECT a.candidate, a.second_bin, count(DISTINCT b.video) AS c, avg(b.stimulus_like_score) AS s FROM (SELECT DISTINCT candidate, second_bin FROM pp) a JOIN pp b
 ON b.candidate = a.candidate AND abs(b.second_bin - a.second_bin) <= 2 GROUP BY ALL),
rx AS (SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY c DESC, round(s, 9) DESC, second_bin) AS rn FROM rr)""",
    """SELECT candidate, any_value(second_bin) AS best_recurrent_second, any_value(c) AS best_recurrent_video_count, any_value(c) / 5.0::DOUBLE AS best_recurrent_video_fraction,
 avg(stimulus_like_score) AS mean_top_peak_score, avg(active_well_fraction) AS mean_top_active_well_fraction, count(*) AS n_peaks
 FROM (SELECT rx.candidate, rx.second_bin, rx.c, pp.stimulus_like_score, pp.active_well_fraction FROM rx JOIN pp ON pp.candidate = rx.candidate WHERE rn = 1) GROUP BY candidate""",
)
def recurrence_summary(spark, d):
    return traces.recurrence_summary(traces.peaks(screened(spark, d)), 5)


_GALLERY = ["cd10_only_strong", "mv_only_strong", "high_both_absolute", "low_both"]


@query(
    "gallery_events_nms", f"event_id:s regime:s {_KEY} score", "cmp",
    _RATIO + ", gs AS (SELECT *, " + _score_sql(
        "(cd10 - effective_cd10_threshold) / (abs(effective_cd10_threshold) + 1)",
        "CASE WHEN abs(effective_smvo_threshold) > 1e-6 THEN (smvo - effective_smvo_threshold) / abs(effective_smvo_threshold) ELSE smvo - effective_smvo_threshold END",
        "cd10_ratio + smvo_ratio",
    ) + f""" AS score, video || chr(1) || well AS trace FROM ra WHERE regime IN ({', '.join(f"'{r}'" for r in _GALLERY)})),
gq AS (SELECT *, row_number() OVER (PARTITION BY regime ORDER BY score DESC, trace, second_bin) AS rn FROM gs),
gk(regime, rn, acc) AS (SELECT regime, 1::BIGINT, [{{'g': trace, 't': second_bin}}] FROM gq WHERE rn = 1 UNION ALL
 SELECT q.regime, q.rn, CASE WHEN len(k.acc) >= 6 OR len(list_filter(k.acc, lambda z: z.g = q.trace AND abs(z.t - q.second_bin) < 8)) > 0 THEN k.acc ELSE list_append(k.acc, {{'g': q.trace, 't': q.second_bin}}) END
 FROM gk k JOIN gq q ON q.regime = k.regime AND q.rn = k.rn + 1),
gl AS (SELECT regime, unnest(arg_max(acc, rn)) AS p FROM gk GROUP BY regime),
ge AS (SELECT gs.*, row_number() OVER (ORDER BY list_position({_GALLERY}, gs.regime), score DESC, video, well, second_bin) AS n FROM gs JOIN gl ON gl.regime = gs.regime AND gl.p.g = gs.trace AND gl.p.t = gs.second_bin)""",
    "SELECT *, printf('%03d_%s_%s_%s_%03ds', n::INT, regime, video, well, second_bin::INT) AS event_id FROM ge",
)
def gallery_events_nms(spark, d):
    return traces.gallery_events(ratios(spark, d), _GALLERY)


_PAIRS = _REGIME + f""",
pa AS (SELECT a.video, a.well AS cd10_well, b.well AS smvo_well, a.cd10::DOUBLE AS x, b.smvo AS y FROM rs a JOIN rs b ON a.video = b.video AND a.second_bin = b.second_bin),
pz AS (SELECT *, coalesce((x - avg(x) OVER w) / nullif(stddev_pop(x) OVER w, 0), 0) AS zx, coalesce((y - avg(y) OVER w) / nullif(stddev_pop(y) OVER w, 0), 0) AS zy FROM pa WINDOW w AS (PARTITION BY video, cd10_well, smvo_well)),
pq AS (SELECT video, cd10_well, smvo_well, CASE WHEN cd10_well = smvo_well THEN 'same_well' ELSE 'different_well' END AS pair_type, {_corr('x', 'y')} AS pearson_r,
 sum(zx * zy) / nullif(sqrt(sum(zx * zx)) * sqrt(sum(zy * zy)), 0) AS cosine FROM pz GROUP BY video, cd10_well, smvo_well)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces.cross_metric_pairs(traces.regime_seconds(compared(spark, sf_dir)))


@query("pair_same_vs_different", "video:s cd10_well:s smvo_well:s pair_type:s pearson_r cosine", "cmp", _PAIRS, "SELECT * FROM pq")
def pair_same_vs_different(spark, d):
    return pairs(spark, d)


@query(
    "within_metric_synchrony", "video:s metric:s well_a:s well_b:s pearson_r cosine", "cmp",
    _REGIME + f""",
wl AS (SELECT video, well, second_bin, metric, value FROM (UNPIVOT (SELECT video, well, second_bin, cd10::DOUBLE AS cd10, smvo, raw_mv_energy FROM rs) ON cd10, smvo, raw_mv_energy INTO NAME metric VALUE value)),
wp AS (SELECT a.video, a.metric, a.well AS well_a, b.well AS well_b, a.value AS x, b.value AS y FROM wl a JOIN wl b USING (video, metric, second_bin) WHERE a.well < b.well),
wz AS (SELECT *, coalesce((x - avg(x) OVER w) / nullif(stddev_pop(x) OVER w, 0), 0) AS zx, coalesce((y - avg(y) OVER w) / nullif(stddev_pop(y) OVER w, 0), 0) AS zy FROM wp WINDOW w AS (PARTITION BY video, metric, well_a, well_b))""",
    f"SELECT video, metric, well_a, well_b, {_corr('x', 'y')} AS pearson_r, sum(zx * zy) / nullif(sqrt(sum(zx * zx)) * sqrt(sum(zy * zy)), 0) AS cosine FROM wz GROUP BY ALL",
)
def within_metric_synchrony(spark, d):
    return traces.within_metric_pairs(traces.regime_seconds(compared(spark, d)))


_HIST = _PAIRS + """,
eg AS (SELECT list_transform(range(41), lambda i: CASE WHEN i = 40 THEN 1.0::DOUBLE ELSE i * 0.05::DOUBLE - 1.0::DOUBLE END) AS e),
hb AS (SELECT pair_type, (least(len(list_filter(e, lambda v: v <= round(pearson_r, 12))), 40) - 1)::INT AS bin FROM pq, eg WHERE round(pearson_r, 12) BETWEEN -1 AND 1),
hs AS (SELECT pair_type, bin::INT AS bin FROM (SELECT DISTINCT pair_type FROM pq), range(40) AS t(bin)),
hn AS (SELECT pair_type, bin, (SELECT count(*) FROM hb WHERE hb.pair_type = hs.pair_type AND hb.bin = hs.bin) AS n FROM hs)"""


@query("corr_histogram", "pair_type:s bin:i n:l", "cmp", _HIST, "SELECT * FROM hn")
def corr_histogram(spark, d):
    steady = pairs(spark, d).withColumn("pearson_r", F.round("pearson_r", traces.STEADY))
    return stats.histogram(steady, ["pair_type"], "pearson_r")


@query(
    "bhattacharyya", "same_well_pairs:l different_well_pairs:l same_well_median different_well_median bhattacharyya", "cmp",
    _HIST + ", hp AS (SELECT *, n / sum(n) OVER (PARTITION BY pair_type) AS p FROM hn)",
    """SELECT (SELECT count(*) FROM pq WHERE pair_type = 'same_well') AS same_well_pairs, (SELECT count(*) FROM pq WHERE pair_type <> 'same_well') AS different_well_pairs,
 (SELECT median(pearson_r) FROM pq WHERE pair_type = 'same_well') AS same_well_median, (SELECT median(pearson_r) FROM pq WHERE pair_type <> 'same_well') AS different_well_median,
 -ln(greatest(sum(sqrt(a.p * b.p)), 1e-12)) AS bhattacharyya FROM hp a JOIN hp b USING (bin) WHERE a.pair_type = 'same_well' AND b.pair_type = 'different_well'""",
)
def bhattacharyya(spark, d):
    return traces.specificity_distance(pairs(spark, d))


_SCAN_COLUMNS = (
    "clip:l min_magnitude_px min_block_cd_pixels:i motion_energy_floor pearson_r spearman_r active_fraction_pearson_r active_fraction_spearman_r active_frames:l cd10_active_frames:l "
    "cd10_sum_absdiff_active_frames:l motion_active_cd10_zero_frames:l motion_active_cd10_positive_frames:l missed_cd10_positive_frames:l "
    "median_energy_when_cd10_positive p95_energy_when_cd10_zero"
)


@query(
    "filter_scan_grid", _SCAN_COLUMNS, "vec fr",
    """px AS (SELECT clip, frame_index, greatest(frame_index % 37 - 12, 0) AS cd10, frame_index % 11 AS cd10_sum_absdiff, n_vectors FROM fr),
gd AS (SELECT unnest([0.0::DOUBLE, 2.0::DOUBLE]) AS m), gc AS (SELECT unnest([0, 5, 10]) AS c), gf AS (SELECT unnest([0.0::DOUBLE, 3.0::DOUBLE]) AS f),
ka AS (SELECT clip, m, c, frame_index, round(sum(magnitude_px), 12) AS e, count(*) AS k FROM vec, gd, gc WHERE magnitude_px >= m AND block_cd_pixels >= c GROUP BY ALL),
sr AS (SELECT m, c, f, px.*, coalesce(k / nullif(n_vectors, 0)::DOUBLE, 0) AS fraction, greatest(coalesce(e, 0) - f, 0) AS energy FROM px CROSS JOIN gd CROSS JOIN gc CROSS JOIN gf LEFT JOIN ka USING (clip, m, c, frame_index)),
sk AS (SELECT *, """ + ", ".join(f"{_rank(x, 'clip, m, c, f')} AS rank_{x}" for x in ("energy", "fraction", "cd10")) + " FROM sr)",
    f"""SELECT clip, m AS min_magnitude_px, c AS min_block_cd_pixels, f AS motion_energy_floor, {_corr('energy', 'cd10')} AS pearson_r, {_corr('rank_energy', 'rank_cd10')} AS spearman_r,
 {_corr('fraction', 'cd10')} AS active_fraction_pearson_r, {_corr('rank_fraction', 'rank_cd10')} AS active_fraction_spearman_r, count(*) FILTER (WHERE energy > 0) AS active_frames,
 count(*) FILTER (WHERE cd10 > 0) AS cd10_active_frames, count(*) FILTER (WHERE cd10_sum_absdiff > 0) AS cd10_sum_absdiff_active_frames,
 count(*) FILTER (WHERE energy > 0 AND cd10 <= 0) AS motion_active_cd10_zero_frames, count(*) FILTER (WHERE energy > 0 AND cd10 > 0) AS motion_active_cd10_positive_frames,
 count(*) FILTER (WHERE energy <= 0 AND cd10 > 0) AS missed_cd10_positive_frames, median(energy) FILTER (WHERE cd10 > 0) AS median_energy_when_cd10_positive,
 quantile_cont(energy, 0.95) FILTER (WHERE cd10 <= 0) AS p95_energy_when_cd10_zero FROM sk GROUP BY clip, m, c, f""",
)
def filter_scan_grid(spark, d):
    frame = views.frames(spark, d)
    px = frame.select("clip", "frame_index", F.greatest(F.col("frame_index") % 37 - 12, F.lit(0)).alias("cd10"), (F.col("frame_index") % 11).alias("cd10_sum_absdiff"))
    return traces.filter_scan(px, views.vectors(spark, d), frame, [0.0, 2.0], [0, 5, 10], [0.0, 3.0], ["clip"])


@query(
    "trace_minmax_robust", f"{_KEY.replace('second_bin', 'frame_index')} unit", "tr",
    "mm AS (SELECT *, quantile_cont(raw_motion_energy, 0.01) OVER w AS lo, quantile_cont(raw_motion_energy, 0.99) OVER w AS hi FROM tr WINDOW w AS (PARTITION BY video, well))",
    "SELECT video, well, frame_index, least(greatest((raw_motion_energy - lo) / (hi - lo), 0), 1) AS unit FROM mm",
)
def trace_minmax_robust(spark, d):
    return views.traces(spark, d).withColumn("unit", stats.robust_unit("raw_motion_energy", traces.TRACE))
