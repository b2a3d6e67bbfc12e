"""Traces: comparison rows, candidate features, regimes, consensus, specificity, profiles, parameter scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectrace.functions import stats
from vectrace.functions.exprs import (
    candidate_category, candidate_features, event_score, ratio, ratio_category, slug,
)
from vectrace.operators.runs import with_runs

TRACE = ["video", "well"]
#: Decimals that means and sums are rounded to before they are ranked or compared, so that ties do not
#: depend on the order of summation.
STEADY = 12
METRICS = {
    "energy": ("motion_energy", "motion energy"),
    "active_fraction": ("mv_active_fraction", "active fraction"),
    "active_vectors": ("mv_active_vectors", "active vectors"),
    "active_bout_fraction": ("mv_bout_fraction", "bout fraction"),
    "active_bout_vectors": ("mv_bout_active_vectors", "bout vectors"),
    "active_frame": ("mv_bout_frame", "active frame"),
}


def comparison_rows(
    motion: DataFrame, pixels: DataFrame, metric: str = "active_bout_fraction", energy_floor: float = 0.0,
    min_blocks: int = 1, min_run: int = 1, keys: list[str] = TRACE,
) -> DataFrame:
    """Motion rows joined with pixel change on (keys, frame_index), with runs, the chosen metric and z-scores."""
    if metric not in METRICS:
        raise ValueError(f"unknown motion metric {metric!r}")
    out = motion.join(pixels, [*keys, "frame_index"])
    out = with_runs(out, F.col("mv_active_vectors") >= min_blocks, keys, ["frame_index"], "mv_active_run_frames")
    bout = F.col("mv_active_run_frames") >= min_run
    out = out.withColumns({"mv_bout_frame": bout, "mv_bout_active_vectors": F.when(bout, F.col("mv_active_vectors")).otherwise(F.lit(0))})
    out = out.withColumns({
        "mv_active_fraction": ratio("mv_active_vectors", "analysis_n_vectors"),
        "mv_bout_fraction": ratio("mv_bout_active_vectors", "analysis_n_vectors"),
        "motion_energy": F.greatest(F.col("raw_motion_energy") - energy_floor, F.lit(0.0)) if energy_floor > 0 else F.col("raw_motion_energy"),
    })
    column, label = METRICS[metric]
    out = out.withColumns({"motion_metric": F.col(column).cast("double"), "motion_metric_label": F.lit(label)})
    return out.withColumns({f"{c}_z": stats.zscore(c, keys) for c in ("motion_energy", "motion_metric", "cd10", "sum_absdiff")})


def per_well_metrics(rows: DataFrame, keys: list[str] = TRACE) -> DataFrame:
    """Medians and both correlations of the metric with pixel change, per trace."""
    ranked = rows.withColumns({"rank_x": stats.average_rank("motion_metric", keys), "rank_y": stats.average_rank("cd10", keys)})
    median = lambda c: F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(f"{c}_median")
    names = ("motion_energy", "raw_motion_energy", "analysis_n_vectors", "mv_active_fraction", "mv_bout_fraction", "motion_metric", "cd10", "cd10_sum_absdiff")
    return ranked.groupBy(*keys).agg(
        F.count("*").alias("n_aligned_frames"), *[median(c) for c in names],
        F.avg(F.col("mv_bout_frame").cast("double")).alias("mv_bout_frame_fraction"),
        stats.pearson("motion_metric", "cd10").alias("pearson_r"), stats.pearson("rank_x", "rank_y").alias("spearman_r"),
    )


def add_candidates(rows: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    made = candidate_features()
    return rows.withColumns({n: c for n, c in made.items() if names is None or n in names})


def candidate_seconds(rows: DataFrame, names: list[str], keys: list[str] = TRACE) -> DataFrame:
    """Per second of a trace: pixel change, activity, and each candidate's mean, peak and active frames."""
    positive = lambda c: F.count(F.when(F.col(c) > 0, 1))
    aggs: dict[str, Column] = {
        "cd10": F.sum("cd10"), "cd10_active_frames": positive("cd10"), "cd10_max": F.max("cd10"),
        "raw_mv_energy": F.avg("raw_motion_energy"), "coherence": F.avg("coherence"),
        "max_active_fraction": F.max("mv_active_fraction"), "mean_active_fraction": F.avg("mv_active_fraction"),
    }
    for n in names:
        aggs |= {n: F.round(F.avg(n), STEADY), f"{n}_max": F.max(n), f"{n}_active_frames": positive(n)}
    second = F.floor("time_seconds").cast("long").alias("second_bin")
    return rows.groupBy(*keys, second).agg(*[c.alias(a) for a, c in aggs.items()])


def long_candidates(seconds: DataFrame, names: list[str], keys: list[str] = TRACE) -> DataFrame:
    """(keys, second_bin, cd10, candidate, value): all candidates in one table, so one plan serves them all."""
    return seconds.unpivot([*keys, "second_bin", "cd10"], names, "candidate", "value")


def candidate_correlations(table: DataFrame, keys: list[str] = TRACE) -> DataFrame:
    """Per candidate and trace: both correlations with pixel change and the seconds that are not 0."""
    by = ["candidate", *keys]
    ranked = stats.with_ranks(table, by, "value", "cd10")
    return ranked.groupBy(*by).agg(
        stats.pearson("value", "cd10").alias("pearson_r"), stats.pearson("rank_x", "rank_y").alias("spearman_r"),
        F.count(F.when(F.col("value") > 0, 1)).alias("candidate_nonzero_seconds"),
        F.count(F.when(F.col("cd10") > 0, 1)).alias("cd10_nonzero_seconds"),
    )


def candidate_categories(
    table: DataFrame, q: float = 0.9, strong: float = 1.5, low: float = 0.5, least_mv: float = 1 / 4200, keys: list[str] = TRACE
) -> DataFrame:
    """Counts of seconds by agreement of candidate and pixel change, per candidate."""
    by = ["candidate", *keys]
    cd = ratio("cd10", F.greatest(stats.quantile("cd10", q, by), F.lit(1.0)))
    mv = ratio("value", F.greatest(stats.quantile("value", q, by), F.lit(least_mv)))
    judged = table.withColumns({"_cd": cd, "_mv": mv}).withColumn("category", candidate_category(F.col("_cd"), F.col("_mv"), strong, low))
    labels = ("high_both_absolute", "cd10_only_strong", "mv_only_strong", "not_strong", "other")
    out = judged.groupBy("candidate").agg(*[F.count(F.when(F.col("category") == x, 1)).alias(x) for x in labels])
    return out.withColumn("strong_discordance_total", F.col("cd10_only_strong") + F.col("mv_only_strong"))


def candidate_summary(table: DataFrame, keys: list[str] = TRACE, **limits) -> DataFrame:
    """Mean and median correlations with the category counts, best candidate first."""
    median = lambda c: F.percentile(F.col(c), F.lit(0.5))
    corr = candidate_correlations(table, keys).groupBy("candidate").agg(
        F.avg("pearson_r").alias("mean_pearson_r"), median("pearson_r").alias("median_pearson_r"),
        F.avg("spearman_r").alias("mean_spearman_r"), median("spearman_r").alias("median_spearman_r"),
        F.count("pearson_r").alias("n_valid_pearson"), F.avg("candidate_nonzero_seconds").alias("mean_candidate_nonzero_seconds"),
    )
    out = corr.join(candidate_categories(table, keys=keys, **limits), "candidate", "left")
    return out.orderBy(F.desc_nulls_last("mean_pearson_r"), "strong_discordance_total", "mv_only_strong", "candidate")


def regime_seconds(rows: DataFrame, keys: list[str] = TRACE) -> DataFrame:
    """Per second of a trace: summed pixel change, the metric's mean and peak, energy, coherence, first label."""
    return rows.groupBy(*keys, F.floor("time_seconds").cast("long").alias("second_bin")).agg(
        F.sum("cd10").alias("cd10"), F.round(F.avg("motion_metric"), STEADY).alias("smvo"), F.avg("raw_motion_energy").alias("raw_mv_energy"),
        F.avg("coherence").alias("coherence"), F.max("motion_metric").alias("max_smvo"),
        F.sum("cd10_sum_absdiff").alias("cd10_sum_absdiff"), F.min_by("motion_metric_label", "frame_index").alias("metric_label"),
    )


def binary_regimes(sec: DataFrame, q_cd: float = 0.9, q_mv: float = 0.9, keys: list[str] = TRACE) -> DataFrame:
    """Seconds above each trace's own quantile of pixel change and of the metric, as four regimes.

    The effective thresholds equal the plain ones here, so that scores are defined without the ratio step.
    """
    out = sec.withColumns({"cd10_threshold": stats.quantile("cd10", q_cd, keys), "smvo_threshold": stats.quantile("smvo", q_mv, keys)})
    out = out.withColumns({"cd10_high": F.col("cd10") > F.col("cd10_threshold"), "smvo_high": F.col("smvo") > F.col("smvo_threshold")})
    regime = (
        F.when(F.col("cd10_high") & F.col("smvo_high"), "high_both").when(F.col("cd10_high"), "high_cd10_only")
        .when(F.col("smvo_high"), "high_smvo_only").otherwise("low_both")
    )
    out = out.withColumns({"regime": regime, "effective_cd10_threshold": F.col("cd10_threshold"), "effective_smvo_threshold": F.col("smvo_threshold")})
    return out.withColumns({"cd10_ratio": ratio("cd10", "effective_cd10_threshold"), "smvo_ratio": ratio("smvo", "effective_smvo_threshold")})


def ratio_regimes(
    binary: DataFrame, strong: float = 1.5, low: float = 0.5, edge_low: float = 0.95, edge_high: float = 1.0,
    least_cd: float = 1.0, least_mv: float = 1 / 4200,
) -> DataFrame:
    """Regimes by the ratio of each value to its threshold; the binary regime is kept as binary_regime."""
    out = binary.withColumns({
        "binary_regime": F.col("regime"),
        "effective_cd10_threshold": F.greatest(F.col("cd10_threshold"), F.lit(least_cd)),
        "effective_smvo_threshold": F.greatest(F.col("smvo_threshold"), F.lit(least_mv)),
    })
    out = out.withColumns({"cd10_ratio": ratio("cd10", "effective_cd10_threshold"), "smvo_ratio": ratio("smvo", "effective_smvo_threshold")})
    label = ratio_category(F.col("cd10_ratio"), F.col("smvo_ratio"), strong, low, edge_low, edge_high)
    return out.withColumns({"category": label, "regime": label})


def representative_bins(sec: DataFrame, n: int = 5, keys: list[str] = TRACE) -> DataFrame:
    """The n best-scored seconds of every regime; ties by trace and second."""
    scored = sec.withColumn("score", event_score("report"))
    rank = F.row_number().over(Window.partitionBy("regime").orderBy(F.desc("score"), *keys, "second_bin"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= n)


def consensus(table: DataFrame, q: float = 0.9) -> DataFrame:
    """Per candidate, video and second: mean and peak z over wells, active wells and the stimulus-like score."""
    by = ["candidate", *TRACE]
    rows = table.withColumns({"z": stats.zscore("value", by), "on": F.col("value") > stats.quantile("value", q, by)})
    out = rows.groupBy("candidate", "video", "second_bin").agg(
        F.avg("z").alias("mean_z"), F.max("z").alias("max_z"), F.count(F.when(F.col("on"), 1)).alias("active_wells"),
        F.count("*").alias("n_wells"), F.avg("value").alias("mean_value"),
    )
    out = out.withColumns({"positive_mean_z": F.greatest("mean_z", F.lit(0.0)), "active_well_fraction": ratio("active_wells", "n_wells")})
    return out.withColumn("stimulus_like_score", F.col("positive_mean_z") * (0.5 + F.col("active_well_fraction")))


def greedy_peaks(df: DataFrame, keys: list[str], at: str, score: str, n: int, gap: float, positive: bool = True, within: str | None = None) -> DataFrame:
    """Greedy non-maximum suppression in each group: best score first, none closer than ``gap`` to one taken.

    With ``within``, the gap only holds between rows of equal value in that column.  Ties go by
    ``within`` and place.  A group is one folded array, so groups must be bounded (seconds of a trace or video).
    """
    place = F.struct(*( [F.col(within).alias("g")] if within else []), F.col(at).cast("double").alias("t"))
    item = F.struct((-F.col(score)).alias("k"), place.alias("p"))
    kind = f"array<struct<{'g:' + dict(df.dtypes)[within] + ',' if within else ''}t:double>>"
    near = (lambda z, e: (z["g"] == e["p"]["g"]) & (F.abs(z["t"] - e["p"]["t"]) < gap)) if within else (lambda z, e: F.abs(z["t"] - e["p"]["t"]) < gap)
    skip = lambda acc, e: (F.size(acc) >= n) | F.exists(acc, lambda z: near(z, e)) | ((e["k"] >= 0) if positive else F.lit(False))
    folded = df.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_all")).select(
        *keys, F.explode(F.aggregate("_all", F.array().cast(kind), lambda acc, e: F.when(skip(acc, e), acc).otherwise(F.concat(acc, F.array(e["p"]))))).alias("_p")
    )
    picked = folded.select(*keys, *([F.col("_p.g").alias(within)] if within else []), F.col("_p.t").alias("_t"))
    on = [*keys, *([within] if within else [])]
    return df.withColumn("_t", F.col(at).cast("double")).join(picked, [*on, "_t"], "left_semi").drop("_t")


def peaks(cons: DataFrame, n: int = 8, gap: float = 5.0) -> DataFrame:
    return greedy_peaks(cons, ["candidate", "video"], "second_bin", "stimulus_like_score", n, gap)


def gallery_events(sec: DataFrame, regimes: list[str], n: int = 6, gap: float = 8.0) -> DataFrame:
    """The best n seconds of each regime, ``gap`` seconds apart in a trace, with rank and event id.

    The gap holds inside a trace alone, so each trace is folded by itself; the best n of what the traces
    pick are those that one greedy pass over the regime would take.
    """
    scored = sec.filter(F.col("regime").isin(regimes)).withColumn("score", event_score("gallery"))
    picked = greedy_peaks(scored, ["regime", *TRACE], "second_bin", "score", n, gap, positive=False)
    best = F.row_number().over(Window.partitionBy("regime").orderBy(F.desc("score"), *TRACE, "second_bin"))
    chosen = picked.withColumn("_best", best).filter(F.col("_best") <= n).drop("_best")
    place = F.array_position(F.array(*map(F.lit, regimes)), F.col("regime"))
    # At most n rows a regime are numbered here.
    number = F.row_number().over(Window.orderBy(place, F.desc("score"), *TRACE, "second_bin"))
    name = F.format_string("%03d_%s_%s_%s_%03ds", number, slug("regime"), slug("video"), slug("well"), F.col("second_bin").cast("int"))
    return chosen.withColumn("event_id", name)


def recurrence(found: DataFrame, tolerance: int = 2) -> DataFrame:
    """Per candidate and peak second: videos with a peak within the tolerance and their mean score.

    A peak is dealt to the few seconds around it, so seconds are grouped and no list of videos is held.
    """
    around = F.explode(F.sequence(F.col("second_bin") - tolerance, F.col("second_bin") + tolerance)).alias("second_bin")
    reached = found.select("candidate", "video", "stimulus_like_score", around)
    return reached.join(found.select("candidate", "second_bin").distinct(), ["candidate", "second_bin"], "left_semi").groupBy("candidate", "second_bin").agg(
        F.countDistinct("video").alias("video_count"), F.avg("stimulus_like_score").alias("mean_peak_score")
    )


def recurrence_summary(found: DataFrame, videos: int, tolerance: int = 2) -> DataFrame:
    """Per candidate the most recurrent second (most videos, best score, earliest) and the peaks' means."""
    best = F.struct("video_count", F.round("mean_peak_score", 9).alias("s"), -F.col("second_bin"))
    top = recurrence(found, tolerance).groupBy("candidate").agg(
        F.max_by("second_bin", best).alias("best_recurrent_second"), F.max("video_count").alias("best_recurrent_video_count")
    )
    means = found.groupBy("candidate").agg(
        F.avg("stimulus_like_score").alias("mean_top_peak_score"), F.avg("active_well_fraction").alias("mean_top_active_well_fraction"), F.count("*").alias("n_peaks")
    )
    out = top.join(means, "candidate").withColumn("best_recurrent_video_fraction", ratio("best_recurrent_video_count", F.lit(videos)))
    return out.orderBy(F.desc("best_recurrent_video_count"), F.desc("mean_top_peak_score"), F.desc("mean_top_active_well_fraction"), "candidate")


def _alike(pairs: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Correlation and cosine of two aligned series: the cosine is taken of their z-scores."""
    zx, zy = stats.zscore(x, keys), stats.zscore(y, keys)
    scored = pairs.withColumns({"_x": zx, "_y": zy})
    cosine = F.try_divide(F.sum(F.col("_x") * F.col("_y")), F.sqrt(F.sum(F.col("_x") * F.col("_x"))) * F.sqrt(F.sum(F.col("_y") * F.col("_y"))))
    return scored.groupBy(*keys).agg(stats.pearson(x, y).alias("pearson_r"), cosine.alias("cosine"))


def cross_metric_pairs(sec: DataFrame) -> DataFrame:
    """Every ordered pair of wells of a video: pixel change of one against the metric of the other."""
    left = sec.select("video", F.col("well").alias("cd10_well"), "second_bin", "cd10")
    right = sec.select("video", F.col("well").alias("smvo_well"), "second_bin", "smvo")
    out = _alike(left.join(right, ["video", "second_bin"]), ["video", "cd10_well", "smvo_well"], "cd10", "smvo")
    return out.withColumn("pair_type", F.when(F.col("cd10_well") == F.col("smvo_well"), "same_well").otherwise("different_well"))


def within_metric_pairs(sec: DataFrame, metrics: tuple[str, ...] = ("cd10", "smvo", "raw_mv_energy")) -> DataFrame:
    """Every unordered pair of wells of a video, metric by metric."""
    wide = sec.select("video", "well", "second_bin", *[F.col(m).cast("double").alias(m) for m in metrics])
    table = wide.unpivot(["video", "well", "second_bin"], list(metrics), "metric", "value")
    a = table.select("video", "metric", "second_bin", F.col("well").alias("well_a"), F.col("value").alias("a"))
    b = table.select("video", "metric", "second_bin", F.col("well").alias("well_b"), F.col("value").alias("b"))
    both = a.join(b, ["video", "metric", "second_bin"]).filter("well_a < well_b")
    return _alike(both, ["video", "metric", "well_a", "well_b"], "a", "b")


def specificity_distance(pairs: DataFrame, measure: str = "pearson_r") -> DataFrame:
    """One row: medians of the measure for same and different wells, and the distance of their histograms."""
    hist = stats.histogram(pairs.withColumn(measure, F.round(measure, STEADY)), ["pair_type"], measure)
    total = F.sum("n").over(Window.partitionBy("pair_type"))
    shares = hist.withColumn("p", ratio("n", total)).groupBy("bin").pivot("pair_type", ["same_well", "different_well"]).agg(F.sum("p"))
    distance = shares.agg(stats.bhattacharyya(F.col("same_well"), F.col("different_well")).alias("bhattacharyya"))
    of = lambda t: F.when(F.col("pair_type") == t, F.col(measure))
    sums = pairs.agg(
        F.count(F.when(F.col("pair_type") == "same_well", 1)).alias("same_well_pairs"),
        F.count(F.when(F.col("pair_type") == "different_well", 1)).alias("different_well_pairs"),
        F.percentile(of("same_well"), F.lit(0.5)).alias("same_well_median"),
        F.percentile(of("different_well"), F.lit(0.5)).alias("different_well_median"),
    )
    return sums.crossJoin(F.broadcast(distance))  # one row each


def filter_scan(
    pixels: DataFrame, vectors: DataFrame, frames: DataFrame, magnitudes: list[float], changed: list[int], floors: list[float],
    keys: list[str] | None = None,
) -> DataFrame:
    """Agreement of thresholded motion with pixel change for every parameter triple of each clip, best first.

    Frames meet on (keys, frame_index), and ranks and percentiles are those of a clip, so a task holds
    one clip's frames under one triple.  Without keys the tables are one clip.  The grid is a small table
    joined to the data, so one plan serves all triples.
    """
    spark, keys = pixels.sparkSession, list(keys or [])
    grid = spark.createDataFrame([(float(m), int(c)) for m in magnitudes for c in changed], "min_magnitude_px double, min_block_cd_pixels int")
    floor = spark.createDataFrame([(float(f),) for f in floors], "motion_energy_floor double")
    steps, frame = ["min_magnitude_px", "min_block_cd_pixels"], [*keys, "frame_index"]
    base = pixels.select(*frame, "cd10", "cd10_sum_absdiff").join(frames.select(*frame, "n_vectors"), frame, "left")
    kept = vectors.join(F.broadcast(grid), (F.col("magnitude_px") >= F.col(steps[0])) & (F.col("block_cd_pixels") >= F.col(steps[1])))
    agg = kept.groupBy(*steps, *frame).agg(F.round(F.sum("magnitude_px"), STEADY).alias("e"), F.count("*").alias("k"))
    rows = base.crossJoin(F.broadcast(grid)).join(agg, [*steps, *frame], "left")  # grid: a few dozen rows
    rows = rows.withColumn("fraction", ratio(F.coalesce("k", F.lit(0)), F.coalesce("n_vectors", F.lit(0))))
    rows = rows.crossJoin(F.broadcast(floor)).withColumn("energy", F.greatest(F.coalesce("e", F.lit(0.0)) - F.col("motion_energy_floor"), F.lit(0.0)))
    by = [*keys, *steps, "motion_energy_floor"]
    rows = rows.withColumns({f"rank_{c}": stats.average_rank(c, by) for c in ("energy", "fraction", "cd10")})
    on, seen = F.col("energy") > 0, F.col("cd10") > 0
    count = lambda test: F.count(F.when(test, 1))
    out = rows.groupBy(*by).agg(
        stats.pearson("energy", "cd10").alias("pearson_r"), stats.pearson("rank_energy", "rank_cd10").alias("spearman_r"),
        stats.pearson("fraction", "cd10").alias("active_fraction_pearson_r"),
        stats.pearson("rank_fraction", "rank_cd10").alias("active_fraction_spearman_r"),
        count(on).alias("active_frames"), count(seen).alias("cd10_active_frames"),
        count(F.col("cd10_sum_absdiff") > 0).alias("cd10_sum_absdiff_active_frames"),
        count(on & ~seen).alias("motion_active_cd10_zero_frames"), count(on & seen).alias("motion_active_cd10_positive_frames"),
        count(~on & seen).alias("missed_cd10_positive_frames"),
        F.percentile(F.when(seen, F.col("energy")), F.lit(0.5)).alias("median_energy_when_cd10_positive"),
        F.percentile(F.when(~seen, F.col("energy")), F.lit(0.95)).alias("p95_energy_when_cd10_zero"),
    )
    return out.orderBy(*keys, "motion_active_cd10_zero_frames", F.desc_nulls_last("pearson_r"), *by)
