"""Scalar expressions: guarded arithmetic, grid cells, candidate features, regimes, paths, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-12


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom as double, 0 where the bottom is 0 or missing."""
    return F.coalesce(F.try_divide(col(top).cast("double"), col(bottom).cast("double")), F.lit(0.0))


def clip(x: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """x held to [low, high]; null stays null (``least`` and ``greatest`` alone would skip it)."""
    x = col(x)
    out = x
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(x.isNotNull(), out)


def finite_or_zero(x: Column | str) -> Column:
    """x with null, NaN and infinities as 0."""
    x = col(x).cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)


def null_if_nan(x: Column | str) -> Column:
    x = col(x).cast("double")
    return F.when(~F.isnan(x), x)


def bin_index(seconds: Column | str, width_seconds: Column | float) -> Column:
    """Floor of the IEEE quotient: 0.15 s in bins of 0.05 s is bin 2, as in the tables this reads."""
    width = width_seconds if isinstance(width_seconds, Column) else F.lit(float(width_seconds))
    return F.floor(col(seconds).cast("double") / width).cast("long")


def pts_seconds(pts: Column | str, time_base: Column | str) -> Column:
    """Presentation time in seconds from a count and a "num/den" base; missing for the least 64-bit count."""
    part = F.split(col(time_base), "/")
    missing = col(pts) == F.lit(-(1 << 63))
    return F.when(~missing, F.try_divide(col(pts) * part[0].cast("double"), part[1].cast("double")))


def in_source(source: Column | str, which: str) -> Column:
    """Direction of the reference frame: past is negative, future positive, 0 neither."""
    tests = {"all": F.lit(True), "past": col(source) < 0, "future": col(source) > 0}
    if which not in tests:
        raise ValueError(f"unknown vector source {which!r}; choose from {', '.join(tests)}")
    return tests[which]


def on_lattice(dst_x: Column | str, dst_y: Column | str, block: int, stride: int) -> Column:
    """Whether the block lies on every ``stride``-th row and column; division truncates toward zero."""
    if stride <= 1:
        return F.lit(True)
    cell = lambda c: F.call_function("div", col(c).cast("long"), F.lit(block).cast("long")) % stride == 0
    return cell(dst_x) & cell(dst_y)


def normalised(x: Column, low: Column, high: Column) -> Column:
    span = F.greatest(high - low, F.lit(EPS))
    return F.least(F.greatest((x.cast("double") - low) / span, F.lit(0.0)), F.lit(0.999999))


#: Fixed names of the candidate features, in order.
CANDIDATES = (
    "mv_bout_fraction", "mv_bout_no_global_50", "mv_bout_no_global_35", "mv_bout_no_global_25", "mv_bout_inverse_saturation",
    "mv_bout_inverse_saturation_sq", "mv_bout_midrange_2_10_blocks", "mv_bout_midrange_2_6_blocks", "mv_bout_midrange_3_10_blocks",
    "mv_bout_low_coherence_075", "mv_bout_low_coherence_060", "mv_bout_capped_6_blocks", "mv_bout_capped_10_blocks",
    "mv_bout_log_vectors", "mv_bout_log_vectors_no_global_35",
)


def candidate_features() -> dict[str, Column]:
    """CANDIDATES of a frame by name, from its bout, activity and coherence columns."""
    floor0 = lambda c: F.greatest(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    active, bout, coherence = floor0("mv_active_fraction"), floor0("mv_bout_fraction"), floor0("coherence")
    blocks, bout_blocks = number("mv_active_vectors"), number("mv_bout_active_vectors")
    total = F.coalesce(F.nullif(F.col("analysis_n_vectors").cast("double"), F.lit(0.0)), F.lit(1.0))
    only = lambda test, value=bout: F.when(test, value).otherwise(F.lit(0.0))
    rest = F.greatest(1.0 - active, F.lit(0.0))
    logs = F.log1p(bout_blocks) / F.log1p(total)
    out = {"mv_bout_fraction": bout}
    out |= {f"mv_bout_no_global_{p}": only(active < p / 100) for p in (50, 35, 25)}
    out |= {"mv_bout_inverse_saturation": bout * rest, "mv_bout_inverse_saturation_sq": bout * rest * rest}
    out |= {f"mv_bout_midrange_{a}_{b}_blocks": only(blocks.between(a, b)) for a, b in ((2, 10), (2, 6), (3, 10))}
    out |= {f"mv_bout_low_coherence_{p:03d}": only(coherence <= p / 100) for p in (75, 60)}
    out |= {f"mv_bout_capped_{k}_blocks": F.least(bout_blocks, F.lit(float(k))) / total for k in (6, 10)}
    out |= {"mv_bout_log_vectors": logs, "mv_bout_log_vectors_no_global_35": only(active < 0.35, logs)}
    return out


#: The candidates screened for stimulus timing.
SCREENED = (
    "mv_bout_no_global_35", "mv_bout_inverse_saturation_sq", "mv_bout_midrange_3_10_blocks",
    "mv_bout_low_coherence_060", "mv_bout_capped_6_blocks", "mv_bout_log_vectors",
)


def cases(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first rule that holds."""
    out = None
    for test, label in rules:
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise)


def candidate_category(cd: Column, mv: Column, strong: float, low: float) -> Column:
    return cases([
        ((cd < strong) & (mv < strong), "not_strong"),
        ((mv >= strong) & (cd <= low), "mv_only_strong"),
        ((cd >= strong) & (mv <= low), "cd10_only_strong"),
        ((cd >= strong) & (mv >= strong), "high_both_absolute"),
    ], "other")


def ratio_category(cd: Column, mv: Column, strong: float, low: float, edge_low: float, edge_high: float) -> Column:
    """Later labels win over earlier ones, so the last rule is tested first; ``high_both_boundary`` only fills gaps."""
    return cases([
        ((mv >= edge_high) & (cd > low) & (cd < edge_low), "mv_high_cd10_mid"),
        ((cd >= edge_high) & (mv > low) & (mv < edge_low), "cd10_high_mv_mid"),
        ((cd >= edge_high) & (mv >= edge_low) & (mv < edge_high), "mv_boundary_cd10_high"),
        ((mv >= edge_high) & (cd >= edge_low) & (cd < edge_high), "cd10_boundary_mv_high"),
        ((mv >= strong) & (cd <= low), "mv_only_strong"),
        ((cd >= strong) & (mv <= low), "cd10_only_strong"),
        ((cd >= strong) & (mv >= strong), "high_both_absolute"),
        ((cd >= edge_high) & (mv >= edge_high), "high_both_boundary"),
    ], "low_both")


def event_score(style: str = "report") -> Column:
    """Score of a second-bin for its regime.  ``report`` ranks by plain excess, ``gallery`` by relative excess."""
    cd, mv = F.col("cd10"), F.col("smvo")
    cd_thr, mv_thr = F.col("cd10_threshold"), F.col("smvo_threshold")
    cd_eff, mv_eff = F.col("effective_cd10_threshold"), F.col("effective_smvo_threshold")
    if style == "report":
        only_cd, only_mv = cd - cd_thr, mv - mv_thr
        part = lambda x, thr, eff: F.when(F.abs(eff) > 1e-6, F.try_divide(x, eff)).otherwise(x - thr)
        both = part(cd, cd_thr, cd_eff) + part(mv, mv_thr, mv_eff)
    elif style == "gallery":
        only_cd = (cd - cd_eff) / (F.abs(cd_eff) + 1.0)
        only_mv = F.when(F.abs(mv_eff) > 1e-6, F.try_divide(mv - mv_eff, F.abs(mv_eff))).otherwise(mv - mv_eff)
        both = F.col("cd10_ratio") + F.col("smvo_ratio")
    else:
        raise ValueError(f"unknown score style {style!r}")
    cr, mr = F.col("cd10_ratio"), F.col("smvo_ratio")
    regime = F.col("regime")
    return (
        F.when(regime.isin("high_cd10_only", "cd10_only_strong"), only_cd)
        .when(regime.isin("high_smvo_only", "mv_only_strong"), only_mv)
        .when(regime.isin("high_both", "high_both_absolute", "high_both_boundary"), both)
        .when(regime == "cd10_boundary_mv_high", mr - F.abs(cr - 1.0))
        .when(regime == "mv_boundary_cd10_high", cr - F.abs(mr - 1.0))
        .when(regime == "cd10_high_mv_mid", cr - mr)
        .when(regime == "mv_high_cd10_mid", mr - cr)
        .otherwise(-(cd + mv))
    )


def basename(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def parent(path: Column | str) -> Column:
    return F.regexp_extract(col(path), r"^(.*)/[^/]*$", 1)


def stem(path: Column | str) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def slug(text: Column | str) -> Column:
    """Runs of anything but letters, digits, dot and hyphen as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(col(text), r"[^A-Za-z0-9.-]+", "_"), "^_+|_+$", "")


def stage(video: Column | str) -> Column:
    """The stage number at the end of a video name (``_S`` and digits), else "unknown"."""
    return F.coalesce(F.nullif(F.regexp_extract(col(video), r"_S(\d+)$", 1), F.lit("")), F.lit("unknown"))


def truthy(text: Column | str) -> Column:
    """1 for 1, true, yes, y in any case, else 0."""
    return F.coalesce(F.lower(F.trim(col(text).cast("string"))).isin("1", "true", "yes", "y"), F.lit(False)).cast("int")


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(F.trim(col(text).cast("string")), F.lit(""))


def label_path(text: Column | str) -> Column:
    """Labels of a JSON list, or of a JSON string parted by slashes; anything else is empty."""
    text = col(text)
    listed = F.from_json(text, "array<string>", {"mode": "PERMISSIVE"})
    plain = F.filter(F.transform(F.split(F.regexp_replace(text, '^"|"$', ""), "/"), lambda x: F.trim(x)), lambda x: x != "")
    none = F.array().cast("array<string>")
    return F.when(F.trim(text).startswith("["), F.coalesce(listed, none)).when(text.rlike('^".*"$'), plain).otherwise(none)


def elapsed_ms(text: Column | str) -> Column:
    """Last minus first ``at_ms`` of a JSON list of decisions; missing below two numbers."""
    times = F.filter(
        F.transform(F.from_json(col(text), "array<struct<at_ms: string>>"), lambda x: x["at_ms"].try_cast("double")),
        lambda x: x.isNotNull(),
    )
    return F.when(F.size(times) >= 2, F.array_max(times) - F.array_min(times))


def sentinels(count: Column | str, wanted: int) -> Column:
    """``wanted`` evenly spaced positions of 0..count-1, halves rounded to even; all of them if there are no more."""
    n = col(count).cast("int")
    if wanted <= 0:
        return F.array().cast("array<int>")
    every = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    if wanted == 1:
        return F.when(n > 1, F.array(F.floor(n / 2).cast("int"))).otherwise(every)
    spaced = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(wanted - 1)), lambda i: F.bround(i * (n - 1) / F.lit(float(wanted - 1))).cast("int")))
    return F.when(n <= wanted, every).otherwise(spaced)


def in_range(name: str, value: float, low: float, high: float) -> None:
    """Driver-side check of an option's range."""
    if not low <= value <= high:
        raise ValueError(f"{name} must lie in {low}..{high}, got {value}")
