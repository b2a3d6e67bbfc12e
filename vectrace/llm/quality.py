"""Quality rules: a threshold table compiled into one projection of built-in expressions.

``RULES`` holds (name, measure, low, high); a measure outside [low, high] rejects the document.
Everything is array and string built-ins over the row itself: no shuffle, no user function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrace.llm.common import SPACES, words

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on are this "
    "le la les de des et en un une que qui dans pour sur du "
    "der die das und den von zu mit sich dem nicht ein eine ist im "
    "el los las del y se por con una su para al lo como"
).split()
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The method's own limits; a bound of None is open.
RULES = (
    Rule("mean_word_chars", "word_chars / n_words", 2.0, 12.0),
    Rule("symbol_share", "n_symbols / n_words", None, 0.15),
    Rule("dup_line_share", "n_dup_lines / n_lines", None, 0.5),
    Rule("stop_word_share", "n_stop / n_words", 0.02, None),
    Rule("ellipsis_lines", "n_ellipsis / n_lines", None, 0.5),
    Rule("letter_share", "n_letters / word_chars", 0.6, None),
)
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50


def _size(a: Column) -> Column:
    return F.size(a).cast("long")


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The raw counts of every text: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and others.

    Null texts count as empty (all zero).  ``keep`` names further input columns to carry; they come
    back as ``_in_<name>`` so that no name can clash with a measure.

    Three-word windows are joined with a space, which no word holds.  Their positions are sorted as
    (window, position) only in texts that repeat a window at all; a window is repeated when a
    neighbour in that order is equal, and its three positions are then counted once each.
    """
    base = df.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        *[F.col(c).alias(f"_in_{c}") for c in keep],
    )
    split = base.withColumns({"_words": words(F.col("_text")), "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACES}]"))})
    size = F.size("_words")
    windows = F.transform(
        F.slice("_words", 1, F.greatest(size - 2, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    grams = split.withColumn("_grams", windows)
    ordered = F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    grams = grams.withColumn(
        "_sorted", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), ordered)
    )
    same = lambda x, y: F.coalesce(x["g"] == y["g"], F.lit(False))
    starts = F.filter(
        "_sorted", lambda x, k: same(x, F.get("_sorted", k + 1)) | same(x, F.get("_sorted", k - 1))
    )
    grams = grams.withColumn("_starts", F.transform(starts, lambda x: x["i"]))
    covered = F.array_distinct(F.flatten(F.transform("_starts", lambda i: F.array(i, i + 1, i + 2))))
    stops = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    joined = F.array_join("_words", "")
    return grams.select(
        F.col("_id").alias(id_col),
        _size(F.col("_words")).alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (_size(F.col("_lines")) - _size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.when(F.col("_sorted").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long").alias("n_repeat_words"),
        _size(F.col("_lines")).alias("n_lines"),
        _size(F.filter("_words", lambda w: w.isin(*stops))).alias("n_stop"),
        _size(F.filter("_lines", lambda x: x.endswith("...") | x.endswith("…"))).alias("n_ellipsis"),
        F.length(F.regexp_replace(joined, r"\P{L}+", "")).cast("long").alias("n_letters"),
        *[f"_in_{c}" for c in keep],
        # A filter on the verdict must not be pushed below this projection, where it would compute
        # every measure again inside each array function; a row number it also reads prevents that.
        *([F.monotonically_increasing_id().alias("_row")] if keep else []),
    )


def verdict(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add base_failed, one boolean ``fails_<rule>`` each, and kept.

    A ratio over no words or lines counts as 0.  base_failed holds below 50 words or when over half
    of the words lie in repeated windows.
    """
    out = df.withColumn(
        "base_failed",
        (F.col("n_words") < BASE_MIN_WORDS)
        | (100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PERCENT * F.col("n_words")),
    )
    fails = {}
    for rule in rules:
        top, _, bottom = rule.measure.partition(" / ")
        value = F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        fails[f"fails_{rule.name}"] = bad
    out = out.withColumns(fails)
    any_rule = F.lit(False)
    for name in fails:
        any_rule = any_rule | F.col(name)
    return out.withColumn("kept", ~F.col("base_failed") & ~any_rule)


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document with its counts and verdict."""
    return verdict(measure(df, id_col, text_col), rules)


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that pass, with their own columns unchanged."""
    judged = verdict(measure(df, id_col, text_col, keep=tuple(df.columns)), rules)
    return judged.filter(F.col("kept") & (F.col("_row") >= 0)).select(*[F.col(f"_in_{c}").alias(c) for c in df.columns])
