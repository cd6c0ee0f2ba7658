"""Quality rules whose limits adapt to each language and source.

Every text is measured inside its row.  Quartiles of the measures come from
mergeable quantile sketches (``percentile_approx``) per language and source, and
merged upwards per language and overall; a group with fewer than ``MIN_GROUP``
documents takes the limits of the next level.  A measure's limit is its third
quartile plus ``FENCE`` quartile distances, a distance counting ``SPREAD`` at
least, so that a clean group loses nothing.  Documents are joined with the limits
of their group and kept if no measure passes its limit and no base rule fails.

Only DataFrame functions are used.  Defined results: a null or empty text has no
words and fails the base rules; null languages or sources form groups of their
own; repeated rows are judged one by one.
A value at its limit is kept; very long texts are measured whole; an empty table gives no rows; ``keep_good``
returns columns of any other names as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import once
from .stages import written

SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
ACCURACY = 10_000
MIN_GROUP = 100
FENCE = 6.0
#: Least quartile distance that counts, by measure.
SPREAD = {"symbol_ratio": 0.01, "capital_ratio": 0.04, "mark_ratio": 0.02, "dup_line_ratio": 0.05, "repeat_ratio": 0.03}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with one more column, ``_q``: a struct of the counts and ratios of ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(
        *docs.columns,
        F.array_remove(F.split(text, SPACE), "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
        _without(text, SPACE_CHARACTERS).alias("_chars"),
        (F.length(text) - _without(text, SYMBOLS)).alias("_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, "\\p{Lu}+", ""))).alias("_capitals"),
        (F.length(text) - _without(text, "!?|")).alias("_marks"),
    )
    kept = [c for c in cut.columns if c not in ("_words", "_lines")]
    hashed = cut.select(
        *kept, F.size("_words").alias("_n"), F.size("_lines").alias("_line_count"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dup_lines"),
        F.when(F.size("_words") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("_words") - WINDOW),
            lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
        )).alias("_windows"),
    )
    # windows in order of their hash; only texts with a repeated window are sorted
    ordered = hashed.select(
        *[c for c in hashed.columns if c != "_windows"],
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(F.transform(
            "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_sorted"),
    )

    def repeated(x: Column, j: Column) -> Column:
        before, after = F.get("_sorted", j - 1), F.get("_sorted", j + 1)
        return (F.coalesce(before["h"] == x["h"], F.lit(False))) | F.coalesce(after["h"] == x["h"], F.lit(False))

    placed = ordered.select(
        *[c for c in ordered.columns if c != "_sorted"],
        F.sort_array(F.transform(F.filter("_sorted", repeated), lambda x: x["i"])).alias("_at"),
    )
    steps = F.zip_with(
        "_at", F.slice("_at", 2, F.greatest(F.size("_at") - 1, F.lit(0))),
        lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    counted = placed.select(
        *[c for c in placed.columns if c != "_at"],
        F.coalesce(F.aggregate(steps, F.lit(0), lambda total, x: total + x), F.lit(0)).alias("_repeats"),
    )

    def ratio(part: str, whole: str) -> Column:
        return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))

    measured = F.struct(
        *[F.col(c).cast("bigint").alias(name) for c, name in zip(
            ["_n", "_chars", "_symbols", "_dup_lines", "_repeats"], COUNTS, strict=True)],
        ratio("_symbols", "_chars").alias("symbol_ratio"),
        ratio("_capitals", "_chars").alias("capital_ratio"),
        ratio("_marks", "_chars").alias("mark_ratio"),
        ratio("_dup_lines", "_line_count").alias("dup_line_ratio"),
        ratio("_repeats", "_n").alias("repeat_ratio"),
    )
    return once(counted, _q=measured).select(*docs.columns, "_q")


def base_failed() -> Column:
    n, repeats = F.col("_q.n_words"), F.col("_q.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)


def limits(measured: DataFrame, min_group: int = MIN_GROUP, fence: float = FENCE) -> DataFrame:
    """The limits of each language and source: lang, source, ``max_`` of every measure."""
    quartiles = [
        F.percentile_approx(f"_q.{m}", [0.25, 0.75], ACCURACY).alias(m) for m in SPREAD
    ]
    levels = written(
        measured.select("lang", "source", "_q").rollup("lang", "source")
        .agg(F.grouping_id().alias("level"), F.count("*").alias("n"), *quartiles), "limits")

    def level(number: int, *keys: str) -> DataFrame:
        picked = levels.where(F.col("level") == number)
        if number:
            return picked.select(*[F.col(k).alias(f"{k}_{number}") for k in keys],
                                 F.struct("n", *SPREAD).alias(f"of_{number}"))
        return picked.select(*keys, F.struct("n", *SPREAD).alias("of_0"))

    joined = (
        level(0, "lang", "source")
        .join(level(1, "lang"), F.col("lang").eqNullSafe(F.col("lang_1")))
        .join(level(3), F.lit(True))  # the one row of the highest level
    )
    chosen = F.when(F.col("of_0.n") >= min_group, F.col("of_0")).when(
        F.col("of_1.n") >= min_group, F.col("of_1")).otherwise(F.col("of_3"))

    def limit(measure: str) -> Column:
        low, high = F.col("_limits")[measure][0], F.col("_limits")[measure][1]
        return F.round(high + fence * F.greatest(high - low, F.lit(SPREAD[measure])), 6)

    return joined.select("lang", "source", chosen.alias("_limits")).select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[limit(m).alias(f"max_{m}") for m in SPREAD])


def judge(measured: DataFrame, allowed: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept."""
    within = F.lit(True)
    for m in SPREAD:
        within = within & (F.col(f"_q.{m}") <= F.col(f"max_{m}"))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return measured.join(allowed, same, "left").select(
        *measured.columns, base_failed().alias("_base_failed"),
        (~base_failed() & F.coalesce(within, F.lit(True))).alias("_kept"))


def quality_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, the counts, base_failed, kept of every document."""
    measured = written(measures(docs.select("doc_id", "lang", "source", "text")).drop("text"), "measures")
    judged = judge(measured, written(limits(measured, **options), "allowed"))
    return judged.select("doc_id", *[F.col(f"_q.{c}").alias(c) for c in COUNTS],
                         F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with the columns of ``docs``, of any names.  Texts are measured twice rather than shuffled."""
    allowed = written(limits(measures(docs.select("lang", "source", "text")), **options), "allowed")
    rows = docs.select("lang", "source", "text", F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    return judge(measures(rows), allowed).where("_kept").select("row.*")
