"""Proxy quality measures of summaries: headline recall, key-term coverage, compression."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import tokens as tk
from ..functions.exprs import once
from ..functions.long_sequences import long_lcs_length
from ..functions.porter import stem_tokens
from ..functions.sequences import lcs_length, ngrams
from .sentences import join_picked, lead


def assemble_summaries(docs: DataFrame, keywords: DataFrame, **picks: DataFrame) -> DataFrame:
    """One row per document: lead, one summary for each table (doc_id, picked) of ``picks``, and keywords.

    Only sentence numbers are joined, as the hashed side, so the texts are read
    once, in one pass, and never sorted.  A document without a pick has no summary.
    """
    table = docs.select("doc_id", "category", "title", "n_words", "sentences")
    for name, picked in picks.items():
        numbers = picked.select("doc_id", F.col("picked").alias(name))
        table = table.join(numbers.hint("shuffle_hash"), "doc_id", "left")
    table = table.join(keywords.hint("shuffle_hash"), "doc_id", "left")
    written_out = [join_picked(F.col("sentences"), F.col(name)).alias(name) for name in picks]
    return table.select("doc_id", "category", "title", "n_words", lead().alias("lead3"), *written_out, "keywords")


def by_model(summaries: DataFrame, models: Mapping[str, str] = fv.MODEL_COLUMNS) -> DataFrame:
    """One row per document and model, the set that is evaluated.

    Documents without keywords and missing summaries give no row.  A generator,
    not ``unpivot``: it keeps the partitioning by doc_id.
    """
    used = {name: column for name, column in models.items() if column in summaries.columns}
    pairs = [F.struct(F.lit(name).alias("model"), F.col(column).alias("summary")) for name, column in used.items()]
    rest = [c for c in summaries.columns if c not in used.values()]
    evaluated = summaries.filter(F.col("keywords").isNotNull())
    return evaluated.select(*rest, F.inline(F.array(*pairs))).filter(F.col("summary").isNotNull())


def tokenised(long: DataFrame, stemmed: bool = False) -> DataFrame:
    """(doc_id, model, reference, candidate): headline and summary tokens."""

    def tokens(text: Column) -> Column:
        words = tk.rouge_tokens(text)
        return stem_tokens(words) if stemmed else words

    return long.select(
        "doc_id", "model", tokens(F.col("title")).alias("reference"), tokens(F.col("summary")).alias("candidate")
    )


#: Steps of the comparison in the JVM that take as long as handing a pair to the one by bits, about.
LONG_PAIRS = 1 << 5


def rouge_n(tokens: DataFrame, sizes: Sequence[int] = (1, 2)) -> DataFrame:
    """(doc_id, model, n, recall): headline n-grams found in the summary, each at most as often as it occurs.

    A projection: only grams that both sides have are counted, inside the row,
    in the product of the lengths at most.
    """
    sides = {f"{side}_{n}": ngrams(F.col(side), n) for n in sizes for side in ("reference", "candidate")}
    grams = once(tokens.select("doc_id", "model", "reference", "candidate"), **sides)

    def count(side: str, gram: Column) -> Column:
        return F.size(side) - F.size(F.array_remove(side, gram))

    def recall(n: int) -> Column:
        reference, candidate = f"reference_{n}", f"candidate_{n}"
        hits = F.aggregate(
            F.array_intersect(reference, candidate), F.lit(0),
            lambda total, gram: total + F.least(count(reference, gram), count(candidate, gram)))
        return F.when(F.size(reference) > 0, hits / F.size(reference)).otherwise(0.0)

    found = F.array(*[F.struct(F.lit(n).alias("n"), recall(n).alias("recall")) for n in sizes])
    return grams.select("doc_id", "model", F.inline(found))


def rouge_l(tokens: DataFrame, long_pairs: int = LONG_PAIRS) -> DataFrame:
    """(doc_id, model, recall): longest common subsequence over headline length.

    Pairs whose lengths multiply to more than ``long_pairs`` are compared bit by bit, in Python; others, and those with a NULL, in the JVM.
    """
    size = F.size("reference")
    is_long = F.coalesce(size.cast("long") * F.size("candidate") > long_pairs, F.lit(False))

    def recalls(rows: DataFrame, lcs: Callable[[Column, Column], Column]) -> DataFrame:
        found = lcs(F.col("reference"), F.col("candidate"))
        return rows.select("doc_id", "model", F.when(size > 0, found / size).otherwise(0.0).alias("recall"))

    return recalls(tokens.where(~is_long), lcs_length).unionByName(recalls(tokens.where(is_long), long_lcs_length))


def _coverage(words: Column) -> Column:
    found = F.size(F.filter("keywords", lambda k: F.array_contains(words, k)))
    return found / F.size("keywords")


def _terms() -> Column:
    return tk.content_terms(F.col("summary"), stop_words=())


def _words() -> Column:
    flat = tx.collapse_space(F.col("summary"))
    return F.when(F.length(flat) == 0, 0).otherwise(tx.word_count(flat))


def measure_words(long: DataFrame) -> DataFrame:
    """(doc_id, model, coverage, words, ratio): keyword share, length and compression of each summary."""
    measured = once(long, terms=_terms(), words=_words())
    return measured.select(
        "doc_id", "model", _coverage(F.col("terms")).alias("coverage"), "words",
        (F.col("words") / F.col("n_words")).alias("ratio"),
    )


def coverage(long: DataFrame) -> DataFrame:
    """(doc_id, model, coverage): share of the document's keywords found in the summary."""
    return once(long, terms=_terms()).select("doc_id", "model", _coverage(F.col("terms")).alias("coverage"))


def compression(long: DataFrame) -> DataFrame:
    """(doc_id, model, words, ratio)."""
    return once(long, words=_words()).select("doc_id", "model", "words", (F.col("words") / F.col("n_words")).alias("ratio"))


def compare_models(long: DataFrame, tokens: DataFrame) -> DataFrame:
    """Mean of each measure per split and model, rounded to three decimals.

    ``long`` is ``by_model`` output with keywords and ``tokens`` its ``tokenised``
    form, best a written table as it is read twice.  The split is read off the
    document id.  Every measure is reduced to its means first, so only a handful
    of rows are joined.
    """
    words = measure_words(long).groupBy(*_split_and_model()).agg(
        F.count("*").alias("n_docs"),
        _mean("coverage", "KeyTermCoverage"), _mean("words", "AvgSummaryWords"), _mean("ratio", "CompressionRatio"),
    )
    grams = rouge_n(tokens).groupBy(*_split_and_model()).agg(
        *[_mean(F.when(F.col("n") == n, F.col("recall")), f"ROUGE{n}_R") for n in (1, 2)]
    )
    sequence = rouge_l(tokens).groupBy(*_split_and_model()).agg(_mean("recall", "ROUGEL_R"))
    return words.join(grams, ["split", "Model"]).join(sequence, ["split", "Model"])


def _split_and_model() -> list[Column]:
    return [F.split_part("doc_id", F.lit("_"), F.lit(1)).alias("split"), F.col("model").alias("Model")]


def _mean(value: str | Column, name: str) -> Column:
    return F.round(F.avg(value), 3).alias(name)
