"""Stemming of token tables by a dictionary: each word of the corpus is stemmed once.

A stem is its word with a changed end, and the rules change a bounded number of
letters, so an entry is (letters cut, letters added), however long the word.
Words that stay as they are have no entry.  Entries of frequent words are
broadcast, a bounded number under keys of bounded length; those of other words
go to the documents that hold them.  Tokens never leave their document's bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bounded_key, once
from ..functions.porter import MIN_STEMMED_LENGTH, changed_ends

ENTRY = "array<struct<word: string, cut: int, added: string>>"
#: Changed words of a document in a map, about: maps are searched from end to end.
SLOT_WORDS = 16


def _distinct_words(tokens: DataFrame) -> DataFrame:
    """(doc_id, word), the words of four letters or more of each row, once a row."""
    words = tokens.select("doc_id", F.explode(F.array_distinct(F.concat("reference", "candidate"))).alias("word"))
    return words.where(F.length("word") >= MIN_STEMMED_LENGTH)


def vocabulary(tokens: DataFrame) -> DataFrame:
    """(word, df): every word that may have another stem, and the rows it stands in."""
    return _distinct_words(tokens).groupBy("word").agg(F.count("*").alias("df"))


def stem_dictionary(words: DataFrame) -> DataFrame:
    """(word, df, stem, cut, added) of a ``vocabulary``; the one place where Python runs, once a word."""
    return words.select("word", "df", changed_ends(F.col("word")).alias("end")).select("word", "df", "end.*")


def changes(dictionary: DataFrame) -> DataFrame:
    """(word, df, cut, added) of the words that have another stem."""
    return dictionary.where(F.col("word") != F.col("stem")).select("word", "df", "cut", "added")


def hot_changes(entries: DataFrame, least: int) -> DataFrame:
    """(key, hot_cut, hot_added) of the words in ``least`` rows or more."""
    hot = entries.where(F.col("df") >= least)
    return hot.select(bounded_key(F.col("word")).alias("key"), F.col("cut").alias("hot_cut"), F.col("added").alias("hot_added"))


def rare_changes(tokens: DataFrame, entries: DataFrame, least: int, partitions: int) -> DataFrame:
    """(doc_id, rare): the entries of the other words of each document.

    Distinct pairs of a document and a word are shuffled, to the entries and
    back; a word here stands in less than ``least`` rows, so none is skewed, as
    words in more are left out before, by a broadcast of bounded size.
    """
    hot = F.broadcast(hot_changes(entries, least).select("key"))
    pairs = _distinct_words(tokens).join(hot, bounded_key(F.col("word")) == F.col("key"), "left_anti").distinct()
    found = pairs.join(entries.where(F.col("df") < least).select("word", "cut", "added"), "word")
    packed = found.repartition(partitions, "doc_id").groupBy("doc_id")
    return packed.agg(F.collect_list(F.struct("word", "cut", "added")).alias("rare"))


def stemmed(tokens: DataFrame, hot: DataFrame, rare: DataFrame | None = None) -> DataFrame:
    """``tokens`` (doc_id, model, reference, candidate) with every token replaced by its stem.

    The distinct words of a document are looked up, and what changes goes back to
    its rows as small maps, dealt by a hash of the word; all of it stays in the bucket.
    Rows without tokens keep their empty arrays.
    """
    entry = F.struct("word", F.col("hot_cut").alias("cut"), F.col("hot_added").alias("added"))
    found = _distinct_words(tokens).join(F.broadcast(hot), bounded_key(F.col("word")) == F.col("key"))
    rows = tokens.join(found.groupBy("doc_id").agg(F.collect_set(entry).alias("known")).hint("shuffle_hash"), "doc_id", "left")
    listed = [F.coalesce("known", F.array().cast(ENTRY))]
    if rare is not None:
        rows = rows.join(rare.hint("shuffle_hash"), "doc_id", "left")
        listed.append(F.coalesce("rare", F.array().cast(ENTRY)))
    changed = F.transform(F.concat(*listed), lambda e: F.struct(
        e["word"].alias("word"), F.concat(F.substr(e["word"], F.lit(1), F.length(e["word"]) - e["cut"]), e["added"]).alias("stem")))
    rows = once(rows.select("doc_id", "model", "reference", "candidate", changed.alias("changed")),
                n_slots=(F.size("changed") / SLOT_WORDS).cast("int") + 1)
    rows = once(rows, slots=F.transform(F.sequence(F.lit(0), F.col("n_slots") - 1), lambda slot: F.map_from_entries(
        F.filter("changed", lambda e: _slot(e["word"]) == slot))))

    def stems_of(side: str) -> Column:
        return F.transform(side, lambda word: F.coalesce(
            F.try_element_at(F.get("slots", _slot(word)), word), word)).alias(side)

    return rows.select("doc_id", "model", stems_of("reference"), stems_of("candidate"))


def _slot(word: Column) -> Column:
    return F.pmod(F.hash(word), "n_slots")
