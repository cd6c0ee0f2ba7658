"""Sentence splitting and tokenising as array expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .text import collapse_space


# white space is looked for first, as most places have none; a break begins with one anyway
_BREAK = r"(?=\s)" + fv.SENTENCE_BREAK


def split_sentences(text: Column) -> Column:
    return F.filter(F.split(text, _BREAK), lambda s: F.length(s) > 0)


def split_long_sentences(text: Column, min_words: int = fv.MIN_SENTENCE_WORDS) -> Column:
    """Sentences of at least ``min_words`` words of the space-collapsed text."""
    parts = F.split(collapse_space(text), _BREAK)
    return F.filter(parts, lambda s: F.size(F.split(s, " ")) >= min_words)


def content_terms(text: Column, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS) -> Column:
    """Lower-case ASCII words of two letters or more that are not stop words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), fv.NON_LETTERS)
    stop = _matchable(stop_words)
    return F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(stop))


def word_runs(text: Column, stop_words: Sequence[str] = fv.ENGLISH_STOP_WORDS) -> Column:
    """Lower-case runs of two or more letters, digits or underscores, without stop words."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(fv.WORD_RUN), 0)
    stop = list(stop_words)
    return F.filter(runs, lambda w: ~w.isin(stop))


def rouge_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+")
    return F.filter(words, lambda w: F.length(w) > 0)


def _matchable(stop_words: Sequence[str]) -> list[str]:
    # forms with an apostrophe never equal a purely alphabetic token
    return [w for w in stop_words if w.isalpha()]
