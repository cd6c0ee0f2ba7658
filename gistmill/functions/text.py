"""Scalar text functions: loading, cleaning, redaction, fingerprints."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixed_values as fv


# --- loading -----------------------------------------------------------------
def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def after_first_line(text: Column) -> Column:
    """Everything behind the first newline; empty when there is none."""
    cut = F.instr(text, "\n")
    return F.when(cut > 0, F.substring(text, cut + 1, F.length(text))).otherwise("")


def collapse_space(text: Column) -> Column:
    """One blank for each run of Unicode white space, none at the ends."""
    return F.trim(F.regexp_replace(text, fv.UNICODE_SPACE + "+", " "))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, f"^{fv.UNICODE_SPACE}+|{fv.UNICODE_SPACE}+$", "")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _decode_references(references: pd.Series) -> pd.Series:
    return references.map(lambda refs: None if refs is None else [html.unescape(r) for r in refs])


def decode_entities(text: Column) -> Column:
    """Full HTML character-reference decoding.

    The JVM cuts the references out and puts the decoded ones back in; Python
    only sees the references themselves, which for most texts is an empty list.
    """
    pieces = F.split(text, fv.CHAR_REFERENCE, -1)
    decoded = _decode_references(F.regexp_extract_all(text, F.lit(fv.CHAR_REFERENCE), 0))
    woven = F.zip_with(pieces, decoded, lambda piece, ref: F.concat(piece, F.coalesce(ref, F.lit(""))))
    return F.array_join(woven, "")


def title_case(text: Column) -> Column:
    """Capital after every character that is not a cased letter (``str.title``)."""
    runs = F.regexp_extract_all(text, F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), 0)
    return F.array_join(F.transform(runs, F.initcap), "")


def flat_id(raw_id: Column) -> Column:
    return F.replace(raw_id, F.lit("/"), F.lit("_"))


def split_of(raw_id: Column) -> Column:
    return F.split_part(raw_id, F.lit("/"), F.lit(1))


def first_label(labels: Column, default: str = "none") -> Column:
    return F.coalesce(F.get(labels, F.lit(0)), F.lit(default))


def blank_to_null(text: Column) -> Column:
    """Blank fields are NULL, as they are after a trip through CSV."""
    return F.nullif(text, F.lit(""))


# --- cleaning ----------------------------------------------------------------
def drop_wire_tags(text: Column, source: Column | None = None) -> Column:
    """Drop ticker tags and unwrap other angle brackets.

    ``source`` is the column ``text`` was made from.  Looking there for a bracket
    is far cheaper than the patterns, and a plain column is not computed again.
    """
    without_tickers = F.regexp_replace(text, fv.TICKER_TAG, "")
    unwrapped = F.regexp_replace(without_tickers, fv.ANGLE_WRAP, "$1")
    return F.when(F.contains(text if source is None else source, F.lit("<")), unwrapped).otherwise(text)


def clean_text(text: Column, signature: str = fv.SIGNATURE) -> Column:
    unsigned = F.regexp_replace(text, signature, "")
    return F.trim(F.regexp_replace(drop_wire_tags(unsigned, source=text), r"\s+", " "))


# --- redaction ---------------------------------------------------------------
def strip_control(text: Column) -> Column:
    return F.regexp_replace(text, fv.CONTROL_CHARS, " ")


def redact_personal_data(text: Column, source: Column | None = None) -> Column:
    """Replace e-mail addresses, then phone numbers; ``source`` as in ``drop_wire_tags``."""
    without_mail = F.when(
        F.contains(text if source is None else source, F.lit("@")), F.regexp_replace(text, fv.EMAIL, "[EMAIL]")
    ).otherwise(text)
    return F.regexp_replace(without_mail, fv.PHONE, "[PHONE]")


def sanitise(text: Column, max_chars: int | None = None) -> Column:
    """The whole redacted text; prompts, which have a limit, give ``max_chars``."""
    untagged = drop_wire_tags(strip_control(text), source=text)
    safe = redact_personal_data(untagged, source=text)
    return safe if max_chars is None else F.substring(safe, 1, max_chars)


def fingerprint(text: Column) -> Column:
    """First 12 hex digits of SHA-256, ``-`` for nothing."""
    digest = F.substring(F.sha2(text, 256), 1, 12)
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "-").otherwise(digest)


# --- counting ----------------------------------------------------------------
def word_count(text: Column, pattern: str = " ") -> Column:
    # size() of NULL depends on the session's ANSI setting, this does not
    return F.when(text.isNotNull(), F.size(F.split(text, pattern)))


def digit_count(text: Column) -> Column:
    # runs of digits are few, so taking them out is quicker than all that is around them
    return F.length(text) - F.length(F.regexp_replace(text, "[0-9]+", ""))


def capital_ratio(sentence: Column, words: Column | None = None) -> Column:
    """Share of the words that begin with A to Z; ``words`` may give the sentence cut at its blanks."""
    words = F.split(sentence, " ") if words is None else words
    # strings are ordered by their bytes, and [ follows Z
    return F.size(F.filter(words, lambda w: (w >= "A") & (w < "["))) / F.size(words)
