"""Porter stemming of token arrays (M. F. Porter, 1980, with the usual later amendments).

The algorithm is rule by rule string rewriting that built-in functions cannot
express; it runs as a vectorised UDF that stems each word of a batch once.
"""

from __future__ import annotations

import os
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# send this module's functions to the workers whole: executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_STEMMED_LENGTH = 4

# --- fixed values: suffix rules of the published algorithm, longest match first ---
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous",
    "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful", "logi": "log",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


def _shape(word: str) -> str:
    """One letter per character: v for a vowel, c for a consonant; y after a consonant is a vowel."""
    shape = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_end(word: str) -> bool:
    """Consonant, vowel, consonant other than w, x, y; or a two-letter vowel, consonant word."""
    shape = _shape(word)
    return (shape[-3:] == "cvc" and word[-1] not in "wxy") or shape == "vc"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = next((e for e in ("ed", "ing") if word.endswith(e) and "v" in _shape(word[: -len(e)])), None)
    if ending is None:
        return word
    stem = word[: -len(ending)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_end(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem


def _final_y(word: str) -> str:
    # amended rule: y after a consonant that is not the first letter
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _replace_suffix(word: str, rules: dict[str, str]) -> str:
    for suffix in sorted((s for s in rules if word.endswith(s)), key=len, reverse=True):
        stem = word[: -len(suffix)]
        measured = stem + "l" if suffix == "logi" else stem
        return stem + rules[suffix] if _measure(measured) > 0 else word
    return word


def _derived(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _derived(word[:-4] + "al")
    return _replace_suffix(word, STEP_2)


def _drop_suffix(word: str) -> str:
    for suffix in sorted((s for s in STEP_4 if word.endswith(s)), key=len, reverse=True):
        stem = word[: -len(suffix)]
        allowed = _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t"))
        return stem if allowed else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derived):
        word = step(word)
    return _tidy(_drop_suffix(_replace_suffix(word, STEP_3)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stem_arrays(tokens: pd.Series) -> pd.Series:
    words = {t for ts in tokens for t in ts}
    stems = {t: stem(t) if len(t) >= MIN_STEMMED_LENGTH else t for t in words}
    return tokens.map(lambda ts: [stems[t] for t in ts])


@F.pandas_udf(T.StructType().add("stem", "string").add("cut", "integer").add("added", "string"))
def _changed_ends(words: pd.Series) -> pd.DataFrame:
    rows = []
    for word in words:
        result = stem(word) if len(word) >= MIN_STEMMED_LENGTH else word
        same = len(os.path.commonprefix((word, result)))
        rows.append((result, len(word) - same, result[same:]))
    return pd.DataFrame(rows, columns=["stem", "cut", "added"])


def changed_ends(word: Column) -> Column:
    """Struct of the stem of a word, the letters it loses at its end and those it gets; for tables that hold each word once."""
    return _changed_ends(word)


def stem_tokens(tokens: Column) -> Column:
    """Stems of the tokens of four letters or more, the others unchanged."""
    return _stem_arrays(tokens)
