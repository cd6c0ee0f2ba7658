"""Small expression and projection helpers."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A plain ``withColumn`` is merged into every later filter and projection
    that uses it, so a regex chain would run again for each of them.  A
    one-element ``inline`` is a boundary the optimizer does not move
    expressions across, costs no shuffle and stays in code generation.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def bounded_key(value: Column, chars: int = 64) -> Column:
    """A join key of at most ``chars`` + 1 characters: the value behind a mark, or the digest of a longer one behind another."""
    return F.when(F.length(value) <= chars, F.concat(F.lit("="), value)).otherwise(
        F.concat(F.lit("#"), F.sha2(value, 256)))


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """A ``{name}`` template as one concatenation; inserted texts are not scanned again."""
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(values[name])
    return F.concat(*parts)
