"""Equi-join that stays even when a few keys hold much of one side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bounded_key

MAX_HOT_KEYS = 1_000
MAX_SALTS = 65_536


def hot_keys(rows: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """(hot_key, rows): the ``MAX_HOT_KEYS`` largest of the keys with more than ``hot_rows`` rows, long ones by digest."""
    counts = rows.groupBy(bounded_key(F.col(key).cast("string")).alias("hot_key")).agg(F.count("*").alias("rows"))
    large = counts.filter((F.col("rows") > hot_rows) & F.col("hot_key").isNotNull())
    return large.orderBy(F.desc("rows")).limit(MAX_HOT_KEYS)


def salted_join(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = 1_000_000, how: str = "left"
) -> DataFrame:
    """``left`` join ``right`` on ``key``, with hot keys spread so that a task gets about ``hot_rows`` rows.

    ``right`` has one row per key.  Keys with more than ``hot_rows`` rows on the
    left are hot; the ``MAX_HOT_KEYS`` largest of them are broadcast, by digest
    if they are long.  Only their right rows are repeated, once for each salt.
    Any key beyond that list holds less than one row in ``MAX_HOT_KEYS``.
    Rows without a key match nothing and are spread as well.  ``left`` is read
    twice, so pass a written table.
    """
    needed = F.least(F.ceil(F.col("rows") / hot_rows), F.lit(MAX_SALTS)).cast("int")
    hot = F.broadcast(hot_keys(left, key, hot_rows).select("hot_key", needed.alias("salts")))
    is_hot = bounded_key(F.col(key).cast("string")) == F.col("hot_key")
    salts = F.when(F.col(key).isNull(), MAX_SALTS).otherwise(F.coalesce("salts", F.lit(1)))
    salted_left = left.join(hot, is_hot, "left").withColumn("salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int"))
    repeats = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    salted_right = right.join(hot, is_hot, "left").withColumn("salt", F.explode(repeats))
    joined = salted_left.drop("salts", "hot_key").join(salted_right.drop("salts", "hot_key"), [key, "salt"], how)
    return joined.drop("salt")
