"""Picking a few keys out of a large bucketed table without moving its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import bounded_key
from .skew import MAX_SALTS, hot_keys, salted_join

#: Bits of the filter at the scan: 1,024 bitmaps of 4 kB at most.
FILTER_BITS = 1 << 25


def may_be_asked(table: DataFrame, asked: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``table`` whose key's hash is that of a key of ``asked``; all that are asked for, and a few more.

    The hashes are set in bitmaps of fixed size, which are broadcast and tested
    where the table is scanned.  Keys of any number take ``bits`` / 8 bytes at most.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    maps = asked.where(F.col(key).isNotNull()).select(place.alias("place")).groupBy(
        F.bitmap_bucket_number("place").alias("map_no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("map"))
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substr("map", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("1 = shiftright(asked_byte, asked_bit) & 1")
    tested = table.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("map_no")).select(
        *table.columns, byte.alias("asked_byte"), (position % 8).cast("int").alias("asked_bit"))
    return tested.where(is_set).select(*table.columns)


def asked_rows(table: DataFrame, asked: DataFrame, key: str, buckets: int | None = None) -> DataFrame:
    """The rows of ``table`` with a key of ``asked``.

    ``table`` is bucketed by ``key`` into ``buckets``: the keys go to its buckets,
    so that only rows that pass the filter are sorted, and none is moved.
    """
    keys = asked.select(key).dropna().distinct()
    if buckets:
        keys = keys.repartition(buckets, key)
    return may_be_asked(table, keys, key).join(keys, key, "left_semi")


def local_join(left: DataFrame, right: DataFrame, key: str, buckets: int, hot_rows: int = 1_000_000) -> DataFrame:
    """``left`` left-joined with ``right``, one row per key and bucketed by ``key``, which stays in its buckets.

    Rows of ``left`` without a key match nothing and are spread.  If a key has
    more than ``hot_rows`` rows, the rows of hot keys are joined apart, by salts; of
    ``right`` only the hot keys' rows are moved then.
    """
    hot = hot_keys(left, key, hot_rows)
    names = [r["hot_key"] for r in hot.collect()]  # a bounded number of keys of bounded length
    spread = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(*[c for c in left.columns if c != key]), F.lit(MAX_SALTS)).cast("string"))
    if not names:
        return _in_buckets(left, right, key, buckets, spread)
    is_hot = F.coalesce(bounded_key(F.col(key).cast("string")).isin(names), F.lit(False))
    apart = salted_join(left.where(is_hot), right.where(is_hot), key, hot_rows)
    return _in_buckets(left.where(~is_hot), right, key, buckets, spread).unionByName(apart)


def _in_buckets(left: DataFrame, right: DataFrame, key: str, buckets: int, spread: Column) -> DataFrame:
    placed = left.withColumnRenamed(key, "own_key").withColumn(key, F.coalesce("own_key", spread)).repartition(buckets, key)
    joined = placed.join(right, key, "left")
    return joined.select(F.col("own_key").alias(key), *[c for c in joined.columns if c not in (key, "own_key")])
