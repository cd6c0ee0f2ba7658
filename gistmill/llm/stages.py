"""Intermediate tables in the folder the cluster names in ``spark.checkpoint.dir``, and names for added columns."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder

#: Bitmaps of ids that are broadcast, 64 MB at most.
MAPS = 1 << 14


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and return the written rows: they survive lost executors and are not computed again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def row_key() -> Column:
    """The id of a row, or, for a row without one, a number beyond all usual ids that its text gives.

    So rows without an id come last, are judged like others, and are repeats of each other if their texts are equal.
    """
    without = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(F.col("doc_id").cast("bigint"), without)


def unused(name: str, taken: Collection[str]) -> str:
    """``name``, with underscores behind it until no column of ``taken`` is called so (in any case)."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name += "_"
    return name


def with_membership(
    docs: DataFrame, ids: DataFrame, name: str = "in_target", maps: int = MAPS, key: str = "doc_id"
) -> DataFrame:
    """``docs`` with a boolean column: is its integer ``key`` among the doc_id of ``ids``?

    Ids that lie close, in at most ``maps`` ranges of 32,768, are broadcast as exact
    bitmaps of 4 kB each, and no text is moved; others are joined.
    """
    doc_id = F.col(key).cast("bigint")
    known = ids.select(F.col("doc_id").cast("bigint").alias("known")).where("known is not null")
    flag = unused(name, docs.columns)
    if known.select(F.bitmap_bucket_number("known")).distinct().count() > maps:
        own = known.select(F.col("known").alias(flag)).distinct()
        joined = docs.join(own, doc_id == own[flag], "left")
        return joined.withColumn(flag, F.col(flag).isNotNull()).withColumnRenamed(flag, name)
    number, bits = unused("number", docs.columns), unused("bits", docs.columns)
    sets = known.groupBy(F.bitmap_bucket_number("known").alias(number)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("known")).alias(bits))
    place = F.bitmap_bit_position(doc_id)
    byte = F.conv(F.hex(F.substr(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1
    joined = docs.join(F.broadcast(sets), F.bitmap_bucket_number(doc_id) == F.col(number), "left")
    return joined.select(*docs.columns, F.coalesce(is_set, F.lit(False)).alias(name))
