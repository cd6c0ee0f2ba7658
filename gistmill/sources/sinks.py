"""Writers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CLEAN_COLUMNS, RAW


def write_raw_csv(df: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    (
        df.select(*RAW.fieldNames()).write.mode("overwrite")
        .options(header=True, escape='"', maxRecordsPerFile=rows_per_file,
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def write_clean(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """The clean table; hashing on the id spreads long documents evenly over the files."""
    clean = df.select(*CLEAN_COLUMNS)
    spread = clean.repartition(partitions, "doc_id") if partitions else clean.repartition("doc_id")
    spread.write.mode("overwrite").parquet(path)


#: Documents whose lists are collected without sorting; a bucket holds a few thousand.
COLLECTED_GROUPS = 1 << 14


@contextmanager
def read_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Every bucket is a task of its own, also where no join needs it: packed files would make tasks grow with the input.

    A bucket is small, so lists by document are collected in a hash table, where Spark would begin to sort after 128 groups.
    """
    settings = {
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": str(COLLECTED_GROUPS),
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def write_bucketed(df: DataFrame, path: str, table: str, buckets: int, key: str = "doc_id") -> DataFrame:
    """Write as an external table bucketed by ``key`` and return it.

    Rows already hashed on ``key`` into that many partitions give one file per
    bucket.  Later work by ``key`` on the returned table needs no shuffle.
    """
    with read_by_bucket(df.sparkSession):
        (
            df.write.mode("overwrite").format("parquet").option("path", path)
            .bucketBy(buckets, key).saveAsTable(table)
        )
    return df.sparkSession.table(table)


def write_summaries(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """Result tables of fixed size (statistics, importances, metrics) as a single file."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def append_audit(df: DataFrame, path: str) -> None:
    """Append-only audit trail; the table holds fingerprints, never texts."""
    df.write.mode("append").parquet(path)


def append_audit_lines(df: DataFrame, path: str) -> None:
    """The same trail as text, one ``time | event | doc_sha256=…`` line per row."""
    utc = F.to_utc_timestamp("ts", F.current_timezone())
    time = F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    line = F.concat_ws(" | ", time, "event", F.concat(F.lit("doc_sha256="), "doc_sha256"))
    df.select(line.alias("value")).write.mode("append").text(path)
