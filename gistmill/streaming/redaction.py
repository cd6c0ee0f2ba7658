"""Sanitising and auditing documents as they arrive.

Both are stateless projections, so they need no watermark and keep no state;
the sink's checkpoint makes the appended files exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as tx


def sanitised_stream(documents: DataFrame) -> DataFrame:
    """(doc_id, safe_text) of a stream or table of (doc_id, text)."""
    return documents.select("doc_id", tx.sanitise(F.col("text")).alias("safe_text"))


def audit_stream(documents: DataFrame, event: str = "load_doc") -> DataFrame:
    """(ts, event, doc_sha256), one row per arriving document."""
    return documents.select(
        F.date_trunc("second", F.current_timestamp()).alias("ts"),
        F.lit(event).alias("event"),
        tx.fingerprint(F.col("text")).alias("doc_sha256"),
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is available now, then stop."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def write_audit_stream(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return write_stream(audit_stream(documents), path, checkpoint)
