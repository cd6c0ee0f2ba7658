"""Readers and writers.  Every path may be any URI Spark can reach."""

from .corpus import (
    bucket_count, check_unique, ingest, input_bytes, read_article_files, read_clean, read_documents, read_raw_csv, spread,
)
from .sinks import (
    append_audit, append_audit_lines, write_bucketed, write_clean, write_raw_csv, write_small_csv, write_summaries,
)

__all__ = [
    "append_audit", "append_audit_lines", "bucket_count", "check_unique", "ingest", "input_bytes",
    "read_article_files", "read_clean", "read_documents", "read_raw_csv", "spread", "write_bucketed", "write_clean", "write_raw_csv",
    "write_small_csv", "write_summaries",
]
