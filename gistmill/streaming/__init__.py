"""Row-wise operators on streams."""

from .redaction import sanitised_stream, write_audit_stream, write_stream

__all__ = ["sanitised_stream", "write_audit_stream", "write_stream"]
