"""Table layouts."""

from pyspark.sql import types as T

RAW = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("doc_id", "split", "category", "title", "text")]
)

CLEAN_COLUMNS = [
    "doc_id", "category", "title", "text", "sentences", "tokens",
    "n_chars", "n_words", "n_sentences", "n_tokens_clean", "avg_sent_len",
]

REQUEST_LOG = T.StructType([
    T.StructField("session", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("line", T.StringType()),
])
