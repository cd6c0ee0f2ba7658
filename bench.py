"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Nothing is warmed up beyond the session.  The stages that several queries share run
under their own names first, so that each later figure is the query's own.  The
throughput of the summaries counts the idf, every stage below them and the write.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gistmill.plans.queries import QUERIES  # noqa: E402
from gistmill.plans.workspace import workspace  # noqa: E402
from gistmill.session import get_spark  # noqa: E402

STAGES = [
    "raw", "docs", "idf", "idf_index", "scores", "keywords", "ranks", "features", "gbt", "predictions",
    "summaries", "all_summaries", "tokens", "stemmed_tokens",
]
LEARNED = [
    *(f"stage_{s}" for s in ("idf", "idf_index", "scores", "features", "gbt", "predictions", "all_summaries")), "gbt_auc",
]
HEADLINE = [
    "eda_summary", "word_frequency_top20", "zipf_rank", "length_histogram_raw", "length_box_by_category",
    "term_weights", "keywords_top10", "summary_lead3", "summary_tfidf", "sentence_features",
    "gbt_summary", "gbt_auc", "summary_textrank", "summary_local", "summary_table", "rouge_ngram", "rouge_lcs",
    "keyterm_coverage", "model_comparison", "model_comparison_stemmed", "sanitise_documents",
    "session_state", "prompt_messages", "offline_reply", "audit_rows", "csv_roundtrip",
    "session_state_stream", "document_frequency_incremental", "distinct_words_sketched", "tfidf_auc",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "gistmill-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    ws = workspace(spark, folder)
    seconds: dict[str, float] = {}

    def timed(name, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    for name in STAGES:
        timed(f"stage_{name}", lambda: getattr(ws, name))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())

    docs = ws.docs.count()
    learned = sum(seconds[q] for q in LEARNED)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 2), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "docs": docs,
        "docs_per_sec": {
            "lead_tfidf_gbt": round(docs / learned, 1),
            "textrank": round(docs / (seconds["stage_ranks"] + seconds["summary_textrank"]), 1),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
