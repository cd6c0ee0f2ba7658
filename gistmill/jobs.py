"""The whole flow as jobs, one per step.

    python -m gistmill.jobs load      --articles URI --out URI
    python -m gistmill.jobs clean     --out URI
    python -m gistmill.jobs explore   --out URI
    python -m gistmill.jobs summarise --out URI

``--articles`` is a table of (raw_id, labels, article); every URI may be an
object store, whose encryption is set in the Hadoop configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import sources
from .functions import text as tx
from .operators import clean, eda, evaluate, learner
from .plans.workspace import Workspace
from .session import get_spark


def load(spark: SparkSession, articles: str, out: str) -> None:
    """Raw table as CSV files."""
    raw = sources.ingest(sources.spread(spark.read.parquet(articles)))
    sources.write_raw_csv(raw, f"{out}/raw_csv")
    sources.check_unique(sources.read_raw_csv(spark, f"{out}/raw_csv"))


def clean_corpus(spark: SparkSession, out: str) -> None:
    """Clean table as Parquet, and its profile."""
    raw = sources.read_raw_csv(spark, f"{out}/raw_csv")
    sources.write_clean(clean.prepare(raw), f"{out}/clean")
    sources.write_small_csv(eda.corpus_profile(sources.read_clean(spark, f"{out}/clean")), f"{out}/profile")


def explore(spark: SparkSession, out: str) -> None:
    """The tables behind the usual charts, and the summary statistics."""
    raw = sources.read_raw_csv(spark, f"{out}/raw_csv")
    docs = sources.read_clean(spark, f"{out}/clean")
    raw_words = tx.word_count(F.col("text"), r"\s+")
    eda.with_range_number(eda.word_frequency(docs)).write.mode("overwrite").parquet(f"{out}/words")
    words = spark.read.parquet(f"{out}/words")
    eda.zipf_rank(words).write.mode("overwrite").parquet(f"{out}/zipf_rank")
    tables = {
        "eda_stats": eda.eda_summary(raw, docs),
        "top_words": eda.top_words(words.select("word", "count"), 20),
        "raw_lengths": eda.equal_width_histogram(raw, raw_words, bins=50, cap=1500),
        "clean_lengths": eda.equal_width_histogram(docs, F.col("n_words"), bins=40, cap=1000),
        "sentences": eda.fixed_edge_histogram(docs, F.col("n_sentences"), start=5, stop=52, step=2, cap=50),
        "categories": eda.top_categories(docs, 10),
        "length_by_category": eda.length_box(docs),
    }
    for name, table in tables.items():
        sources.write_small_csv(table, f"{out}/{name}")


def summarise(spark: SparkSession, out: str) -> Workspace:
    """Summaries of all models as Parquet; importances, AUC and the comparison as CSV.

    Runs on the stages that the registered queries use: one shuffle by document,
    after which every step finds its rows in their bucket.
    """
    ws = Workspace(spark, out, clean=sources.read_clean(spark, f"{out}/clean").drop("text"))
    sources.write_small_csv(learner.importances(spark, ws.gbt), f"{out}/gbt_importance")
    auc = spark.createDataFrame([(learner.area_under_roc(ws.predictions),)], "auc double")
    sources.write_small_csv(auc, f"{out}/gbt_auc")
    sources.write_summaries(ws.all_summaries, f"{out}/summaries")
    test_set = ~learner.is_training(F.col("doc_id"))
    long = evaluate.by_model(ws.all_summaries.filter(test_set))
    tokens = ws.stem(ws.write_bucketed(evaluate.tokenised(long), "test_tokens"), "test")
    results = evaluate.compare_models(long, tokens)
    sources.write_small_csv(results, f"{out}/model_results")
    return ws


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=["load", "clean", "explore", "summarise"])
    parser.add_argument("--articles")
    parser.add_argument("--out", required=True)
    args = parser.parse_args()
    spark = get_spark(f"gistmill-{args.step}")
    if args.step == "load":
        load(spark, args.articles, args.out)
    else:
        {"clean": clean_corpus, "explore": explore, "summarise": summarise}[args.step](spark, args.out)
    spark.stop()


if __name__ == "__main__":
    main()
