"""The registered queries.  Each reads the tables of ``input_dir`` whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import tokens as tk
from ..operators import assistant, clean, eda, evaluate, increments, learner, local_summary, sentences, stems, textrank
from ..sources import corpus, sinks
from ..streaming import redaction
from .workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Workspace], DataFrame], decimals: int = 6) -> Callable[[Workspace], DataFrame]:
    """Register ``build`` under its name, with whole numbers as bigint and fractions rounded."""

    def run(spark: SparkSession, input_dir: str) -> DataFrame:
        return comparable(build(workspace(spark, input_dir)), decimals)

    QUERIES[build.__name__] = run
    return build


def comparable(df: DataFrame, decimals: int) -> DataFrame:
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind in ("tinyint", "smallint", "int"):
            column = column.cast("bigint")
        elif kind in ("float", "double"):
            column = F.round(column.cast("double"), decimals)
        columns.append(column.alias(name))
    return df.select(columns)


# --- loading and cleaning ------------------------------------------------------
@query
def ingest_title_body(ws: Workspace) -> DataFrame:
    return corpus.ingest(corpus.spread(corpus.read_documents(ws.spark, ws.input("documents"))))


@query
def ingest_title_body_stream(ws: Workspace) -> DataFrame:
    """The loader over articles that arrive in two parts, with labels that come before, with or after them."""
    return ws.arriving.labelled()


@query
def decode_entities(ws: Workspace) -> DataFrame:
    pages = corpus.spread(ws.spark.read.parquet(ws.input("pages")))
    return pages.select("page_id", tx.decode_entities(F.col("html")).alias("decoded"))


@query
def clean_documents(ws: Workspace) -> DataFrame:
    return clean.clean_documents(ws.raw).select("doc_id", "split", "category", "title", "text")


@query
def sentence_table(ws: Workspace) -> DataFrame:
    table = sentences.sentence_table(ws.docs)
    return table.select(
        "doc_id", "n_sentences", "sent_idx", "sentence", F.array_join("terms", " ").alias("terms"), "s_words"
    )


@query
def sentence_table_min4(ws: Workspace) -> DataFrame:
    rows = ws.raw.dropna(subset=["text"]).select(
        "doc_id", F.posexplode(tk.split_long_sentences(F.col("text"))).alias("sent_idx", "sentence")
    )
    return rows


@query
def document_features(ws: Workspace) -> DataFrame:
    return ws.docs.select(
        "doc_id", "category", "title", F.array_join("tokens", " ").alias("tokens"),
        "n_chars", "n_words", "n_sentences", "n_tokens_clean", "avg_sent_len",
    )


# --- exploration ---------------------------------------------------------------
@query
def corpus_profile(ws: Workspace) -> DataFrame:
    return eda.corpus_profile(ws.docs)


@query
def eda_summary(ws: Workspace) -> DataFrame:
    return eda.eda_summary(ws.raw, ws.docs)


@query
def word_frequency(ws: Workspace) -> DataFrame:
    return eda.word_frequency(ws.docs)


@query
def word_frequency_top20(ws: Workspace) -> DataFrame:
    return eda.top_words(eda.word_frequency(ws.docs), 20)


@query
def zipf_rank(ws: Workspace) -> DataFrame:
    return eda.zipf_rank(ws.ranged_words)


@query
def length_histogram_raw(ws: Workspace) -> DataFrame:
    return eda.equal_width_histogram(ws.raw, tx.word_count(F.col("text"), r"\s+"), bins=50, cap=1500)


@query
def length_histogram_clean(ws: Workspace) -> DataFrame:
    return eda.equal_width_histogram(ws.docs, F.col("n_words"), bins=40, cap=1000)


@query
def sentence_histogram(ws: Workspace) -> DataFrame:
    return eda.fixed_edge_histogram(ws.docs, F.col("n_sentences"), start=5, stop=52, step=2, cap=50)


@query
def category_top10(ws: Workspace) -> DataFrame:
    return eda.top_categories(ws.docs, 10)


@query
def length_box_by_category(ws: Workspace) -> DataFrame:
    return eda.length_box(ws.docs)


# --- statistics kept up to date -----------------------------------------------------
@query
def document_frequency_incremental(ws: Workspace) -> DataFrame:
    """Document frequency and idf of three batches, two of them compacted."""
    return ws.term_counts.idf()


@query
def distinct_words_sketched(ws: Workspace) -> DataFrame:
    """Distinct words of every category (null: all) by merged sketches, held against exact counts."""
    rows = ws.group_sketches.read()
    levels = increments.merged(rows, "category").unionByName(
        increments.merged(rows).select(F.lit(None).cast("string").alias("category"), "n_docs", "words", "lengths"))
    words = ws.docs.select("category", F.explode(F.array_distinct("tokens")).alias("word")).distinct()
    exact = words.groupBy("category").agg(F.count("*").alias("exact")).unionByName(
        words.select("word").distinct().agg(F.count("*").alias("exact")).select(
            F.lit(None).cast("string").alias("category"), "exact"))
    at_once = increments.group_sketches(ws.docs, "category").select(
        F.col("category").alias("of"), increments.distinct_words().alias("at_once"))
    estimate, bound = increments.distinct_words(), 4 * increments.DISTINCT_ERROR
    return (
        levels.withColumnRenamed("category", "group").join(exact, F.col("group").eqNullSafe(F.col("category")))
        .join(at_once, F.col("group") == F.col("of"), "left")
        .select(
            "category", F.col("exact").alias("distinct_words"),
            (F.abs(estimate - F.col("exact")) <= bound * F.col("exact") + 1).alias("within_bound"),
            (F.abs(estimate - F.coalesce("at_once", estimate)) <= bound * F.col("exact") + 1).alias("as_built_at_once"))
    )


@query
def length_quantiles_sketched(ws: Workspace) -> DataFrame:
    """Quartiles of document length of every category by merged sketches: is each rank within the stated error?"""
    merged = increments.merged(ws.group_sketches.read(), "category")
    errors = increments.with_rank_errors(merged, ws.docs)
    return errors.select("category", "n_docs", *[
        (F.col(c) <= increments.RANK_ERROR).alias(c.replace("error", "within")) for c in errors.columns if c.startswith("error_")])


# --- weights, scores, summaries --------------------------------------------------
@query
def document_frequency(ws: Workspace) -> DataFrame:
    return ws.idf


@query
def term_weights(ws: Workspace) -> DataFrame:
    return ws.term_weights


@query
def keywords_top10(ws: Workspace) -> DataFrame:
    return ws.keywords.select("doc_id", F.array_join("keywords", " ").alias("keywords"))


@query
def sentence_scores(ws: Workspace) -> DataFrame:
    return ws.scores


@query
def summary_lead3(ws: Workspace) -> DataFrame:
    return sentences.lead_summary(ws.docs)


@query
def summary_tfidf(ws: Workspace) -> DataFrame:
    return sentences.tfidf_summary(ws.scores, ws.docs)


@query
def textrank_vectors(ws: Workspace) -> DataFrame:
    return textrank.sentence_vectors(ws.docs).drop("term_no")


# ranks are often 1/n, which six decimals would cut in the middle
@partial(query, decimals=10)
def textrank_ranks(ws: Workspace) -> DataFrame:
    return textrank.sentence_ranks(ws.ranks)


@query
def summary_textrank(ws: Workspace) -> DataFrame:
    return textrank.textrank_summary(ws.ranks, ws.docs)


@query
def summary_local(ws: Workspace) -> DataFrame:
    safe = ws.raw.dropna(subset=["text"]).select("doc_id", tx.sanitise(F.col("text")).alias("text"))
    best = local_summary.local_summary(safe)
    return best.select("doc_id", F.array_join(local_summary.best_sentences("best"), " ").alias("local_summary"))


# --- classifier --------------------------------------------------------------------
@query
def headline_labels(ws: Workspace) -> DataFrame:
    return ws.features.select("doc_id", "sent_idx", "overlap", "overlap_rank", "label")


@query
def sentence_features(ws: Workspace) -> DataFrame:
    return ws.features.drop("overlap", "overlap_rank", "label")


@query
def gbt_predictions(ws: Workspace) -> DataFrame:
    return ws.predictions.select("doc_id", "sent_idx", "label", "p")


@query
def gbt_summary(ws: Workspace) -> DataFrame:
    return learner.gbt_summary(ws.predictions, ws.docs)


@query
def gbt_importance(ws: Workspace) -> DataFrame:
    return learner.importances(ws.spark, ws.gbt)


@query
def gbt_auc(ws: Workspace) -> DataFrame:
    return learner.exact_auc(ws.scored(ws.predictions, "gbt")).select(F.col("n").alias("n_sentences"), "auc")


# a score alone, without a model: the SQL has it, too
@partial(query, decimals=9)
def tfidf_auc(ws: Workspace) -> DataFrame:
    """How well the normalised tf-idf score of a sentence finds the sentences that share most with the headline."""
    rows = ws.features.select("label", F.round("tfidf_norm", 6).alias("score"))
    return learner.exact_auc(ws.scored(rows, "tfidf", "score"))


# --- assembly and evaluation -------------------------------------------------------
@query
def summary_table(ws: Workspace) -> DataFrame:
    return ws.summaries.withColumn("keywords", F.array_join("keywords", " "))


@query
def summary_table_gbt(ws: Workspace) -> DataFrame:
    return ws.all_summaries.withColumn("keywords", F.array_join("keywords", " "))


@query
def rouge_ngram(ws: Workspace) -> DataFrame:
    return evaluate.rouge_n(ws.tokens)


@query
def rouge_ngram_stemmed(ws: Workspace) -> DataFrame:
    return evaluate.rouge_n(ws.stemmed_tokens)


@query
def stem_dictionary(ws: Workspace) -> DataFrame:
    """Every word of headlines and untrained summaries with its stem, of the dictionary that tokens are stemmed by."""
    words = stems.vocabulary(_untrained(ws.all_tokens)).select("word")
    return words.join(ws.stem_dictionary.select("word", "stem"), "word")


def _untrained(rows: DataFrame) -> DataFrame:
    """Without the classifier's summaries, which SQL has no model for."""
    return rows.where(F.col("model") != fv.LEARNED_MODEL)


@query
def rouge_ngram_stemmed_untrained(ws: Workspace) -> DataFrame:
    return evaluate.rouge_n(_untrained(ws.stemmed_tokens))


@query
def rouge_lcs_stemmed_untrained(ws: Workspace) -> DataFrame:
    return evaluate.rouge_l(_untrained(ws.stemmed_tokens))


@query
def model_comparison_stemmed_untrained(ws: Workspace) -> DataFrame:
    """The comparison by stems of the models that need no training."""
    return evaluate.compare_models(_untrained(evaluate.by_model(ws.all_summaries)), _untrained(ws.stemmed_tokens))


@query
def rouge_lcs(ws: Workspace) -> DataFrame:
    return evaluate.rouge_l(ws.tokens)


@query
def keyterm_coverage(ws: Workspace) -> DataFrame:
    return evaluate.coverage(evaluate.by_model(ws.summaries))


@query
def compression(ws: Workspace) -> DataFrame:
    return evaluate.compression(evaluate.by_model(ws.summaries))


@query
def model_comparison(ws: Workspace) -> DataFrame:
    return evaluate.compare_models(evaluate.by_model(ws.summaries), ws.tokens)


@query
def model_comparison_stemmed(ws: Workspace) -> DataFrame:
    return evaluate.compare_models(evaluate.by_model(ws.all_summaries), ws.stemmed_tokens)


# --- redaction and the assistant -----------------------------------------------------
@query
def sanitise_documents(ws: Workspace) -> DataFrame:
    return ws.documents().select(
        "doc_id", tx.sanitise(F.col("text")).alias("safe_text"), tx.fingerprint(F.col("text")).alias("doc_sha256")
    )


@query
def abstractive_inputs(ws: Workspace) -> DataFrame:
    return clean.abstractive_inputs(ws.raw, rows=None)


@query
def abstractive_inputs_top5(ws: Workspace) -> DataFrame:
    return clean.abstractive_inputs(ws.raw)


@query
def session_state(ws: Workspace) -> DataFrame:
    return ws.session_state.drop("argument")


@query
def prompt_messages(ws: Workspace) -> DataFrame:
    messages = assistant.prompt_messages(ws.session_state, ws.documents_in_use, buckets=ws.buckets)
    return messages.select("session", "turn", F.inline("messages"))


@query
def prompt_preview(ws: Workspace) -> DataFrame:
    return assistant.prompt_preview(assistant.prompt_messages(ws.session_state, ws.documents_in_use, buckets=ws.buckets))


@query
def offline_reply(ws: Workspace) -> DataFrame:
    return assistant.offline_replies(ws.session_state, ws.documents_in_use, buckets=ws.buckets)


@query
def confirmations(ws: Workspace) -> DataFrame:
    return assistant.confirmations(ws.session_state, ws.documents_in_use, buckets=ws.buckets)


@query
def audit_rows(ws: Workspace) -> DataFrame:
    return assistant.audit_rows(ws.session_state, ws.documents_in_use, buckets=ws.buckets)


@query
def session_state_stream(ws: Workspace) -> DataFrame:
    """The state of sessions kept by a stream that was stopped in the middle of the log."""
    return ws.live.table("state").drop("argument", "pasted")


@query
def prompt_messages_stream(ws: Workspace) -> DataFrame:
    return ws.live.table("prompts").select("session", "turn", F.inline("messages"))


@query
def audit_rows_stream(ws: Workspace) -> DataFrame:
    return ws.live.table("audit")


# --- sinks -----------------------------------------------------------------------------
@query
def csv_roundtrip(ws: Workspace) -> DataFrame:
    path = ws.fresh_path("raw_csv")
    sinks.write_raw_csv(ws.raw, path)
    return corpus.read_raw_csv(ws.spark, path)


@query
def parquet_roundtrip(ws: Workspace) -> DataFrame:
    path = ws.fresh_path("clean")
    sinks.write_clean(ws.docs, path)
    return corpus.read_clean(ws.spark, path).drop("sentences", "tokens")


@query
def audit_append(ws: Workspace) -> DataFrame:
    """Two appends of the audit rows, loads and the rest, read back without the time."""
    rows = assistant.stamped(assistant.audit_rows(ws.session_state, ws.documents_in_use, buckets=ws.buckets))
    path = ws.fresh_path("audit")
    sinks.append_audit(rows.filter("event LIKE '%doc'"), path)
    sinks.append_audit(rows.filter("event NOT LIKE '%doc'"), path)
    return ws.spark.read.parquet(path).drop("ts")


@query
def sanitise_stream(ws: Workspace) -> DataFrame:
    """The documents read as a stream, sanitised, and appended until none is left."""
    schema = ws.spark.read.parquet(ws.input("documents")).schema
    # a pattern that only this name fits: as a source of a stream, it may stand for one file or for a folder of files
    stream = ws.spark.readStream.schema(schema).parquet(f"{ws.input_dir}/documents.parque[t]")
    path = ws.fresh_path("sanitised")
    redaction.write_stream(redaction.sanitised_stream(stream), path, path + "_checkpoint").awaitTermination()
    return ws.spark.read.parquet(path)
