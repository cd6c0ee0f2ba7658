"""Tables written between stages.

Cleaning is a chain of regular expressions that every later step needs, so its
result is written once.  The document tables are bucketed by doc_id: the shuffle
that spreads the corpus over files is the only one the per-document work needs.
Windows, groupings and joins by document then run where the bucket lies.
A written table also survives the loss of any executor.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.ml.classification import GBTClassificationModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assistant, clean, eda, evaluate, increments, learner, stems, textrank, weights
from ..operators import sentences as sentence_ops
from ..session import shared_folder
from ..sources import bucket_count, check_unique, ingest, read_documents, spread, write_bucketed
from ..sources.corpus import BUCKET_BYTES, input_bytes
from ..streaming import articles, sessions
from . import request_log


class Workspace:
    """The stages of one input folder; each is computed at first use and written once.

    ``clean`` may give the clean table itself; stages before it then do not exist.
    """

    def __init__(
        self, spark: SparkSession, input_dir: str, bucket_bytes: int = BUCKET_BYTES, clean: DataFrame | None = None
    ):
        self.spark = spark
        self.input_dir = input_dir.rstrip("/")
        self.clean = clean
        self.tables: list[str] = []
        self.bucket_bytes = bucket_bytes
        self.run = f"gistmill_{uuid.uuid4().hex[:12]}"
        self.folder = f"{shared_folder(spark)}/{self.run}"

    # --- writing ---------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def fresh_path(self, name: str) -> str:
        """A new path each time, for queries whose point is the writing."""
        return self.path(f"{name}_{uuid.uuid4().hex[:8]}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def write_bucketed(self, df: DataFrame, name: str, key: str = "doc_id") -> DataFrame:
        self.tables.append(f"{self.run}_{name}")
        return write_bucketed(df, self.path(name), self.tables[-1], self.buckets, key)

    def forget(self) -> None:
        """Take the bucketed tables out of the session's catalog; ``folder`` can then be deleted as a whole."""
        while self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")

    @cached_property
    def buckets(self) -> int:
        source = self.spark.read.parquet(self.input("documents")) if self.clean is None else self.clean
        return bucket_count(source, self.bucket_bytes)

    def input(self, table: str) -> str:
        return f"{self.input_dir}/{table}.parquet"

    # --- stages ----------------------------------------------------------------
    def documents(self) -> DataFrame:
        return spread(self.spark.read.parquet(self.input("documents")))

    @cached_property
    def raw(self) -> DataFrame:
        """doc_id, split, category, title, text of every article."""
        documents = read_documents(self.spark, self.input("documents"))
        raw = self.write_bucketed(ingest(documents, partitions=self.buckets), "raw")
        check_unique(raw)
        return raw

    @cached_property
    def arriving(self) -> articles.ArrivingCorpus:
        """The documents as they arrive in two parts, most labels behind their articles."""
        corpus = articles.ArrivingCorpus(self.spark, self.path("arriving"))
        rows = read_documents(self.spark, self.input("documents")).withColumn("arrived", F.current_timestamp())
        part = F.pmod(F.xxhash64("raw_id"), F.lit(4))
        for texts, labels in ((part < 2, part == 0), (part >= 2, part != 0)):
            rows.where(texts).select("raw_id", "article", "arrived").write.mode("append").parquet(self.path("new_articles"))
            rows.where(labels).select("raw_id", "labels", "arrived").write.mode("append").parquet(self.path("new_labels"))
            corpus.run(articles.arriving(self.spark, self.path("new_articles"), articles.ARTICLES),
                       articles.arriving(self.spark, self.path("new_labels"), articles.LABELS))
        return corpus

    @cached_property
    def docs(self) -> DataFrame:
        """Clean documents that passed the length gate."""
        if self.clean is not None:
            return self.write_bucketed(self.clean.repartition(self.buckets, "doc_id"), "docs")
        return self.write_bucketed(clean.prepare(self.raw), "docs")

    @cached_property
    def idf(self) -> DataFrame:
        return self.write(weights.idf_table(self.docs), "idf")

    @cached_property
    def idf_index(self) -> weights.IdfIndex:
        return self.index_idf()

    def index_idf(self, hot_terms: int = weights.HOT_TERMS) -> weights.IdfIndex:
        """The idf cut for joining; both parts are written, the rare terms in their documents' buckets."""
        least = weights.least_hot_df(self.idf, hot_terms)
        hot = self.write(weights.hot_idf(self.idf, least), f"hot_idf_{least}")
        if least <= 1:
            return weights.IdfIndex(hot, None)
        rare = weights.rare_idf(self.docs, self.idf, hot, least, self.buckets)
        return weights.IdfIndex(hot, self.write_bucketed(rare, f"rare_idf_{least}"))

    @cached_property
    def term_weights(self) -> DataFrame:
        return weights.term_weights(self.docs, self.idf_index)

    @cached_property
    def scores(self) -> DataFrame:
        return self.write_bucketed(sentence_ops.sentence_scores(self.docs, self.idf_index), "scores")

    @cached_property
    def ranks(self) -> DataFrame:
        """Ranks of all sentences, one array per document; the texts stay in the clean table."""
        return self.write_bucketed(textrank.textrank(self.docs), "ranks")

    @cached_property
    def keywords(self) -> DataFrame:
        return self.write_bucketed(weights.keywords(self.term_weights), "keywords")

    @cached_property
    def features(self) -> DataFrame:
        return self.write_bucketed(learner.sentence_features(self.docs, self.scores), "features")

    @cached_property
    def gbt(self) -> GBTClassificationModel:
        return learner.fit_gbt(self.features)

    @cached_property
    def predictions(self) -> DataFrame:
        return self.write_bucketed(learner.gbt_predictions(self.gbt, self.features), "predictions")

    def scored(self, rows: DataFrame, name: str, score: str = "p") -> DataFrame:
        return self.write(learner.by_score(rows, score), f"{name}_by_score")

    # --- statistics that grow with the corpus -------------------------------------
    def batches(self, n: int = 3) -> list[DataFrame]:
        """The clean documents as if they had come in ``n`` batches."""
        return [self.docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) == i) for i in range(n)]

    @cached_property
    def term_counts(self) -> increments.TermCounts:
        """Document frequencies of three batches; the first two are brought together before the third comes."""
        counts = increments.TermCounts(self.spark, self.path("term_counts"))
        for i, batch in enumerate(self.batches()):
            counts.add_documents(batch, f"batch {i}")
            if i == 1:
                counts.compact_terms()
        return counts

    @cached_property
    def group_sketches(self) -> increments.GroupSketches:
        """Sketches per category of three batches."""
        sketches = increments.GroupSketches(self.spark, self.path("group_sketches"))
        for i, batch in enumerate(self.batches()):
            sketches.add_documents(batch, f"batch {i}")
        return sketches

    @cached_property
    def summaries(self) -> DataFrame:
        """Lead, tf-idf and graph summaries with keywords."""
        return self.write_bucketed(evaluate.assemble_summaries(self.docs, self.keywords, **self._picks()), "summaries")

    def _picks(self) -> dict[str, DataFrame]:
        return {
            "tfidf_summary": sentence_ops.pick_top(self.scores, "tfidf_score"),
            "textrank_summary": textrank.pick_ranked(self.ranks),
        }

    @cached_property
    def all_summaries(self) -> DataFrame:
        """The summaries with those of the classifier, which exist for test documents only."""
        learned = sentence_ops.pick_top(self.predictions, "p")
        table = evaluate.assemble_summaries(self.docs, self.keywords, **self._picks(), gbt_summary=learned)
        return self.write_bucketed(table, "all_summaries")

    @cached_property
    def tokens(self) -> DataFrame:
        pairs = evaluate.by_model(self.summaries)
        return self.write_bucketed(evaluate.tokenised(pairs), "tokens")

    @cached_property
    def stemmed_tokens(self) -> DataFrame:
        return self.stem(self.all_tokens, "all")

    @cached_property
    def all_tokens(self) -> DataFrame:
        return self.write_bucketed(evaluate.tokenised(evaluate.by_model(self.all_summaries)), "all_tokens")

    @cached_property
    def stem_dictionary(self) -> DataFrame:
        return self.write_dictionary(self.all_tokens, "all")

    def write_dictionary(self, tokens: DataFrame, name: str) -> DataFrame:
        return self.write(stems.stem_dictionary(stems.vocabulary(tokens)), f"stem_dictionary_{name}")

    def stem(self, tokens: DataFrame, name: str, hot_terms: int = weights.HOT_TERMS) -> DataFrame:
        """A bucketed table of tokens with stems in their place, by a dictionary that is written first."""
        known = self.stem_dictionary if name == "all" else self.write_dictionary(tokens, name)
        entries = self.write(stems.changes(known), f"stem_changes_{name}_{hot_terms}")
        least = weights.least_hot_df(entries, hot_terms)
        hot, rare = self.write(stems.hot_changes(entries, least), f"hot_stems_{name}_{hot_terms}"), None
        if least > 1:
            rare = self.write_bucketed(
                stems.rare_changes(tokens, entries, least, self.buckets), f"rare_stems_{name}_{hot_terms}")
        return self.write_bucketed(stems.stemmed(tokens, hot, rare), f"stemmed_tokens_{name}_{hot_terms}")

    @cached_property
    def ranged_words(self) -> DataFrame:
        return self.write(eda.with_range_number(eda.word_frequency(self.docs)), "ranged_words")

    @cached_property
    def known_ids(self) -> DataFrame:
        """The ids of the articles with a text, in their buckets: what a request is checked against."""
        return self.write_bucketed(self.raw.filter(F.col("text").isNotNull()).select("doc_id"), "known_ids")

    @cached_property
    def session_state(self) -> DataFrame:
        log = request_log.from_conversations(self.spark, self.input("conversations"))
        commands = self.write(assistant.parse_commands(log), "commands")
        resolved = assistant.resolve_documents(commands, self.known_ids, self.buckets)
        state = assistant.session_state(self.write(resolved, "resolved"))
        return self.write(state, "session_state")

    @cached_property
    def live(self) -> sessions.LiveAssistant:
        """The request log as it arrives: its first turns, then, after a stop, the rest."""
        log = request_log.from_conversations(self.spark, self.input("conversations"))
        live = sessions.LiveAssistant(self.spark, self.path("live"), self.raw, self.known_ids, self.buckets)
        early = F.coalesce(F.col("turn") < request_log.FIRST_TURNS, F.lit(False))
        for arrived in (early, ~early):
            log.where(arrived).write.mode("append").parquet(self.path("log_lines"))
            live.run(self.path("log_lines"))
        return live

    @cached_property
    def documents_in_use(self) -> DataFrame:
        used = assistant.documents_in_use(self.session_state, self.raw, self.buckets)
        return self.write_bucketed(used, "documents_in_use", "doc_key")


_OPEN: dict[tuple, Workspace] = {}


def workspace(spark: SparkSession, input_dir: str) -> Workspace:
    """The workspace of this application for ``input_dir``; queries share its stages while the input's files are the same."""
    files = [_files(spark, f"{input_dir.rstrip('/')}/{table}.parquet") for table in ("documents", "conversations")]
    key = (spark.sparkContext.applicationId, input_dir.rstrip("/"), *files)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, input_dir)
    return _OPEN[key]


def _files(spark: SparkSession, path: str) -> tuple[int, int]:
    """A hash of the names of the files and their bytes; without a schema to look for nothing is read."""
    try:
        table = spark.read.schema("x int").parquet(path)
    except AnalysisException:  # not every input has every table
        return 0, 0
    return hash(frozenset(table.inputFiles())), input_bytes(table)
