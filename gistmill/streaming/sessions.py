"""The assistant on a live log: two streams, each of which can be stopped and continued.

The first splits arriving lines and resolves the documents they ask for.  The
second keeps the state of every session (``transformWithStateInPandas``), and
writes each batch's rows in force, prompts and audit rows.  Tables have one folder
per batch, published by one rename, so a batch that is run again after a stop
changes nothing; on an object store without an atomic rename a reader may see a
batch in parts.  Sessions come in order of turn from batch to batch; inside a batch
rows are sorted.  A session is one key, so a batch's rows of it are held in one
task: bound the batch by the source's limits if single sessions are large.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import text as tx
from ..operators import assistant
from ..sources import versions

# the processor goes to the workers whole: executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LINES = "session long, turn long, line string"
RESOLVED = "session long, turn long, command string, argument string, doc_ref string"
FIELDS = "style string, length string, language string, doc_ref string, pasted string"
IN_FORCE = f"session long, turn long, command string, argument string, set_ref string, {FIELDS}"
TABLES = {
    "resolved": RESOLVED,
    "state": f"{IN_FORCE}, status string",
    "documents": "doc_key string, doc_ref string, title string, text string",
    "prompts": "session long, turn long, command string, messages array<struct<role: string, content: string>>",
    "audit": "session long, turn long, event string, doc_sha256 string",
}


class Sessions(StatefulProcessor):
    """Carries the settings and the current document of a session from row to row and from batch to batch.

    ``pasted`` is the text of the current document if it was pasted.  Rows after
    a /quit are dropped; a closed session is remembered for ``retention_ms``, by
    a timer, or for good without it.
    """

    def __init__(self, defaults: tuple[str, str, str], retention_ms: int | None = None):
        self.defaults, self.retention_ms = defaults, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", f"{FIELDS}, closed boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        style, length, language, doc_ref, pasted, closed = (
            self.state.get() if self.state.exists() else (*self.defaults, None, None, False))
        if closed:
            return
        out = []
        arrived = pd.concat(list(rows)).sort_values("turn", kind="stable")
        for turn, command, argument, spoken, set_ref in zip(
                *(arrived[c].tolist() for c in ("turn", "command", "argument", "spoken", "doc_ref")), strict=True):
            if command == "style":
                style = argument
            elif command == "length":
                length = argument
            elif command == "lang":
                language = spoken
            if set_ref is not None:
                doc_ref, pasted = set_ref, argument if command == "paste" else None
            out.append((key[0], turn, command, argument, set_ref, style, length, language, doc_ref, pasted))
            if command == "quit":
                closed = True
                break
        self.state.update((style, length, language, doc_ref, pasted, closed))
        if closed and self.retention_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retention_ms)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in IN_FORCE.split(", ")], dtype=object).astype({"session": "int64", "turn": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def session_states(resolved: DataFrame, retention_ms: int | None = None) -> DataFrame:
    """State in force at each row of a stream of resolved commands, as ``assistant.session_state`` gives it for a table.

    With ``retention_ms`` the timers run on processing time, for a stream that
    runs on; a stream that stops when nothing is left must do without.
    """
    spoken = F.when(F.col("command") == "lang", tx.title_case(F.col("argument")))
    defaults = tuple(assistant.DEFAULTS[c] for c in ("style", "length", "language"))
    mode = "None" if retention_ms is None else "ProcessingTime"
    rows = resolved.withColumn("spoken", spoken).groupBy("session").transformWithStateInPandas(
        Sessions(defaults, retention_ms), IN_FORCE, "append", mode)
    return rows.withColumn("status", assistant.status())


@contextmanager
def rocksdb(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """For the streams started inside: the state store that arbitrary state needs, in ``partitions``.

    A checkpoint keeps the number it was begun with.  Each partition takes about 4 MB
    of disk on its executor and a task a batch, however little state it has.
    """
    wanted = {PROVIDER: ROCKS} | ({PARTITIONS: str(partitions)} if partitions else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def publish(rows: DataFrame, table: str, batch_id: int) -> None:
    """Make the batch's folder of ``table``, unless an earlier run of the batch made it.

    The batch is computed in any case, as its state has to be.
    """
    versions.publish(rows, f"{table}/batch-{batch_id:09d}")


@dataclass
class LiveAssistant:
    """Tables and checkpoints of a live log below ``folder``.

    ``raw`` (doc_id, title, text) and ``known_ids`` (doc_id) are bucketed by
    doc_id into ``buckets``; both are looked up in their buckets.  State is kept
    in ``partitions``, by default one for each core there is when the log begins.
    """

    spark: SparkSession
    folder: str
    raw: DataFrame
    known_ids: DataFrame
    buckets: int
    texts: assistant.PromptTexts = field(default_factory=assistant.PromptTexts)
    partitions: int | None = None

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def table(self, name: str) -> DataFrame:
        """Everything published so far."""
        return self.spark.read.schema(TABLES[name]).option("recursiveFileLookup", True).parquet(self.path(name))

    def _published(self, name: str, batch_id: int) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path(name)}/batch-{batch_id:09d}")

    def _make_folders(self) -> None:
        for name in TABLES:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(path)

    def resolve(self, lines: str) -> StreamingQuery:
        """Resolve the lines that have arrived below ``lines`` as Parquet files (session, turn, line)."""
        self._make_folders()
        log = self.spark.readStream.schema(LINES).parquet(lines)

        def batch(commands: DataFrame, batch_id: int) -> None:
            publish(assistant.resolve_documents(commands, self.known_ids, self.buckets), self.path("resolved"), batch_id)

        return self._started(assistant.parse_commands(log, self.texts), batch, "resolve")

    def answer(self) -> StreamingQuery:
        """Carry the sessions on over what is resolved, and write state, prompts and audit rows."""
        self._make_folders()
        resolved = self.spark.readStream.schema(RESOLVED).option("recursiveFileLookup", True).parquet(self.path("resolved"))

        def batch(in_force: DataFrame, batch_id: int) -> None:
            publish(in_force, self.path("state"), batch_id)  # computed once; the rest reads what is written
            state = self._published("state", batch_id)
            used = state.filter(F.col("pasted").isNotNull()).select("doc_ref", F.col("pasted").alias("text"))
            articles = assistant.articles_in_use(state, self.raw, self.buckets)
            publish(assistant.with_pasted(articles, used.dropDuplicates(["doc_ref"])), self.path("documents"), batch_id)
            documents = self._published("documents", batch_id)  # the corpus is searched once a batch
            publish(assistant.prompt_messages(state, documents, self.texts), self.path("prompts"), batch_id)
            publish(assistant.audit_rows(state, documents), self.path("audit"), batch_id)

        with rocksdb(self.spark, self.partitions or self.spark.sparkContext.defaultParallelism):
            return self._started(session_states(resolved), batch, "answer")

    def _started(self, rows: DataFrame, batch, name: str) -> StreamingQuery:
        return (
            rows.writeStream.foreachBatch(batch).option("checkpointLocation", self.path(f"checkpoint_{name}"))
            .trigger(availableNow=True).start()
        )

    def run(self, lines: str) -> None:
        """Both streams over what has arrived, then stop; the next run continues."""
        for stream in (lambda: self.resolve(lines), self.answer):
            stream().awaitTermination()
