"""The assistant on a live log: sessions over several batches, batches run again, closed sessions forgotten."""

import os
import random
import time

import pytest

from gistmill.operators import assistant
from gistmill.sources import write_bucketed
from gistmill.streaming import sessions

BUCKETS = 3
ARTICLES = [(f"test_{i}", f"Title {i}", " ".join(f"The market rose {i * k} points in early trading." for k in range(1, 6)) if i % 4 else None)
            for i in range(12)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    df = spark.createDataFrame(ARTICLES, "doc_id string, title string, text string")
    return write_bucketed(df.repartition(BUCKETS, "doc_id"), str(tmp_path_factory.mktemp("raw")) + "/raw", "live_raw", BUCKETS)


def log_lines():
    rng = random.Random(4)
    lines = ["/doc test_{}", "/doc nowhere", "/paste Some text {}. More of it here.", "/paste", "/style tldr", "/style bullets", "/style no",
             "/length long", "/lang french", "/lang english", "/summarize", "/summarize", "/ask why {}?", "/prompt", "hello", "", "/help"]
    log = [(s, t, rng.choice(lines).format(rng.randrange(14))) for s in range(40) for t in range(rng.randrange(1, 25))]
    return log + [(s, 30, "/quit") for s in range(0, 40, 5)] + [(s, t, "/summarize") for s in range(0, 40, 5) for t in (31, 60)]


def arrive(spark, log, path):
    spark.createDataFrame(log, sessions.LINES).repartition(2).write.mode("append").parquet(path)


def expected(spark, log, raw):
    state = assistant.session_state(assistant.resolve_documents(
        assistant.parse_commands(spark.createDataFrame(log, sessions.LINES)), raw)).cache()
    documents = assistant.documents_in_use(state, raw)
    return {"state": rows(state), "prompts": rows(assistant.prompt_messages(state, documents)),
            "audit": rows(assistant.audit_rows(state, documents))}


def tables(live):
    return {"state": rows(live.table("state").drop("pasted").select(
        "session", "turn", "command", "argument", "set_ref", "style", "length", "language", "doc_ref", "status")),
        "prompts": rows(live.table("prompts")), "audit": rows(live.table("audit"))}


def test_batches_continue_sessions_and_can_be_run_again(spark, raw, tmp_path):
    log = log_lines()
    known = raw.where("text IS NOT NULL").select("doc_id")
    live = sessions.LiveAssistant(spark, f"{tmp_path}/live", raw, known, BUCKETS)
    lines = f"{tmp_path}/lines"
    # the first batch is not in order; documents, pastes and closings of one batch are in force in the next
    for low, high in ((0, 8), (8, 31), (31, 99)):
        part = [r for r in log if low <= r[1] < high]
        random.Random(low).shuffle(part)
        arrive(spark, part, lines)
        live.run(lines)
    want = expected(spark, log, raw)
    assert tables(live) == want
    assert any("paste:" in str(r) for r in want["prompts"] + want["state"])

    # stopped after the tables were written, before the batch was noted as done: both run their last batch again
    folders = {name: sorted(os.listdir(live.path(name))) for name in sessions.TABLES}
    for name in ("resolve", "answer"):
        commits = f"{live.path(f'checkpoint_{name}')}/commits"
        last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
        os.remove(f"{commits}/{last}")
        os.remove(f"{commits}/.{last}.crc")
    live.run(lines)
    assert {name: sorted(os.listdir(live.path(name))) for name in sessions.TABLES} == folders
    assert tables(live) == want

    # and the stream goes on from there
    more = [(1, 200, "/style eli5"), (1, 201, "/prompt"), (99, 1, "/paste new text"), (99, 2, "/ask")]
    arrive(spark, more, lines)
    live.run(lines)
    assert tables(live) == expected(spark, log + more, raw)


def test_publish_keeps_the_first(spark, tmp_path):
    table = str(tmp_path)
    sessions.publish(spark.range(3), table, 5)
    sessions.publish(spark.range(9), table, 5)
    sessions.publish(spark.range(10, 11), table, 6)
    assert sorted(os.listdir(table)) == ["batch-000000005", "batch-000000006"]
    assert rows(spark.read.option("recursiveFileLookup", True).parquet(table)) == [(0,), (1,), (10,), (2,)]


def test_closed_sessions_are_forgotten_by_a_timer(spark, tmp_path):
    resolved = [(1, 1, "style", "tldr", None), (1, 2, "quit", "", None), (2, 1, "style", "bullets", None)]
    spark.createDataFrame(resolved, sessions.RESOLVED).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(sessions.RESOLVED).parquet(f"{tmp_path}/in")
    with sessions.rocksdb(spark):
        query = sessions.session_states(stream, retention_ms=1).writeStream.format("parquet").option(
            "path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").start()
    try:
        deadline, kept = time.time() + 60, None
        while time.time() < deadline and kept != 1:
            time.sleep(1)
            if query.lastProgress:
                kept = _states(spark, tmp_path)
    finally:
        query.stop()
    assert kept == 1  # session 2 is still open
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def _states(spark, tmp_path):
    reader = spark.read.format("statestore").option("path", f"{tmp_path}/checkpoint").option("stateVarName", "state")
    return reader.load().count()
