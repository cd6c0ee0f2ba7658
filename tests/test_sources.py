from pyspark.sql import functions as F

from gistmill import sources
from gistmill.operators import clean
from gistmill.streaming import redaction, sanitised_stream, write_audit_stream, write_stream


def test_article_files(spark, tmp_path):
    for name, text in {"test/1": "OIL &lt;UP&gt;\nLine  one\nline two", "training/22": "NO BODY"}.items():
        path = tmp_path / "corpus" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    labels = spark.createDataFrame([("test/1", ["crude", "gas"])], "raw_id string, labels array<string>")
    articles = sources.read_article_files(spark, str(tmp_path / "corpus"), str(tmp_path / "corpus"), labels)
    rows = {r["doc_id"]: tuple(r)[1:] for r in sources.ingest(articles).collect()}
    assert rows == {
        "test_1": ("test", "crude", "Oil <Up>", "Line one line two"),
        "training_22": ("training", "none", "No Body", None),
    }


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    rows = [("a", "test", "c", 'He said "no", twice', "one\ntwo,three"), ("b", "test", "c", None, " kept "),
            ("d", "training", "c", "back\\slash", '"')]
    raw = spark.createDataFrame(rows, sources.corpus.RAW)
    sources.write_raw_csv(raw, f"{tmp_path}/csv")
    assert sorted(map(tuple, sources.read_raw_csv(spark, f"{tmp_path}/csv").collect())) == sorted(rows)


def test_clean_table_round_trip(spark, tmp_path, ws):
    sources.write_clean(ws.docs, f"{tmp_path}/clean", partitions=3)
    back = sources.read_clean(spark, f"{tmp_path}/clean")
    assert back.count() == ws.docs.count()
    assert back.columns == sources.sinks.CLEAN_COLUMNS


def test_small_tables_are_one_file(spark, tmp_path):
    sources.write_small_csv(spark.range(5).repartition(3), f"{tmp_path}/small")
    assert len(list((tmp_path / "small").glob("part-*"))) == 1


def test_length_gate(spark):
    sentence = "The quick brown fox jumped over the lazy dog near sixteen calm silent rivers running east today. "
    raw = spark.createDataFrame(
        [("long", "test", "c", "t", sentence * 5), ("short", "test", "c", "t", sentence * 4),
         ("null", "test", "c", "t", None), ("blank", "test", "c", "t", " \n ")],
        sources.corpus.RAW,
    )
    kept = clean.prepare(raw).collect()
    assert [(r["doc_id"], r["n_sentences"], r["n_words"]) for r in kept] == [("long", 5, 85)]


def test_streams_append_once(spark, tmp_path):
    schema = "doc_id long, text string"
    source, sink, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        write_stream(sanitised_stream(stream), sink, checkpoint).awaitTermination()
        write_audit_stream(stream, sink + "_audit", checkpoint + "_audit").awaitTermination()

    spark.createDataFrame([(1, "mail a@b.org"), (2, "")], schema).write.mode("append").parquet(source)
    run()
    run()
    spark.createDataFrame([(3, "abc")], schema).write.mode("append").parquet(source)
    run()
    assert sorted(map(tuple, spark.read.parquet(sink).collect())) == [(1, "mail [EMAIL]"), (2, ""), (3, "abc")]
    audit = spark.read.parquet(sink + "_audit")
    assert audit.count() == 3 and set(audit.columns) == {"ts", "event", "doc_sha256"}
    assert {r["doc_sha256"] for r in audit.collect()} >= {"-", "ba7816bf8f01"}


def test_stream_equals_batch(spark, ws):
    batch = redaction.sanitised_stream(ws.documents())
    assert batch.select(F.max(F.length("safe_text"))).first()[0] > 12_000  # whole texts


def test_audit_lines(spark, tmp_path):
    rows = spark.sql("SELECT timestamp '2026-01-02 03:04:05' AS ts, 'ask' AS event, 'ba7816bf8f01' AS doc_sha256")
    for _ in range(2):
        sources.append_audit_lines(rows, f"{tmp_path}/audit")
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/audit").collect()]
    assert lines == ["2026-01-02T03:04:05+00:00 | ask | doc_sha256=ba7816bf8f01"] * 2


def test_stream_reads_a_folder_of_document_files(spark, tmp_path):
    from gistmill.plans.queries import QUERIES

    rows = [(i, f"mail a{i}@b.org now") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(99, "other")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet.old")
    found = QUERIES["sanitise_stream"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [(i, "mail [EMAIL] now") for i in range(6)]
