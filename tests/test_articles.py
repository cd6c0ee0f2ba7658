"""Articles and labels arriving as files, in any order, over several runs."""

import datetime as dt
import os

from gistmill import sources
from gistmill.streaming import articles

TEXTS = {f"{'test' if i % 3 else 'training'}/{i}": f"HEADLINE {i} &lt;UP&gt;\nBody  {i}\nline two" for i in range(12)}
TEXTS |= {"test/empty": "", "test/bare": "ONLY A TITLE", "training/long": "LONG\n" + "word " * 200_000}
LABELS = {raw_id: [f"topic{i % 4}", "other"] for i, raw_id in enumerate(TEXTS)} | {"test/bare": [], "nowhere/1": ["lost"]}


def put(tmp_path, raw_ids):
    for raw_id in raw_ids:
        path = tmp_path / "corpus" / raw_id
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(TEXTS[raw_id])


def label(spark, tmp_path, raw_ids, at=None):
    rows = [(r, LABELS[r], at or dt.datetime.now()) for r in raw_ids]
    spark.createDataFrame(rows, articles.LABELS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/labels")


def run(spark, tmp_path, corpus):
    root = f"{tmp_path}/corpus"
    corpus.run(articles.article_files(spark, root, root, files_per_batch=5),
               articles.arriving(spark, f"{tmp_path}/labels", articles.LABELS))


def expected(spark, tmp_path):
    labels = spark.createDataFrame(list(LABELS.items()), "raw_id string, labels array<string>")
    root = f"{tmp_path}/corpus"
    return sorted(map(tuple, sources.ingest(sources.read_article_files(spark, root, root, labels)).collect()))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_two_batches_give_the_whole(spark, tmp_path):
    corpus = articles.ArrivingCorpus(spark, f"{tmp_path}/arriving")
    ids = list(TEXTS)
    put(tmp_path, ids[:8])
    label(spark, tmp_path, [*ids[:3], ids[13], "nowhere/1"])  # some early, some too late for this run
    run(spark, tmp_path, corpus)
    assert corpus.labelled().count() == 3 and corpus.waiting().count() == 5
    put(tmp_path, ids[8:])
    label(spark, tmp_path, [i for i in ids[3:] if i != ids[13]])
    run(spark, tmp_path, corpus)
    want = expected(spark, tmp_path)
    assert len(want) == len(TEXTS) - 1 and corpus.waiting().count() == 0  # an empty file has no row
    assert rows(corpus.labelled()) == rows(corpus.labelled(partitions=3)) == want
    # nothing new, and the last batch of either stream run again: nothing is written twice
    run(spark, tmp_path, corpus)
    for name in ("articles", "categories"):
        commits = corpus.path(f"checkpoint_{name}") + "/commits"
        last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
        os.remove(f"{commits}/{last}")
        os.remove(f"{commits}/.{last}.crc")
    run(spark, tmp_path, corpus)
    assert rows(corpus.labelled()) == want


def test_labels_that_are_overdue(spark, tmp_path):
    corpus = articles.ArrivingCorpus(spark, f"{tmp_path}/arriving", delay="1 hour")
    start = dt.datetime(2026, 1, 1)

    def arrive(raw_id, hours):
        at = start + dt.timedelta(hours=hours)
        spark.createDataFrame([(raw_id, "TITLE\nText.", at)], articles.ARTICLES).write.mode("append").parquet(f"{tmp_path}/in")

    def labelled(raw_id, hours):
        at = start + dt.timedelta(hours=hours)
        spark.createDataFrame([(raw_id, ["topic"], at)], articles.LABELS).write.mode("append").parquet(f"{tmp_path}/labels")

    def go():
        corpus.run(*(articles.arriving(spark, f"{tmp_path}/{name}", schema)
                     for name, schema in (("in", articles.ARTICLES), ("labels", articles.LABELS))))
        return {r.doc_id: r.category for r in corpus.labelled().collect()}

    arrive("test/never", 0)
    arrive("test/late", 0)
    labelled("test/other", 0)
    assert go() == {} and corpus.waiting().count() == 2
    arrive("test/on_time", 9)
    labelled("test/late", 9)
    labelled("test/on_time", 9.5)
    found = go()
    assert found == {"test_never": "none", "test_late": "none", "test_on_time": "topic"}
    assert corpus.waiting().count() == 0
