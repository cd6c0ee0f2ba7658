"""Statistics by batches against those of the whole, stops between the steps of a version, and the exact AUC."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gistmill.operators import increments, learner, weights
from gistmill.sources.versions import VersionedTable, publish


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def rounded(idf):
    return rows(idf.select("term", "df", F.round("idf", 9)))


def test_three_increments_equal_the_whole(spark, ws, tmp_path):
    counts = increments.TermCounts(spark, str(tmp_path))
    assert counts.versions() == [] and counts.idf().collect() == [] and counts.docs() == 0
    batches = ws.batches(3)
    for i, batch in enumerate(batches):
        assert counts.add_documents(batch, f"b{i}")
    assert not counts.add_documents(batches[1], "b1")  # sent again
    assert counts.versions() == [1, 2, 3]
    assert rounded(counts.idf()) == rounded(weights.idf_table(ws.docs))
    two = batches[0].unionByName(batches[1])
    assert rounded(counts.idf(2)) == rounded(weights.idf_table(two))  # an old version is still there

    counts.compact_terms()
    assert len({p for p, _, _ in counts.manifest()}) == 1 and counts.docs() == ws.docs.count()
    assert rounded(counts.idf()) == rounded(weights.idf_table(ws.docs))
    assert not counts.add_documents(batches[2], "b2")  # compaction forgets no batch


def test_a_stop_before_a_version_is_named_leaves_the_last_one(spark, ws, tmp_path, monkeypatch):
    counts = increments.TermCounts(spark, str(tmp_path))
    first, second, _ = ws.batches(3)
    counts.add_documents(first, "first")
    before = rounded(counts.idf())

    def stopped(self, entries):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_name", stopped)
        for step in (lambda: counts.add_documents(second, "second"), counts.compact_terms):
            with pytest.raises(KeyboardInterrupt):
                step()
    again = increments.TermCounts(spark, str(tmp_path))
    assert again.versions() == [1] and rounded(again.idf()) == before
    assert again.add_documents(second, "second")
    assert rounded(again.idf()) == rounded(weights.idf_table(first.unionByName(second)))


def test_a_published_folder_is_not_replaced(spark, tmp_path):
    target = f"{tmp_path}/table/part"
    assert publish(spark.range(3), target) and not publish(spark.range(9), target)
    assert spark.read.parquet(target).count() == 3
    assert [f.name for f in (tmp_path / "table").iterdir()] == ["part"]


def test_merged_sketches(spark, ws, tmp_path):
    sketches = increments.GroupSketches(spark, str(tmp_path))
    for i, batch in enumerate(ws.batches(4)):
        sketches.add_documents(batch, str(i))
    parts = sketches.read()
    sketches.compact_groups()
    assert sketches.read().count() == ws.docs.select("category").distinct().count() < parts.count()
    for table in (parts, sketches.read()):
        whole = increments.merged(table).select("n_docs", increments.distinct_words().alias("words"),
                                                increments.length_quantile(0.5).alias("median")).first()
        exact = ws.docs.select(F.explode("tokens").alias("w")).distinct().count()
        assert whole.n_docs == ws.docs.count() and abs(whole.words / exact - 1) < 4 * increments.DISTINCT_ERROR
        lengths = sorted(r.n_words for r in ws.docs.select("n_words").collect())
        share = sum(n <= whole.median for n in lengths) / len(lengths)
        assert abs(share - 0.5) < increments.RANK_ERROR + 1 / len(lengths)
        for r in increments.with_rank_errors(increments.merged(table, "category"), ws.docs).collect():
            assert max(r.error_25, r.error_50, r.error_75) <= increments.RANK_ERROR


def test_sketches_of_odd_groups(spark):
    docs = spark.createDataFrame([(None, ["a", "b"], 2), (None, ["a"], 1), ("x", [], 0), ("y", None, None)],
                                 "category string, tokens array<string>, n_words int")
    got = increments.group_sketches(docs, "category").select("category", "n_docs", increments.distinct_words().alias("w"))
    assert rows(got) == rows(spark.createDataFrame([(None, 2, 2), ("x", 1, 0), ("y", 1, 0)], "c string, n long, w long"))


SQL = """SELECT count(*), count(*) FILTER (label > 0), (sum(r) FILTER (label > 0) - p * (p + 1) / 2) / p / (count(*) - p) FROM (
    SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS r FROM t),
    (SELECT count(*) AS p FROM t WHERE label > 0) GROUP BY p"""


@pytest.mark.parametrize("partitions", [1, 7, None])
def test_auc_equals_rank_sums(spark, tmp_path, partitions):
    rng = random.Random(2)
    data = [(float(rng.random() < 0.3), rng.choice([rng.random(), 0.5, round(rng.random(), 1)])) for _ in range(4000)]
    spark.createDataFrame(data, "label double, p double").repartition(5).write.parquet(f"{tmp_path}/t")
    learner.by_score(spark.read.parquet(f"{tmp_path}/t"), partitions=partitions).write.parquet(f"{tmp_path}/by")
    got = learner.exact_auc(spark.read.parquet(f"{tmp_path}/by")).first()
    want = duckdb.sql(SQL.replace(" t", f" '{tmp_path}/t/*.parquet'")).fetchall()[0]
    assert tuple(got)[:2] == want[:2] and abs(got.auc - want[2]) < 1e-9


def test_auc_of_written_predictions(ws):
    learned = learner.exact_auc(ws.scored(ws.predictions, "auc_test")).first()
    want = duckdb.sql(SQL.replace(" t", f" '{ws.path('predictions')}/*.parquet'")).fetchall()[0]
    assert tuple(learned)[:2] == want[:2] and abs(learned.auc - want[2]) < 1e-9


def test_auc_without_both_kinds(spark, tmp_path):
    for i, data in enumerate(([], [(1.0, 0.3)], [(0.0, 0.3), (0.0, 0.1)])):
        scores = learner.by_score(spark.createDataFrame(data, "label double, p double"))
        scores.write.parquet(f"{tmp_path}/{i}")
        assert learner.exact_auc(spark.read.schema(scores.schema).parquet(f"{tmp_path}/{i}")).first().auc is None
