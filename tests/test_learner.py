import pytest
from pyspark.sql import functions as F

from gistmill.functions import fixed_values as fv
from gistmill.operators import learner


def test_labels_follow_the_headline(ws):
    per_doc = ws.features.groupBy("doc_id").agg(
        F.sum("label").alias("labels"), F.count_if(F.col("overlap") > 0).alias("hits")
    )
    assert per_doc.filter(F.col("labels") != F.least(F.col("hits"), F.lit(2))).count() == 0


def test_percent_rank_with_ties(spark):
    rows = spark.createDataFrame(
        [("d", i, 4, v) for i, v in enumerate([1.0, 1.0 + 1e-12, 2.0, 3.0])],
        "doc_id string, sent_idx int, n_sentences int, tfidf_norm double",
    )
    ranked = learner._with_positions(rows).orderBy("sent_idx").collect()
    assert [r["tfidf_pct"] for r in ranked] == pytest.approx([0, 0, 2 / 3, 1])
    assert [r["rel_pos"] for r in ranked] == pytest.approx([0, 1 / 3, 2 / 3, 1])


def test_auc_agrees_with_the_rank_sum(spark, ws):
    ws.predictions.createOrReplaceTempView("predictions_for_auc")
    ranked = spark.sql("""
        SELECT avg(CASE WHEN label = 1 THEN mid END) AS mean_rank, sum(label) AS pos, sum(1 - label) AS neg
        FROM (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS mid
              FROM predictions_for_auc)""").first()
    by_rank = (ranked["mean_rank"] - (ranked["pos"] + 1) / 2) / ranked["neg"]
    assert learner.area_under_roc(ws.predictions) == pytest.approx(by_rank, abs=5e-3)


def test_importances(spark, ws):
    values = learner.importances(spark, ws.gbt).collect()
    assert {r["feature"] for r in values} == set(fv.FEATURES)
    assert sum(r["importance"] for r in values) == pytest.approx(1)
    assert [r["importance"] for r in values] == sorted((r["importance"] for r in values), reverse=True)


def test_only_test_documents_are_predicted(ws):
    assert ws.predictions.filter(F.col("doc_id").startswith("training")).count() == 0
    summaries = ws.all_summaries.withColumn("has", F.col("gbt_summary").isNotNull())
    assert summaries.filter(F.col("has") == F.col("doc_id").startswith("training")).count() == 0


def test_trees_are_grown_on_every_sentence(spark):
    """More training sentences than the 2,000,000 that were once the most, in more parts than cores."""
    n = 2_100_000
    rows = spark.range(0, n, 1, 40).select(
        F.concat(F.lit("training_"), (F.col("id") / 30).cast("long")).alias("doc_id"), (F.col("id") % 30).cast("int").alias("sent_idx"),
        (F.col("id") % 30 < 2).cast("double").alias("label"), *[(F.col("id") % 7).cast("double").alias(c) for c in fv.FEATURES if c != "sent_idx"])
    held_out = spark.range(100).select(
        F.lit("test_1").alias("doc_id"), F.col("id").cast("int").alias("sent_idx"), F.lit(1.0).alias("label"),
        *[F.lit(1.0).alias(c) for c in fv.FEATURES if c != "sent_idx"])
    model = learner.fit_gbt(rows.unionByName(held_out), maxIter=1, maxDepth=1)
    assert model.trees[0]._java_obj.rootNode().impurityStats().rawCount() == n
