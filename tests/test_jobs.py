import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from gistmill import jobs, sources
from gistmill.operators import learner, sentences
from gistmill.plans.workspace import workspace


def test_the_whole_flow(spark, ws, tmp_path):
    out = f"{tmp_path}/out"
    sources.read_documents(spark, f"{SMALL}/documents.parquet").write.parquet(f"{tmp_path}/articles")
    jobs.load(spark, f"{tmp_path}/articles", out)
    jobs.clean_corpus(spark, out)
    jobs.explore(spark, out)
    stages = jobs.summarise(spark, out)
    # what the job runs is what the plan tests look at
    for df in (sentences.pick_top(stages.scores, "tfidf_score"), sentences.pick_top(stages.predictions, "p"),
               learner.sentence_features(stages.docs, stages.scores)):
        assert "Exchange hash" not in df._jdf.queryExecution().executedPlan().toString()

    summaries = spark.read.parquet(f"{out}/summaries")
    same = summaries.join(ws.summaries.alias("w"), "doc_id").filter(
        (summaries["tfidf_summary"] == F.col("w.tfidf_summary"))
        & (summaries["textrank_summary"] == F.col("w.textrank_summary"))
    )
    assert same.count() == summaries.count() == ws.docs.count()
    results = spark.read.csv(f"{out}/model_results", header=True, inferSchema=True).collect()
    assert {r["Model"] for r in results} == {"Lead-3", "Spark TF-IDF", "Spark ML GBT", "TextRank"}
    assert {r["split"] for r in results} == {"test"}
    stats = dict(spark.read.csv(f"{out}/eda_stats", header=True, inferSchema=True).collect())
    assert stats["docs_raw"] == 200 and stats["docs_kept"] == summaries.count()
    auc = spark.read.csv(f"{out}/gbt_auc", header=True, inferSchema=True).first()["auc"]
    assert 0.5 < auc <= 1
    tables = list(stages.tables)
    stages.forget()
    assert tables and not any(spark.catalog.tableExists(t) for t in tables)


def test_repeated_short_documents_are_refused(spark, tmp_path):
    row = ("test/1", ["s"], "Title\nToo short to be kept.")
    spark.createDataFrame([row, row], "raw_id string, labels array<string>, article string") \
        .write.parquet(f"{tmp_path}/articles")
    with pytest.raises(ValueError, match="unique"):
        jobs.load(spark, f"{tmp_path}/articles", f"{tmp_path}/out")


def test_stages_follow_the_input(spark, tmp_path):
    def write(word):
        docs = [(1, f"{word}\nSome text.", "en", "s", 1)]
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
            .write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        return workspace(spark, str(tmp_path))

    first = write("One")
    assert workspace(spark, str(tmp_path)) is first
    assert first.raw.first()["title"] == "One"
    assert write("Two").raw.first()["title"] == "Two"
