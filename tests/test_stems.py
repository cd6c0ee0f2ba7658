"""Tokens stemmed by a dictionary: frequent words by broadcast, others through their documents."""

import random

import duckdb
import pytest

from gistmill.functions.porter import stem
from gistmill.operators import evaluate, stems, weights
from gistmill.plans import oracles
from gistmill.sources import write_bucketed

BUCKETS = 3
LETTERS = "aeiouybcdfglmnprstvz7"
ENDS = ["", "s", "es", "ies", "ied", "eed", "ed", "ing", "ational", "ationally", "izer", "alli", "ousness", "logi", "icate", "ement",
        "ion", "sses", "ly", "y", "ee", "lled", "ling", "ability", "fulness", "able", "e"]


def words(n, seed):
    rng = random.Random(seed)
    return sorted({"".join(rng.choices(LETTERS, k=rng.randrange(1, 8))) + rng.choice(ENDS) for _ in range(n)} | {"dying", "skies", "news"})


def rows(n=60):
    rng = random.Random(3)
    vocabulary = words(300, 1)
    made = []
    for d in range(n):
        text = ["falling" if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(0, 40))]
        made += [(f"test_{d}", m, rng.sample(text, len(text) // 3), text) for m in ("Lead-3", "TextRank")]
    return made + [("empty", "TextRank", [], []), ("long", "TextRank", ["dogs"], ["x" * 300_000 + "ings", "dogs", "dogs"])]


def expected(made):
    def stem_all(tokens):
        return [stem(t) if len(t) > 3 else t for t in tokens]

    return sorted((d, m, stem_all(r), stem_all(c)) for d, m, r, c in made)


@pytest.mark.parametrize("hot_terms", [weights.HOT_TERMS, 20, 0])
def test_every_token_gets_its_stem(spark, tmp_path, hot_terms):
    made = rows()
    df = spark.createDataFrame(made, "doc_id string, model string, reference array<string>, candidate array<string>")
    tokens = write_bucketed(df.repartition(BUCKETS, "doc_id"), f"{tmp_path}/tokens", f"stem_tokens_{hot_terms}", BUCKETS)
    entries = stems.changes(stems.stem_dictionary(stems.vocabulary(tokens))).cache()
    least = weights.least_hot_df(entries, hot_terms)
    hot = stems.hot_changes(entries, least)
    assert hot.count() <= hot_terms
    rare = stems.rare_changes(tokens, entries, least, BUCKETS) if least > 1 else None
    assert (rare is None) == (hot_terms == weights.HOT_TERMS)
    result = stems.stemmed(tokens, hot, rare)
    assert sorted((r.doc_id, r.model, r.reference, r.candidate) for r in result.collect()) == expected(made)


def test_empty_table(spark):
    tokens = spark.createDataFrame([], "doc_id string, model string, reference array<string>, candidate array<string>")
    entries = stems.changes(stems.stem_dictionary(stems.vocabulary(tokens)))
    assert stems.stemmed(tokens, stems.hot_changes(entries, 1)).collect() == []


def test_scoring_runs_without_python_and_tokens_stay_in_their_bucket(spark, ws):
    plan = evaluate.rouge_n(ws.stemmed_tokens)._jdf.queryExecution().toString()
    assert "Python" not in plan
    tokens = ws.all_tokens
    entries = stems.changes(ws.stem_dictionary)
    rare = ws.write_bucketed(stems.rare_changes(tokens, entries, 3, ws.buckets), "test_rare_stems")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = stems.stemmed(tokens, stems.hot_changes(entries, 3), rare)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_sql_of_the_published_steps_equals_the_function(ws):
    listed = words(6000, 7)
    sql = oracles._with("SELECT * FROM stems", "stems", **{
        **oracles.STEMMED, "plain": ([], f"SELECT {listed}::VARCHAR[] AS ref, []::VARCHAR[] AS cand")})
    found = dict(duckdb.sql(sql).fetchall())
    assert found == {w: stem(w) for w in listed if len(w) > 3}


def test_many_changed_words_of_a_document(spark):
    """More changed words than one map holds, in both rows of a document; no list of places is collected."""
    listed = [w for w in words(3000, 11) if len(w) > 3][:700]
    made = [("d", "a", listed[:9], listed), ("d", "b", [], listed[::-1] + listed[:3]), ("e", "a", ["cats"], [])]
    tokens = spark.createDataFrame(made, "doc_id string, model string, reference array<string>, candidate array<string>")
    entries = stems.changes(stems.stem_dictionary(stems.vocabulary(tokens))).cache()
    result = stems.stemmed(tokens, stems.hot_changes(entries, 1))
    assert sorted((r.doc_id, r.model, r.reference, r.candidate) for r in result.collect()) == expected(made)
    assert "collect_list" not in result._jdf.queryExecution().executedPlan().toString()
