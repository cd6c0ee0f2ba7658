import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gistmill.functions.porter import stem
from gistmill.functions.sequences import lcs_length, ngrams
from gistmill.operators import evaluate


def table_lcs(a, b):
    line = [0] * (len(a) + 1)
    for w in b:
        new = [0]
        for j, v in enumerate(a):
            new.append(line[j] + 1 if v == w else max(line[j + 1], new[j]))
        line = new
    return line[-1]


words = st.lists(st.sampled_from("abcd"), max_size=9)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=20, max_size=40))
def test_lcs(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>")
    found = dict(df.select("i", lcs_length(F.col("a"), F.col("b"))).collect())
    assert found == {i: table_lcs(a, b) for i, (a, b) in enumerate(pairs)}


def test_lcs_of_repeated_words(spark):
    """One word many times on both sides costs the product of the lengths, not more."""
    df = spark.createDataFrame([(["a"] * 3000, ["a"] * 2990)], "a array<string>, b array<string>")
    start = time.monotonic()
    assert df.select(lcs_length(F.col("a"), F.col("b"))).first()[0] == 2990
    assert time.monotonic() - start < 60


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    grams = [tuple(r) for r in df.select(*[ngrams(F.col("t"), n) for n in (1, 2, 3)]).collect()]
    assert grams == [(["a", "b", "c"], ["a b", "b c"], ["a b c"]), (["a"], [], []), ([], [], [])]


@pytest.fixture
def long(spark):
    return spark.createDataFrame(
        [("test_1", "Lead-3", "Oil Price Rises, Oil Output Falls", "Oil is up. The price of oil rises!", 20,
          ["oil", "up", "tin"]),
         ("test_2", "Lead-3", None, "No headline here", 10, ["here"]),
         ("test_3", "Lead-3", "Gold", "", 10, ["gold"])],
        "doc_id string, model string, title string, summary string, n_words int, keywords array<string>",
    )


def test_recall_counts_repeats_once_each(long):
    tokens = evaluate.tokenised(long)
    grams = {(r["doc_id"], r["n"]): r["recall"] for r in evaluate.rouge_n(tokens).collect()}
    # oil twice, price and rises of six headline words; "oil rises" is no headline pair, "price rises" not adjacent
    assert grams[("test_1", 1)] == pytest.approx(4 / 6)
    assert grams[("test_1", 2)] == 0
    assert grams[("test_2", 1)] == grams[("test_2", 2)] == 0
    assert grams[("test_3", 1)] == grams[("test_3", 2)] == 0
    lcs = {r["doc_id"]: r["recall"] for r in evaluate.rouge_l(tokens).collect()}
    assert lcs == {"test_1": pytest.approx(3 / 6), "test_2": 0, "test_3": 0}


def test_coverage_and_compression(long):
    assert dict(evaluate.coverage(long).select("doc_id", "coverage").collect()) == {
        "test_1": pytest.approx(2 / 3), "test_2": 1.0, "test_3": 0.0
    }
    sizes = {r["doc_id"]: (r["words"], r["ratio"]) for r in evaluate.compression(long).collect()}
    assert sizes == {"test_1": (8, 0.4), "test_2": (3, 0.3), "test_3": (0, 0.0)}


def test_stemmed_tokens_match_more(long):
    tokens = evaluate.tokenised(long, stemmed=True)
    first = tokens.filter("doc_id = 'test_1'").first()
    assert first["reference"] == ["oil", "price", "rise", "oil", "output", "fall"]


@pytest.mark.parametrize("word, expected", [
    # examples of the published description
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("agreed", "agre"), ("feed", "feed"),
    ("plastered", "plaster"), ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"),
    ("sized", "size"), ("hopping", "hop"), ("falling", "fall"), ("hissing", "hiss"), ("filing", "file"), ("happy", "happi"),
    ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"), ("valenci", "valenc"),
    ("digitizer", "digit"), ("radicalli", "radic"), ("vietnamization", "vietnam"), ("feudalism", "feudal"),
    ("decisiveness", "decis"), ("formaliti", "formal"), ("sensibiliti", "sensibl"), ("triplicate", "triplic"),
    ("formalize", "formal"), ("electrical", "electr"), ("hopeful", "hope"), ("goodness", "good"), ("revival", "reviv"),
    ("allowance", "allow"), ("adjustable", "adjust"), ("replacement", "replac"), ("adoption", "adopt"),
    ("communism", "commun"), ("effective", "effect"), ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"),
    ("controll", "control"), ("roll", "roll"), ("generalizations", "gener"), ("oscillators", "oscil"),
    # amended rules and irregular forms
    ("enjoy", "enjoy"), ("dies", "die"), ("dying", "die"), ("skies", "sky"), ("proceed", "proceed"), ("by", "by"),
])
def test_stem(word, expected):
    assert stem(word) == expected
