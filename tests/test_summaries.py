import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gistmill.functions import fixed_values as fv
from gistmill.operators import local_summary, sentences, textrank

STOP = set(fv.ENGLISH_STOP_WORDS)


def dense_ranks(texts, damping=0.85, rounds=50):
    """The textbook form: the full similarity matrix of one document."""
    words = [[w for w in re.findall(r"\w\w+", t.lower()) if w not in STOP] for t in texts]
    vocabulary = sorted({w for ws in words for w in ws})
    n = len(texts)
    if not vocabulary:
        return np.full(n, (1 - damping) / n)
    x = np.array([[ws.count(v) for v in vocabulary] for ws in words], float)
    x = x * (np.log((1 + n) / (1 + (x > 0).sum(0))) + 1)
    lengths = np.linalg.norm(x, axis=1, keepdims=True)
    x = x / np.where(lengths == 0, 1, lengths)
    s = x @ x.T
    np.fill_diagonal(s, 0)
    total = s.sum(1, keepdims=True)
    p = s / np.where(total == 0, 1, total)
    r = np.full(n, 1 / n)
    for _ in range(rounds):
        r = (1 - damping) / n + damping * p.T @ r
    return r


def documents(spark, texts):
    return spark.createDataFrame(
        [(f"d{i}", t, len(t)) for i, t in enumerate(texts)], "doc_id string, sentences array<string>, n_sentences int"
    )


TEXTS = [
    ["Oil prices rose.", "Oil output fell as prices rose.", "Gold fell.", "Nothing else moved.", "Gold and oil rose."],
    ["The and of.", "Is it?", "Over and over.", "Because."],
    ["Alpha beta.", "Gamma delta.", "Epsilon zeta."],
    ["Same words here.", "Same words here.", "Same words here.", "Same words here."],
]


def test_ranks_equal_the_dense_matrix(spark):
    ranked = textrank.sentence_ranks(textrank.textrank(documents(spark, TEXTS)))
    for i, texts in enumerate(TEXTS):
        mine = [r["rank"] for r in ranked.filter(F.col("doc_id") == f"d{i}").orderBy("sent_idx").collect()]
        assert mine == pytest.approx(list(dense_ranks(texts)), abs=1e-12)


def test_ranks_on_real_documents(ws):
    some = ws.docs.orderBy("doc_id").limit(15)
    for row in textrank.textrank(some).join(some, "doc_id").collect():
        assert row["ranks"] == pytest.approx(list(dense_ranks(row["sentences"])), abs=1e-10)
        assert sum(row["ranks"]) <= 1 + 1e-9


def test_textrank_without_links_takes_the_first_sentences(spark):
    docs = documents(spark, TEXTS)
    found = dict(textrank.textrank_summary(textrank.textrank(docs), docs).collect())
    assert found["d1"] == " ".join(TEXTS[1][:3])
    assert found["d2"] == " ".join(TEXTS[2])
    assert found["d3"] == " ".join(TEXTS[3][:3])


def plain_local(text, k=3):
    parts = re.split(r'(?<=[a-z0-9")][.!?])\s+(?=[A-Z"(])', " ".join(text.split()))
    parts = [p for p in parts if len(p.split()) >= 4]
    words = [[w for w in re.findall("[a-z]{2,}", p.lower()) if w not in STOP] for p in parts]
    tf, df = Counter(w for ws in words for w in ws), Counter(w for ws in words for w in set(ws))

    def score(i):
        total = sum(tf[w] * (math.log((len(parts) + 1) / (df[w] + 1)) + 1) for w in words[i])
        return round(total / math.sqrt(max(len(words[i]), 1)) * (1 + 1 / (1 + i)), 9)

    best = sorted(range(len(parts)), key=lambda i: (-score(i), i))[:k]
    return [parts[i] for i in sorted(best)]


@pytest.mark.parametrize("k", [1, 3])
def test_local_summary_equals_plain_python(spark, ws, k):
    texts = ws.raw.dropna(subset=["text"]).select("doc_id", "text").limit(25).collect()
    texts = [tuple(t) for t in texts] + [("short", "One two three four."), ("none", "Hm."), ("empty", "")]
    df = spark.createDataFrame(texts, "doc_id string, text string")
    best = local_summary.local_summary(df, 3)
    found = dict(best.select("doc_id", local_summary.best_sentences("best", k)).collect())
    assert found == {doc_id: plain_local(text, k) for doc_id, text in texts}


def test_summaries_are_ordered_parts_of_the_document(ws):
    table = ws.summaries.join(ws.docs.select("doc_id", "sentences"), "doc_id").collect()
    assert table
    for row in table:
        for column in ("lead3", "tfidf_summary", "textrank_summary"):
            rest = row[column]
            taken = 0
            for sentence in row["sentences"]:
                if rest.startswith(sentence) and taken < 3 and (rest == sentence or rest[len(sentence)] == " "):
                    rest = rest[len(sentence):].lstrip(" ")
                    taken += 1
            assert rest == "" and taken == 3


def test_ties_go_to_the_earlier_sentence(spark):
    scores = spark.createDataFrame(
        [("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 2.0 + 1e-13), ("a", 3, 1.0), ("b", 0, 0.5)],
        "doc_id string, sent_idx int, s double",
    )
    assert dict(sentences.pick_top(scores, "s", 2).collect()) == {"a": [1, 2], "b": [0]}
    assert dict(sentences.pick_top(scores, "s", 1).collect()) == {"a": [1], "b": [0]}


@pytest.mark.parametrize("words_at_once", [1, 7, 1 << 18])
def test_documents_ranked_together_or_alone(words_at_once):
    import pyarrow as pa

    from gistmill.functions.graph import rank_documents

    texts = [*TEXTS, [], ["Alone."], None, *TEXTS]
    words = [t and [re.findall(r"\w\w+", s.lower()) for s in t] for t in texts]
    words = [w and [[x for x in ws if x not in STOP] for ws in w] for w in words]
    column = pa.array([["cut off"]] + [[None] if w is None else w for w in words], pa.list_(pa.list_(pa.string())))[1:]
    sizes, similarity, ranks = rank_documents(column, 0.85, 50, words_at_once)
    assert list(sizes) == [1 if t is None else len(t) for t in texts] and len(similarity) == sum(sizes)
    expected = [r for t in texts for r in (dense_ranks(["."] if t is None else t) if t != [] else [])]
    assert list(ranks) == pytest.approx(expected, abs=1e-12)
    assert [len(x) for x in rank_documents(pa.array([], column.type), 0.85, 50)] == [0, 0, 0]
