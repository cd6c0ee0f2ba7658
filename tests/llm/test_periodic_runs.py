"""Periodic runs against all periods tried one by one, on sequences and on documents."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from gistmill.llm import periodic_runs as pr
from gistmill.llm import queries

SMALL = "/root/testdata/sf0.001"


def brute(words, least=6, times=4):
    """Every period from 1 on; a stretch found with a shorter period that divides its repetition is not one of this."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([ids[w] for w in words], np.int64)
    n, out = len(x), []
    for p in range(1, n // times + 1):
        edges = np.diff(np.concatenate(([0], (x[p:] == x[:-p]).astype(np.int8), [0])))
        for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            length = e - s + p
            own = x[s:s + length]
            if length >= max(least, times * p) and not any((own[q:] == own[:-q]).all() for q in range(1, p)):
                out.append((s, length, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("times", [2, 4])
def test_runs_of_small_alphabets(times):
    rng = random.Random(times)
    for _ in range(1500):
        n, kinds = rng.randrange(45), rng.choice([1, 2, 2, 3, 5])
        words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randrange(1, 7)
            words = words[:a] + [words[min(a + i % p, n - 1)] for i in range(n - a)]
        assert pr.document_runs(words, 1, times) == brute(words, 1, times), words


def test_extensions_are_those_of_the_texts():
    rng = random.Random(1)
    x = [rng.randrange(2) for _ in range(60)]
    tree = pr.SuffixTree(x)
    pairs = [(a, b) for a in range(61) for b in range(61) if a != b]
    got = tree.extension(*(np.array(c) for c in zip(*pairs)))
    for (a, b), n in zip(pairs, got.tolist()):
        m = 0
        while max(a, b) + m < 60 and x[a + m] == x[b + m]:
            m += 1
        assert n == m
    order = sorted(range(61), key=lambda i: x[i:])
    assert [int(tree.rank[0, i]) for i in order] == list(range(61))
    order = sorted(range(61), key=lambda i: [-v for v in x[i:]])
    assert [int(tree.rank[1, i]) for i in order] == list(range(61))


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def test_query_as_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_periodic_runs(spark, SMALL)
    assert got.columns == pr.REPORT.names
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(expected(r.doc_id, r.text) for r in docs)
    assert any(r[1] for r in rows)


def test_odd_rows(spark):
    texts = [None, "", " \n", "one", "a " * 9, "la la la la", "été 你 " * 5, "x y z " * 20_000, "a b " * 4 + "c " * 7 + "a b " * 4,
             "p q r s " * 3 + "p q r", "p q r s " * 4]
    data = [(i, t, "c", 1) for i, t in enumerate(texts)] + [(4, texts[4], "c", 1), (None, texts[4], None, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, runs_sha256 string, n_runs int")
    rows = pr.run_report(df).collect()
    assert len(rows) == len(data)
    by = {r.doc_id: r for r in rows}
    assert [by[i].n_runs for i in range(len(texts))] == [0, 0, 0, 0, 1, 0, 1, 1, 3, 0, 1]
    assert (by[7].start, by[7].length, by[7].period, by[7].exponent_milli) == (0, 60_000, 3, 20_000_000)
    assert by[None][1:] == by[4][1:] and by[4].collapsed_sha256 == hashlib.sha256(b"a").hexdigest()
    assert {r.doc_id: r.text for r in pr.collapse(df).collect()}[8] == "a b c a b"
    assert pr.run_report(df.limit(0)).collect() == [] and pr.collapse(df.limit(0)).collect() == []
