"""Mixing against a plain simulation of the queues, with other weights and budgets, and on odd rows."""

import hashlib
import math
import re
from collections import defaultdict

import pytest

from gistmill.llm import mixing

SCHEMA = "doc_id bigint, source string, text string, row string, flow string, mix_at int"


def levels(sizes, weights, budget, repeats=3):
    """Targets by sharing the excess again and again."""
    budget = min(budget, sum(repeats * n for s, n in sizes.items() if weights[s] > 0))
    target, full, left = dict.fromkeys(sizes, 0.0), set(), float(budget)
    open_ = {s for s in sizes if weights[s] > 0}
    while open_:
        share = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if share * weights[s] >= repeats * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
        open_ -= over
    for s in open_:
        target[s] = share * weights[s]
    return target, budget


def simulated(data, weights=None, budget=None, repeats=3):
    """taken by (doc_id, source, text), one entry a row."""
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    names = sorted({r[1] for r in data}, key=lambda s: (s is None, (s or "").encode()))
    weights = weights or {s: i % 3 + 1 for i, s in enumerate(names)}
    sizes = {s: sum(size(r[2]) for r in data if r[1] == s) for s in names}
    target, budget = levels(sizes, weights, sum(sizes.values()) if budget is None else budget, repeats)
    key = lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[2] or ''}".encode()).hexdigest()[:16]
    served = []
    for rank, s in enumerate(names):
        queue = sorted((r for r in data if r[1] == s), key=lambda r: (key(r), r[0] or 0))
        done = 0
        for epoch in range(repeats):
            for r in queue:
                n = size(r[2])
                if n and done < target[s]:
                    served.append((min(1.0, (done + n) / target[s]), rank, epoch, key(r), min(n, math.ceil(target[s]) - done), id(r)))
                done += n
    taken, at = defaultdict(int), 0
    for *_, words, row in sorted(served):
        taken[row] += max(0, min(words, budget - at))
        at += words
    return sorted((str(r[0]), size(r[2]), sizes[r[1]], round(target[r[1]], 6), taken[id(r)]) for r in data)


def report(spark, data, **options):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in data], SCHEMA).repartition(3)
    return sorted((str(r[0]), r[1], r[2], round(r[3], 6), r[4]) for r in mixing.mix_report(df, **options).collect())


def corpus():
    data = [[i, f"s{i * i % 5}", "w " * (i * 37 % 90 + 1)] for i in range(120)]
    data += [[500, "tiny", "one two three"], [501, "long", "l " * 30_000], [502, None, "n " * 40], [503, "blank", " \n"], [504, "s1", None],
             [505, "s1", ""], [None, "s2", "a b"], [None, "s2", "a b"], [None, "s2", "c d e"], [7, "s4", "again"], [7, "s4", "again"]]
    return data


def test_report_as_by_simulation(spark):
    data = corpus()
    assert report(spark, data) == simulated(data)
    assert report(spark, data) == report(spark, list(reversed(data)))  # reruns agree, whatever the order of rows


@pytest.mark.parametrize("budget", [0, 7, 1_000, 20_000, 10**9])
def test_other_weights_and_budgets(spark, budget):
    data = corpus()
    weights = {"s0": 5.0, "s1": 0.5, "long": 2.0, None: 1.0, "blank": 1.0}
    given = spark.createDataFrame(list(weights.items()), "source string, weight double")
    want = simulated(data, defaultdict(float, weights), budget)
    assert report(spark, data, weights=given, budget=budget) == want


def test_small_buckets_and_slices_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_TASK", 5)
    data = corpus()
    assert report(spark, data) == simulated(data)


def test_sources_come_near_their_targets(spark):
    data = corpus()
    by = defaultdict(lambda: [0, 0.0])
    of = {str(r[0]): r[1] for r in data if r[0] is not None}
    for doc, size, _, target, taken in report(spark, data):
        assert taken <= 3 * size
        if doc in of:
            by[of[doc]][0] += taken
            by[of[doc]][1] = target
    assert all(abs(taken - target) <= 12 for taken, target in by.values())
    rows = report(spark, data)
    assert sum(r[4] for r in rows) == sum(r[1] for r in rows)  # the whole budget is used


def test_documents_of_the_mix(spark):
    data = corpus()
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in data], SCHEMA)
    mix = mixing.mix_documents(df)
    assert mix.columns == [*df.columns, "mix_at_", "mix_words"]
    rows = mix.collect()
    at = 0
    for r in rows:  # one after the other, without gaps, each with the words it counts
        assert r.mix_at_ == at and len(re.findall("[^\x20\x09-\x0d]+", r.text)) == r.mix_words and r.row == "x" and r.mix_at == 1
        at += r.mix_words
    whole = {(r[0], r[2]) for r in data}
    assert sum((r.doc_id, r.text) not in whole for r in rows) <= 8  # at most one copy a source is cut


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_report(none).collect() == [] and mixing.mix_documents(none).collect() == []
    blank = spark.createDataFrame([(1, "s", None, "", "", 0)], SCHEMA)
    assert [tuple(r) for r in mixing.mix_report(blank).collect()] == [(1, 0, 0, 0.0, 0)]
