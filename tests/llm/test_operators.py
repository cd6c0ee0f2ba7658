"""The training-data operators against brute force, and on null, empty, long, repeated and clashing rows."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from gistmill.llm import (  # noqa: E402
    decontamination, license_scan, lm_scoring, near_duplicates, packing, quality_classifier, quality_rules, substring,
    suffix_array, url_filter,
)

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, kept string, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return {r.doc_id: (r.text or "") for r in docs.select("doc_id", "text").collect()}


def _word(rng):
    return "".join(rng.choice("abcdefgh") for _ in range(5))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and columns, empty and very long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(1)
    passage = " ".join(_word(rng) for _ in range(120))
    long = " ".join(_word(rng) for _ in range(60_000))
    texts = [None, "", " \n ", "one", passage, passage + " end", long, "a " * 500, "\u00e9t\u00e9 \u4f60\u597d " * 30]
    data = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None, "x", "y", "z") for i, t in enumerate(texts)]
    data += [data[4], data[4], (None, passage, "en", "s", 1, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (4, 1, 0), (5, 0, 0), (None, 1, 0), (999, 0, 0), (7, None, 0)],
                                 "doc_id bigint, quality int, toxic int")


def items(spark):
    return spark.createDataFrame([(1, "alpha beta gamma"), (2, None), (3, "")], "item_id bigint, text string")


REPORTS = {
    "lm": lambda s, d: lm_scoring.cross_entropy_difference(d, F.col("lang") == "en"),
    "license": lambda s, d: license_scan.scan(d),
    "rules": lambda s, d: quality_rules.quality_report(d),
    "classifier": lambda s, d: quality_classifier.quality_scores(d, labels(s)),
    "substring": lambda s, d: substring.removal_report(d),
    "suffix": lambda s, d: suffix_array.removal_report(d),
    "decontamination": lambda s, d: decontamination.contamination_report(d, items(s)),
    "near": lambda s, d: near_duplicates.duplicate_groups(d),
}


@pytest.mark.parametrize("name", REPORTS)
def test_one_row_per_document_on_odd_input(spark, odd, name):
    assert len(REPORTS[name](spark, odd).collect()) == odd.count()


@pytest.mark.parametrize("name", REPORTS)
def test_empty_table(spark, none, name):
    assert REPORTS[name](spark, none).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_and_empty_input(spark, odd, none, name, stage):
    assert stage(spark, none, SMALL).count() == 0
    out = stage(spark, odd, SMALL)
    assert out.count() >= 0
    if stage is not corpus_pipeline.pack:
        assert out.columns == odd.columns


def test_url_rules_on_odd_urls(spark):
    urls = [None, "", "nourl", "http://A.Example.COM/en/x?y", "http://www.example.com/en/", "x://net/es/1", "http://b.net/fr/#a",
            "http://com/", "http://com", "http://notcom/a", "http://x.com/a"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, url_host string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert len(got) == len(urls)
    expected = [None, None, None, ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
                ("net/fr/", "block"), ("com/", "allow"), None, None, ("com/", "allow")]
    for i, e in enumerate(expected):
        assert (got[i].url_rule, got[i].url_verdict if e else None) == (e or (None, None))
    assert (got[3].url_host, got[3].url_path, got[0].url_host, got[8].url_path) == ("a.example.com", "/en/x", "", "")
    assert url_filter.judge_urls(pages.limit(0)).collect() == []


def test_passages_as_by_brute_force(docs, rows):
    words = {d: t.encode().split() for d, t in rows.items()}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - 49):
            first.setdefault(tuple(words[d][i:i + 50]), d)
    for r in substring.removal_report(docs).collect():
        w = words[r.doc_id]
        gone = {j for i in range(len(w) - 49) if first[tuple(w[i:i + 50])] < r.doc_id for j in range(i, i + 50)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(kept).hexdigest())


def test_strings_as_by_brute_force(docs, rows):
    data = {d: t.encode() for d, t in rows.items()}
    counts = Counter(t[i:i + 400] for t in data.values() for i in range(len(t) - 399))
    for r in suffix_array.removal_report(docs).collect():
        t = data[r.doc_id]
        gone = bytearray(len(t))
        for i in range(len(t) - 399):
            if counts[t[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())


def _groups(texts, percent):
    sets = {}
    for d, t in texts.items():
        w = t.encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_a_group_of_copies_with_few_and_many_edits(spark):
    rng = random.Random(3)
    base = [_word(rng) for _ in range(150)]
    texts = {}
    for d in range(120):
        copy = list(base)
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(150)] = _word(rng)
        texts[d] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.duplicate_groups(df, 0.85).collect()}
    assert got == _groups(texts, 85)


def test_groups_as_by_brute_force(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.duplicate_groups(docs).collect()}
    assert got == _groups(rows, 80)


def test_license_places(spark):
    text = "Under the MIT License. under the mit license; apache license, version 2\nSPDX-License-Identifier: GPL-3.0-only cc-by-nc"
    df = spark.createDataFrame([(1, text), (2, "plain words")], "doc_id bigint, text string")
    a, b = sorted(license_scan.scan(df).collect(), key=lambda r: r.doc_id)
    assert (a.n_base, a.first_word, a.last_word, a.base_labels) == (4, 0, 19, "apache-2,cc-by-nc,mit")
    assert "gpl-3" in a.labels.split(",") and a.score == 1.0
    assert (b.n_base, b.first_word, b.labels, b.score, b.n_words) == (0, None, "", 0.0, 2)


def test_contained_detections_are_suppressed():
    line, _ = license_scan.word_line(b"licensed under the terms of the gnu general public license version 2")
    assert [d[2] for d in license_scan.detect(line, license_scan.rules())] == ["gpl-2"]


def test_keywords_drop_no_match(spark):
    texts = {"This code is released under the GPL v3 or later": "gpl-3", "distributed under the terms of the MPL 2.0": "mpl-2",
             "governed by the AGPL v3": "agpl-3", "subject to the terms of the BSD": "bsd", "the Expat license": "mit",
             "Creative Commons Attribution International": "cc-by", "redistributed under CDDL 1.0": "cddl-1"}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan(df).collect()}
    assert got == dict(enumerate(texts.values()))
    verbs = ["released under the terms of the", "licenced under a", "subject to", "covered by the", "license type", "spdx license identifier", ""]
    ordered = license_scan.rules()
    for label, _, names in license_scan.FAMILIES:
        name = re.sub(r"\(\?:[^()]*(?:\(\?:[^()]*\)\?)*\)\?", "", names.decode())  # the optional parts left out
        name = re.sub(r"\(\?:([^()]*)\)", r"\1", name) if "|" not in name.split(")")[-1] else name
        for way in re.sub(r"[()?:]", "", name).replace("\\d", "4").replace("\\w+", "s").replace("[cs]", "s").replace("[01]", "1").split("|"):
            for verb in verbs:
                for end in ("", "license", "international", "generic"):
                    line, _ = license_scan.word_line(f"x {verb} {way} {end} y".encode())
                    for rule in ordered:
                        if rule.pattern.search(line):
                            assert all(any(k in line for k in group) for group in rule.keywords), (rule, line)


def test_reworded_questions_are_found(spark):
    item = "A train leaves Paris at 9 and drives 300 km to reach Lyon while another train leaves Paris at 11 today"
    same = item.replace("Paris", "Rome").replace("300", "450").replace("Lyon", "Milan")
    mixed = item.replace("leaves Paris at 9", "leaves Rome at 9", 1)
    df = spark.createDataFrame([(1, "Some words. " + same + " more."), (2, "nothing of this kind here at all, really nothing"),
                                (3, item), (4, mixed)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = {r.doc_id: r["items"] for r in decontamination.contamination_report(df, bench).collect()}
    assert got[1] == [7] and got[3] == [7] and got[2] == []


def test_a_copy_is_found_beside_variants_of_it(spark):
    item = "add 91 eggs and 11 nuts then 81 figs or 21 pears with 71 beans under 31 leaves plus 61 drops over 41 plates"

    def variant(other):
        return " ".join(dict(zip(("91", "11", "81", "21", "71", "31", "61", "41"), other)).get(w, w) for w in item.split())

    one = variant(("15", "95", "16", "96", "17", "97", "18", "98"))
    two = variant(("92", "12", "82", "22", "72", "32", "62", "42"))
    texts = [item, f"{item} {one}", f"{one} {item} {two}", f"{two} filler words {one}", f"{one} {item.replace('71 beans', '71 or more beans')}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    got = {r.doc_id: r.coverage for r in decontamination.matches(df, bench).collect()}
    assert [got.get(i) for i in range(5)] == [1.0] * 5


def test_exact_copies_full_of_names_and_numbers_and_in_lower_case(spark):
    bench = {1: "The list is George Washington John Adams Thomas Jefferson James Madison James Monroe Andrew Jackson",
             2: "Continue the series 1 1 2 3 5 8 13 21 34 55 89 144 233",
             3: "the road from Paris to Lyon passes Dijon and then Beaune before it reaches Chalon and the river",
             4: "Berlin lies on the Spree"}
    texts = [text for item in bench.values() for text in (f"Some words first {item} and some more", f"so {item.lower()} so")]
    df = spark.createDataFrame([*enumerate(texts), (99, "no list of Other Names or 4 5 6 7 8 numbers")], "doc_id bigint, text string")
    found = decontamination.contamination_report(df, spark.createDataFrame(list(bench.items()), "item_id bigint, text string")).collect()
    got = {r.doc_id: r["items"] for r in found}
    assert got == {**{i: [i // 2 + 1] for i in range(8)}, 99: []}


def test_benchmark_passages_in_documents(spark, docs, rows):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = {r.doc_id for r in decontamination.matches(docs, bench).collect()}
    whole = set()
    for item in bench.collect():
        whole |= {d for d, t in rows.items() if len(item.text.split()) >= 6 and item.text in t}
    assert whole and whole <= got and len(got) < len(rows) / 2


def test_bins_hold_what_they_may(docs, rows):
    out = packing.best_fit(docs, capacity=512, per_source=2, shard=80).collect()
    bins = defaultdict(list)
    for r in out:
        bins[r.bin_id].append(r)
    assert sum(r.n_words for r in out) == sum(len(t.encode().split()) for t in rows.values())
    for pieces in bins.values():
        assert sum(p.n_words for p in pieces) == pieces[0].bin_words <= 512
        assert max(Counter(p.source for p in pieces).values()) <= 2
        assert max(Counter(p.cluster for p in pieces).values()) == 1


def test_packing_takes_the_tightest_compatible_bin():
    rng = random.Random(5)
    pieces = sorted(((rng.randrange(1, 60), rng.choice("stu"), rng.randrange(40)) for _ in range(300)),
                    key=lambda p: (-p[0], p[2], p[1]))
    got = packing.pack([p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces], 64, 2)
    bins = []
    for (n, s, c), number in zip(pieces, got, strict=True):
        fits = [(64 - sum(x[0] for x in b), i) for i, b in enumerate(bins)
                if sum(x[0] for x in b) + n <= 64 and all(x[2] != c for x in b) and sum(x[1] == s for x in b) < 2]
        assert number == (min(fits)[1] if fits else len(bins))
        if number == len(bins):
            bins.append([])
        bins[number].append((n, s, c))


def test_equal_pieces_of_unique_clusters_share_bins():
    assert len(set(packing.pack([10] * 100, ["s"] * 100, list(range(100)), 64, 4))) == 25
    rng = random.Random(6)
    for sources, clusters, per_source in (("s", 10**9, 4), ("s", 10**9, 2), ("st", 10**9, 3), ("st", 150, 3)):
        pieces = sorted(((rng.randrange(5, 20), rng.choice(sources), rng.randrange(clusters)) for _ in range(300)),
                        key=lambda p: (-p[0], p[1]))
        got = packing.pack([p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces], 64, per_source)
        bins = []
        for (n, s, c), number in zip(pieces, got, strict=True):
            fits = [(64 - sum(x[0] for x in b), i) for i, b in enumerate(bins)
                    if sum(x[0] for x in b) + n <= 64 and all(x[2] != c for x in b) and sum(x[1] == s for x in b) < per_source]
            assert number == (min(fits)[1] if fits else len(bins))
            if number == len(bins):
                bins.append([])
            bins[number].append((n, s, c))


def test_quality_scores_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    d, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r for r in quality_classifier.quality_scores(d, marks).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    truth = {r.doc_id: r.quality for r in marks.collect()}
    good = [r.score for i, r in got.items() if r.held_out and truth.get(i) == 1]
    bad = [r.score for i, r in got.items() if r.held_out and truth.get(i) == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.9


def test_losses_of_small_models(spark):
    df = spark.createDataFrame([(1, "a b a b a b"), (2, "c d c d c d"), (3, "a b")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(df, F.col("doc_id") == 1).collect()}
    assert got[1].score < got[2].score and got[3].score < got[2].score
    assert [got[i].n_words for i in (1, 2, 3)] == [6, 6, 2]


@pytest.mark.parametrize("maps", [lm_scoring.MAPS, 0])
def test_membership(spark, maps):
    ids = [1, 2, 32_768, 32_769, 40_000, 0, -1, -32_768, -40_000, 1 << 40, None, 7, 7]
    asked = [*ids, 3, 32_770, 8, -2, 1 << 41, -(1 << 40), 9, 16]
    docs = spark.createDataFrame([(i, "x", "mine") for i in asked], "doc_id bigint, text string, number string")
    known = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    got = lm_scoring.with_membership(docs, known, maps=maps)
    assert got.columns == ["doc_id", "text", "number", "in_target"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        ((i, "x", "mine", i is not None and i in ids) for i in asked), key=repr)


@pytest.mark.parametrize("chunk_bytes,part_bytes", [(lm_scoring.CHUNK_BYTES, lm_scoring.PART_BYTES), (10_000, 20_000), (1, 1 << 40), (50_000, 50)])
def test_losses_as_by_exact_counts(spark, docs, rows, chunk_bytes, part_bytes):
    words = {d: t.encode().lower().split() for d, t in rows.items()}
    word, pair = [Counter(), Counter()], [Counter(), Counter()]
    for d, w in words.items():
        for k in (0, 1) if d % 3 == 0 else (1,):
            word[k].update(w)
            pair[k].update(zip(w, w[1:]))

    def loss(k, w):
        total, out = sum(word[k].values()), 0.0
        for i, x in enumerate(w):
            p = lm_scoring.PRIOR * (word[k][x] + 1) / (total + len(word[1]))
            out -= math.log((p + (pair[k][w[i - 1], x] if i else 0)) / (lm_scoring.PRIOR + (word[k][w[i - 1]] if i else 0)))
        return out / len(w)

    got = lm_scoring.cross_entropy_difference(docs, F.col("doc_id") % 3 == 0, chunk_bytes, part_bytes).collect()
    assert sorted(r.doc_id for r in got) == sorted(words)
    for r in got:
        w = words[r.doc_id]
        assert r.n_words == len(w)
        if w:
            assert r.target_loss == pytest.approx(loss(0, w), rel=1e-9)
            assert r.background_loss == pytest.approx(loss(1, w), rel=1e-9)


def test_pipeline_decisions_take_effect(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert 0 < out.select("doc_id").distinct().count() < 200
    assert out.groupBy("bin_id").agg(F.sum("n_words").alias("n")).where("n > 2048").isEmpty()


def test_queries_without_python_on_the_main_path(spark):
    judged = url_filter.judge_urls(spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url"))
    kept = quality_rules.quality_report(spark.read.parquet(f"{SMALL}/documents.parquet"))
    for df in (judged, kept):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_memory_of_the_words_of_a_batch(spark):
    """A batch of many texts is worked on text by text, so its words never stand in memory together."""
    import tracemalloc

    import pyarrow as pa

    texts = ["abc def ghi " * 500] * 400
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts)], names=["doc_id", "text"])

    class Taken:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            tracemalloc.start()
            out = list(run(iter([batch])))
            self.peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            return out

    taken = Taken()
    (rows,) = substring.word_digest(taken)
    assert set(rows.column("n_words").to_pylist()) == {1500}
    assert taken.peak < 3 * sum(map(len, texts))


def test_stages_that_drop_documents_move_no_text(spark):
    rng = random.Random(5)
    prose = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4)]
    item = "which river runs past the old mill below the stone bridge of the town"
    rows = [(1, prose[0]), (2, prose[1]), (3, prose[0]), (4, f"{prose[2]} {item}"), (None, prose[1]), (None, prose[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for kept, gone in ((near_duplicates.drop_near_duplicates(docs), [rows[2], rows[4]]),
                           (decontamination.drop_contaminated(docs, bench), [rows[3]])):
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert Counter(map(tuple, kept.collect())) == Counter(r for r in rows if r not in gone)
            assert "SortMergeJoin" not in plan and not re.search(r"Exchange hashpartitioning\(key", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
