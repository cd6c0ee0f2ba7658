"""Paths that only large or skewed data takes, and the shape of the plans."""

import re

from pyspark.sql import functions as F

from gistmill.operators import assistant, eda, evaluate, sentences, skew, textrank, weights


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|round|Single)", plan_of(df), re.I))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_rare_terms_join_as_well_as_frequent_ones(spark, ws):
    whole, cut = ws.idf_index, ws.index_idf(hot_terms=50)
    assert whole.rare is None and cut.rare is not None
    assert 0 < cut.hot.count() <= 50
    assert rows(weights.term_weights(ws.docs, cut)) == rows(weights.term_weights(ws.docs, whole))

    def rounded(index):
        scores = sentences.sentence_scores(ws.docs, index)
        return rows(scores.select("doc_id", "sent_idx", "n_terms", F.round("wsum", 6), F.round("tfidf_score", 6)))

    assert rounded(cut) == rounded(whole)

    # the plan of a large vocabulary: documents read and exploded once, no posting moved, no top-k
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (sentences.sentence_scores(ws.docs, cut), weights.term_weights(ws.docs, cut),
                   weights.keywords(weights.term_weights(ws.docs, cut))):
            plan = plan_of(df)
            assert shuffles(df) == 0
            assert plan.count("FileScan") == 3  # documents, hot terms, rare terms
            assert "TakeOrdered" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_terms_are_the_most_frequent(spark):
    idf = spark.createDataFrame(
        [("x" * 100, 900, 1.0), *[(f"a{i}", 500, 2.0) for i in range(3)], *[(f"b{i}", 1, 3.0) for i in range(30)]],
        "term string, df long, idf double")
    assert weights.least_hot_df(idf, 34) == 1
    assert weights.least_hot_df(idf, 33) == 500
    assert weights.least_hot_df(idf, 3) == 900
    assert weights.hot_idf(idf, weights.least_hot_df(idf, 0)).count() == 0
    docs = spark.createDataFrame([(1, ["x" * 100, "a0", "b1", "b1"]), (2, ["a1"]), (3, [])], "doc_id long, tokens array<string>")
    for limit in (34, 33, 3, 0):
        least = weights.least_hot_df(idf, limit)
        hot = weights.hot_idf(idf, least)
        index = weights.IdfIndex(hot, weights.rare_idf(docs, idf, hot, least, 3))
        assert rows(weights.term_weights(docs, index)) == [
            (1, "a0", 1, 2.0), (1, "b1", 2, 6.0), (1, "x" * 100, 1, 1.0), (2, "a1", 1, 2.0)]


def test_summaries_read_the_texts_once(spark, ws):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = evaluate.assemble_summaries(ws.docs, ws.keywords, **ws._picks())
        plan = plan_of(df)
        assert shuffles(df) == 0
        assert len(re.findall(r"FileScan[^\n]*sentences", plan)) == 1
        assert not re.search(r"SortMergeJoin", plan)
        assert shuffles(evaluate.rouge_n(ws.tokens)) == 0 and "Aggregate" not in plan_of(evaluate.rouge_n(ws.tokens))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_equals_plain_join(spark):
    left = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot" * 100)
        .otherwise(F.concat(F.lit("k"), "id")).alias("key"), F.col("id").alias("v")
    )
    right = spark.createDataFrame([("hot" * 100, 1), ("k2", 2), ("k5", 3), ("unused", 4)], "key string, w int")
    plain = left.join(right, "key", "left")
    salted = skew.salted_join(left, right, "key", hot_rows=100)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salting_spreads_the_hot_key(spark):
    left = spark.range(4000).select(F.lit("hot" * 100).alias("key"), F.col("id").alias("v"))
    right = spark.createDataFrame([("hot" * 100, 1)], "key string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(left, right, "key", hot_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_state_carried_over_blocks(spark):
    lines = ["/style tldr", "x", "/lang german", "/paste some text", "x", "/length long", "/style nonsense",
             "/paste more text", "/summarize", "/quit", "/style eli5", "/quit"]
    log = spark.createDataFrame(
        [(s, t * 5 + s, line) for s in range(4) for t, line in enumerate(lines[s:])],
        "session long, turn long, line string",
    )
    raw = spark.createDataFrame([("a", "T", "text")], "doc_id string, title string, text string")
    resolved = assistant.resolve_documents(assistant.parse_commands(log), raw)
    expected = rows(assistant.session_state(resolved))
    assert len(expected) == sum(10 - s for s in range(4))
    for block_turns in (1, 2, 7):
        assert rows(assistant.session_state(resolved, block_turns)) == expected


def test_global_rank_over_many_ranges(ws):
    words = eda.word_frequency(ws.docs)
    ranged = ws.write(eda.with_range_number(words, 7), "ranged_test")
    assert ranged.select("part").distinct().count() > 1
    ranked = [r for r in eda.zipf_rank(ranged).orderBy("rank").collect()]
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert [(-r["count"], r["word"]) for r in ranked] == sorted((-r["count"], r["word"]) for r in ranked)


def test_work_inside_documents_is_not_shuffled(spark, ws):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {
            "scores": sentences.sentence_scores(ws.docs, ws.idf_index),
            "summary": sentences.tfidf_summary(ws.scores, ws.docs),
            "weights": weights.term_weights(ws.docs, ws.idf_index),
            "keywords": weights.keywords(ws.term_weights),
            "textrank": textrank.textrank(ws.docs),
            "textrank_summary": textrank.textrank_summary(ws.ranks, ws.docs),
        }
        assert {name: shuffles(df) for name, df in plans.items()} == dict.fromkeys(plans, 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cleaning_runs_each_pattern_once(ws):
    from gistmill.operators import clean

    plan = plan_of(clean.prepare(ws.raw))
    assert shuffles(clean.prepare(ws.raw)) == 0
    # one operator holds each pattern; filters above it read its column
    for pattern in ("Reuter", "(?<=[a-z0-9", "[^a-zA-Z]+"):
        assert sum(pattern in line for line in plan.splitlines()) == 1


def test_only_needed_columns_are_read(ws):
    plan = plan_of(eda.word_frequency(ws.docs))
    assert re.search(r"ReadSchema: struct<tokens:array<string>>", plan)


def test_no_cartesian_product(ws):
    for df in (eda.eda_summary(ws.raw, ws.docs), eda.length_box(ws.docs), eda.zipf_rank(ws.ranged_words)):
        assert "CartesianProduct" not in plan_of(df) and "NestedLoop" not in plan_of(df)


def test_repeated_ids_are_refused(spark, tmp_path):
    import pytest

    from gistmill.plans.workspace import Workspace

    text = "Title\n" + " ".join(f"The market rose {i} points on heavy volume in early trading today." for i in range(9))
    rows_ = [(1, text, "en", "s", 1)] * 2
    spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    with pytest.raises(ValueError, match="unique"):
        Workspace(spark, str(tmp_path)).docs


def scans_below_exchange(df, column):
    """Lines of the plan that scan ``column`` of a file with a shuffle somewhere above them."""
    path, found = [], []
    for line in plan_of(df).splitlines():
        depth = len(re.match(r"[\s:+\-]*", line).group())
        path = [(d, shuffles_) for d, shuffles_ in path if d < depth]
        if "FileScan" in line and re.search(rf"ReadSchema: struct<[^>]*\b{column}:", line) and any(s for _, s in path):
            found.append(line)
        path.append((depth, bool(re.search(r"(?<!Broadcast)Exchange (?:hash|range|round|Single)", line, re.I))))
    return found


def test_texts_are_not_moved_for_requests(spark, ws):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state, documents = ws.session_state, ws.documents_in_use
        used = assistant.documents_in_use(state, ws.raw, ws.buckets)
        asked = [f(state, documents, buckets=ws.buckets) for f in (
            assistant.prompt_messages, assistant.offline_replies, assistant.audit_rows, assistant.confirmations)]
        for df in (used, *asked):
            assert "text:string" in plan_of(df) and scans_below_exchange(df, "text") == []
        # the check of the ids reads no text
        commands = ws.spark.read.parquet(ws.path("commands"))
        assert "text:string" not in plan_of(assistant.resolve_documents(commands, ws.known_ids, ws.buckets))
        # the test itself sees a shuffle of texts
        moved = documents.select("text", F.col("doc_ref")).join(state, "doc_ref")
        assert scans_below_exchange(moved, "text")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_asked_rows_are_all_found(spark):
    from gistmill.operators import lookup

    table = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("v"))
    asked = spark.range(0, 6000, 37).select(F.when(F.col("id") % 5 != 0, F.concat(F.lit("k"), "id")).alias("key"))
    expected = rows(table.join(asked.distinct(), "key", "left_semi"))
    assert rows(lookup.asked_rows(table, asked, "key")) == expected
    few = lookup.may_be_asked(table, asked, "key")
    assert len(expected) <= few.count() <= len(expected) + 5
    full = lookup.may_be_asked(table, asked, "key", bits=64)  # a filter that is full lets all pass, and loses none
    assert set(expected) <= set(rows(full))
    assert lookup.asked_rows(table, asked.limit(0), "key").count() == 0


def test_local_join_equals_plain_join(spark):
    from gistmill.operators import lookup

    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot" * 100)
        .otherwise(F.concat(F.lit("k"), "id")).alias("key"), F.col("id").alias("v"))
    right = spark.createDataFrame([("hot" * 100, 1), ("k2", 2), ("k5", 3), ("unused", 4)], "key string, w int")
    plain = left.join(right, "key", "left")
    for hot_rows in (100, 1000):
        joined = lookup.local_join(left, right, "key", 4, hot_rows)
        assert joined.columns == plain.columns and rows(joined) == rows(plain)


def test_buckets_do_not_grow_with_the_input(spark):
    """What a task sorts is a bucket, so a bucket is small at any size of the input."""
    from gistmill.sources import bucket_count, input_bytes

    table = spark.range(10_000_000)
    assert input_bytes(table) == 80_000_000
    assert input_bytes(table) / bucket_count(table) <= 4 << 20


def test_tables_are_written_bucket_by_bucket(spark, tmp_path):
    """A table that is read without a join is not packed into larger tasks."""
    from gistmill.plans.workspace import Workspace

    rows = spark.range(200).selectExpr("concat('test_', id) as doc_id", "id as x")
    ws = Workspace(spark, str(tmp_path), clean=rows, bucket_bytes=100)
    first = ws.write_bucketed(rows.repartition(ws.buckets, "doc_id"), "first")
    tasks = F.spark_partition_id().alias("task")
    again = ws.write_bucketed(first.select("doc_id", tasks), "again")
    assert ws.buckets >= 16 and again.select("task").distinct().count() == ws.buckets
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"
    ws.forget()


def test_ranks_are_made_without_sorting_words(ws):
    plan = plan_of(textrank.textrank(ws.docs))
    assert not re.search(r"Window|Sort|Aggregate|Join", plan)


def test_features_sort_no_texts(spark, ws):
    from gistmill.operators import learner

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(learner.sentence_features(ws.docs, ws.scores))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_coverage_reads_terms_alone(ws):
    long = evaluate.by_model(ws.summaries)
    assert "p{Z}" not in plan_of(evaluate.coverage(long)) and "[^a-zA-Z]" not in plan_of(evaluate.compression(long))
    assert rows(evaluate.coverage(long)) == rows(evaluate.measure_words(long).select("doc_id", "model", "coverage"))
    assert rows(evaluate.compression(long)) == rows(evaluate.measure_words(long).select("doc_id", "model", "words", "ratio"))
