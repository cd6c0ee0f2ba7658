"""The pipeline's stages row by row on odd tables, against brute force, and operators on workers without the package."""

import os
import random
import subprocess
import sys
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from gistmill.llm import decontamination, near_duplicates, packing, quality_rules, substring  # noqa: E402

#: extra columns that bear names which the stages use, or might
CLASHES = ["_gone", "_words", "_lang", "_kept", "_changed_id", "_q", "key", "gone", "again", "row", "left", "changed_id", "kept", "piece"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def table(spark, rows):
    """Rows (doc_id, text) with filled extra columns."""
    return spark.createDataFrame([(d, t, "en", "s", 1, *[f"{c}!" for c in CLASHES]) for d, t in rows], SCHEMA).repartition(3)


def kept(df):
    assert df.columns == COLUMNS
    rows = df.collect()
    assert all(r[c] == f"{c}!" for r in rows for c in CLASHES)
    return Counter((r.doc_id, r.text) for r in rows)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = prose(rng, 200)
    near = base.split()
    near[100] = "changed"
    item = "What is the capital city of the northern province where the old river meets the wide sea"
    return {"base": base, "near": " ".join(near), "other": prose(rng, 150), "item": item, "long": prose(rng, 60_000),
            "holds": prose(rng, 40) + " " + item + " " + prose(rng, 40), "passage": base + " " + prose(rng, 90)}


def test_quality_rules_keep_rows_and_columns(spark, texts):
    rows = [(1, texts["base"]), (1, texts["base"]), (None, texts["other"]), (2, None), (3, ""), (4, "few words only"),
            (5, "again and again once more " * 40), (6, texts["long"])]
    assert kept(quality_rules.keep_good(table(spark, rows))) == Counter(
        [(1, texts["base"]), (1, texts["base"]), (None, texts["other"]), (6, texts["long"])])


def test_one_of_each_group_of_near_duplicates(spark, texts):
    t = texts
    rows = [(9, t["base"]), (4, t["near"]), (None, t["base"]), (None, t["other"]), (None, t["other"]), (7, t["long"]), (7, t["long"]),
            (2, None), (3, ""), (None, None), (None, None), (5, "one two"), (6, "one two")]
    assert kept(near_duplicates.drop_near_duplicates(table(spark, rows))) == Counter(
        [(4, t["near"]), (None, t["other"]), (7, t["long"]), (2, None), (3, ""), (None, None), (5, "one two")])


def test_repeated_passages_are_cut_from_later_rows(spark, texts):
    t = texts
    rest = " ".join(t["passage"].split()[200:])
    rows = [(1, t["base"]), (8, t["passage"]), (8, t["passage"]), (None, t["passage"]), (None, t["other"]), (5, None), (6, " ")]
    assert kept(substring.remove_repeats(table(spark, rows))) == Counter(
        [(1, t["base"]), (8, rest), (8, rest), (None, ""), (None, t["other"]), (5, None), (6, " ")])


def test_contaminated_rows_go_with_or_without_an_id(spark, texts):
    t = texts
    items = spark.createDataFrame([(1, t["item"]), (None, t["other"]), (3, None)], "item_id bigint, text string")
    rows = [(1, t["holds"]), (None, t["holds"]), (2, t["base"]), (2, t["base"]), (None, t["other"]), (3, None), (4, "")]
    assert kept(decontamination.drop_contaminated(table(spark, rows), items)) == Counter(
        [(2, t["base"]), (2, t["base"]), (None, t["other"]), (3, None), (4, "")])


def test_pieces_of_rows_without_an_id_are_spread(spark):
    docs = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.format_string("w%d x y", "id").alias("text"),
                                    (F.col("id") % 50).cast("string").alias("source"))
    bins = packing.best_fit(docs, shard=300)
    sizes = [r["count"] for r in bins.groupBy(F.split_part("bin_id", F.lit("-"), F.lit(1))).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 10 and max(sizes) < 450
    same = spark.createDataFrame([(1, "a b", "s")] * 40, "doc_id bigint, text string, source string")
    assert packing.best_fit(same).groupBy("bin_id").count().where("count > 1").isEmpty()  # one cluster


def test_clusters_from_a_column(spark):
    docs = spark.createDataFrame([(i, f"word{i} two", f"s{i}", i % 2) for i in range(6)], "doc_id bigint, text string, source string, g int")
    assert packing.best_fit(docs).select("bin_id").distinct().count() == 1
    apart = packing.best_fit(docs, group="g").join(docs.select("doc_id", "g"), "doc_id")
    assert apart.groupBy("bin_id", "g").count().where("count > 1").isEmpty()


def test_pipeline_as_by_brute_force(spark, tmp_path, texts):
    rng = random.Random(8)
    t = dict(texts)
    plain = {i: prose(rng, 120) for i in range(20, 40)}
    rows = [(1, t["base"]), (2, t["near"]), (3, t["passage"]), (4, t["holds"]), (5, "too short"), (6, None), (None, t["base"]),
            (None, t["other"]), (None, t["other"]), *plain.items()]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, t["item"])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # 2 and the nameless base repeat 1, 3 loses the words of 1, 4 holds an item, 5 and 6 fail the rules, one of two nameless rows stays
    words = {1: 200, 3: 90, None: 150, **dict.fromkeys(plain, 120)}
    assert sorted((str(r.doc_id), r.n_words) for r in out) == sorted((str(d), n) for d, n in words.items())
    used = Counter()
    for r in out:
        used[r.bin_id] += r.n_words
    assert all(r.bin_words == used[r.bin_id] <= 2048 for r in out)


def test_workers_need_no_package(tmp_path):
    """All operators with Python in their tasks, started where the package cannot be imported from."""
    script = tmp_path / "far.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from gistmill.session import get_spark
        from gistmill.llm.queries import QUERIES
        spark = get_spark("far", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4")
        for name in sorted(QUERIES):
            if name.split("_")[0] in ("op2", "op3", "op5", "op6", "op7", "op8", "op9", "op10", "op11", "op12"):
                print("ROWS", name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd="/", env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-1500:]
    assert done.stdout.count("ROWS") == 10
