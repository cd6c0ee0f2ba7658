"""The bit-parallel subsequence against the textbook table and against the JVM's."""

import random
import time

import pytest
from pyspark.sql import functions as F

from gistmill.functions.long_sequences import lcs_of, long_lcs_length
from gistmill.functions.sequences import lcs_length
from gistmill.operators import evaluate


def table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@pytest.mark.parametrize("width", [1, 3, 64, 4096])
def test_lengths_as_in_the_table(width):
    rng = random.Random(width)
    for _ in range(300):
        kinds = rng.choice([1, 2, 4, 30])
        a, b = ([str(rng.randrange(kinds)) for _ in range(rng.randrange(50))] for _ in range(2))
        assert lcs_of(a, b, width) == table(a, b)


def test_long_arrays_take_no_time():
    start = time.time()
    assert lcs_of(["x"] * 3000, ["x"] * 3000) == 3000
    rng = random.Random(1)
    a, b = ([str(rng.randrange(50)) for _ in range(9000)] for _ in range(2))
    assert lcs_of(a, b) == lcs_of(b, a) == lcs_of(a, b, 64)
    assert time.time() - start < 5


def test_both_forms_agree_and_no_row_is_lost(spark):
    rng = random.Random(7)
    data = [(i, "m", [str(rng.randrange(9)) for _ in range(rng.randrange(40))], [str(rng.randrange(9)) for _ in range(rng.randrange(40))])
            for i in range(60)] + [(100, "m", None, ["a"]), (101, "m", ["a"], []), (102, "m", ["x"] * 3000, ["x"] * 3000)]
    df = spark.createDataFrame(data, "doc_id long, model string, reference array<string>, candidate array<string>")
    some = df.where("doc_id < 100")
    sides = F.col("reference"), F.col("candidate")
    assert some.select("doc_id", lcs_length(*sides)).collect() == some.select("doc_id", long_lcs_length(*sides)).collect()
    by_jvm, by_bits = (sorted(map(tuple, evaluate.rouge_l(some, n).collect())) for n in (1 << 30, -1))
    assert by_jvm == by_bits and len(by_jvm) == 60
    whole = {r.doc_id: r.recall for r in evaluate.rouge_l(df).collect()}
    assert len(whole) == 63 and whole[100] == 0.0 and whole[101] == 0.0 and whole[102] == 1.0


def test_usual_pairs_are_compared_by_bits(spark):
    """A headline of nine words and a summary of 60 take the quicker form."""
    df = spark.createDataFrame([(1, "m", list("abcdefghi"), list("ihgfedcba") + ["x"] * 51)],
                               "doc_id long, model string, reference array<string>, candidate array<string>")
    assert 9 * 60 > evaluate.LONG_PAIRS
    assert [r.recall for r in evaluate.rouge_l(df).collect()] == [pytest.approx(1 / 9)]
