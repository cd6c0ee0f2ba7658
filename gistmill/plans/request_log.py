"""A command log derived from the conversations table: every turn becomes one line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import fill_template, once

# the n-th entry is the line of the turns with (conv_id + turn) % 10 = n;
# {conv} is the conversation id, {split} the split of the document with that id, {text} the turn's text
LINES = [
    "/doc {split}_{conv}",
    "/style bullets",
    "/summarize",
    "/ask {text}",
    "/length long",
    "/lang french",
    "/paste {text}",
    "/prompt",
    "/style {text}",
    "{text}",
]
# conversations with conv_id % 3 = 0 go through these lines instead
SECOND_LINES = [
    "/doc missing_{conv}",
    "/paste {text}",
    "/style tldr",
    "/summarize",
    "/lang english",
    "/ask",
    "/doc {split}_{conv}",
    "/summarize",
    "/quit",
    "/help",
]


#: a live log is read in two parts, the first of which ends before this turn
FIRST_TURNS = 4


def from_conversations(spark: SparkSession, path: str) -> DataFrame:
    """(session, turn, line)"""
    turns = spark.read.parquet(path).select("conv_id", "turn", "text")
    split = F.when(F.col("conv_id") % 10 < 7, "training").otherwise("test")
    values = {"conv": F.col("conv_id").cast("string"), "split": split, "text": F.col("text")}
    place = ((F.col("conv_id") + F.col("turn")) % len(LINES)).cast("int")
    first, second = (F.array(*[fill_template(t, values) for t in lines]) for lines in (LINES, SECOND_LINES))
    line = F.get(F.when(F.col("conv_id") % 3 == 0, second).otherwise(first), place)
    return once(turns, line=line).select(F.col("conv_id").alias("session"), "turn", "line")
