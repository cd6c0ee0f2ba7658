"""Documents scored by the cross-entropy difference of a target and a background language model.

Both are bigram models over the lower-cased words.  Every word and every
bigram is counted by its own 63-bit hash, without a limit on their number;
counts cover every word of every document; the background is the whole corpus, the
target its marked part.  A bigram's probability is its count, smoothed towards the
unigram with ``PRIOR`` pseudo-counts, the unigram by one count per distinct word of
the corpus; both models use the same words and smoothing.  A document's
score is the mean over its words of (target loss - background loss): the less,
the more it resembles the target.

Documents are worked on in chunks of ``CHUNK_BYTES`` of text.  A chunk sends each distinct
gram once, with its count, to the part of the grams that its hash belongs to.  The part
adds up the counts of all chunks and answers every chunk in the order of its question, by
counts alone.  A second pass over the texts writes down which grams, by their place in
that order, a document holds; question and answer then meet, and the losses follow.  A gram is sent
once a chunk however often it occurs, so no gram is hot, and nothing is broadcast.
A part has the grams of ``PART_BYTES`` of text, at any size of the corpus; from some 100 GB
on questions become short, until each is a single gram.

Defined results: a null or empty text has no words and null losses and score;
repeated rows count and are scored one by one; without target rows the target
is the smoothed uniform model.
Very long texts are counted whole, one longer than a chunk is a chunk of its own; nothing depends on the order of rows or of
ties; an empty table gives no rows; columns other than doc_id, text and the target are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as ar
from .stages import MAPS, with_membership, written  # noqa: F401

PRIOR = 8.0
CHUNK_BYTES = 8 << 20
PART_BYTES = 16 << 20
#: The hash of a bigram has this bit, that of a word has not.
PAIR = np.uint64(1 << 63)
#: In the place of a bigram: the first word of a text.
OPENING = np.uint64(0)

QUESTION = "chunk long, part long, grams binary, target binary, background binary"
ANSWER = "chunk long, part long, target binary, background binary, n_distinct long, n_target long, n_background long"
INDEX = ("chunk long, doc_id array<bigint>, row binary, n_words binary, opening binary, part binary, part_words binary, "
         "part_pairs binary, word binary, previous binary, n_docs binary, doc binary, times binary")
LOSS = "row long, doc_id long, n_words long, target double, background double"
SPLITS = "spark.sql.files.minPartitionNum"


def grams(texts: list[bytes]) -> tuple[ar.Words, np.ndarray, np.ndarray]:
    """Words, and for each the hash of the word and of the bigram that it ends (``OPENING`` at the first)."""
    words = ar.Words(texts, lower=True)
    one = words.hashes() >> np.uint64(1)
    before = np.concatenate((np.zeros(1, np.uint64), one))[: len(one)]
    two = ar.mix(before * ar.BASE + one) | PAIR
    two[words.first[:-1][words.counts > 0]] = OPENING
    return words, one, two


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, small ones in little space: the least type that holds all, byte by byte, compressed."""
    kind = np.min_scalar_type(values.max()) if len(values) else np.dtype(np.uint8)
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, kind.itemsize).T).tobytes()
    head = np.array([kind.itemsize, len(values)], np.int64).tobytes()
    return head + pa.compress(planes, "zstd", asbytes=True) if len(values) else head


def unpack(data: bytes) -> np.ndarray:
    size, n = (int(x) for x in np.frombuffer(data, np.int64, 2))
    if not n:
        return np.zeros(0, np.int64)
    planes = pa.decompress(memoryview(data)[16:], size * n, "zstd", asbytes=True)
    values = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(f"<u{size}").reshape(n)
    return values.astype(np.int64)


class Chunk:
    """Some documents and their distinct grams in the order in which they are asked for.

    That order is by part; within a part words come first, then bigrams by their word.
    """

    def __init__(self, rows: list[int], doc_ids: list[int | None], target: list[bool], texts: list[bytes], parts: int):
        self.rows, self.doc_ids, self.target = rows, doc_ids, np.array(target, bool)
        ones, twos, owners, counts = [], [], [], []
        for low, high in ar.blocks(texts):
            words, one, two = grams(texts[low:high])
            ones.append(one)
            twos.append(two)
            owners.append(words.owner() + low)
            counts.append(words.counts)
        one, two = np.concatenate(ones), np.concatenate(twos)
        self.owner, self.n_words = np.concatenate(owners), np.concatenate(counts)
        self.words, of_word = np.unique(one, return_inverse=True)
        part = (self.words % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        self.words, self.word_part = self.words[order], part[order]
        self.of_word = _ranks(order)[of_word]
        self.inside = np.flatnonzero(two != OPENING)
        self.pairs, at, of_pair = np.unique(two[self.inside], return_index=True, return_inverse=True)
        word, previous = self.of_word[self.inside[at]], self.of_word[self.inside[at] - 1]
        part = ((self.pairs ^ PAIR) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((word, part))
        self.pairs, self.pair_part, self.word, self.previous = self.pairs[order], part[order], word[order], previous[order]
        self.of_pair = _ranks(order)[of_pair]
        self.parts = np.unique(np.concatenate((self.word_part, self.pair_part)))
        self.word_ends, self.pair_ends = (
            np.searchsorted(p, self.parts, side="right") for p in (self.word_part, self.pair_part))

    def questions(self) -> pa.RecordBatch:
        marked = self.target[self.owner]
        counts = []
        for of, in_target, n in ((self.of_word, marked, len(self.words)), (self.of_pair, marked[self.inside], len(self.pairs))):
            counts.append((np.bincount(of[in_target], minlength=n), np.bincount(of, minlength=n)))
        out: dict[str, list] = {"grams": [], "target": [], "background": []}
        low = high = 0
        for word_end, pair_end in zip(self.word_ends, self.pair_ends, strict=True):
            out["grams"].append(np.concatenate((self.words[low:word_end], self.pairs[high:pair_end])).tobytes())
            for k, name in enumerate(("target", "background")):
                out[name].append(pack(np.concatenate((counts[0][k][low:word_end], counts[1][k][high:pair_end]))))
            low, high = word_end, pair_end
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(self.parts), self.rows[0])), pa.array(self.parts), *(pa.array(v, pa.binary()) for v in out.values())],
            names=["chunk", "part", *out])

    def index(self) -> pa.RecordBatch:
        """One row: what the documents hold, by places in the order of the questions."""
        n = len(self.rows)
        held, times = np.unique(self.of_pair * n + self.owner[self.inside], return_counts=True)
        opening = np.zeros(n, np.int64)  # 0: no word
        starts = np.cumsum(self.n_words) - self.n_words
        with_words = self.n_words > 0
        opening[with_words] = self.of_word[starts[with_words]] + 1
        columns = {
            "row": np.array(self.rows, np.int64), "n_words": self.n_words, "opening": opening, "part": self.parts,
            "part_words": np.diff(self.word_ends, prepend=0), "part_pairs": np.diff(self.pair_ends, prepend=0),
            "word": self.word - np.concatenate(([0], self.word[:-1])) + len(self.words) if len(self.word) else self.word,
            "previous": self.previous, "n_docs": np.bincount(held // n, minlength=len(self.pairs)), "doc": held % n, "times": times,
        }
        return pa.RecordBatch.from_arrays(
            [pa.array([self.rows[0]], pa.int64()), pa.array([self.doc_ids], pa.list_(pa.int64())),
             *(pa.array([pack(v)], pa.binary()) for v in columns.values())],
            names=["chunk", "doc_id", *columns])


def _ranks(order: np.ndarray) -> np.ndarray:
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.arange(len(order))
    return ranks


def chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int, parts: int) -> Iterator[Chunk]:
    """The rows of a task in their order, cut where ``chunk_bytes`` are reached."""
    held: tuple[list, list, list, list] = ([], [], [], [])
    size = 0
    for batch in batches:
        texts = ar.text_bytes(batch.column("text"))
        for row in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "target")), texts, strict=True):
            for column, value in zip(held, row, strict=True):
                column.append(value)
            size += len(row[-1]) + 1
            if size >= chunk_bytes:
                yield Chunk(*held, parts)
                held, size = ([], [], [], []), 0
    if held[0]:
        yield Chunk(*held, parts)


def questions(marked: DataFrame, chunk_bytes: int, parts: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, chunk_bytes, parts):
            if len(chunk.words):
                yield chunk.questions()

    return marked.mapInArrow(ask, QUESTION)


def index(marked: DataFrame, chunk_bytes: int, parts: int) -> DataFrame:
    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, chunk_bytes, parts):
            yield chunk.index()

    return marked.mapInArrow(note, INDEX)


def answers(asked: DataFrame) -> DataFrame:
    """For every question the counts of its grams in the corpus; and a row per part with the sums over its words."""

    def answer(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(b, np.uint64) for b in table.column("grams").to_pylist()]
        keys = np.concatenate(sent)
        order = np.argsort(keys)
        starts = run_starts(keys[order])
        run = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(keys)))
        is_word = keys[order][starts] < PAIR
        cuts = np.cumsum([len(k) for k in sent])[:-1]
        packed, sums = [], []
        for name in ("target", "background"):
            counts = np.concatenate([unpack(b) for b in table.column(name).to_pylist()])
            totals = np.add.reduceat(counts[order], starts)
            sums.append(int(totals[is_word].sum()))
            back = np.empty(len(keys), np.int64)
            back[order] = totals[run]
            packed.append([pack(piece) for piece in np.split(back, cuts)])
        n = len(sent)
        return pa.table({
            "chunk": pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
            "part": pa.array([*table.column("part").to_pylist(), table.column("part")[0].as_py()], pa.int64()),
            "target": pa.array([*packed[0], None], pa.binary()), "background": pa.array([*packed[1], None], pa.binary()),
            "n_distinct": pa.array([None] * n + [int(is_word.sum())], pa.int64()),
            "n_target": pa.array([None] * n + [sums[0]], pa.int64()),
            "n_background": pa.array([None] * n + [sums[1]], pa.int64()),
        })

    return asked.groupBy("part").applyInArrow(answer, ANSWER)


def losses(noted: DataFrame, answered: DataFrame, totals: tuple[int, int], n_distinct: int) -> DataFrame:
    """The losses of every document, added up over its words."""

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        note = {name: left.column(name)[0].as_py() for name in left.column_names}
        doc_id = pa.array(note.pop("doc_id"), pa.int64())
        chunk = note.pop("chunk")
        at = {name: unpack(data) for name, data in note.items()}
        right = right.sort_by("part")
        if right.column("part").to_pylist() != at["part"].tolist():
            raise ValueError(f"the texts of chunk {chunk} were split in another way than before")
        word = np.cumsum(at["word"] - at["part_words"].sum())
        n, has_words = len(doc_id), at["n_words"] > 0
        opening = at["opening"][has_words] - 1
        sums = []
        for k, name in enumerate(("target", "background")):
            words, pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for data, n_words, n_pairs in zip(right.column(name).to_pylist(), at["part_words"], at["part_pairs"], strict=True):
                counts = unpack(data)
                if len(counts) != n_words + n_pairs:
                    raise ValueError(f"the texts of chunk {chunk} were split in another way than before")
                words.append(counts[:n_words])
                pairs.append(counts[n_words:])
            of_word, of_pair = np.concatenate(words).astype(float), np.concatenate(pairs).astype(float)
            single = PRIOR * (of_word + 1.0) / (totals[k] + n_distinct)
            step = np.log(of_word[at["previous"]] + PRIOR) - np.log(of_pair + single[word])
            loss = np.bincount(at["doc"], np.repeat(step, at["n_docs"]) * at["times"], minlength=n).astype(float)
            loss[has_words] += math.log(PRIOR) - np.log(single[opening])
            sums.append(loss)
        return pa.table({"row": pa.array(at["row"]), "doc_id": doc_id, "n_words": pa.array(at["n_words"]),
                         "target": pa.array(sums[0]), "background": pa.array(sums[1])})

    given = answered.where("chunk is not null").select("chunk", "part", "target", "background")
    return noted.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(settle, LOSS)


@contextmanager
def same_splits(spark: SparkSession):
    """Files are split alike by every job inside, also if executors come or go."""
    before = spark.conf.get(SPLITS, None)
    spark.conf.set(SPLITS, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SPLITS)


def cross_entropy_difference(
    docs: DataFrame, target: Column, chunk_bytes: int = CHUNK_BYTES, part_bytes: int = PART_BYTES
) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss (nats a word), score of every document of ``docs`` (doc_id, text).

    ``target`` marks the rows of the target model.
    """
    marked = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.coalesce(target, F.lit(False)).alias("target")), "marked", codec="zstd")
    size = marked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    with same_splits(docs.sparkSession):
        answered = written(answers(questions(marked, chunk_bytes, parts)), "gram_answers", codec="zstd")
        n_distinct, *totals = (x or 0 for x in answered.agg(F.sum("n_distinct"), F.sum("n_target"), F.sum("n_background")).first())
        sums = written(losses(index(marked, chunk_bytes, parts), answered, tuple(totals), n_distinct), "losses")
    mean = [F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")) for c in ("target", "background")]
    return sums.select("doc_id", "n_words", mean[0].alias("target_loss"), mean[1].alias("background_loss"),
                       (mean[0] - mean[1]).alias("score"))
