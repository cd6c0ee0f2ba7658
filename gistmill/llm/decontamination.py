"""Documents that hold benchmark items, also with other numbers, names or units.

Texts are reduced to templates: numbers, units and names inside a sentence
become typed placeholders whose values are kept as slots; other words are
lower-cased and freed of surrounding marks.  Windows of ``WINDOW`` template
words (a shorter item is one window) are hashed and joined.  A window with
placeholders counts if at least half of it is plain words.  Besides, every window is joined as it
stands, in lower case and with its values in place of the placeholders: an exact
copy is found however many names and numbers it has, and in any case.

For an occurrence of an item in a document, the slots of the joined windows must be
consistent: one value of the item always stands for one value of the document and the
other way round.  Windows with a slot outside its most frequent partner are left out, and a
document is contaminated if the rest of any occurrence cover ``COVERAGE`` of the item's
words.  An occurrence is what stands at one distance from the item's places, or,
as other values may have more or fewer words, at distances in a band as wide as
the item is long (bands overlap by half).  An item in scattered parts has the
whole document as its occurrence.

The benchmark's window hashes set bits in a bitmap of fixed size (``FILTER_BITS``),
the only thing sent to every task; documents emit the windows that hit it, and
the join by hash decides.  More benchmark items fill the bitmap and cost
more emitted windows, never a match.

Defined results: null or empty texts and items match nothing; null ids of
documents are kept; repeated documents or items give the same verdict for each.
Very long texts are searched whole, repeated rows one by one; an empty table or benchmark gives no hits;
``drop_contaminated`` judges rows without an id, too, and returns columns of any other names as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as ar
from .stages import row_key, unused, with_membership, written

WINDOW = 6
COVERAGE = 0.5
FILTER_BITS = 1 << 22
#: Fixed values.
UNITS = frozenset(
    b"% $ \xe2\x82\xac \xc2\xa3 mm cm m km g kg mg lb lbs oz ml l s sec min h hr hrs mph kph w kw v hz khz mhz ghz "
    b"kb mb gb tb usd eur gbp dollars euros pounds cents miles metres meters feet inches grams kilograms litres liters "
    b"seconds minutes hours days weeks months years percent degrees".split())
MARKS = b".,;:!?()[]{}\"'`*#&|<>-_/\\"
ENDS = (b".", b"!", b"?", b":")
NUMBER, NAME, UNIT = b"\x01", b"\x02", b"\x03"


def template(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """Template words of a text, and for each its value if it is a placeholder, else empty."""
    words, slots = [], []
    opening = True
    for raw in text.split():
        core = raw.strip(MARKS)
        if core:
            low = core.lower()
            if core[:1].isdigit() or (core[:1] in b"+-$" and core[1:2].isdigit()):
                words.append(NUMBER)
                slots.append(low)
            elif low in UNITS and words and words[-1] == NUMBER:
                words.append(UNIT)
                slots.append(low)
            elif not opening and core[:1].isupper() and core[1:2].islower():
                words.append(NAME)
                slots.append(low)
            else:
                words.append(low)
                slots.append(b"")
        opening = raw.endswith(ENDS)
    return words, slots


def windows(texts: list[bytes], lengths: list[int], whole: bool) -> tuple[np.ndarray, ...]:
    """text, place, length, hash of the windows, their place in the slots, whether they have slots; and the slots.

    Each window comes as it stands and, if it has placeholders, also as a template.  ``whole`` takes one window of each text shorter than ``WINDOW``; otherwise
    windows of every length of ``lengths`` are taken.
    """
    cut = [template(t) for t in texts]
    words = ar.Words([b"\n".join(w) for w, _ in cut])
    slots = [s for _, row in cut for s in row]
    plain = np.array([not s for s in slots], np.int64)
    sums, plains = ar.prefix_sums(words.hashes()), np.concatenate(([0], np.cumsum(plain)))
    stands = ar.Words([b"\n".join(s or w for w, s in zip(*row, strict=True)) for row in cut])
    stand_sums = ar.prefix_sums(stands.hashes())
    out = []
    for n in lengths:
        place = np.concatenate([
            np.arange(first, first + count - n + 1) if count >= n and (not whole or n == min(count, WINDOW))
            else np.zeros(0, np.int64)
            for first, count in zip(words.first[:-1].tolist(), words.counts.tolist(), strict=True)] or [np.zeros(0, np.int64)])
        place = place.astype(np.int64)
        n_plain = plains[place + n] - plains[place]
        typed = place[(2 * n_plain >= n) & (n_plain < n)]
        for of, at, slotted in ((stand_sums, place, False), (sums, typed, True)):
            text = np.searchsorted(words.first, at, side="right") - 1
            length = np.full(len(at), n)
            out.append((text, at - words.first[text], length, ar.span_hash(of, at, length), at, np.full(len(at), slotted)))
    return tuple(np.concatenate(column) for column in zip(*out, strict=True)) + (slots,)


ROW = "key bigint, n int, place int, size int, hash bigint, slots array<string>"


def _window_rows(rows: DataFrame, key: str, lengths: list[int], whole: bool, bitmap=None) -> DataFrame:
    """The windows of (key, text) rows; those of documents only where the bitmap is set."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(bitmap.value, np.uint8)) if bitmap else None
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            texts = ar.text_bytes(batch.column("text"))
            for low, high in ar.blocks(texts):
                text, place, n, hashes, at, slotted, slots = windows(texts[low:high], lengths, whole)
                sizes = np.zeros(high - low, np.int64)
                if whole:
                    sizes = np.array([len(template(t)[0]) for t in texts[low:high]], np.int64)
                hit = np.flatnonzero(wanted[(hashes % np.uint64(FILTER_BITS)).astype(np.int64)]) if bitmap else np.arange(len(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[low:high][text[hit]].astype(np.int64)), pa.array(n[hit].astype(np.int32)),
                     pa.array(place[hit].astype(np.int32)), pa.array(sizes[text[hit]].astype(np.int32)), ar.signed(hashes[hit]),
                     pa.array([[s.decode("utf-8", "replace") for s in slots[i:i + k]] if own else []
                               for i, k, own in zip(at[hit].tolist(), n[hit].tolist(), slotted[hit].tolist(), strict=True)],
                              pa.list_(pa.string()))],
                    names=["key", "n", "place", "size", "hash", "slots"])

    picked = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), "text")
    return picked.mapInArrow(emit, ROW)


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "item_id") -> DataFrame:
    """doc_id, item_id, n_words, covered, coverage of the documents that hold an item."""
    spark = docs.sparkSession
    items = written(_window_rows(benchmark, key, list(range(1, WINDOW + 1)), True), "item_windows")
    found = items.select("n", F.pmod("hash", F.lit(FILTER_BITS)).alias("bit")).distinct()
    bits = np.zeros(FILTER_BITS, np.uint8)
    lengths = {WINDOW}
    for row in found.toLocalIterator():  # at most FILTER_BITS * WINDOW small rows, whatever the benchmark's size
        bits[row["bit"]] = 1
        lengths.add(row["n"])
    bitmap = spark.sparkContext.broadcast(np.packbits(bits).tobytes())
    emitted = _window_rows(docs, "doc_id", sorted(lengths), False, bitmap)
    held = items.select(F.col("key").alias("item_id"), F.col("place").alias("item_place"), "size", "hash", "n",
                        F.col("slots").alias("item_slots"))
    joined = written(
        emitted.select(F.col("key").alias("doc_id"), F.col("place").alias("doc_place"), "hash", "n",
                       F.col("slots").alias("doc_slots")).distinct()
        .join(held, ["hash", "n"])
        .select("doc_id", "item_id", "doc_place", "item_place", "n", "size", F.filter(
            F.arrays_zip("item_slots", "doc_slots"), lambda p: p["item_slots"] != "").alias("pairs")), "window_matches")
    away, size = F.col("doc_place") - F.col("item_place"), F.col("size")
    occurrences = [away, F.floor(away / size), F.floor((away + size / 2) / size), F.lit(0)]
    placed = joined.select("doc_id", "item_id", "item_place", "n", "size", "pairs", F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), at.cast("bigint").alias("at")) for kind, at in enumerate(occurrences)])).alias("occurrence"))
    key = ["doc_id", "item_id", "occurrence"]
    # the partner of each value: the most frequent one, both ways
    slots = placed.select(*key, F.explode("pairs").alias("p")).groupBy(
        *key, F.col("p.item_slots").alias("x"), F.col("p.doc_slots").alias("y")).agg(F.count("*").alias("c"))
    forward = slots.groupBy(*key, "x").agg(F.max_by("y", F.struct("c", "y")).alias("y"))
    backward = slots.groupBy(*key, "y").agg(F.max_by("x", F.struct("c", "x")).alias("x"))
    agreed = forward.join(backward, [*key, "x", "y"]).groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("x", "y"))).alias("partner"))
    consistent = placed.join(agreed, key, "left").where(F.forall(
        "pairs", lambda p: F.coalesce(F.element_at("partner", p["item_slots"]) == p["doc_slots"], F.lit(False))))
    covered = (
        consistent.groupBy(*key)
        .agg(F.max("size").alias("n_words"), F.size(F.array_distinct(F.flatten(F.collect_set(
            F.sequence("item_place", F.col("item_place") + F.col("n") - 1))))).alias("covered"))
        .groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"), F.max("covered").alias("covered"))
    )
    return covered.withColumn("coverage", F.col("covered") / F.col("n_words")).where(F.col("coverage") >= COVERAGE)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, items (sorted ids) of every document."""
    held = matches(docs, benchmark).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).join(held, "doc_id", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with the columns of ``docs``; rows without an id are judged by their text."""
    key, gone = unused("key", docs.columns), unused("gone", docs.columns)
    keyed = docs.withColumn(key, row_key())
    found = written(
        matches(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark).select("doc_id").distinct(), "contaminated")
    return with_membership(keyed, found, gone, key=key).where(~F.col(gone)).select(*docs.columns)
