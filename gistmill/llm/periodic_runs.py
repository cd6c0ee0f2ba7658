"""Periodic runs of words in every document.

A run is a stretch whose words repeat with a smallest period and which no
neighbouring word continues.  Reported are runs of at least ``LEAST`` words and
``TIMES`` periods.

Method: Ukkonen suffix trees of a stretch of words and of its reversal; an Euler
tour of string depths with a sparse table of minima answers the longest common
extension of two places, forwards or backwards, in constant time as the depth of
the lowest common ancestor of two leaves.  The period of a run has a Lyndon root
in one of the two orders of the alphabet: from every place the longest Lyndon
word ends where the next smaller suffix starts, which the order of the leaves
gives.  Each such root is extended in both directions; what is long enough is a run.

A word of a run stands in it ``TIMES`` times.  So words that are rarer in their
stretch cut it, again and again until nothing changes, before any tree is
built; no run is lost, and plain prose is dropped by counting alone.

Scale: documents are judged one by one inside their task, nothing is shuffled.
Memory follows the longest stretch left of a single document: about 1.5 kB a word
while its two trees stand.  Very long texts that are prose leave no long stretch.

Defined results: a null or empty text has no words, no runs and the digest of
nothing; repeated rows are judged one by one; a null id is kept, and drawn like an
empty one when tails are planted; ties for the longest run go to the smallest
start, then period; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 6
TIMES = 4
REPORT = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
     ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
REPORT_DDL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
              "runs_sha256 string, collapsed_sha256 string")
COLLAPSED_DDL = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string"
COLLAPSED = pa.schema([
    ("doc_id", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("text", pa.string())])

Run = tuple[int, int, int]


class SuffixTree:
    """The suffix tree of ``symbols`` (0 and up) and an end mark, by Ukkonen's algorithm, with constant-time extensions."""

    def __init__(self, symbols: Sequence[int]):
        text = [s + 1 for s in symbols] + [0]  # the end mark is the least symbol
        n, width = len(text), max(text) + 1
        begin, end, link = [0], [0], [0]  # of the edge above a node; a leaf's end is open
        child: dict[int, int] = {}  # node * width + symbol to node
        open_end = n
        node = edge = length = rest = 0
        for i, symbol in enumerate(text):
            rest += 1
            last = 0
            while rest:
                if not length:
                    edge = i
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i)
                    end.append(open_end)
                    link.append(0)
                    if last:
                        link[last] = node
                    last = node
                else:
                    span = min(end[below], i + 1) - begin[below]
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if text[begin[below] + length] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(begin)
                    begin.append(begin[below])
                    end.append(begin[below] + length)
                    link.append(0)
                    child[key] = split
                    child[split * width + symbol] = split + 1
                    begin.append(i)
                    end.append(open_end)
                    link.append(0)
                    begin[below] += length
                    child[split * width + text[begin[below]]] = below
                    if last:
                        link[last] = split
                    last = split
                rest -= 1
                if not node and length:
                    length -= 1
                    edge = i - rest + 1
                elif node:
                    node = link[node]
        self.n = n
        self._order(begin, end, child, width)

    def _order(self, begin: list[int], end: list[int], child: dict[int, int], width: int) -> None:
        """Euler tour with string depths, and the ranks of suffixes in both orders of the symbols."""
        size = len(begin)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        parents, nodes = keys[order] // width, nodes[order]
        ends_here = (keys[order] % width == 0).tolist()
        low = np.searchsorted(parents, np.arange(size)).tolist()
        high = np.searchsorted(parents, np.arange(size), side="right").tolist()
        below = nodes.tolist()
        tour: list[int] = []
        first = np.zeros(self.n, np.int64)
        self.rank = np.zeros((2, self.n), np.int64)
        seen, n = 0, self.n
        stack = [(0, 0, low[0])]
        while stack:
            node, depth, at = stack.pop()
            tour.append(depth)
            if low[node] == high[node]:
                leaf = n - depth
                first[leaf] = len(tour) - 1
                self.rank[0, leaf] = seen
                seen += 1
            elif at < high[node]:
                stack.append((node, depth, at + 1))
                down = below[at]
                stack.append((down, depth + end[down] - begin[down], low[down]))
        # the same leaves with larger symbols first; an end stays first
        walk, seen = [(0, 0)], 0
        while walk:
            node, depth = walk.pop()
            if low[node] == high[node]:
                self.rank[1, n - depth] = seen
                seen += 1
                continue
            slots = range(low[node], high[node])
            ending = ends_here[low[node]]
            # the last one pushed is visited first
            for slot in slots[1:] if ending else slots:
                walk.append((below[slot], depth + end[below[slot]] - begin[below[slot]]))
            if ending:
                down = below[low[node]]
                walk.append((down, depth + end[down] - begin[down]))
        self.first = first
        self.table = [np.array(tour, np.int32)]
        while 2 << len(self.table) - 1 <= len(tour):
            half = 1 << len(self.table) - 1
            above = self.table[-1]
            self.table.append(np.minimum(above[:-half], above[half:]))

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from each of the places ``a`` and ``b`` (different) on are equal."""
        x, y = self.first[a], self.first[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(level):
            own = level == k
            row = self.table[k]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << int(k)) + 1])
        return out


def next_smaller(rank: Sequence[int]) -> list[int]:
    """For each place the next one with a smaller rank."""
    n = len(rank)
    out, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        mine = rank[i]
        while stack and rank[stack[-1]] > mine:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return out


def stretch_runs(symbols: Sequence[int], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs (start, length, period) of a sequence of at least ``least`` symbols and ``times`` periods."""
    n = len(symbols)
    if n < 2:
        return []
    ahead, behind = SuffixTree(symbols), SuffixTree(symbols[::-1])
    found: set[Run] = set()
    start = np.arange(n)
    for rank in ahead.rank:
        root_end = np.array(next_smaller(rank.tolist())[:n])  # the empty suffix, at n, is the least
        period = root_end - start
        right = ahead.extension(start, root_end)
        left = np.zeros(n, np.int64)
        inner = start > 0
        left[inner] = behind.extension(n - start[inner], n - root_end[inner])
        length = left + period + right
        good = (length >= least) & (length >= times * period)
        found.update(zip((start - left)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """The parts that can hold runs: in each every word stands ``times`` times or more."""
    todo, done = [(0, len(ids))], []
    while todo:
        low, high = todo.pop()
        if high - low < max(least, times):
            continue
        own = ids[low:high]
        if high - low > 256:
            _, place, count = np.unique(own, return_inverse=True, return_counts=True)
            kept = count[place] >= times
        else:
            listed = own.tolist()
            tally: dict[int, int] = {}
            for x in listed:
                tally[x] = tally.get(x, 0) + 1
            kept = np.fromiter((tally[x] >= times for x in listed), bool, len(listed))
        if kept.all():
            done.append((low, high))
            continue
        edges = np.flatnonzero(np.diff(kept.astype(np.int8), prepend=0, append=0))
        todo += [(low + int(a), low + int(b)) for a, b in edges.reshape(-1, 2)]
    return sorted(done)


def document_runs(words: Sequence[bytes], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs of a document, by start, then period."""
    if len(words) < max(least, times):
        return []
    table: dict[bytes, int] = {}
    ids = np.array([table.setdefault(w, len(table)) for w in words], np.int64)
    out: list[Run] = []
    for low, high in stretches(ids, least, times):
        dense: dict[int, int] = {}
        symbols = [dense.setdefault(x, len(dense)) for x in ids[low:high].tolist()]
        out += [(low + s, n, p) for s, n, p in stretch_runs(symbols, least, times)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> bytes:
    """The words without those behind the first period of a run, joined by one space."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    dropped = np.cumsum(steps[:-1]) > 0
    return b" ".join(w for w, gone in zip(words, dropped.tolist()) if not gone)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """``words`` with a periodic tail in every tenth document, drawn by the checksum of the id (a null id as empty)."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]


def _documents(batches: Iterable[pa.RecordBatch], tails: bool) -> Iterator[tuple[int | None, list[bytes], list[Run]]]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
            words = (text.as_py() or b"").split()
            if tails:
                words = planted(doc_id, words)
            yield doc_id, words, document_runs(words)


def run_report(docs: DataFrame, tails: bool = False) -> DataFrame:
    """Per document its number of runs, the longest one, and digests of all runs and of the collapsed words.

    ``tails`` gives every tenth document a planted periodic tail first.
    """

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for doc_id, words, runs in _documents(batches, tails):
            start = length = period = exponent = None
            if runs:
                start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
                exponent = 1000 * length // period
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            out.append((doc_id, len(runs), start, length, period, exponent, hashlib.sha256(listed.encode()).hexdigest(),
                        hashlib.sha256(collapsed(words, runs)).hexdigest()))
            if len(out) == 1024:
                yield _batch(out, REPORT)
                out = []
        yield _batch(out, REPORT)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(report, REPORT_DDL)


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id, the runs, and the text with each run cut to its first period."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for doc_id, words, runs in _documents(batches, False):
            text = collapsed(words, runs).decode()
            out.append((doc_id, [{"start": s, "length": n, "period": p} for s, n, p in runs], text))
            size += len(text)
            if size > 1 << 22 or len(out) == 1024:
                yield _batch(out, COLLAPSED)
                out, size = [], 0
        yield _batch(out, COLLAPSED)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, COLLAPSED_DDL)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
