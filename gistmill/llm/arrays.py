"""Vectorised helpers for Arrow batches: words, fingerprints of spans, content-defined positions.

Texts of a batch are laid side by side in one byte buffer.  A fingerprint of
the span ``[i, i+n)`` of any sequence is taken from prefix sums of
``value * BASE**position`` modulo 2**64, so all spans of a buffer cost two
array operations; equal spans have equal fingerprints wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BLOCK_BYTES = 1 << 19
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LICENCE_BREAKS = np.zeros(256, bool)
LICENCE_BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), BLOCK_BYTES + 1)
        with np.errstate(over="ignore"):
            for_each = np.full(size, BASE, np.uint64)
            for_each[0] = 1
            _powers = np.cumprod(for_each, dtype=np.uint64)
            for_each = np.full(size, BASE_INVERSE, np.uint64)
            for_each[0] = 1
            _inverses = np.cumprod(for_each, dtype=np.uint64)
    return _powers, _inverses


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of ``values[j] * BASE**j`` before each position."""
    sums = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, lengths) -> np.ndarray:
    """Fingerprints of the spans that begin at ``starts``."""
    lengths = np.asarray(lengths)
    with np.errstate(over="ignore"):
        raw = (sums[starts + lengths] - sums[starts]) * powers(len(sums))[1][starts]
        return mix(raw + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of some texts: where they stand in ``data`` and a fingerprint of each.

    ``first[i]:first[i + 1]`` are the words of text ``i``.
    """

    def __init__(self, texts: Sequence[bytes], breaks: np.ndarray = SPACES, lower: bool = False):
        joined = b"\n".join(texts) + b"\n"
        self.raw = joined.lower() if lower else joined
        self.data = np.frombuffer(self.raw, np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths)))
        inside = ~breaks[self.data]
        edges = np.diff(inside.view(np.int8), prepend=np.int8(0))
        self.start = np.flatnonzero(edges == 1)
        self.end = np.flatnonzero(edges == -1)
        self.first = np.searchsorted(self.start, self.text_start)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        sums = prefix_sums(self.data.astype(np.uint64) + np.uint64(1))
        return span_hash(sums, self.start, self.end - self.start)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


def blocks(texts: Sequence[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive slices of at most ``limit`` bytes, or of a single longer text."""
    low = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield low, i
            low, size = i, 0
        size += len(text) + 1
    if low < len(texts):
        yield low, len(texts)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` consecutive values."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        rest = width - have
        out = np.minimum(out[: len(out) - rest], out[rest:])
    return out


def anchors(marks: np.ndarray, width: int) -> np.ndarray:
    """Positions ``i`` where the least of ``marks[i:i+width]`` stands first or last.

    Whether a position is chosen depends on these marks alone, and of any
    ``width - 1`` consecutive positions at least one is chosen (closed syncmers).
    Ties count, so a run of equal marks is chosen throughout.
    """
    if len(marks) < width:
        return np.zeros(0, np.int64)
    least = window_minima(marks, width)
    n = len(least)
    return np.flatnonzero((marks[:n] == least) | (marks[width - 1:] == least))


def runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edges = np.diff(covered.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def cover(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` places lie in ``[s, s+width)`` for one of ``starts``."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:n]) > 0


def signed(x: np.ndarray) -> pa.Array:
    """64-bit fingerprints as a bigint column."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def sampled(marks: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, need: int):
    """Chosen positions of each text, see ``anchors``, at which ``need`` values of the text stand.

    ``starts[i]:ends[i]`` are the values of text ``i``; ``need`` values are
    at least ``width`` marks long.  Returns the texts, the places, and how many
    starts lie behind each place up to the one chosen before it.
    """
    at = anchors(marks, width)
    text = np.searchsorted(starts, at, side="right") - 1
    inside = at + need <= ends[text]
    at, text = at[inside], text[inside]
    place = at - starts[text]
    back = np.diff(at, prepend=-1)
    fresh = np.diff(text, prepend=-1) != 0
    back[fresh] = place[fresh] + 1
    return text, place, back


def spread_back(place: np.ndarray, back: np.ndarray) -> np.ndarray:
    """All starts ``place - back + 1 .. place`` of each pair, one pair after the other."""
    last = np.cumsum(back)
    return np.repeat(place - last + 1, back) + np.arange(last[-1] if len(last) else 0)
