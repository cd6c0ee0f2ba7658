"""Power iteration on the sentence graphs of many documents, given by the words of their sentences."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# send this module's functions to the workers whole: executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words that are ranked at once; a longer document is ranked alone.
WORDS_AT_ONCE = 1 << 18


def linking_entries(sizes: np.ndarray, sentence: np.ndarray, term: np.ndarray):
    """(row, col, x): the entries of the unit tf-idf vectors of all sentences, idf within the document, for terms that link.

    ``sizes`` has the sentences of each document; ``sentence`` and ``term`` number the
    sentence and the term of each word.  Columns are terms of one document.  Only terms
    that two sentences of a document or more hold have entries, but all count for the length.
    """
    document = np.repeat(np.arange(len(sizes)), sizes)
    terms = int(term.max(initial=0)) + 1
    pairs, tf = np.unique(sentence * terms + term, return_counts=True)
    row, word = np.divmod(pairs, terms)
    _, col = np.unique(document[row] * terms + word, return_inverse=True)
    df = np.bincount(col)[col] if len(col) else col
    w = tf * (np.log((sizes[document[row]] + 1) / (df + 1)) + 1)
    x = w / np.sqrt(np.bincount(row, w * w, len(document)))[row]
    linking = df >= 2
    return row[linking], col[linking], x[linking]


def rank_sentences(sizes: np.ndarray, row: np.ndarray, col: np.ndarray, x: np.ndarray, damping: float, rounds: int):
    """Similarity sums and ranks of the sentences of all documents from the entries x[row, col] of their unit vectors.

    S y is computed as X (X' y) - diag * y, so the n x n similarities are never formed.  Documents
    share no column, so one product serves them all.
    """
    total, n = int(sizes.sum()), np.repeat(sizes, sizes)
    own = np.bincount(row, x * x, total)

    def similar(y: np.ndarray) -> np.ndarray:
        by_term = np.bincount(col, x * y[row])
        return np.bincount(row, x * by_term[col], total) - own * y

    mass = similar(np.ones(total))
    share = np.divide(1.0, mass, out=np.zeros(total), where=mass > 0)
    rank = 1.0 / n
    for _ in range(rounds):
        rank = (1 - damping) / n + damping * similar(rank * share)
    return mass, rank


def rank_documents(words: pa.Array, damping: float, rounds: int, words_at_once: int = WORDS_AT_ONCE):
    """(sizes, similarity, rank) of documents given as arrays of the words of each sentence."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    sentences = words.flatten()
    lengths = pc.fill_null(pc.list_value_length(sentences), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    term = pc.dictionary_encode(sentences.flatten()).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))  # sentence of a document
    start = np.concatenate(([0], np.cumsum(lengths)))  # word of a sentence
    masses, ranks, low = [np.zeros(0)], [np.zeros(0)], 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(start[first], start[first[low]] + words_at_once, "right")) - 1)
        some, inside = slice(first[low], first[high]), slice(start[first[low]], start[first[high]])
        sentence = np.repeat(np.arange(first[high] - first[low]), lengths[some])
        _, own = np.unique(term[inside], return_inverse=True)
        mass, rank = rank_sentences(sizes[low:high], *linking_entries(sizes[low:high], sentence, own), damping, rounds)
        masses.append(mass)
        ranks.append(rank)
        low = high
    return sizes, np.concatenate(masses), np.concatenate(ranks)


def graph_ranks(words: Column, damping: float, rounds: int) -> Column:
    """struct(similarity, rank), two arrays with one value for each sentence of a document given by the words of each."""

    @F.arrow_udf("struct<similarity: array<double>, rank: array<double>>")
    def ranks(words: pa.Array) -> pa.Array:
        sizes, *values = rank_documents(words, damping, rounds)
        offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(v)) for v in values], ["similarity", "rank"])

    return ranks(words)
