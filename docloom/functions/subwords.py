"""Array helpers of ``features.subword_vectors``, run inside tasks: buckets of character n-grams, counts per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that are cut together.
WORDS = 1 << 16
#: Counters, and tokens, of the documents that are counted together.
CELLS, TOKENS = 1 << 22, 100_000


def murmur3(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """Signed 32-bit hashes of the pieces of ``data``, as in ``HashingTF``."""
    turn = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    h = np.full(len(start), seed, np.uint32)
    for i in range(0, int(size.max(initial=0)), 4):
        on = np.flatnonzero(size > i)
        left = size[on] - i
        k = np.zeros(len(on), np.uint32)
        for j in range(4):
            k |= np.where(j < left, data[np.minimum(start[on] + i + j, len(data) - 1)], 0).astype(np.uint32) << np.uint32(8 * j)
        mixed = h[on] ^ (turn(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593))
        h[on] = np.where(left >= 4, turn(mixed, 13) * np.uint32(5) + np.uint32(0xE6546B64), mixed)
    h ^= size.astype(np.uint32)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32)


def word_buckets(words: pa.Array, low: int, high: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of the bracketed words, one word behind the other, repeats included, and their number per word."""
    text = pc.binary_join_element_wise("<", words, ">", "").cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], np.int64)[:len(text) + 1]
    data = np.concatenate([np.frombuffer(text.buffers()[2], np.uint8)[:ends[-1]], np.zeros(4, np.uint8)])
    at = np.flatnonzero((data[:-4] & 0xC0) != 0x80)  # first byte of each character
    first = np.searchsorted(at, ends)
    word = np.repeat(np.arange(len(text)), np.diff(first))
    at = np.append(at, ends[-1])
    of_size = [np.maximum(np.diff(first) - n + 1, 0) for n in range(low, high + 1)]
    size = np.sum(of_size, axis=0, dtype=np.int64)
    place = np.cumsum(size) - size
    out = np.empty(size.sum(), np.int32)
    for n, found in zip(range(low, high + 1), of_size):
        k = np.flatnonzero(np.arange(len(word)) + n <= first[word + 1])
        out[place[word[k]] + k - first[word[k]]] = murmur3(data, at[k], at[k + n] - at[k]) % buckets
        place = place + found
    return out, size


def slices(lengths: np.ndarray, buckets: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents that are counted together; one document at least."""
    most, first, held = max(1, CELLS // buckets), 0, 0
    for i, n in enumerate(lengths):
        if i > first and (i - first == most or held + n > TOKENS):
            yield first, i
            first, held = i, 0
        held += n
    if len(lengths):
        yield first, len(lengths)


def count_buckets(lengths: np.ndarray, codes: np.ndarray, every: np.ndarray, size: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-empty buckets per document, their numbers in rising order and counts; ``codes`` gives each token its word, whose buckets are in ``every``."""
    start = np.cumsum(size) - size
    ends = np.concatenate([[0], np.cumsum(lengths)])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0))]
    for a, b in slices(lengths, buckets):
        own = codes[ends[a]:ends[b]]
        n = size[own]
        at = np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc = np.repeat(np.repeat(np.arange(b - a), lengths[a:b]), n)
        cells = np.bincount(doc * buckets + every[at], minlength=(b - a) * buckets)
        filled = np.flatnonzero(cells)
        found.append((np.bincount(filled // buckets, minlength=b - a), (filled % buckets).astype(np.int32), cells[filled].astype(float)))
    return tuple(np.concatenate(part) for part in zip(*found))


def sparse_counts(batches: Iterator[pa.RecordBatch], low: int, high: int, buckets: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """``(id, tokens)`` to ``(id, sparse vector)``; each distinct word of a batch is cut and hashed once."""
    for batch in batches:
        tokens = batch.column(1)
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        words = tokens.flatten().dictionary_encode()
        cut = [word_buckets(words.dictionary[i:i + WORDS], low, high, buckets) for i in range(0, max(1, len(words.dictionary)), WORDS)]
        every, size = (np.concatenate(part) for part in zip(*cut))
        per_doc, index, value = count_buckets(lengths, words.indices.to_numpy(zero_copy_only=False), every, size, buckets)
        ends = pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32))
        rows = len(lengths)
        vectors = pa.StructArray.from_arrays(
            [pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, buckets, np.int32)),
             pa.ListArray.from_arrays(ends, pa.array(index)), pa.ListArray.from_arrays(ends, pa.array(value))], ["type", "size", "indices", "values"])
        yield pa.RecordBatch.from_arrays([batch.column(0), vectors], names)
