"""Spelling variant grouping (operator 13).

Method: Bloom-guided neighbourhoods. The words of a corpus and their counts are a table. Each word goes as a few bits into a
blocked Bloom filter of its length: one 64-bit block per word, ``BITS`` bits set in it. The filters, of ``FILTER_BYTES`` at most however large the
vocabulary is, are broadcast. Tasks generate the edits of each word and probe the filter of the edit's length, all hashes of a batch at once:
the hash of a word is a sum over positions, so an edit changes it in constant time. Only positives are made strings and shuffled
to an exact join with the vocabulary, which removes false ones; a fuller filter costs more of them, never a result.

A pair of near words is generated once: by deleting from the longer word, or by replacing a code point with a larger one. Every
pair then counts for both words. What meets at one key of the join is bounded by the neighbourhood of a word.

Defined cases: null or empty text has no words; a document without ``doc_id`` loses no code points; repeated rows count like
others; very long runs are words like others; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import guarded, settle

LEAST_LENGTH, LEAST_COUNT = 5, 3
EVERY = 97
#: Code points a counted word can hold: lower-cased A-Z and U+00C0 to U+00FF.
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.int64)
#: Words held by a counting task before it hands counts on.
HELD_WORDS = 400_000
#: Filter bits per word, bits set per word, and the size of all filters at most.
BITS_PER_WORD, BITS, FILTER_BYTES = 16, 4, 32 << 20
#: All longer words share the last filter.
LAST_SHARD = 64
#: Edits hashed at a time.
PROBES = 1 << 20
M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = np.uint64(pow(BASE, -1, 1 << 64))


def counted_words(docs: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the vocabulary, settled. All runs of a word in a document have one checksum, so a document is a count per word."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not t:
                    continue
                start = None if doc_id is None else crc32(f"{doc_id}:".encode())
                # bytes: lower() changes A-Z only
                for word, n in Counter(runs.findall(t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))).items():
                    if start is not None:
                        h = crc32(word.encode(), start)
                        if h % EVERY == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                    total[word] += n
            if len(total) >= HELD_WORDS:
                yield counts(total)
                total.clear()
        yield counts(total)

    def counts(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    given = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text).alias("text"))
    parts = given.mapInArrow(run, "word string, n long").where(F.length("word") >= least_length)
    return settle(parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "vocabulary")


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * M1
    h = (h ^ (h >> np.uint64(33))) * M2
    return h ^ (h >> np.uint64(33))


def symbol_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def powers(length: int) -> np.ndarray:
    out = np.full(length, np.uint64(BASE))
    if length:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def terms(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of equally long words, and what each adds to its word's hash."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)
    return codes, symbol_values()[codes] * powers(codes.shape[1])


def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of a filter and the bits in it, per hash."""
    h = mixed(hashes)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.zeros(h.shape, np.uint64)
    for k in range(BITS):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return block, bits


def shard_of(length: int) -> int:
    return min(length, LAST_SHARD)


def by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(len(w), []).append(k)
    return out


def filters(vocabulary: DataFrame) -> dict[int, np.ndarray]:
    """Filter per length: blocks as uint64. At most ``FILTER_BYTES`` and a block per length reach the driver."""
    shard = F.least(F.length("word"), F.lit(LAST_SHARD))
    sizes = {r["shard"]: r["n"] for r in vocabulary.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}
    per_word = min(BITS_PER_WORD, 8 * FILTER_BYTES / max(1, sum(sizes.values())))
    blocks = {s: int(n * per_word / 64) + 1 for s, n in sizes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, at in by_length(words).items():
                _, parts = terms([words[k] for k in at])
                block, bits = places(parts.sum(axis=1, dtype=np.uint64), blocks[shard_of(length)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), shard_of(length)), pa.int32()), pa.array(block.astype(np.int64)),
                                                  pa.array(bits.view(np.int64))], names=["shard", "block", "bits"])

    made = {s: np.zeros(n, np.uint64) for s, n in blocks.items()}
    if sizes:
        marks = vocabulary.select("word").mapInArrow(run, "shard int, block long, bits long")
        marks = marks.groupBy("shard", "block").agg(F.bit_or("bits").alias("bits")).toArrow()
        shards, block, bits = (marks.column(k).to_numpy() for k in range(3))
        for s, f in made.items():
            own = shards == s
            f[block[own]] = bits[own].view(np.uint64)
    return made


def positives(codes: np.ndarray, parts: np.ndarray, shards: dict[int, np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(word, position, symbol) of the edits that pass the filters; symbol 0 deletes. For words of one length."""
    n, length = codes.shape
    shorter, same = shards.get(shard_of(length - 1)), shards.get(shard_of(length))
    total = parts.sum(axis=1, dtype=np.uint64)

    def passing(hashes: np.ndarray, shard: np.ndarray) -> np.ndarray:
        block, bits = places(hashes, len(shard))
        return (shard[block] & bits) == bits

    if shorter is not None:
        upto = np.cumsum(parts, axis=1, dtype=np.uint64)
        hits = passing((upto - parts) + (total[:, None] - upto) * BASE_INVERSE, shorter)
        hits[:, :-1] &= codes[:, 1:] != codes[:, :-1]  # of a run of one symbol, the last is deleted
        for row, at in zip(*np.nonzero(hits)):
            yield int(row), int(at), 0
    if same is not None:
        values, power = symbol_values(), powers(length)
        rest = total[:, None] - parts
        for symbol in ALPHABET.tolist():
            row, at = np.nonzero(codes < symbol)
            hit = passing(rest[row, at] + values[symbol] * power[at], same)
            for r, a in zip(row[hit].tolist(), at[hit].tolist()):
                yield r, a, symbol


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``word, near, near_n`` for each word and each word near it, from the settled ``vocabulary``."""
    sent = vocabulary.sparkSession.sparkContext.broadcast(filters(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, at in by_length(words).items():
                step = max(1, PROBES // (length + 1))
                for start in range(0, len(at), step):
                    some = at[start:start + step]
                    edit, word, n = [], [], []
                    for row, k, symbol in positives(*terms([words[i] for i in some]), sent.value):
                        w = words[some[row]]
                        edit.append(w[:k] + (chr(symbol) if symbol else "") + w[k + 1:])
                        word.append(w)
                        n.append(counts[some[row]])
                    yield pa.RecordBatch.from_arrays([pa.array(edit, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())],
                                                     names=["edit", "word", "n"])

    tasks = int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = vocabulary.select("word", "n").repartition(tasks)
    found = dealt.mapInArrow(run, "edit string, word string, n long")
    once = settle(found.join(vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit"), "near-words")
    return once.select("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")).unionByName(
        once.select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the rows of ``forms`` (``word, form``): forms followed to the last, twice as far in each round.

    A form has at least twice the count of its word, so chains end, and their length is logarithmic in the counts.
    """
    state = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = guarded(state.select(F.col("word").alias("root"), F.col("root").alias("further")))
        far = settle(state.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        state = far.select("word", "root")
        if far.where("moved").isEmpty():
            return state


def variants(docs: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``."""
    vocabulary = counted_words(docs, text, least_length, least_count)
    best = near_pairs(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    rows = vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    changes = F.coalesce(F.col("form_n") >= 2 * F.col("n"), F.lit(False))
    rows = settle(rows.withColumn("form", F.when(changes, F.col("form"))).withColumn("form_n", F.when(changes, F.col("form_n"))), "forms")
    ends = guarded(roots(rows.where("form IS NOT NULL")))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
