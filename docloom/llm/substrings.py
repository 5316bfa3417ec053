"""Substring dedup (operator 8).

Method: fixed-block anchors. Every document is cut into non-overlapping blocks of ``(window + 1) // 2`` words; each window of the
full length holds a whole block wherever it stands, so the blocks are an index that no repeat escapes. Every rolling stretch of
a block's length, in every document, probes that index. Where a block is hit from elsewhere, the hit is extended: all full windows around it are
looked up by their digests, and the ones that start in a second place anywhere are covered, run by run, to the maximal exact repeat.

Documents are packed (about ``PACK_BYTES`` of text, words by one space) into a settled table. A probe or a window leaves its pack once,
however often it occurs there: sorted, as differences, in one row per pack and lane of the hash space, so that a passage in a third of all
documents is one entry per pack. A lane has about ``LANE_WINDOWS`` entries and answers with one bit per entry; no pair of
places is ever written down. Anchors may be hit by chance (their hashes are 32 bits within a lane), the windows decide: 64 bits within a lane.

Python on Arrow data inside Spark's grouping, as rolling hashes need the word order of whole documents.

Defined cases: null text counts as empty; documents shorter than the window keep all words; repeated rows are places like any others,
so both lose what they share; a null ``doc_id`` is passed on; an empty table gives no rows. Other columns are not taken along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import settle

WINDOW = 35
PACK_BYTES = 4 << 20
LANE_WINDOWS = 4_000_000
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
PACK_SCHEMA = "pack long, doc_ids array<long>, n_words long, words binary"
SENT_SCHEMA = "lane long, pack long, amount long, entries binary, aligned binary, several binary"
REPLY_SCHEMA = "kind int, pack long, lane long, hits binary"


def pack_documents(docs: DataFrame, text: str = "text", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Rows of many documents each: their ids and their words, compressed. Settled, so that packs never change."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=3)
        ids: list[int | None] = []
        lines: list[bytes] = []
        held = words = 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([words], pa.int64()),
                 pa.array([press.compress(b"\n".join(lines))], pa.binary())],
                names=["pack", "doc_ids", "n_words", "words"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc_id, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = t.encode("utf-8", "surrogatepass").split() if t else []  # bytes: cuts at exactly [\x20\x09-\x0D]
                    ids.append(doc_id)
                    lines.append(b" ".join(found))
                    held += len(lines[-1]) + 8
                    words += len(found)
                    if held >= pack_bytes:
                        yield row()
                        number += 1
                        ids, lines, held, words = [], [], 0, 0
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return settle(rows.mapInArrow(run, PACK_SCHEMA), "packs")


class Pack:
    """Word hashes of a pack's documents, one after the other, and the digests of their stretches."""

    def __init__(self, blob: bytes, window: int, lanes: int):
        text = zstandard.ZstdDecompressor().decompress(blob)
        self.documents = [line.split() for line in text.split(b"\n")]
        self.window, self.block, self.lanes = window, (window + 1) // 2, np.uint64(lanes)
        sizes = np.array([len(d) for d in self.documents], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.n = int(sizes.sum())
        h = np.fromiter(map(xxhash.xxh64_intdigest, text.split()), np.uint64, self.n)
        within = np.arange(self.n) - np.repeat(self.starts, sizes)  # position in the document
        self.left = np.repeat(sizes, sizes) - within  # words from here to the document's end
        self.aligned = within % self.block == 0
        self.sums = []
        for base in BASES:
            power = np.full(self.n, base, np.uint64)
            power[:1] = 1
            np.multiply.accumulate(power, out=power)
            inverse = np.full(self.n, pow(base, -1, 1 << 64), np.uint64)
            inverse[:1] = 1
            np.multiply.accumulate(inverse, out=inverse)
            self.sums.append((np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)]), inverse))

    def digest(self, at: np.ndarray, length: int, which: int) -> np.ndarray:
        """64-bit hashes of the ``length`` words from each position of ``at``."""
        sums, inverse = self.sums[which]
        h = (sums[at + length] - sums[at]) * inverse[at]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(29))

    def anchors(self):
        """Positions of all stretches of a block's length, and their keys: lane above 32 bits of hash."""
        at = np.flatnonzero(self.left >= self.block)
        h = self.digest(at, self.block, 0)
        return at, (h >> np.uint64(32)) % self.lanes, h & np.uint64(0xFFFFFFFF)

    def windows(self, hit: np.ndarray):
        """Positions of the full windows that hold one of the stretches at ``hit``, their lanes and hashes."""
        marks = np.zeros(self.n + 1, np.int64)
        marks[hit + 1] = 1
        marks = np.cumsum(marks)
        at = np.flatnonzero(self.left >= self.window)
        at = at[marks[at + self.window - self.block + 1] > marks[at]]
        return at, self.digest(at, self.window, 0) % self.lanes, self.digest(at, self.window, 1)


def squeeze(values: np.ndarray) -> bytes:
    """Sorted numbers as their differences, byte planes apart, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), -1).T).tobytes())


def unsqueeze(data: bytes, amount: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(-1, amount)
    steps = np.ascontiguousarray(planes.T).view(f"<u{planes.shape[0]}").ravel()
    return np.cumsum(steps, dtype=steps.dtype)


def entries(lane: np.ndarray, value: np.ndarray):
    """Distinct (lane, value) in that order; which of them each input is; how often each occurs; bounds of the lanes."""
    order = np.lexsort((value, lane))
    lane, value = lane[order], value[order]
    new = np.ones(len(order), bool)
    new[1:] = (lane[1:] != lane[:-1]) | (value[1:] != value[:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    lanes, first = np.unique(lane[new], return_index=True)
    return value[new], which, np.bincount(which, minlength=int(new.sum())), list(zip(lanes.tolist(), first.tolist(), [*first.tolist()[1:], int(new.sum())]))


def sent_rows(pack: int, lane: np.ndarray, value: np.ndarray, aligned: np.ndarray | None, kind: np.dtype) -> list[tuple]:
    values, which, times, bounds = entries(lane, value)
    block = np.ones(len(values), bool)
    if aligned is not None:
        block = np.bincount(which, weights=aligned, minlength=len(values)) > 0
    return [(k, pack, b - a, squeeze(values[a:b].astype(kind)), np.packbits(block[a:b]).tobytes(), np.packbits(times[a:b] > 1).tobytes())
            for k, a, b in bounds]


def as_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(schema), schema)], schema=schema)


SENT = pa.schema([("lane", pa.int64()), ("pack", pa.int64()), ("amount", pa.int64()), ("entries", pa.binary()), ("aligned", pa.binary()), ("several", pa.binary())])
REPLY = pa.schema([("kind", pa.int32()), ("pack", pa.int64()), ("lane", pa.int64()), ("hits", pa.binary())])


def answer(kind: int):
    """For the rows of one lane: one bit per entry, whether it is a block somewhere and occurs in two places."""
    def run(table: pa.Table) -> pa.Table:
        lane, packs, amounts = table["lane"][0].as_py(), table["pack"].to_pylist(), table["amount"].to_pylist()
        values = np.concatenate([unsqueeze(d, n) for d, n in zip(table["entries"].to_pylist(), amounts)])
        bits = [np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8), count=n) for d, n in zip(table[c].to_pylist(), amounts)]).astype(bool)
                for c in ("aligned", "several")]
        order = np.argsort(values, kind="stable")
        ranked = values[order]
        first = np.ones(len(order), bool)
        first[1:] = ranked[1:] != ranked[:-1]
        group = np.cumsum(first) - 1
        n = int(first.sum())
        block = np.bincount(group, weights=bits[0][order], minlength=n) > 0
        twice = (np.bincount(group, minlength=n) > 1) | (np.bincount(group, weights=bits[1][order], minlength=n) > 0)
        hit = np.empty(len(order), bool)
        hit[order] = (block & twice)[group]
        rows, at = [], 0
        for pack, amount in zip(packs, amounts):
            part = hit[at:at + amount]
            at += amount
            if part.any():
                rows.append((kind, pack, lane, np.packbits(part).tobytes()))
        return as_table(rows, REPLY)
    return run


def hits_of(replies: pa.Table, kind: int, lane: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which of the inputs got a positive answer."""
    values, which, _, bounds = entries(lane, value)
    got = {k: h for t, k, h in zip(replies["kind"].to_pylist(), replies["lane"].to_pylist(), replies["hits"].to_pylist()) if t == kind}
    hit = np.zeros(len(values), bool)
    for k, a, b in bounds:
        if k in got:
            hit[a:b] = np.unpackbits(np.frombuffer(got[k], np.uint8), count=b - a)
    return hit[which]


def remove_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept`` (the words left, by one space)."""
    packs = pack_documents(docs, text, pack_bytes)
    total = packs.agg(F.sum("n_words")).first()[0] or 0
    lanes = int(total // LANE_WINDOWS) + int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pack = Pack(batch.column(1)[k].as_py(), window, lanes)
                at, lane, value = pack.anchors()
                rows = sent_rows(batch.column(0)[k].as_py(), lane, value, pack.aligned[at], np.dtype("<u4"))
                yield from as_table(rows, SENT).to_batches()

    def extend(left: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        for k in range(left.num_rows if replies.num_rows else 0):
            pack = Pack(left["words"][k].as_py(), window, lanes)
            at, lane, value = pack.anchors()
            _, lane, value = pack.windows(at[hits_of(replies, 0, lane, value)])
            rows += sent_rows(left["pack"][k].as_py(), lane, value, None, np.dtype("<u8"))
        return as_table(rows, SENT)

    def cut(left: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for k in range(left.num_rows):
            pack = Pack(left["words"][k].as_py(), window, lanes)
            covered = np.zeros(pack.n + 1, np.int64)
            if replies.num_rows:
                at, lane, value = pack.anchors()
                at, lane, value = pack.windows(at[hits_of(replies, 0, lane, value)])
                at = at[hits_of(replies, 1, lane, value)]
                np.add.at(covered, at, 1)
                np.add.at(covered, at + window, -1)
            gone = np.cumsum(covered[:-1]) > 0
            for doc_id, words, start in zip(left["doc_ids"][k].as_py(), pack.documents, pack.starts.tolist()):
                lost = gone[start:start + len(words)]
                kept = [w for w, x in zip(words, lost.tolist()) if not x] if lost.any() else words
                out.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
        return as_table(out, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    sent = packs.select("pack", "words").mapInArrow(probe, SENT_SCHEMA)
    anchored = settle(sent.groupBy("lane").applyInArrow(answer(0), REPLY_SCHEMA), "anchor-hits")
    by_pack = packs.select("pack", "words").groupBy("pack")
    sent = by_pack.cogroup(anchored.groupBy("pack")).applyInArrow(extend, SENT_SCHEMA)
    repeated = settle(sent.groupBy("lane").applyInArrow(answer(1), REPLY_SCHEMA), "window-hits")
    # packs without a repeated window need no anchors either
    replies = anchored.join(repeated.select("pack").distinct(), "pack", "left_semi").unionByName(repeated)
    return packs.select("pack", "doc_ids", "words").groupBy("pack").cogroup(replies.groupBy("pack")).applyInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string")
