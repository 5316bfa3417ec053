"""BPE encoding and decoding (operator 1).

Method: contiguous rank array. A short word is held as its part boundaries, the ids of its parts and the merge ranks
of adjacent parts. The smallest rank is searched by scanning, the boundary there is deleted and the two ranks beside it
are looked up again, until no rank is left. Words of more than ``SCAN_BYTES`` bytes take their merges from a heap
instead, in the same order and with the same result, as repeated scans of a long array would take quadratic time.

Python on Arrow batches: the merges of one word depend on each other, and words repeat, so each worker keeps a bounded
memo of words. No shuffle; a lost executor costs its own tasks.

Defined cases: null text counts as empty and gives no ids and the empty text; other columns pass through unless the
result has one of that name (``ids``, ``decoded``), which is replaced; repeated rows are encoded row by row.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from docloom.llm.common import Memo

SCAN_BYTES = 256
#: Fixed value: the pre-tokenization pattern that the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = 1 << 60


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ByteBpe:
    """A byte-level vocabulary file, its merges and its added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
        chars = byte_chars()
        code = {c: b for b, c in chars.items()}
        self.byte_ids = [vocab[chars[b]] for b in range(256)]
        self.ranks = {vocab[a] << 20 | vocab[b]: i for i, (a, b) in reversed(list(enumerate(merges)))}
        self.merged = [vocab[a + b] for a, b in merges]
        self.token_bytes = {i: bytes(code[c] for c in t) for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes |= {i: t.encode() for t, i in self.added.items()}
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.pieces = regex.compile(PATTERN).findall
        self.unsafe_space = regex.compile(r" (?=\s|$)").search
        self.split_safe = regex.compile(r" (?=\S)").split
        self.units = Memo(lambda unit: self.encode_unit(" " + unit))

    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one pre-tokenized word."""
        if len(word) > SCAN_BYTES:
            return self.merge_long(word)
        bounds = list(range(len(word) + 1))
        ids = [self.byte_ids[b] for b in word]
        rank_of = self.ranks.get
        ranks = [rank_of(a << 20 | b, NO_RANK) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            ids[at] = self.merged[least]
            del bounds[at + 1], ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of(ids[at - 1] << 20 | ids[at], NO_RANK)
            if at < len(ranks):
                ranks[at] = rank_of(ids[at] << 20 | ids[at + 1], NO_RANK)
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """As ``merge_word``: smallest rank first, leftmost of equals, with a heap over linked parts."""
        ids: list[int | None] = [self.byte_ids[b] for b in word]
        n, rank_of = len(ids), self.ranks.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = self.merged[rank], None, right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := rank_of(ids[x] << 20 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i is not None]

    def encode_unit(self, unit: str) -> tuple[int, ...]:
        return tuple(i for piece in self.pieces(unit) for i in self.merge_word(piece.encode("utf-8", "surrogatepass")))

    def encode_plain(self, text: str) -> list[int]:
        """Ids of a text without added tokens.

        A space before a visible character always begins a word of the pattern, so
        the text falls into units there that are encoded, and remembered, on their own.
        """
        first, *rest = self.split_safe(text) if self.unsafe_space(text) else text.split(" ")
        ids = list(self.encode_unit(first))
        units, add = self.units, ids.extend
        for unit in rest:
            add(units[unit])
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.split_added is None or "<" not in text:
            return self.encode_plain(text)
        ids: list[int] = []
        for i, part in enumerate(self.split_added.split(text)):
            if part:
                ids.extend([self.added[part]] if i % 2 else self.encode_plain(part))
        return ids

    def decode(self, ids: list[int] | None) -> str:
        token = self.token_bytes
        return b"".join([token[i] for i in ids or () if i in token]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> ByteBpe:
    return ByteBpe(path)


def _mapped(df: DataFrame, source: str, result: dict[str, tuple[T.DataType, pa.DataType]], step) -> DataFrame:
    """``df`` with the columns of ``result``, which ``step`` computes from the Python values of ``source``."""
    kept = [c for c in df.columns if c.lower() not in result]
    given = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias("_in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                made = step(part.column(part.num_columns - 1).to_pylist())
                arrays = [pa.array(v, t) for v, (_, t) in zip(made, result.values())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], names=[*kept, *result])

    added = [T.StructField(name, kind) for name, (kind, _) in result.items()]
    return given.mapInArrow(run, T.StructType([*given.drop("_in").schema.fields, *added]))


IDS, TEXT = (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), (T.StringType(), pa.string())


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array of int): the whole text's ids; added tokens in the text are recognized, none are put in."""
    return _mapped(df, text, {"ids": IDS},
                   lambda texts: [[vocabulary(path).encode(t) for t in texts]])


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of the ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
    return _mapped(df, ids, {"decoded": TEXT},
                   lambda lists: [[vocabulary(path).decode(x) for x in lists]])


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``decode(encode(df))`` in one pass over Python: adds ``ids`` and ``decoded``."""
    def step(texts):
        bpe = vocabulary(path)
        lists = [bpe.encode(t) for t in texts]
        return lists, [bpe.decode(x) for x in lists]

    return _mapped(df, text, {"ids": IDS, "decoded": TEXT}, step)
