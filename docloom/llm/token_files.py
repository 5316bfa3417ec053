"""Token ids in binary files of independent zstandard frames (operator 7).

Layout of a file, all numbers little-endian:

    frame 1 | frame 2 | ... | seek table

Each frame is a complete zstandard frame with its content checksum, holding the ids of consecutive documents as unsigned
16- or 32-bit integers. The seek table is a skippable zstandard frame, so that any zstandard tool reads the file; it
holds a header (document count, frame count, bytes per id, first document's null flag), per frame its offset, size, first
document and a CRC-32 of the compressed bytes, per document its id and its number of ids, and a tail: the table's length
and the magic ``DLTOK1`` with a line end. A reader takes the tail, then the table, then only the frames that hold the
wanted documents.

Spark does the work: documents are range partitioned by ``doc_id``, each task encodes its range and cuts it into files
of about ``FILE_BYTES``, and Spark's own writer and its commit protocol put each into a file of its own in the shared
folder. An executor that is lost costs its range. Readers get the files through Spark's ``binaryFile`` source.

Defined cases: null text counts as empty (only the end id); a null ``doc_id`` comes first; documents with the same
``doc_id`` are ordered by a hash of their text and keep one entry each; an empty table gives no files and an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docloom.llm.common import guarded, settle

FRAME_IDS = 1 << 16
FILE_BYTES = 16 << 20
SKIPPABLE = 0x184D2A5E
MAGIC = b"DLTOK1\n"
#: How the vocabulary cuts lower-cased text, written out for Latin-1; white space is dropped.
LETTERS, NUMBERS, BLANKS = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t\n\x0b\x0c\r \x85\xa0"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{BLANKS}{LETTERS}{NUMBERS}]+")
HEAD = struct.Struct("<IIII")
FRAME = struct.Struct("<QIII")
DOC = struct.Struct("<QQ")
TAIL = struct.Struct("<I7s")


class DamagedFile(ValueError):
    """A checksum or a length in a token file is wrong."""


def pack(docs: Sequence[tuple[int | None, np.ndarray]], frame_ids: int = FRAME_IDS) -> bytes:
    """A whole file of (doc_id, ids) pairs, null ids first."""
    wide = max([0, *(int(ids.max()) for _, ids in docs if len(ids))]) > 0xFFFF
    kind = np.dtype("<u4" if wide else "<u2")
    press = zstandard.ZstdCompressor(level=3, write_checksum=True)
    frames, body, table, at = [], [], [], 0
    first, held = 0, 0
    group: list[np.ndarray] = []
    for k, (doc_id, ids) in enumerate(docs):
        group.append(ids.astype(kind))
        held += len(ids)
        table.append(DOC.pack((doc_id or 0) & 0xFFFFFFFFFFFFFFFF, len(ids)))
        if held >= frame_ids or k == len(docs) - 1:
            data = press.compress(np.concatenate(group).tobytes())
            frames.append(FRAME.pack(at, len(data), first, zlib.crc32(data)))
            body.append(data)
            at, first, held, group = at + len(data), k + 1, 0, []
    nulls = sum(d is None for d, _ in docs)
    seek = HEAD.pack(len(docs), len(frames), kind.itemsize, nulls) + b"".join(frames) + b"".join(table)
    seek += TAIL.pack(len(seek), MAGIC)
    return b"".join(body) + struct.pack("<II", SKIPPABLE, len(seek)) + seek


def unpack(data: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """The (doc_id, ids) pairs of a file in order; with ``wanted``, only these, and only their frames are decompressed."""
    if len(data) < TAIL.size:
        raise DamagedFile("no seek table")
    length, magic = TAIL.unpack_from(data, len(data) - TAIL.size)
    if magic != MAGIC or length + TAIL.size + 8 > len(data):
        raise DamagedFile("no seek table")
    seek = memoryview(data)[len(data) - TAIL.size - length:]
    n_docs, n_frames, width, nulls = HEAD.unpack_from(seek)
    frames = [FRAME.unpack_from(seek, HEAD.size + k * FRAME.size) for k in range(n_frames)]
    table = np.frombuffer(seek, dtype="<u8", count=2 * n_docs, offset=HEAD.size + n_frames * FRAME.size).reshape(n_docs, 2)
    doc_ids, sizes = table[:, 0].astype("<i8").tolist(), table[:, 1].astype("<i8")
    expand = zstandard.ZstdDecompressor()
    for k, (at, size, first, crc) in enumerate(frames):
        last = frames[k + 1][2] if k + 1 < n_frames else n_docs
        if wanted is not None and not any(d in wanted for d in doc_ids[max(first, nulls):last]):
            continue
        part = data[at:at + size]
        if zlib.crc32(part) != crc:
            raise DamagedFile(f"frame {k}: checksum")
        ids = np.frombuffer(expand.decompress(part), dtype=f"<u{width}").astype("<u4")
        ends = np.cumsum(sizes[first:last])
        if len(ids) != (ends[-1] if len(ends) else 0):
            raise DamagedFile(f"frame {k}: length")
        for i, end in zip(range(first, last), ends.tolist()):
            doc_id = None if i < nulls else doc_ids[i]
            if wanted is None or doc_id in wanted:
                yield doc_id, ids[end - int(sizes[i]):end]


def is_plain(text: str) -> bool:
    """Whether lower-casing and composing characters is the same for a text's pieces as for the text: Latin-1 without added tokens."""
    if "<|" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEncoder:
    """Ids by the tokenizers library, asked once for each distinct piece of text.

    The vocabulary's rules drop white space and never look past it. They cut the rest into pieces by ``PIECES``, each with ids of its own, which the
    library's model is asked for. A text that is not plain is taken apart at its spaces, and the library is asked for each stretch that
    is not plain as a whole. Pieces are remembered in two generations: above ``HELD`` the older one, and what was not asked for since, is forgotten.
    """

    HELD = 300_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {c: spell.pre_tokenize_str(chr(c))[0][0] for c in range(256)}
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ask(self, key: str) -> bytes:
        """Ids of a piece, or of a whole stretch, whose key starts with a space."""
        if key[0] == " ":
            return np.array(self.tokenizer.encode(key[1:], add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.array([t.id for t in self.model.tokenize(key.translate(self.spelling))], dtype="<u4").tobytes()

    @staticmethod
    def keys(text: str | None) -> list[str]:
        if not text:
            return []
        if is_plain(text):
            return PIECES.findall(text.lower())
        out = []
        for unit in text.split(" "):
            out += PIECES.findall(unit.lower()) if is_plain(unit) else [" " + unit]
        return out

    def encode_batch(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of the texts as little-endian unsigned 32-bit integers."""
        rows = [self.keys(t) for t in texts]
        known, old = self.known, self.old
        for row in rows:
            for key in {k for k in row if k not in known}:
                found = old.get(key)
                known[key] = self.ask(key) if found is None else found
        out = [b"".join([known[k] for k in row]) for row in rows]
        if len(known) > self.HELD:
            self.old, self.known = known, {}
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text])[0]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_files(df: DataFrame, folder: str, path: str, end_id: int = 1, text: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Encode every document, append ``end_id`` and write token files to ``folder`` in ascending ``doc_id`` order.

    File names sort in that order. Other columns are not stored.
    """
    given = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = given.repartitionByRange(n, F.col("doc_id").asc_nulls_first())
    ordered = ordered.withColumn("_tie", F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4").tobytes()
        docs: list[tuple[int | None, np.ndarray]] = []
        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc_id, found in zip(part.column(0).to_pylist(), encoder(path).encode_batch(part.column(1).to_pylist())):
                    ids = np.frombuffer(found + end, dtype="<u4")
                    docs.append((doc_id, ids))
                    held += 2 * len(ids) + 16
                    if held >= file_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([pack(docs)], pa.binary())], names=["content"])
                        docs, held = [], 0
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([pack(docs)], pa.binary())], names=["content"])

    # The text writer puts a line end behind each row: it is the last byte of the magic.
    files = ordered.mapInArrow(run, "content binary")
    whole = F.expr(f"CAST(substring(content, 1, length(content) - 1) AS STRING)").alias("value")
    files.select(whole).write.option("maxRecordsPerFile", 1).option("compression", "none").text(folder)


def read_files(spark: SparkSession, folder: str, wanted: Sequence[int] | None = None) -> DataFrame:
    """One row per stored document: ``file`` (its name), ``file_start`` (ids before it in the file), ``doc_id``, ``ids`` (binary, uint32).

    Every checksum is verified. ``wanted`` names the documents to decompress.
    """
    chosen = set(wanted) if wanted is not None else None
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                name = batch.column(0)[row].as_py().rsplit("/", 1)[-1]
                rows, start = [], 0
                for doc_id, ids in unpack(batch.column(1)[row].as_py(), chosen):
                    rows.append((name, start, doc_id, len(ids), ids.tobytes()))
                    start += len(ids)
                    if len(rows) == 1000:
                        yield as_batch(rows)
                        rows = []
                yield as_batch(rows)

    def as_batch(rows):
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["file", "file_start", "doc_id", "n_tokens", "ids"])

    return files.mapInArrow(run, "file string, file_start long, doc_id long, n_tokens long, ids binary")


def stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """From the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32``."""
    rows = read_files(spark, folder).select("file", "file_start", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    rows = settle(rows, "token-index")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = (rows.groupBy("file").agg(F.sum("n_tokens").alias("_n"))
             .select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    bases = settle(bases, "token-bases")
    return rows.join(guarded(bases), "file").select(
        "doc_id", (F.col("_base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")
