"""BPE and token files against the tokenizers library, and exact round trips."""

import random
import zlib

import numpy as np
import pytest
from helpers import awkward, clashing, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docloom.llm import bpe, token_files
from docloom.llm.common import new_folder
from docloom.llm.queries import encoded_digests, tokenizer_path

BYTES, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def test_merges_as_the_library_on_odd_strings():
    mine, library = bpe.ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    draw = random.Random(5)
    letters = "ab é\n\t 'sT19<|endoftext|>!   ́中🎉"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|>", " <|endoftext|> x", "".join(draw.choice("abcd") for _ in range(3000)), "é" * 700]
    for t in texts:
        ids = mine.encode(t)
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False) == t


def test_long_words_merge_as_short_ones(monkeypatch):
    mine = bpe.ByteBpe(BYTES)
    draw = random.Random(1)
    for _ in range(300):
        word = "".join(draw.choice("etaoin shrdlu") for _ in range(draw.randint(1, 200))).encode()
        assert mine.merge_long(word) == mine.merge_word(word)


def test_partial_bytes_decode_as_the_library():
    mine, library = bpe.ByteBpe(BYTES), Tokenizer.from_file(BYTES)
    ids = mine.encode("é中🎉 x")
    for k in range(len(ids)):
        assert mine.decode(ids[k:]) == library.decode(ids[k:], skip_special_tokens=False)


def test_encode_decode_columns(spark):
    docs = clashing(awkward(spark))
    rows = bpe.decode(bpe.encode(docs, BYTES), BYTES)
    assert rows.count() == docs.count()
    assert rows.where("NOT decoded <=> coalesce(text, '')").isEmpty()
    assert "kept" in rows.columns and rows.schema["ids"].dataType.simpleString() == "array<int>"
    both = bpe.round_trip(docs, BYTES)
    assert both.where("NOT decoded <=> coalesce(text, '')").isEmpty()
    assert encoded_digests(empty(spark), BYTES).count() == 0


def test_query_equals_library(spark, sf):
    library = Tokenizer.from_file(BYTES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in encoded_digests(docs, BYTES).collect()}
    import hashlib
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def library_ids(text):
    return Tokenizer.from_file(PIECES).encode(text or "", add_special_tokens=False).ids + [1]


def test_token_files_hold_the_library_ids(spark):
    docs = clashing(awkward(spark))
    folder = new_folder(spark, "test-files")
    token_files.write_files(docs, folder, PIECES, file_bytes=3000)
    rows = token_files.stored_documents(spark, folder).collect()
    rows.sort(key=lambda r: r["start"])
    want = sorted([(r["doc_id"] is not None, r["doc_id"] or 0, r["text"]) for r in docs.collect()], key=lambda x: x[:2])
    assert [r["doc_id"] for r in rows] == [i if known else None for known, i, _ in want]
    start = 0
    for r, (_, _, text) in zip(rows, want):
        ids = library_ids(text)
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    some = {r["doc_id"]: bytes(r["ids"]) for r in token_files.read_files(spark, folder, [7, 12]).collect()}
    assert some.keys() == {7, 12} and all(np.frombuffer(v, "<u4").tolist() == library_ids(t) for _, i, t in want for v in [some.get(i)] if v)


def test_empty_table_gives_no_documents(spark):
    folder = new_folder(spark, "test-files")
    token_files.write_files(empty(spark), folder, PIECES)
    assert token_files.stored_documents(spark, folder).count() == 0


def test_frames_are_independent_and_checked():
    docs = [(None, np.array([70_000, 1])), (3, np.arange(10)), (4, np.array([], dtype=np.int64)), (9, np.arange(5))]
    data = token_files.pack(docs, frame_ids=4)
    assert [(d, ids.tolist()) for d, ids in token_files.unpack(data)] == [(d, ids.tolist()) for d, ids in docs]
    assert [d for d, _ in token_files.unpack(data, {9})] == [9]
    broken = bytearray(data)
    broken[len(token_files.zstandard.ZstdCompressor(level=3, write_checksum=True).compress(b"")) // 2 + 8] ^= 1
    with pytest.raises(token_files.DamagedFile):
        list(token_files.unpack(bytes(broken)))
    with pytest.raises(token_files.DamagedFile):
        list(token_files.unpack(data[:-1]))
    assert [d for d, _ in token_files.unpack(bytes(broken), {9})] == [9]  # its frame is whole


def test_other_tools_read_the_frames():
    import zstandard

    data = token_files.pack([(1, np.arange(100)), (2, np.arange(7))], frame_ids=10)
    reader = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True)
    assert np.frombuffer(reader.read(), "<u2").tolist() == [*range(100), *range(7)]
