from __future__ import annotations

import base64
import hashlib
import os
import random
import time
import zlib

import numpy as np
import pytest
import tokenizers

from tierloom.llm import bpe, pieces, token_store
from tierloom.llm.common import load_ranks, vocabulary_path
from tierloom.llm.files import open_place

DOCS = "doc_id long, text string"
PARTS = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x1c", " ", "　", "\x85", "'s", "'ll", "a", "Foo", "12", "é", "日本",
    "!", "...", "<|endoftext|>", "\x00", "😀", "the", "thethe" * 30,
]


def hard_texts(count, seed=8):
    random.seed(seed)
    return ["".join(random.choices(PARTS, k=random.randrange(12))) for _ in range(count)] + [""]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    ranks = load_ranks(vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def duck(ranks=None):
    import public_tokenizers

    return bpe.DuckBpe(ranks or load_ranks(vocabulary_path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


@pytest.mark.parametrize("bits", [1, 2, 7, 8, 11, 16, 17, 32])
def test_packing(bits):
    ids = np.random.default_rng(1).integers(0, 1 << bits, 1000, np.uint64).astype(np.uint32)
    packed = token_store.pack(ids, bits)
    assert len(packed) == -(-1000 * bits // 8)
    assert (token_store.unpack(packed, bits, 1000) == ids).all()


def test_fewest_bits():
    assert [token_store.bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize(("segment", "remembered"), [(1 << 21, 1 << 18), (37, 1 << 18), (37, 50)])
def test_pieces_encode_as_the_library_does(monkeypatch, segment, remembered):
    monkeypatch.setattr(pieces, "SEGMENT", segment)
    encode, _ = token_store.library_encoder(vocabulary_path("byte_bpe_50k.json"))
    library = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    own, texts = pieces.PieceEncoder(encode, remembered), hard_texts(1500)
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        ids, sizes = own.encode(part)
        want = [found.ids for found in library.encode_batch(part, add_special_tokens=False)]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [x for found in want for x in found]


def test_words_remembered_within_bounds(tiktoken_encoding):
    own = duck()
    own.remembered = 40
    encoder = pieces.PieceEncoder(own.encode_many, 60)
    for text in hard_texts(200, 9):
        ids, sizes = encoder.encode([text, text])
        assert ids.tolist() == 2 * tiktoken_encoding.encode_ordinary(text)
        assert len(own.known) <= 40 and len(encoder.known) <= 60


def test_long_words_merge_as_short_ones_do(tiktoken_encoding):
    random.seed(10)
    words = ["".join(random.choices("abcthe", k=random.randrange(1, 700))) for _ in range(25)]
    words += ["a" * 900, "the" * 300, "é" * 400, "日本" * 100]
    own = duck()
    ids, sizes = own.encode_many(words)
    cut = np.split(ids, np.cumsum(sizes)[:-1])
    assert [x.tolist() for x in cut] == [tiktoken_encoding.encode_ordinary(word) for word in words]
    texts = [bytes.fromhex(x).decode() for x in own.decode_many(ids, sizes)]
    assert texts == words


@pytest.mark.parametrize("unit, times", [("z", 100000), ("字", 100000), ("=", 100000), ("ab", 100000), ("न", 30000), ("ing", 20000)])
def test_runs_merge_in_few_rounds(tiktoken_encoding, unit, times):
    started = time.monotonic()
    ids, _ = duck().encode_many([unit * times])
    assert time.monotonic() - started < 60
    assert ids.tolist() == tiktoken_encoding.encode_ordinary(unit * times)


def test_runs_of_changing_units(tiktoken_encoding):
    random.seed(4)
    units = ["ab", "ing", "the", "=-", "z", "字文", "aeiou", "0123", "na"]
    words = []
    for _ in range(60):
        unit = random.choice(units)
        words.append("".join(random.choice(unit) * random.randint(1, random.choice([1, 3, 40])) for _ in range(80)))
    ids, _ = duck().encode_many(words)
    assert ids.tolist() == [x for word in words for x in tiktoken_encoding.encode_ordinary(word)]


def test_decoding_in_portions(monkeypatch, tiktoken_encoding):
    monkeypatch.setattr(bpe, "QUERY_TOKENS", 7)
    texts = hard_texts(60)
    ids = [tiktoken_encoding.encode_ordinary(text) for text in texts]
    flat = np.array([x for own in ids for x in own], np.uint32)
    assert [bytes.fromhex(x).decode() for x in duck().decode_many(flat, np.array(list(map(len, ids))))] == texts


def document_rows():
    rows = [(i * 7919 % 1000, text) for i, text in enumerate(hard_texts(150))]
    return rows + [(None, None), (None, "x"), (5, "twice"), (5, "twice"), (2000, "long text " * 30000)]


def test_bpe_round_trip(spark, tiktoken_encoding):
    rows = document_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted(map(tuple, bpe.round_trip(docs).collect()), key=str)
    want = []
    for doc_id, text in rows:
        ids = np.array(tiktoken_encoding.encode_ordinary(text or ""), "<u4")
        plain = hashlib.sha256((text or "").encode()).hexdigest()
        want.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), plain))
    assert got == sorted(want, key=str)


def test_bpe_columns(spark, tiktoken_encoding):
    docs = spark.createDataFrame([(1, "hello world", 5), (2, None, 6)], "doc_id long, text string, ids int")
    out = bpe.encode(docs, decode=True)
    assert out.columns == ["doc_id", "text", "ids", "_ids", "decoded"]
    rows = {row.doc_id: row for row in out.collect()}
    assert rows[1]["_ids"] == tiktoken_encoding.encode_ordinary("hello world") and rows[1].decoded == "hello world"
    assert rows[2]["_ids"] == [] and rows[2].decoded == "" and rows[2]["ids"] == 6
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_store_round_trip(spark):
    rows = document_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(4).withColumn("shard", docs_extra())
    encode, _ = token_store.library_encoder(vocabulary_path("byte_bpe_50k.json"))
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or "")):
        ids = [*encode([text or ""])[0].tolist(), 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_store.round_trip(docs).collect()), key=lambda row: row[1])
    assert got == want


def docs_extra():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_store_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store.files, "SMALLEST", 2000)
    rows = [(i, f"document {i} " * (i % 9 + 1)) for i in range(500)]
    docs, folder = spark.createDataFrame(rows, DOCS), str(tmp_path / "store")
    path = vocabulary_path("byte_bpe_50k.json")
    manifest = token_store.write(docs, folder, path, 2).orderBy("shard").collect()
    assert len(manifest) > 5 and sum(row.docs for row in manifest) == 500
    assert sorted(x for x in os.listdir(folder) if x.endswith((".bin", ".tmp"))) == [row.file for row in manifest]
    encode, vocabulary = token_store.library_encoder(path)
    assert vocabulary == 50257
    expected = iter(rows)
    for row in manifest:
        store, root = open_place(folder)
        with store.open_input_file(f"{root}/{row.file}") as source:
            reader = token_store.ShardReader(source)
            assert reader.bits == 16 and reader.ids == row.ids
            for number in range(row.docs):
                doc_id, text = next(expected)
                span = reader.span(int(reader.starts[number]), int(reader.sizes[number]))
                assert reader.doc_ids[number] == doc_id and span.tolist() == [*encode([text])[0].tolist(), 2]
    again = str(tmp_path / "again")
    token_store.write(docs.repartition(3), again, path, 2)
    for row in manifest:
        with open(f"{folder}/{row.file}", "rb") as one, open(f"{again}/{row.file}", "rb") as other:
            assert one.read() == other.read()


def test_reader_crosses_blocks(tmp_path):
    import pyarrow as pa

    ids = np.arange(3 * token_store.BLOCK + 17, dtype=np.uint32) % 40000
    with pa.OSFile(str(tmp_path / "x.bin"), "wb") as out:
        writer = token_store.ShardWriter(out, 17, 40000)
        for part in np.array_split(ids, 7):
            writer.add(np.ma.array([1]), np.array([len(part)]), part)
        assert writer.close() == (7, len(ids))
    with pa.OSFile(str(tmp_path / "x.bin")) as source:
        reader = token_store.ShardReader(source)
        for first, count in ((0, 5), (token_store.BLOCK - 3, 9), (10, 2 * token_store.BLOCK), (len(ids) - 4, 4), (5, 0)):
            assert (reader.span(first, count) == ids[first : first + count]).all()


def test_empty_store(spark):
    assert token_store.round_trip(spark.createDataFrame([], DOCS)).count() == 0


def test_ranks_are_read(tmp_path):
    (tmp_path / "r").write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)))
    ids, sizes = duck(load_ranks(str(tmp_path / "r"))).encode_many(["é a"])
    assert ids.tolist() == list("é a".encode()) and sizes.tolist() == [4]
