"""Token-id files: every id in the fewest bits that hold the vocabulary.

A file is a header, blocks of BLOCK ids packed bit by bit, each block beginning
at a whole byte, the offsets of the blocks, and an index of its documents (id,
first token, number of tokens). A reader unpacks whole blocks with numpy and
reaches any span of tokens through the offsets, without reading what is
before it.

Documents are dealt into shards by ascending id; a task sorts, encodes and
packs its shards, keeping one block of ids in memory, and gives a file its
name when it is complete. Only one row a shard (its numbers of documents and
ids) is needed to know where each shard starts in the whole.

Defined cases: a null or empty text is only its end id; documents without an
id come first, marked so in the index; rows with equal ids are ordered by
their text; columns other than doc_id and text are not read; an empty table
gives a store without files.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierloom.llm import files
from tierloom.llm.common import per_worker, vocabulary_path
from tierloom.llm.pieces import EncodeMany, PieceEncoder
from tierloom.sources.storage import scratch_path

MAGIC = b"TIERTOK1"
#: Ids of a block; a multiple of eight, so that blocks end at whole bytes.
BLOCK = 1 << 16
#: Documents that are encoded together.
TOGETHER = 512
MANIFEST = "shard int, file string, docs long, ids long, bytes long"

Batches = Iterator[pa.RecordBatch]


def bits_for(vocabulary: int) -> int:
    """Fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids, lowest bit first, without gaps between them."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(each.ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a block."""
    if bits in (8, 16, 32):
        return np.frombuffer(packed, f"<u{bits // 8}", count).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(packed, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = each
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


class ShardWriter:
    """One file; ids come in any portions."""

    def __init__(self, out, bits: int, vocabulary: int) -> None:
        self.out, self.bits = out, bits
        self.at = self.ids = 0
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.offsets: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray]] = []
        self._put(MAGIC + json.dumps({"bits": bits, "block": BLOCK, "vocabulary": vocabulary}).encode() + b"\n")

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _blocks(self, least: int) -> None:
        ids = np.concatenate([np.empty(0, np.uint32), *self.waiting])
        cut = 0
        while len(ids) - cut >= least and cut < len(ids):
            self.offsets.append(self.at)
            self._put(pack(ids[cut : cut + BLOCK], self.bits))
            cut += BLOCK
        self.waiting = [ids[cut:]]
        self.held = len(self.waiting[0])

    def add(self, doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents (ids as masked longs, sizes in tokens) and their tokens."""
        self.docs.append((doc_ids, sizes))
        self.waiting.append(ids.astype(np.uint32))
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= BLOCK:
            self._blocks(BLOCK)

    def close(self) -> tuple[int, int]:
        """Write what is left and the index; returns the numbers of documents and ids."""
        self._blocks(1)
        doc_ids = np.ma.concatenate([x[0] for x in self.docs])
        sizes = np.concatenate([x[1] for x in self.docs])
        index = self.at
        self._put(np.array(self.offsets, "<i8").tobytes())
        self._put(doc_ids.filled(0).astype("<i8").tobytes())
        self._put(np.ma.getmaskarray(doc_ids).astype(np.uint8).tobytes())
        self._put(sizes.astype("<i8").tobytes())
        self._put(np.array([index, len(self.offsets), len(sizes), self.ids], "<i8").tobytes() + MAGIC)
        return len(sizes), self.ids


class ShardReader:
    """Random access to one file (an open input file of a pyarrow file system)."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(source.size() - 32 - len(MAGIC))
        tail = source.read()
        if tail[32:] != MAGIC:
            raise ValueError("not a token file")
        index, blocks, docs, self.ids = np.frombuffer(tail[:32], "<i8").tolist()
        source.seek(0)
        head = json.loads(source.read(128)[len(MAGIC) :].split(b"\n")[0])
        self.bits, self.block = head["bits"], head["block"]
        source.seek(index)
        self.offsets = np.frombuffer(source.read(8 * blocks), "<i8")
        values = np.frombuffer(source.read(8 * docs), "<i8")
        self.doc_ids = np.ma.array(values, mask=np.frombuffer(source.read(docs), np.uint8).astype(bool))
        self.sizes = np.frombuffer(source.read(8 * docs), "<i8")
        self.starts = np.cumsum(self.sizes) - self.sizes

    def span(self, first: int, count: int) -> np.ndarray:
        """Tokens ``first`` to ``first + count`` of the file; reads only their blocks."""
        if not count:
            return np.empty(0, np.uint32)
        start, stop = first // self.block, -(-(first + count) // self.block)
        found = []
        for block in range(start, stop):
            n = min(self.block, self.ids - block * self.block)
            self.source.seek(int(self.offsets[block]))
            found.append(unpack(self.source.read(-(-n * self.bits // 8)), self.bits, n))
        begin = first - start * self.block
        return np.concatenate(found)[begin : begin + count]


#: Characters that the library encodes as one string.
JOINED = 1 << 14


def _joined(texts: list[str]) -> list[list[str]]:
    """Texts in groups that may be encoded as one string: each but a group's first begins where a text may be cut."""
    groups: list[list[str]] = []
    size = JOINED
    for text in texts:
        if size >= JOINED or not (text[:1] in (" ", "\n") and len(text) > 1 and not text[1].isspace()):
            groups.append([])
            size = 0
        groups[-1].append(text)
        size += len(text)
    return groups


def library_encoder(path: str) -> tuple[EncodeMany, int]:
    """Batch encoder of a byte-level tokenizer file, and its vocabulary's size; special tokens' strings are ordinary text.

    The library spends more on a string than on its tokens, so texts go to it
    joined; the bytes of the tokens tell where each text ends.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads would only wait for it
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    vocabulary = tokenizer.get_vocab()
    n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
    n_bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # one character stands for a byte

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = ["".join(group) for group in _joined(texts)]
        ids = [found.ids for found in tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, sum(map(len, ids)))
        token_ends = np.cumsum(n_bytes[flat])
        text_ends = np.cumsum(np.fromiter((len(text.encode()) for text in texts), np.int64, len(texts)))
        until = np.searchsorted(token_ends, text_ends, "right")
        if (np.concatenate([[0], token_ends])[until] != text_ends).any():
            raise ValueError(f"{path} does not cut texts as byte-level tokenizers do")
        return flat, np.diff(until, prepend=0)

    return encode, tokenizer.get_vocab_size()


def _pieces(path: str) -> tuple[PieceEncoder, int]:
    encode, vocabulary = library_encoder(path)
    return PieceEncoder(encode, 1 << 19), vocabulary


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each document."""
    return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1


def write(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Encode all texts into token files below ``folder``; returns the committed manifest."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, shards = files.with_shard(rows, "doc_id", F.octet_length("text") + 1, "shard")
    manifest = pa.schema(
        [("shard", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]
    )

    def save(batches: Batches) -> Batches:
        pieces, vocabulary = per_worker(("token store", path), lambda: _pieces(path))
        bits = bits_for(vocabulary)
        done: list[dict] = []
        shard, file, writer = None, None, None

        def close() -> None:
            n_docs, n_ids = writer.close()
            file.__exit__(None, None, None)
            done.append({"shard": shard, "file": name(shard), "docs": n_docs, "ids": n_ids, "bytes": writer.at})

        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            for own in np.unique(numbers):
                first, last = np.searchsorted(numbers, own), np.searchsorted(numbers, own, "right")
                if own != shard:
                    if writer:
                        close()
                    shard, file = int(own), files.committed(folder, name(own))
                    writer = ShardWriter(file.__enter__(), bits, vocabulary)
                for at in range(first, last, TOGETHER):
                    part = batch.slice(at, min(TOGETHER, last - at))
                    ids, sizes = with_end(*pieces.encode(part.column("text").to_pylist()), end_id)
                    keys = part.column("doc_id")
                    missing = keys.is_null().to_numpy(zero_copy_only=False)
                    writer.add(np.ma.array(keys.fill_null(0).to_numpy(), mask=missing), sizes, ids)
        if writer:
            close()
        yield pa.RecordBatch.from_pylist(done, manifest)

    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "text")
    listed = f"{folder}/_manifest"
    ordered.select("shard", "doc_id", "text").mapInArrow(save, MANIFEST).write.parquet(listed)
    files.clear_temporary(folder)
    return docs.sparkSession.read.parquet(listed)


def name(shard: int) -> str:
    return f"tokens-{int(shard):06d}.bin"


def read_documents(spark: SparkSession, folder: str, result: str, make: Callable[[np.ndarray], object]) -> DataFrame:
    """One row per document of the store: doc_id, start, n_tokens, and ``make`` of its ids as ``result`` (name type).

    Spans of about a million tokens are unpacked at once, whatever the documents' sizes.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    listed = spark.read.parquet(f"{folder}/_manifest")
    listed = listed.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))

    def load(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                store, root = files.open_place(folder)
                with store.open_input_file(f"{root}/{row['file']}") as source:
                    reader = ShardReader(source)
                    ends = np.cumsum(reader.sizes)
                    first = 0
                    while first < len(ends):
                        start = int(reader.starts[first])
                        last = max(first + 1, int(np.searchsorted(ends, start + (1 << 20), "right")))
                        ids = reader.span(start, int(ends[last - 1]) - start)
                        cut = np.split(ids, ends[first : last - 1] - start)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids.data[first:last], mask=np.ma.getmaskarray(reader.doc_ids)[first:last]),
                                pa.array(reader.starts[first:last] + row["before"]),
                                pa.array(reader.sizes[first:last]),
                                pa.array([make(x) for x in cut]),
                            ],
                            ["doc_id", "start", "n_tokens", result.split()[0]],
                        )
                        first = last

    return listed.repartition(max(1, listed.count()), "file").mapInArrow(load, f"doc_id long, start long, n_tokens long, {result}")


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def round_trip(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Write all documents to a new store in the shared folder and read them back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch_path(docs.sparkSession)
    write(docs, folder, vocabulary_path(tokenizer), end_id)
    return read_documents(docs.sparkSession, folder, "ids_crc32 long", ids_crc32)
