"""Line dedup with two Bloom filters.

A first pass hashes the lines' keys, each task keeping every hash once with a
mark if several of its documents have it. The hashes are dealt into blocks of
bounded size; per block one filter holds what was seen once and a second one
what was seen again. The second filter is all that later passes need: lines
it doesn't know cannot repeat and never move. Suspected lines, alone, shuffle
by the SHA-256 of their key for exact confirmation, and the largest id holding
a key is chosen to keep it. Only documents with suspected lines meet the list
of their lines that go.

The second filter is broadcast if its size, known before it is built, is at
most ``BROADCAST_BYTES``. Beyond that, suspected hashes stay a table, and the
lines' hashes and digests meet it in one shuffle; what it doesn't know goes no
further.

Defined cases: a null or empty text is one empty line; rows with one
``doc_id`` are one document, and all its rows lose the same lines; a null id
is a document before all others; only the columns ``doc_id`` and ``text``
are read by the report, and ``clean`` returns the input's columns as they
are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import fresh
from tierloom.sources.storage import materialize

SPACES = " \t\n\x0b\x0c\r"
LEAST_CHARS = 20
LEAST_DOCS = 3
#: Filter bits and probes per hash: about one in 400 unrepeated lines is suspected.
BITS, PROBES = 16, 4
#: Hashes of one block of the filters.
BLOCK = 1 << 17
BROADCAST_BYTES = 64 << 20
#: Documents that are cut into lines at a time.
STEP = 1024
#: Stands for a null id.
NO_ID = -(1 << 63)

Batches = Iterator[pa.RecordBatch]


def steps(batches: Batches) -> Batches:
    """The rows of ``batches``, a few at a time, as texts may be long."""
    return (batch.slice(at, STEP) for batch in batches for at in range(0, batch.num_rows, STEP))


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    """Lines of all texts, the row of each, their keys, and which keys are long enough to count."""
    lists = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), "\n")
    lines = pc.list_flatten(lists)
    rows = pc.list_parent_indices(lists).to_numpy()
    keys = pc.ascii_lower(pc.ascii_trim(lines, characters=SPACES))
    return lines, rows, keys, pc.greater_equal(pc.utf8_length(keys), LEAST_CHARS).to_numpy(zero_copy_only=False)


def key_hashes(keys: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys.to_pylist()), np.uint64, len(keys))


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each hash in a filter, one row per probe."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) + turns * step) % np.uint64(bits)


def known(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter (bytes of 8 bits) may hold each hash."""
    at = probes(hashes, filter_.size * 8)
    return ((filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def add(filter_: np.ndarray, hashes: np.ndarray) -> None:
    at = probes(hashes, filter_.size * 8).ravel()
    np.bitwise_or.at(filter_, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def local_hashes(texts: DataFrame) -> DataFrame:
    """(hash, many): every hash of a partition's lines once; many: several of its documents have it."""

    def scan(batches: Batches) -> Batches:
        found: list[np.ndarray] = []
        for batch in steps(batches):
            _, rows, keys, counts = split_lines(batch.column(0))
            hashes = key_hashes(keys.filter(pa.array(counts)))
            pairs = np.unique(np.rec.fromarrays([hashes, rows[counts]], names="hash,row"))
            found.append(pairs["hash"])
        hashes, times = np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)
        for at in range(0, len(hashes), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[part].view(np.int64)), pa.array(times[part] > 1)], ["hash", "many"]
            )

    return texts.mapInArrow(scan, "hash long, many boolean")


def second_filter(hashes: np.ndarray, many: np.ndarray, size: int) -> np.ndarray:
    """Bytes of the filter of hashes that the first filter knew already, or that are marked ``many``."""
    once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
    add(twice, hashes[many])
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    turn = np.arange(len(ordered)) - np.searchsorted(ordered, ordered)  # the n-th task that has this hash
    for n in range(min(2, turn.max(initial=-1) + 1)):
        round_ = ordered[turn == n]
        add(twice, round_[known(once, round_)])
        add(once, round_)
    return twice


def blocks_of(n: int) -> int:
    return n // BLOCK + 1


def block_filters(hashes: DataFrame, blocks: int, as_hashes: bool) -> DataFrame:
    """Per block the second filter (block, bits), or with ``as_hashes`` the hashes it knows (hash)."""

    def build(block: pa.Table) -> pa.Table:
        own = block["hash"].to_numpy().view(np.uint64)
        twice = second_filter(own, block["many"].to_numpy(zero_copy_only=False), BLOCK * BITS // 8)
        if as_hashes:
            return pa.table({"hash": np.unique(own[known(twice, own)]).view(np.int64)})
        return pa.table({"block": block["block"][:1], "bits": pa.array([twice.tobytes()], pa.binary())})

    dealt = hashes.withColumn("block", F.pmod("hash", F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(build, "hash long" if as_hashes else "block int, bits binary")


Suspect = Callable[[np.ndarray], np.ndarray]


def broadcast_filter(hashes: DataFrame, blocks: int) -> Suspect:
    """Function of hashes that tells which may repeat, over one broadcast copy of all blocks."""
    parts = {row.block: row.bits for row in block_filters(hashes, blocks, False).toLocalIterator()}
    empty = bytes(BLOCK * BITS // 8)
    shared = hashes.sparkSession.sparkContext.broadcast(b"".join(parts.get(i, empty) for i in range(blocks)))

    def suspect(own: np.ndarray) -> np.ndarray:
        filters = np.frombuffer(shared.value, np.uint8)
        size = filters.size // blocks
        at = probes(own, size * 8)
        first = (own.view(np.int64) % blocks).astype(np.uint64) * np.uint64(size)
        return ((filters[first + (at >> np.uint64(3))] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)

    return suspect


def key_rows(docs: DataFrame, suspect: Suspect | None) -> DataFrame:
    """(doc_id, hash, digest) of each document's countable lines, or of the suspected ones only."""

    def scan(batches: Batches) -> Batches:
        for batch in steps(batches):
            _, rows, keys, counts = split_lines(batch.column("text"))
            keys, rows = keys.filter(pa.array(counts)), rows[counts]
            hashes = key_hashes(keys)
            if suspect:
                chosen = suspect(hashes)
                keys, rows, hashes = keys.filter(pa.array(chosen)), rows[chosen], hashes[chosen]
            for at in range(0, len(rows), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows[part])),
                        pa.array(hashes[part].view(np.int64)),
                        pa.array([hashlib.sha256(key.encode()).digest() for key in keys[part].to_pylist()], pa.binary()),
                    ],
                    ["doc_id", "hash", "digest"],
                )

    return docs.mapInArrow(scan, "doc_id long, hash long, digest binary")


def lost_lines(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, Suspect | None]:
    """(doc_id, lost): digests of the keys that a document loses; and the filter, if it was broadcast."""
    hashes = materialize(local_hashes(docs.select("text")))
    blocks = blocks_of(hashes.count())
    suspect = None
    if blocks * BLOCK * BITS // 8 <= broadcast_bytes:
        suspect = broadcast_filter(hashes, blocks)
        rows = key_rows(docs, suspect)
    else:
        rows = key_rows(docs, None).join(materialize(block_filters(hashes, blocks, True)), "hash", "left_semi")
    rows = materialize(rows.select("doc_id", "digest").distinct())
    confirmed = materialize(
        rows.groupBy("digest")
        .agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= LEAST_DOCS)
        .drop("docs")
    )
    lost = rows.join(confirmed, "digest").where("doc_id < keeper")
    return materialize(lost.groupBy("doc_id").agg(F.collect_set("digest").alias("lost"))), suspect


def without(text: str | None, lost: set[bytes]) -> tuple[str, int, int]:
    """The text without its lost lines, its lines before, and how many were lost."""
    lines = (text or "").split("\n")
    if not lost:
        return "\n".join(lines), len(lines), 0
    stay = []
    for line in lines:
        key = line.strip(SPACES).translate(ASCII_LOWER)
        if len(key) < LEAST_CHARS or hashlib.sha256(key.encode()).digest() not in lost:
            stay.append(line)
    return "\n".join(stay), len(lines), len(lines) - len(stay)


ASCII_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
STRUCT = pa.struct([("kept_text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])


def _strip(texts: pa.Array, lost: pa.Array) -> pa.Array:
    done = [without(t, set(x or ())) for t, x in zip(texts.to_pylist(), lost.to_pylist(), strict=True)]
    return pa.array([{"kept_text": t, "n_lines": n, "n_dropped": d} for t, n, d in done], STRUCT)


def strip_repeats(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents with ``kept_text``, ``n_lines`` and ``n_dropped``, renamed if they would clash."""
    key, lost_, found, flag = (fresh(docs.columns, x) for x in ("key", "lost", "found", "flag"))
    named = docs.withColumn(key, F.coalesce("doc_id", F.lit(NO_ID)))
    lost, suspect = lost_lines(named.select(F.col(key).alias("doc_id"), "text"), broadcast_bytes)
    lost = lost.select(F.col("doc_id").alias(key), F.col("lost").alias(lost_))
    if suspect:

        @F.arrow_udf("boolean")
        def may_lose(texts: pa.Array) -> pa.Array:
            _, rows, keys, counts = split_lines(texts)
            hit = np.zeros(len(texts), bool)
            hit[rows[counts][suspect(key_hashes(keys.filter(pa.array(counts))))]] = True
            return pa.array(hit)

        named = named.withColumn(flag, may_lose("text"))
    else:
        named = named.withColumn(flag, F.lit(True))
    untouched = named.where(~F.col(flag)).withColumn(
        found,
        F.struct(
            F.coalesce("text", F.lit("")).alias("kept_text"),
            F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
            F.lit(0).cast("long").alias("n_dropped"),
        ),
    )
    strip = F.arrow_udf(_strip, "struct<kept_text:string,n_lines:long,n_dropped:long>")
    touched = named.where(flag).join(lost, key, "left").withColumn(found, strip("text", lost_))
    both = untouched.select(*docs.columns, found).unionByName(touched.select(*docs.columns, found))
    return both.select(*docs.columns, *[F.col(found)[x].alias(fresh(docs.columns, x)) for x in ("kept_text", "n_lines", "n_dropped")])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
    return strip_repeats(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents with their repeated lines gone from ``text``."""
    kept = fresh(docs.columns, "kept_text")
    return strip_repeats(docs).withColumn("text", F.col(kept)).select(docs.columns)
