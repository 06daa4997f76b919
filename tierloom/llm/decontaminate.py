"""Benchmark decontamination by winnowing.

Every run of WINDOW words has one fingerprint: the least of the hashes of the
runs of GRAM words in it. So two texts that share WINDOW words share that
fingerprint, whatever stands around. Fingerprints of documents that a filter of
fixed size doesn't know from the benchmark never leave their task; the others
go on with the windows around them, join the benchmark's fingerprints, and a
hit counts if the words of the whole window are the same. Spans of words are
what a document's hits cover together.

An item of fewer words is one window of its own size, found by the hash of all
its words. Windows that the same items hold share one list of items, so a
passage of many items meets many documents as one row each.

Defined cases: a null text has no words, and an item without words is in no
document; a null item_id is one item with an empty name; rows of one item_id
are one item; repeated documents and null ids are rows of their own; empty
tables give no hits or no rows; all columns of the documents but ``text`` come
back as they are, new ones get names that do not clash; long texts are taken
in portions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.common import fresh
from tierloom.sources.storage import materialize

WINDOW, GRAM = 10, 5
#: Bits of the filter of known fingerprints, and of one of its blocks.
BITS, BLOCK = 1 << 26, 1 << 16
#: Bytes of a text whose words are taken at once.
PORTION = 1 << 20
#: Words are made of digits, letters a to z and all that is not ASCII.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
FACTOR, MIXER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

Batches = Iterator[pa.RecordBatch]
#: A window's fingerprint, its words, and the places of its first word in the document.
FOUND = "array<struct<print:long,window:string,size:int,starts:array<int>>>"
FOUND_ARROW = pa.list_(
    pa.struct([("print", pa.int64()), ("window", pa.string()), ("size", pa.int32()), ("starts", pa.list_(pa.int32()))])
)


def portions(text: str | None, size: int = PORTION) -> Iterator[tuple[int, list[bytes]]]:
    """Words of a text by portions, each with the WINDOW - 1 words before it; and the first word's place."""
    plain = (text or "").encode().translate(PLAIN)
    at, place, before = 0, 0, []
    while at < len(plain):
        end = plain.find(b" ", at + size)
        end = len(plain) if end < 0 else end
        words = before + plain[at:end].split()
        yield place, words
        before = words[max(0, len(words) - WINDOW + 1) :]
        place += len(words) - len(before)
        at = end


def run_hashes(own: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, from the words' hashes."""
    count = max(0, len(own) - size + 1)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * FACTOR + own[k : k + count]
    total ^= total >> np.uint64(32)
    total *= MIXER
    return total ^ (total >> np.uint64(32))


def prints_of(words: list[bytes], size: int) -> np.ndarray:
    """Fingerprint of every window of ``size`` words; of WINDOW words by winnowing."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if size < WINDOW:
        return run_hashes(own, size)
    runs = run_hashes(own, GRAM)
    count = max(0, len(own) - WINDOW + 1)
    least = runs[:count].copy()
    for k in range(1, WINDOW - GRAM + 1):
        np.minimum(least, runs[k : k + count], out=least)
    return least


def item_windows(items: DataFrame) -> DataFrame:
    """(item, print, window, size) of all windows of the items (item, text), each once an item."""

    def scan(batches: Batches) -> Batches:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                for place, words in portions(text.as_py()):
                    size = WINDOW if place else min(WINDOW, len(words))
                    if not size or len(words) < size:
                        continue
                    windows = {
                        b" ".join(words[i : i + size]).decode(): print_
                        for i, print_ in enumerate(prints_of(words, size).view(np.int64).tolist())
                    }
                    yield pa.RecordBatch.from_pydict(
                        {
                            "item": pa.array([item] * len(windows), pa.string()),
                            "print": pa.array(windows.values(), pa.int64()),
                            "window": pa.array(windows.keys(), pa.string()),
                            "size": pa.array([size] * len(windows), pa.int32()),
                        }
                    )

    return items.mapInArrow(scan, "item string, print long, window string, size int").distinct()


def filter_of(prints: DataFrame) -> np.ndarray:
    """Bits of the slots of ``prints`` (print); BITS / 8 bytes, whatever their number."""

    def build(block: pa.Table) -> pa.Table:
        bits = np.zeros(BLOCK, np.uint8)
        bits[block["slot"].to_numpy() % BLOCK] = 1
        return pa.table({"block": block["block"][:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    slots = prints.select(F.pmod("print", F.lit(BITS)).alias("slot")).distinct()
    blocks = slots.withColumn("block", F.floor(F.col("slot") / F.lit(BLOCK)).cast("int"))
    whole = np.zeros((BITS // BLOCK, BLOCK // 8), np.uint8)
    for row in blocks.groupBy("block").applyInArrow(build, "block int, bits binary").toLocalIterator():
        whole[row.block] = np.frombuffer(row.bits, np.uint8)
    return whole.ravel()


def suspects(text: str | None, sizes: list[int], known: np.ndarray) -> tuple[int, list[dict]]:
    """Number of words, and the windows of ``sizes`` words whose fingerprint ``known`` may hold."""
    starts: dict[tuple[int, str], list[int]] = {}
    prints: dict[tuple[int, str], int] = {}
    n_words = 0
    for place, words in portions(text):
        n_words = place + len(words)
        fresh_from = WINDOW - 1 if place else 0
        for size in sizes:
            own = prints_of(words, size)
            slots = own % np.uint64(BITS)
            hit = (known[slots >> np.uint64(3)] >> (np.uint64(7) - (slots & np.uint64(7))).astype(np.uint8)) & 1
            for i in np.flatnonzero(hit).tolist():
                if i + size > fresh_from:
                    key = size, b" ".join(words[i : i + size]).decode()
                    starts.setdefault(key, []).append(place + i)
                    prints[key] = int(own[i : i + 1].view(np.int64)[0])
    found = [{"print": prints[key], "window": key[1], "size": key[0], "starts": own} for key, own in starts.items()]
    return n_words, found


def scan_documents(docs: DataFrame, sizes: list[int], known: np.ndarray, names: tuple[str, str]) -> DataFrame:
    """The columns of ``docs`` but ``text``, its number of words and its suspected windows."""
    shared = docs.sparkSession.sparkContext.broadcast(known.tobytes())
    others = [column for column in docs.columns if column != "text"]

    def scan(batches: Batches) -> Batches:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                judged = [suspects(text.as_py(), sizes, bits) for text in part.column("text")]
                columns = [*map(part.column, others), pa.array([n for n, _ in judged], pa.int64())]
                found = pa.array([windows for _, windows in judged], FOUND_ARROW)
                yield pa.RecordBatch.from_arrays([*columns, found], [*others, *names])

    schema = T.StructType([docs.schema[c] for c in others]).add(names[0], "long").add(names[1], T._parse_datatype_string(FOUND))
    return docs.mapInArrow(scan, schema)


def _merge(starts: pa.Array) -> pa.Array:
    """Spans (start, end) that the windows of each row cover; a window is (start, size)."""
    out = []
    for windows in starts.to_pylist():
        spans: list[list[int]] = []
        for start, end in sorted((at, at + part["size"]) for part in windows for at in part["starts"]):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([start, end])
        out.append([{"start": a, "end": b} for a, b in spans])
    return pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def find_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Columns of ``docs`` but ``text``; n_words; spans of words found in ``items``; names of the items found, in order."""
    row, found = fresh(docs.columns, "row"), fresh(docs.columns, "found")
    n_words, spans, names = (fresh(docs.columns, x) for x in ("n_words", "spans", "items"))
    tests = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    windows = materialize(item_windows(tests))
    sizes = sorted(size for (size,) in windows.select("size").distinct().collect())  # WINDOW values at most
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    scanned = materialize(scan_documents(numbered, sizes, filter_of(windows), (n_words, found)))

    held = windows.groupBy("print", "window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    held = materialize(held.withColumn("list", F.sha2(F.to_json("items"), 256)))
    lists = held.groupBy("list").agg(F.any_value("items").alias("items"))
    suspected = scanned.where(F.size(found) > 0).select(F.col(row).alias("row"), F.inline(found))
    hits = materialize(
        suspected.join(held.drop("items"), ["print", "window"]).select("row", "list", F.struct("size", "starts").alias("part"))
    )
    merge = F.arrow_udf(_merge, "array<struct<start:int,end:int>>")
    covered = hits.groupBy("row").agg(F.collect_list("part").alias("parts")).select("row", merge("parts").alias("spans"))
    each = hits.select("row", "list").distinct().join(lists, "list").select("row", F.explode("items").alias("item"))
    named = each.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    both = covered.join(named, "row").select(F.col("row").alias(row), F.col("spans").alias(spans), F.col("items").alias(names))
    others = [column for column in docs.columns if column != "text"]
    none = F.array().cast("array<struct<start:int,end:int>>"), F.array().cast("array<string>")
    return scanned.join(both, row, "left").select(
        *others, n_words, F.coalesce(spans, none[0]).alias(spans), F.coalesce(names, none[1]).alias(names)
    )


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return find_spans(docs.select("doc_id", "text"), items).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no window of any item, with all their columns."""
    own = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), "text")
    key, digest = fresh(docs.columns, "key"), fresh(docs.columns, "digest")
    lost = find_spans(own, items).where(F.size("spans") > 0).select(F.col("doc_id").alias(key), F.col("sha").alias(digest))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.sha2(F.coalesce("text", F.lit("")), 256) == F.col(digest))
    return docs.join(lost.distinct(), same, "left_anti")
