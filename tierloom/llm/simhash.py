"""SimHash near-dedup over an inverted index of byte positions.

A fingerprint of 64 bits is eight bytes at fixed positions. Two fingerprints
with at most four differing bits share at least four positional bytes, so the
index lists every fingerprint under each set of four of its positional bytes
(70 lists), and a comparison of all bits verifies what meets there. These
composite keys replace the count filter's tally per pair: two fingerprints
share a list exactly if their tally would reach four, while lists of single
bytes would each hold 1/256 of all fingerprints, and every pair in one a tally.

Equal fingerprints are one entry. A list emits no pairs but a spanning forest
of its links, at most one edge per entry. A list of more than ``LIST`` entries
is passed on to a second round, which cuts it into blocks and compares every
two blocks in a task of their own, so no task holds a list as a whole.
Components are then found over the edges.

Defined cases: a null or empty text, or one without words, has fingerprint
zero, linked like any other; fewer words than a shingle takes are one
shingle; repeated rows are repeated in the result; a null id is never a
component's id unless all of its members' are null; an empty table gives an
empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import fresh
from tierloom.llm.components import components
from tierloom.sources.storage import materialize

SHINGLE, SEED = 4, 42
MOST_BITS = 4
BYTES = 8
#: Positional bytes that any linked pair shares.
SHARED = BYTES - MOST_BITS
POSITIONS = list(combinations(range(BYTES), SHARED))
#: Entries of a list that one task compares.
LIST = 8192
#: Lists up to this size are compared entry by entry in one sweep over many lists.
SHORT = 8

Batches = Iterator[pa.RecordBatch]


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case; of bytes, so that only ASCII letters and white space count."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Hash of every run of ``shingle`` words, or of all words if there are fewer; ``words`` has one at least."""
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:count].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True)
    return np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text's shingles, each counted as often as it occurs."""
    words = plain_words(text)
    if not words:
        return 0
    hashes = shingle_hashes(words, shingle)
    count = len(hashes)
    votes = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``extra`` texts, fp) of every document; fp holds the 64 bits as a signed long."""
    own = ["doc_id", *extra]

    def scan(batches: Batches) -> Batches:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            columns = [*map(batch.column, own), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*own, "fp"])

    kinds = ", ".join(["doc_id long", *(f"{c} string" for c in extra), "fp long"])
    return docs.select(F.col("doc_id").cast("long"), *extra, "text").mapInArrow(scan, kinds)


def forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that tie each entry to the first entry of its component within the list."""
    left, right = [], []
    rest = np.arange(len(prints))
    while rest.size > 1:
        seed, frontier, rest = rest[0], rest[:1], rest[1:]
        while frontier.size and rest.size:
            near = np.zeros(rest.size, bool)
            step = max(1, (1 << 20) // rest.size)
            for at in range(0, frontier.size, step):
                apart = prints[frontier[at : at + step], None] ^ prints[None, rest]
                near |= (np.bitwise_count(apart) <= MOST_BITS).any(axis=0)
            frontier, rest = rest[near], rest[~near]
            left.append(np.full(frontier.size, seed))
            right.append(frontier)
    empty = np.empty(0, np.int64)
    return prints[np.concatenate([empty, *left])], prints[np.concatenate([empty, *right])]


def links_of(lists: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges within runs of equal ``lists``; short runs together, longer ones each by its forest."""
    cuts = np.flatnonzero(np.diff(lists)) + 1
    starts = np.concatenate([[0], cuts])
    sizes = np.diff(np.concatenate([starts, [len(lists)]]))
    left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    short = np.repeat(sizes <= SHORT, sizes)
    for apart in range(1, SHORT):
        a = np.flatnonzero(short[:-apart] & (lists[:-apart] == lists[apart:]))
        a = a[np.bitwise_count(prints[a] ^ prints[a + apart]) <= MOST_BITS]
        left.append(prints[a])
        right.append(prints[a + apart])
    for start, size in zip(starts[sizes > SHORT], sizes[sizes > SHORT], strict=True):
        a, b = forest(prints[start : start + size])
        left.append(a)
        right.append(b)
    return np.concatenate(left), np.concatenate(right)


EDGES = "u long, v long, list long, fp long"


def _edge_batch(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(u), pa.int64())
    pair = [pa.array(x.view(np.int64)) for x in (u, v)]
    return pa.RecordBatch.from_arrays([*pair, none, none], ["u", "v", "list", "fp"])


def _over_batch(lists: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(lists), pa.int64())
    pair = [pa.array(lists), pa.array(prints.view(np.int64))]
    return pa.RecordBatch.from_arrays([none, none, *pair], ["u", "v", "list", "fp"])


def compare_lists(rows: DataFrame, most: int) -> DataFrame:
    """Edges (u, v) of the lists in ``rows`` (list, fp; lists whole and in order within a partition).

    Rows of lists longer than ``most`` come back as they are (list, fp) as soon
    as the length is seen, so a task never keeps more than ``most`` of a list.
    """

    def scan(batches: Batches) -> Batches:
        lists, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        over = None
        for batch in batches:
            lists = np.concatenate([lists, batch.column("list").to_numpy()])
            prints = np.concatenate([prints, batch.column("fp").to_numpy().view(np.uint64)])
            if over is not None:
                n = np.searchsorted(lists != over, True)
                yield _over_batch(lists[:n], prints[:n])
                lists, prints, over = lists[n:], prints[n:], over if n == len(lists) else None
            if not len(lists):
                continue
            last = np.searchsorted(lists == lists[-1], True)
            yield from _whole(lists[:last], prints[:last])
            lists, prints = lists[last:], prints[last:]
            if len(lists) > most:
                yield _over_batch(lists, prints)
                over, lists, prints = lists[0], lists[:0], prints[:0]
        if len(lists):
            yield from _whole(lists, prints)

    def _whole(lists: np.ndarray, prints: np.ndarray) -> Batches:
        if not len(lists):
            return
        sizes = np.diff(np.flatnonzero(np.concatenate([[True], np.diff(lists) != 0, [True]])))
        long_ = np.repeat(sizes > most, sizes)
        if long_.any():
            yield _over_batch(lists[long_], prints[long_])
            lists, prints = lists[~long_], prints[~long_]
        if len(lists) > 1:
            yield _edge_batch(*links_of(lists, prints))

    return rows.mapInArrow(scan, EDGES)


def index(prints: DataFrame) -> DataFrame:
    """(list, fp): every fingerprint under each set of SHARED of its positional bytes."""
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(BYTES)]
    keys = []
    for number, chosen in enumerate(POSITIONS):
        key = F.lit(number).cast("long")
        for p in chosen:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        keys.append(key)
    return prints.select(F.explode(F.array(*keys)).alias("list"), "fp")


def block_pairs(over: DataFrame, most: int) -> DataFrame:
    """Long lists cut into blocks; every two blocks of a list become a list of their own."""
    sizes = over.groupBy("list").agg(F.ceil(F.count(F.lit(1)) * 2 / most).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = over.join(materialize(sizes), "list").select("list", "fp", own.alias("own"), other)
    return dealt.select(F.xxhash64("list", F.least("own", "other"), F.greatest("own", "other")).alias("list"), "fp")


def links(prints: DataFrame, most: int = LIST) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints ``prints`` (fp) as their links do."""
    first = materialize(compare_lists(_dealt(index(prints)), most))
    over = first.where("u IS NULL").select("list", "fp")
    edges = first.where("u IS NOT NULL").select("u", "v")
    if over.isEmpty():
        return edges
    rest = compare_lists(_dealt(block_pairs(over, most)), 1 << 62)
    return edges.union(rest.select("u", "v"))


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(F.col("list")).sortWithinPartitions("list")


def _rooted(rows: DataFrame, first: Column, most: int) -> DataFrame:
    """(fp, first, root) of the distinct fingerprints of ``rows`` (fp, ...); ``first`` is a minimum over their rows."""
    prints = materialize(rows.groupBy("fp").agg(first.alias("first")))
    roots = materialize(components(links(prints.select("fp"), most)))
    return prints.join(roots, prints.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def find_groups(docs: DataFrame, shingle: int = SHINGLE, most: int = LIST) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    rows = materialize(fingerprints(docs, shingle))
    rooted = _rooted(rows, F.min("doc_id"), most)
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = materialize(rooted.join(materialize(named), "root").select("fp", "component_id"))
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(groups, "fp").select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def row_order() -> Column:
    """Smallest id first, null last; the text's digest decides between texts of one id."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "sha")


def one_of_each(docs: DataFrame, sha: str, rows: DataFrame, rooted: DataFrame, node: str) -> DataFrame:
    """``docs`` (with the text's digest ``sha``) without the rows that are not the first of their group.

    ``rows`` (doc_id, sha, node) are all documents, ``rooted`` (node, first, root) has the first row of every node.
    Rows of one id and one text have one node, so they stay or go together; of those that stay, one is kept.
    """
    keepers = materialize(rooted.groupBy("root").agg(F.min("first").alias("keeper")))
    named = materialize(rooted.join(keepers, "root").select(node, "keeper"))
    judged = materialize(rows.join(named, node).select("doc_id", "sha", (row_order() == F.col("keeper")).alias("kept")))
    key, digest = fresh(docs.columns, "key"), fresh(docs.columns, "digest")
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(sha) == F.col(digest))
    names = [F.col("doc_id").alias(key), F.col("sha").alias(digest)]
    lost = judged.where(~F.col("kept")).select(names).distinct()
    repeated = judged.where("kept").groupBy("doc_id", "sha").count().where("count > 1").select(names)
    stay = docs.join(lost, same, "left_anti")
    if repeated.isEmpty():
        return stay
    repeated = materialize(repeated)
    one = docs.join(repeated, same, "left_semi").dropDuplicates(["doc_id", sha])
    return stay.join(repeated, same, "left_anti").unionByName(one)


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, most: int = LIST) -> DataFrame:
    """One document of each component, with all its columns: the smallest id (null last), then the smallest digest."""
    sha = fresh(docs.columns, "sha")
    named = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = named.select("doc_id", "text", F.col(sha).alias("sha"))
    rows = materialize(fingerprints(texts, shingle, ("sha",)))
    rooted = _rooted(rows, F.min(row_order()), most)
    return one_of_each(named, sha, rows, rooted, "fp").drop(sha)
