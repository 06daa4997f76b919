"""Hard negatives by inner products, searched in STR-packed R-trees.

Vectors are packed sort-tile-recursive: the whole table is cut into slabs by
its most spread coordinate and each slab into tiles by the second one, at
borders that Spark estimates; a task then packs a tile's rows, by label and
further coordinates, into leaves of LEAF rows under nodes of FANOUT leaves. A
box is the least and greatest value of each coordinate, and of the label, so it
bounds the inner product with any anchor from both sides.

Anchors are the stated query set. They come in blocks of bounded size, which
are broadcast and searched through all tiles where these lie. A tile's boxes
are visited best first, many anchors at a time: nodes, then leaves, that lie
outside an anchor's score window, strictly below its k-th score or on the wrong
side of the labels are left out. A task keeps its anchors' best rows from tile
to tile, so bounds rise as it goes, and its partial results are merged by a
grouped top k. The search is exact.

Defined cases: rows with a null label, a null vector or a component that is
null or not finite take no part; a shorter vector is as one with zeros behind
it; components are whole numbers, those beyond 2 ** 24 count as 2 ** 24; a null
vec_id comes last among equal scores and is no anchor; repeated rows are rows
of their own, and repeated anchors anchors of their own; equal rows are spread
over tiles by a hash; an empty table gives an empty result; only vec_id,
embedding and label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierloom.sources.storage import materialize, scratch_path

POSITIVES, NEGATIVES = 5, 5
#: Window of a negative's score, in hundredths of the positive's.
LOWEST, HIGHEST = 80, 100
ANCHOR_EVERY, MISLABELLED_EVERY, LABELS = 100, 7, 10
SCALE, BIGGEST = 256, 1 << 24
#: Rows of a tile, rows of a leaf, leaves of a node.
TILE, LEAF, FANOUT = 4096, 32, 16
#: Bytes of the anchors of one block, and bounds that are computed at once.
BLOCK_BYTES, CELLS = 16 << 20, 1 << 20
NO_ID = (1 << 63) - 1
NOTHING = -(1 << 62)

Batches = Iterator[pa.RecordBatch]


def prepared(rows: DataFrame) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part; vectors of whole numbers, ``row`` is the row's own number."""
    whole = F.transform(
        "embedding",
        lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(float(-BIGGEST))), F.lit(float(BIGGEST)))).cast("int"),
    )
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    moved = F.when(F.col("vec_id") % MISLABELLED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    taken = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    own = F.monotonically_increasing_id().alias("row")
    return materialize(taken.select(own, F.col("vec_id").cast("long"), moved.cast("long").alias("label"), whole.alias("vector")))


def _borders(value: Column, parts: int) -> Column:
    return F.percentile_approx(value, [i / parts for i in range(1, parts)] or [0.5], 10_000)


def _place(value: Column, borders: Column, parts: int) -> Column:
    return F.size(F.filter(borders, lambda border: border < value)) if parts > 1 else F.lit(0)


def in_tiles(rows: DataFrame, dims: int, tile: int) -> DataFrame:
    """``rows`` with slab and tile: cut by the two most spread coordinates, equal values apart by a hash."""
    at = lambda d: F.coalesce(F.get("vector", F.lit(d)), F.lit(0)).cast("double")
    spread = rows.agg(F.count(F.lit(1)), *[F.var_pop(at(d)) for d in range(dims)]).first()
    widest = sorted(range(dims), key=lambda d: (-(spread[d + 1] or 0), d))
    parts = math.ceil(math.sqrt(math.ceil(spread[0] / tile)))
    # Values are whole numbers, so a fraction keeps their order and cuts equal ones.
    fraction = lambda salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    first, second = [at(d) + fraction(salt) for salt, d in enumerate((widest + [0, 0])[:2])]
    # The square root of the number of tiles: a few thousand numbers at most.
    slabs = rows.select(first.alias("value")).agg(_borders(F.col("value"), parts)).first()[0] or [0.0]
    slabbed = rows.withColumns({"slab": _place(first, F.lit(slabs), parts), "second": second})
    tiles = materialize(slabbed.groupBy("slab").agg(_borders(F.col("second"), parts).alias("tiles")))
    return slabbed.join(tiles, "slab").withColumn("tile", _place(F.col("second"), F.col("tiles"), parts)).drop("tiles", "second")


def pack(vectors: np.ndarray, labels: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the rows that puts leaves of ``leaf`` rows side by side: by label, then by the most spread coordinates."""
    keys = [labels, *vectors.T[np.argsort(-vectors.var(axis=0), kind="stable")[:2]]]
    order = np.lexsort((vectors[:, 0] if vectors.shape[1] else labels, labels))

    def cut(rows: np.ndarray, level: int) -> Iterator[np.ndarray]:
        leaves = math.ceil(len(rows) / leaf)
        if level == len(keys) or leaves <= 1:
            yield rows
            return
        rows = rows[np.argsort(keys[level][rows], kind="stable")]
        slabs = math.ceil(leaves ** (1 / (len(keys) - level)))
        size = math.ceil(leaves / slabs) * leaf
        for at in range(0, len(rows), size):
            yield from cut(rows[at : at + size], level + 1)

    return np.concatenate(list(cut(order, 0)))


TREE = "tile long, n int, vectors binary, labels binary, ids binary, rows binary, leaf_low binary, leaf_high binary, leaf_labels binary"


def build_trees(rows: DataFrame, dims: int, tile: int, leaf: int) -> DataFrame:
    """A row per tile: its rows in packed order, and the boxes of its leaves."""

    def build(own: pa.Table) -> Iterator[pa.Table]:
        vectors = np.zeros((own.num_rows, dims), np.int32)
        column = own["vector"].combine_chunks()
        sizes = column.value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(np.arange(len(sizes)), sizes), np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
        vectors[at] = column.flatten().to_numpy()
        labels, ids, numbers = (own[c].to_numpy() for c in ("label", "id", "row"))
        order = pack(vectors, labels, leaf)
        for piece in range(0, len(order), 2 * tile):  # borders are estimates: a tile of more rows is several trees
            part = order[piece : piece + 2 * tile]
            cuts = np.arange(0, len(part), leaf)
            mine, own_labels = vectors[part], labels[part]
            low, high = np.minimum.reduceat(mine, cuts, axis=0), np.maximum.reduceat(mine, cuts, axis=0)
            sides = np.stack([np.minimum.reduceat(own_labels, cuts), np.maximum.reduceat(own_labels, cuts)])
            cells = [mine, own_labels, ids[part], numbers[part], low, high, sides]
            columns = [pa.array([x.tobytes()], pa.binary()) for x in cells]
            names = ["vectors", "labels", "ids", "rows", "leaf_low", "leaf_high", "leaf_labels"]
            yield pa.Table.from_arrays([own["tile"][:1], pa.array([len(part)], pa.int32()), *columns], ["tile", "n", *names])

    def whole(own: pa.Table) -> pa.Table:
        return pa.concat_tables([t.combine_chunks() for t in build(own)])

    number = F.col("slab").cast("long") * F.lit(1 << 32) + F.col("tile")
    dealt = rows.select(number.alias("tile"), "row", F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), "label", "vector")
    return materialize(dealt.groupBy("tile").applyInArrow(whole, TREE))


class Tree(NamedTuple):
    vectors: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sides: np.ndarray


def read_tree(row: dict, dims: int, leaf: int) -> Tree:
    n = row["n"]
    leaves = math.ceil(n / leaf)
    box = lambda name: np.frombuffer(row[name], np.int32).reshape(leaves, dims)
    whole = lambda name: np.frombuffer(row[name], np.int64)
    vectors = np.frombuffer(row["vectors"], np.int32).reshape(n, dims)
    sides = whole("leaf_labels").reshape(2, leaves)
    return Tree(vectors, whole("labels"), whole("ids"), whole("rows"), box("leaf_low"), box("leaf_high"), sides)


class Anchors(NamedTuple):
    """Anchors of a block with their score windows; a window whose low is above its high is not searched."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Best:
    """The ``most`` best (score, id) of each window of each anchor so far, in order."""

    def __init__(self, anchors: Anchors, most: int):
        shape = (*anchors.low.shape, most)
        self.most, self.scores, self.ids = most, np.full(shape, NOTHING, np.int64), np.full(shape, NO_ID, np.int64)
        self.floor = anchors.low.copy()

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of windows ``at`` (flat places)."""
        touched = np.unique(at)
        flat_scores, flat_ids = self.scores.reshape(-1, self.most), self.ids.reshape(-1, self.most)
        at = np.concatenate([np.repeat(touched, self.most), at])
        scores = np.concatenate([flat_scores[touched].ravel(), scores])
        ids = np.concatenate([flat_ids[touched].ravel(), ids])
        order = np.lexsort((ids, -scores, at))
        at, scores, ids = at[order], scores[order], ids[order]
        first = np.searchsorted(at, touched)
        take = (first[:, None] + np.arange(self.most)).ravel()
        flat_scores[touched] = scores[take].reshape(-1, self.most)
        flat_ids[touched] = ids[take].reshape(-1, self.most)
        floor = self.floor.reshape(-1)
        floor[touched] = np.maximum(floor[touched], flat_scores[touched, -1])


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left @ right.T in whole numbers, exactly."""
    most = float(np.abs(left, dtype=np.float64).max(initial=0)) * float(np.abs(right, dtype=np.float64).max(initial=0))
    if most * max(1, left.shape[1]) < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector with any point of each box."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def search(tree: Tree, anchors: Anchors, best: Best, same: bool, leaf: int) -> int:
    """Add the tree's rows to ``best``: of the anchor's label but itself, or of other labels. Returns the leaves visited."""
    leaves = len(tree.low)
    visited = 0
    step = max(1, CELLS // max(1, leaves))
    nodes = np.arange(0, leaves, FANOUT)
    node_low, node_high = np.minimum.reduceat(tree.low, nodes, axis=0), np.maximum.reduceat(tree.high, nodes, axis=0)
    for start in range(0, len(anchors.rows), step):
        part = slice(start, start + step)
        vectors, labels = anchors.vectors[part], anchors.labels[part]
        windows = anchors.low.shape[1]

        def wanted(least, most, part=part):
            """Whether any window of an anchor may have rows of a box with these bounds."""
            hit = np.zeros(least.shape, bool)
            for w in range(anchors.low.shape[1]):
                floor, high = best.floor[part, w, None], anchors.high[part, w, None]
                hit |= (most >= floor) & (least <= high) & (floor <= high)
            return hit

        open_nodes = wanted(*bounds(vectors, node_low, node_high))
        least, most = bounds(vectors, tree.low, tree.high)
        if same:
            right = (tree.sides[0] <= labels[:, None]) & (labels[:, None] <= tree.sides[1])
        else:
            right = (tree.sides[0] != labels[:, None]) | (labels[:, None] != tree.sides[1])
        right &= np.repeat(open_nodes, FANOUT, axis=1)[:, :leaves]
        queue = np.argsort(np.where(right, -most, -NOTHING), axis=1, kind="stable")
        taken, turns = 0, 1
        while taken < leaves:
            # The next boxes of all queues, fewer of them while bounds rise quickly.
            heads = queue[:, taken : taken + turns]
            taken, turns = taken + turns, turns * 2
            mine = np.zeros(right.shape, bool)
            np.put_along_axis(mine, heads, True, axis=1)
            mine &= right & wanted(least, most)
            visits = np.flatnonzero(mine.any(axis=0))
            if not visits.size and not (right & wanted(least, most)).any():
                break
            for box in visits.tolist():
                who = np.flatnonzero(mine[:, box])
                visited += who.size
                inside = slice(box * leaf, (box + 1) * leaf)
                scores = products(vectors[who], tree.vectors[inside])
                fits = tree.labels[inside] == labels[who, None]
                fits = fits & (tree.rows[inside] != anchors.rows[part][who, None]) if same else ~fits
                for w in range(windows):
                    floor, high = best.floor[part][who, w, None], anchors.high[part][who, w, None]
                    a, b = np.nonzero(fits & (scores >= floor) & (scores <= high))
                    if a.size:
                        best.add((start + who[a]) * windows + w, scores[a, b], tree.ids[inside][b])
    return visited


def found_in(trees: DataFrame, anchors: Anchors, dims: int, leaf: int, most: int, same: bool) -> DataFrame:
    """(anchor, place, id, score) of the best rows of every task, for each window (its place) of each anchor."""
    shared = trees.sparkSession.sparkContext.broadcast(tuple(anchors))

    def scan(batches: Batches) -> Batches:
        own = Anchors(*shared.value)
        best = Best(own, most)
        for batch in batches:
            for at in range(batch.num_rows):
                search(read_tree(batch.slice(at, 1).to_pylist()[0], dims, leaf), own, best, same, leaf)
        for at in range(0, len(own.rows), 4096):
            scores = best.scores[at : at + 4096]
            a, w, k = np.nonzero(scores != NOTHING)
            columns = [own.rows[at + a], w, best.ids[at + a, w, k], scores[a, w, k]]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["anchor", "place", "id", "score"])

    return trees.drop("tile").mapInArrow(scan, "anchor long, place long, id long, score long")


def best_of(found: DataFrame, most: int) -> DataFrame:
    """(anchor, place, rank, id, score): the first ``most`` of each window, over all tasks."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _block(anchors: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = anchors.orderBy("row").toArrow()
    vectors = np.zeros((table.num_rows, dims), np.int32)
    for i, own in enumerate(table["vector"]):
        vectors[i, : len(own)] = own.values.to_numpy()
    return table["row"].to_numpy(), table["label"].to_numpy(), vectors


def mine(
    rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, tile: int = TILE, leaf: int = LEAF, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: see the module."""
    spark: SparkSession = rows.sparkSession
    known = prepared(rows)
    is_anchor = F.coalesce(F.col("vec_id") % ANCHOR_EVERY == 0, F.lit(False))
    dims = max(1, known.agg(F.max(F.size("vector"))).first()[0] or 0)
    anchors = known.where(is_anchor)
    trees = build_trees(in_tiles(known, dims, tile), dims, tile, leaf)
    blocks = math.ceil(anchors.count() * dims * 4 / block_bytes)
    anchors = materialize(anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, blocks)))))
    folder, written = scratch_path(spark), []
    for block in range(blocks):
        numbers, labels, vectors = _block(anchors.where(F.col("block") == block).drop("block"), dims)
        if not len(numbers):
            continue
        low, high = np.full((len(numbers), 1), NOTHING + 1, np.int64), np.full((len(numbers), 1), -NOTHING, np.int64)
        first = materialize(best_of(found_in(trees, Anchors(numbers, labels, vectors, low, high), dims, leaf, positives, True), positives))
        scores = first.select("anchor", "score").distinct().toArrow()  # ``positives`` windows an anchor at most
        low, high = np.ones((len(numbers), positives), np.int64), np.zeros((len(numbers), positives), np.int64)
        who, score = np.searchsorted(numbers, scores["anchor"].to_numpy()), scores["score"].to_numpy()
        order = np.lexsort((-score, who))
        who, score = who[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        low[who, place], high[who, place] = -(-LOWEST * score // 100), HIGHEST * score // 100
        second = best_of(found_in(trees, Anchors(numbers, labels, vectors, low, high), dims, leaf, negatives, False), negatives)
        places = F.dense_rank().over(Window.partitionBy("anchor").orderBy(F.desc("score"))) - 1
        windows = first.select("anchor", places.alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        pairs = windows.withColumn("place", F.col("place").cast("long")).join(second, ["anchor", "place"])
        written.append(f"{folder}/{block}")
        pairs.write.parquet(written[-1])
    schema = "anchor long, place long, positive_id long, positive_score long, rank int, id long, score long"
    mined = spark.read.schema(schema).parquet(*written) if written else spark.createDataFrame([], schema)
    ids = lambda name: F.when(F.col(name) != NO_ID, F.col(name))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return mined.join(named, "anchor").select(
        "anchor_id", ids("positive_id").alias("positive_id"), "rank", ids("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
