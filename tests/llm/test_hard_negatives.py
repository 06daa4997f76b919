from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from tierloom.llm import hard_negatives

ROWS = "vec_id long, embedding array<float>, label int, score string"


def slow(rows):
    known = []
    for vec_id, vector, label, _ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        known.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    order = lambda pair: (-pair[0], pair[1] is None, pair[1] or 0)
    for i, (anchor, label, vector) in enumerate(known):
        if anchor is None or anchor % 100:
            continue
        scored = [(sum(a * b for a, b in zip(vector, own, strict=False)), vec_id, mark, k) for k, (vec_id, mark, own) in enumerate(known)]
        positives = sorted((x for x in scored if x[2] == label and x[3] != i), key=order)[:5]
        for score, positive, *_ in positives:
            fits = sorted((x for x in scored if x[2] != label and 80 * score <= 100 * x[0] <= 100 * score), key=order)[:5]
            out += [(anchor, positive, rank, x[1], score, x[0]) for rank, x in enumerate(fits, 1)]
    return Counter(out)


def some(n, dims=6, spread=1.0):
    random.seed(n)
    centres = [[random.gauss(0, 1) for _ in range(dims)] for _ in range(8)]
    rows = []
    for i in range(n):
        centre = random.choice(centres)
        rows.append((i * 5, [x + random.gauss(0, spread) for x in centre], random.randrange(10), None))
    return rows


def odd():
    rows = some(300)
    rows += [(100 * k, [0.0] * 6, k % 10, "x") for k in range(60, 63)]
    rows += [(None, rows[3][1], 3, None), (None, rows[4][1], 4, None), (40_000, None, 1, None), (40_001, [], 2, None)]
    rows += [(40_100, [1.0, None, 0.0], 1, None), (40_200, [math.nan] * 6, 1, None), (40_300, [math.inf] * 6, 1, None), (40_400, [2.0, -1.0], 1, None)]
    rows += [(50_000, rows[7][1], None, None), (-700, rows[8][1], 9, None)] + [rows[20]] * 3
    return rows + [(60_000 + i, [0.5] * 6, 5, None) for i in range(150)]


@pytest.mark.parametrize(("tile", "leaf", "block"), [(16, 4, 300), (4096, 32, 1 << 20)])
def test_mines_what_brute_force_finds(spark, tile, leaf, block):
    rows = odd()
    got = hard_negatives.mine(spark.createDataFrame(rows, ROWS).repartition(3), tile=tile, leaf=leaf, block_bytes=block)
    assert Counter(map(tuple, got.collect())) == slow(rows)


def test_wide_scores_are_exact():
    left = np.array([[1 << 24, -(1 << 24), 3]] * 2, np.int32)
    assert hard_negatives.products(left, left).tolist() == [[(1 << 49) + 9] * 2] * 2


def test_boxes_bound_and_prune():
    random.seed(3)
    rng = np.random.default_rng(5)
    centres = rng.integers(-200, 200, (40, 8))
    vectors = (centres[rng.integers(0, 40, 4000)] + rng.integers(-5, 6, (4000, 8))).astype(np.int32)
    labels = rng.integers(0, 4, 4000)
    order = hard_negatives.pack(vectors, labels, 32)
    assert sorted(order.tolist()) == list(range(4000))
    vectors, labels = vectors[order], labels[order]
    cuts = np.arange(0, 4000, 32)
    low, high = np.minimum.reduceat(vectors, cuts, axis=0), np.maximum.reduceat(vectors, cuts, axis=0)
    sides = np.stack([np.minimum.reduceat(labels, cuts), np.maximum.reduceat(labels, cuts)])
    numbers = np.arange(4000)
    tree = hard_negatives.Tree(vectors, labels, numbers, numbers, low, high, sides)
    least, most = hard_negatives.bounds(vectors[:50], low, high)
    scores = hard_negatives.products(vectors[:50], vectors)
    assert (np.repeat(least, 32, axis=1) <= scores).all() and (scores <= np.repeat(most, 32, axis=1)).all()
    bottom = hard_negatives.NOTHING
    anchors = hard_negatives.Anchors(numbers[:50], labels[:50], vectors[:50], np.full((50, 1), bottom + 1), np.full((50, 1), -bottom))
    best = hard_negatives.Best(anchors, 5)
    visited = hard_negatives.search(tree, anchors, best, True, 32)
    assert visited < 50 * len(cuts) / 4
    scores[:, :][labels[:50, None] != labels] = bottom
    scores[np.arange(50), np.arange(50)] = bottom
    assert (best.scores[:, 0] == -np.sort(-scores, axis=1)[:, :5]).all()


def test_empty(spark):
    assert hard_negatives.mine(spark.createDataFrame([], ROWS)).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(100, None, 1, None), (3, [1.0], None, None)], ROWS)).count() == 0
    alone = hard_negatives.mine(spark.createDataFrame([(100, [], 1, None), (1, [], 1, None), (2, [], 2, None)], ROWS))
    assert [tuple(r) for r in alone.collect()] == [(100, 1, 1, 2, 0, 0)]
