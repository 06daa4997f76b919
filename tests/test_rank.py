from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierloom.operators import rank
from tierloom.operators.rank import Key, falling, rank_rows, ranks_of, rising, sorts, top_k, top_ranked

SCHEMA = "id bigint, score bigint, flag boolean, kind string"


def order():
    return [falling("score", nulls_first=True), rising("id")]


def brute(rows):
    """Row numbers by sorting in Python."""
    placed = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    seen: dict = {}
    out = []
    for number, row in enumerate(placed, 1):
        keys = (("flag", row[2]), ("kind", row[3] or "none"))
        for key in keys:
            seen[key] = seen.get(key, 0) + 1
        out.append((*row, number, seen[keys[0]], seen[keys[1]]))
    return sorted(out)


def ranked(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    ranks = {"overall": [], "by_flag": ["flag"], "by_kind": [F.coalesce("kind", F.lit("none"))]}
    return sorted(tuple(row) for row in rank_rows(df, order(), ranks).collect())


@pytest.fixture(autouse=True)
def small_parts(monkeypatch):
    """So that a few hundred rows are many parts."""
    monkeypatch.setattr(rank, "PART_ROWS", 50)
    monkeypatch.setattr(rank, "SAMPLES", 4)


def test_ranks_match_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (
            i,
            rng.choice([None, 3, 3, 3, rng.randrange(50)]),
            rng.choice([True, False, None]),
            rng.choice(["a", "b", None]),
        )
        for i in range(700)
    ]
    assert ranked(spark, rows) == brute(rows)


def test_with_one_value_in_most_rows(spark):
    """Ties are settled by the id, so a hot value is still cut into ranges."""
    rows = [(i, 5 if i % 10 else i, None if i % 3 else True, "a") for i in range(2000)]
    assert ranked(spark, rows) == brute(rows)


def test_on_no_rows(spark):
    assert ranked(spark, []) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.sampled_from([True, False, None])), max_size=40
    )
)
def test_ranks_of_any_rows(spark, values):
    rows = [(i, score, flag, None) for i, (score, flag) in enumerate(values)]
    assert ranked(spark, rows) == brute(rows)


def test_no_task_holds_the_table(spark):
    """Rows are numbered in their parts; only the parts' sizes ever meet in one task, and only narrow rows are written."""
    df = spark.range(2000).selectExpr("id", "id % 7 AS score", "repeat('x', 50) AS wide")
    ranked_ = rank_rows(df, [falling("score"), rising("id")], {"r": [], "by_score": ["score"]})
    text = plan(ranked_.where("r > 0")).split("Initial Plan")[0]
    for piece in text.split("SinglePartition")[1:]:
        # Sizes of parts, or the borders that the driver holds.
        assert "_size" in piece.split("Exchange")[0] or "n#" in piece.split("Exchange")[0]
    for scan in text.split("Scan parquet")[1:]:
        assert "wide" not in scan.split("ReadSchema")[1].split("\n")[0]
    assert ranked_.agg(F.sum("r")).first()[0] == 2000 * 2001 // 2


def test_a_part_computed_again_gives_the_same_ranks(spark):
    """The borders are constants: rows dealt anew, as after a loss, keep their parts."""
    rows = [(i, i * 7919 % 50, None if i % 3 else True, "a") for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    ranked_ = rank_rows(df, order(), {"r": []})
    parts = [ranked_.where(F.col("id") % 9 == k).collect() for k in range(9)]  # each its own job
    assert sorted(row["r"] for part in parts for row in part) == list(range(1, 901))
    again = rank_rows(df.repartition(11), order(), {"r": []}).select("id", "r")
    assert again.exceptAll(ranked_.select("id", "r")).isEmpty()


def test_borders_cut_a_hot_value(spark, monkeypatch):
    seen = []
    with_place = rank.with_place
    monkeypatch.setattr(rank, "with_place", lambda df, *a: seen.append(with_place(df, *a)) or seen[-1])
    rank_rows(spark.range(3000).selectExpr("id", "if(id % 3 = 0, 1, id) AS score"), [falling("score"), rising("id")], {"r": []})
    sizes = [row["count"] for row in seen[0].groupBy("_part").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 3 * 3000 / len(sizes)


def test_ranks_of_chosen_rows(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, 3, rng.randrange(50)]), rng.choice([True, False, None]), "a") for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = {row[0]: row[4:6] for row in brute(rows)}
    chosen = df.where("NOT flag").orderBy(*sorts(order())).limit(40)
    got = ranks_of(df, chosen, order(), {"overall": None, "among_false": ~F.col("flag")})
    assert {row["id"]: (row["overall"], row["among_false"]) for row in got.collect()} == {
        row["id"]: want[row["id"]] for row in chosen.collect()
    }
    text = plan(got)
    assert "parquet" not in text and "rangepartitioning" not in text
    assert ranks_of(df, df.where("id < 0"), order(), {"overall": None}).count() == 0


def test_keys_of_all_kinds(spark):
    odd = [float("nan"), float("inf"), -0.0, 0.0, None]
    rows = [(i % 3, "aé日b"[i % 4] if i % 5 else None, i / 7 if i % 4 else odd[i // 4 % 5], i) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d bigint")
    for falls in (False, True):
        keys = [rising("a"), falling("b"), Key("c", falls, nulls_first=False), falling("d")]
        got = rank_rows(df, keys, {"r": []})
        assert [row["d"] for row in got.orderBy("r").collect()] == [row["d"] for row in df.orderBy(*sorts(keys)).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    best = top_k(df, ["g"], [F.col("id").desc()], 2, "place")
    assert sorted(tuple(r) for r in best.collect()) == [
        (994, 1, 2), (995, 2, 2), (996, 0, 2), (997, 1, 1), (998, 2, 1), (999, 0, 1),
    ]
    text = plan(best)
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_top_ranked_needs_no_full_sort(spark):
    df = spark.range(1000).repartition(4)
    best = top_ranked(df, [falling("id")], 3, "place")
    assert [tuple(r) for r in best.orderBy("place").collect()] == [(999, 1), (998, 2), (997, 3)]
    assert "TakeOrderedAndProject" in plan(best)
