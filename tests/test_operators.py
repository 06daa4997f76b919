from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierloom.constants import APP_POWER_LABELS, ATTACK_TIERS, DEFENSE_TIERS, POWER_BOUNDS, TILE_POWER_LABELS
from tierloom.functions.derive import (
    any_match,
    bucket,
    category,
    expected_value,
    lower_columns,
    row_total,
    tier,
)
from tierloom.operators.project import Projection, project
from tierloom.operators.reshape import matrix_wide, pivot_max, unpivot_cols


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    ("thresholds", "cases"),
    [
        (ATTACK_TIERS, {149: "C", 150: "B", 199: "B", 200: "A", 249: "A", 250: "S", None: "C"}),
        (DEFENSE_TIERS, {249: "C", 250: "B", 299: "B", 300: "A", 349: "A", 350: "S"}),
    ],
)
def test_tiers(spark, thresholds, cases):
    got = values(spark, [(value,) for value in cases], "v int", tier(F.col("v"), thresholds))
    assert got == list(cases.values())


@pytest.mark.parametrize("labels", [APP_POWER_LABELS, TILE_POWER_LABELS])
def test_power_buckets(spark, labels):
    powers = [(p,) for p in (39, 40, 59, 60, 79, 80, 99, 100, 119, 120)]
    got = values(spark, powers, "v int", bucket(F.col("v"), POWER_BOUNDS, labels))
    assert got == [labels[i] for i in (0, 1, 1, 2, 2, 3, 3, 4, 4, 5)]


def test_bucket_needs_matching_labels():
    with pytest.raises(ValueError, match="label"):
        bucket(None, (1, 2), ("a",))


def test_expected_value(spark):
    rows = [(None, 50), (None, None), (80, None), (80, 75), (33, 33), (2**40, 100)]
    got = values(spark, rows, "a bigint, p bigint", expected_value(F.col("a"), F.col("p")))
    assert got == [0.0, 0.0, 80.0, 60.0, 10.89, float(2**40)]


def test_row_total_and_any_match(spark):
    assert values(spark, [(1, None), (None, None)], "a int, b int", row_total(["a", "b"])) == [1, 0]
    rows = [("x", "x", None), ("x", None, "x"), ("x", "y", None), (None, None, None)]
    matched = any_match(F.col("v"), F.col("a"), F.col("b"))
    assert values(spark, rows, "v string, a string, b string", matched) == [True, True, False, False]


def test_category(spark):
    rows = [(True, True, "x"), (False, True, "x"), (None, True, "x"), (None, None, "x"), (False, False, None)]
    got = values(spark, rows, "m boolean, l boolean, t string", category(F.col("m"), F.col("l"), F.col("t")))
    assert got == ["Mythical", "Legendary", "Legendary", "x", None]


def test_lower_columns(spark):
    assert lower_columns(spark.createDataFrame([(1, 2)], "Abc int, DEF int")).columns == ["abc", "def"]


def test_pivot_and_unpivot_are_inverse_on_values(spark):
    long = [(1, "a", 5), (1, "b", 7), (2, "a", 3), (3, "c", 9)]
    df = spark.createDataFrame([*long, (1, "a", 4), (1, "other", 99)], "id int, k string, v int")
    mapping = {"a": "col_a", "b": "col_b", "c": "col_c"}
    wide = pivot_max(df, ["id"], "k", "v", mapping)
    assert {r["id"]: (r["col_a"], r["col_b"], r["col_c"]) for r in wide.collect()} == {
        1: (5, 7, None),
        2: (3, None, None),
        3: (None, None, 9),
    }
    back = unpivot_cols(wide, ["id"], {column: name for name, column in mapping.items()}, "k", "v")
    assert sorted(map(tuple, back.collect())) == long
    kept = unpivot_cols(wide, ["id"], {"col_a": "a", "col_b": "b"}, "k", "v", keep_nulls=True)
    assert kept.count() == 6


def test_pivot_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 2 AS id", "'a' AS k", "id AS v")
    text = pivot_max(df, ["id"], "k", "v", {"a": "a"})._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.index("partial_max")


def test_matrix_wide(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)], "r string, c string, v double")
    wide = matrix_wide(df, "r", "c", "v", ["x", "y"]).orderBy("r")
    assert [tuple(row) for row in wide.collect()] == [("a", 1.0, 2.0), ("b", 3.0, None)]
    assert matrix_wide(df, "r", "c", "v", ["z"], 1).select("z").distinct().first()[0] == 1


def test_projection(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("3", None)], "`order` string, n string")
    spec = Projection([("order", "bigint", "position"), ("n", "string", "name")], ["order"])
    assert [tuple(row) for row in project(df, spec).collect()] == [(1, "a"), (3, None)]
    bad = spark.createDataFrame([("x", "a")], "`order` string, n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        project(bad, spec).collect()


def test_projection_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id AS a", "id AS unused").write.parquet(path)
    spec = Projection([("a", "bigint", "b")], ["id"])
    text = project(spark.read.parquet(path), spec)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id)]" in text and "unused" not in text
