from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.sources import keyed_table
from tierloom.sources.keyed_table import KeyedTable, latest_rows, merge_latest

DDL = "id bigint, part string, value bigint"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(DDL), ["id", "part"], buckets=4)


def batch(spark, rows):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], f"{DDL}, seq bigint")


def put(spark, table, rows, **options):
    return table.upsert(batch(spark, rows), [F.col("seq").desc()], **options)


def content(table):
    return sorted((tuple(row) for row in table.read().collect()), key=str)


def test_empty_table(table):
    assert content(table) == [] and table.version() == -1


def test_last_write_wins_within_and_across_batches(spark, table):
    assert put(spark, table, [(1, "a", 1), (2, "a", 2), (1, "a", 3)]) == (2, 2, None)
    assert content(table) == [(1, "a", 3), (2, "a", 2)]
    assert put(spark, table, [(2, "a", 9), (3, "b", 4)], greatest="value") == (2, 2, 9)
    assert content(table) == [(1, "a", 3), (2, "a", 9), (3, "b", 4)]


def test_same_batch_twice_changes_nothing(spark, table):
    rows = [(1, "a", 1), (2, "b", 2)]
    put(spark, table, rows)
    before, version = content(table), table.version()
    assert put(spark, table, rows) == (2, 0, None)
    assert put(spark, table, [*rows, (1, "a", None)]) == (2, 1, None)  # a value that went is a change
    assert put(spark, table, rows) == (2, 1, None)
    assert content(table) == before and table.version() == version + 2


def test_token_is_applied_once(spark, table):
    put(spark, table, [(1, "a", 1)], token="s/0")
    put(spark, table, [(1, "a", 2)], token="s/1")
    assert put(spark, table, [(1, "a", 1)], token="s/0") == (0, 0, None)
    assert put(spark, table, [(1, "a", 2)], token="s/2").written == 0
    assert put(spark, table, [(1, "a", 7)], token="s/2").rows == 0
    assert content(table) == [(1, "a", 2)]


def test_unfinished_batch_is_never_seen_and_is_replaced(spark, table, tmp_path):
    """A folder without the file that ends it is what a writer that died leaves."""
    put(spark, table, [(1, "a", 1)])
    lost = tmp_path / "t" / "v1"
    for bucket in range(4):
        spark.createDataFrame([(1, "a", 5), (7, "z", 7)], DDL).write.parquet(str(lost / f"_bucket={bucket}"))
    assert content(table) == [(1, "a", 1)] and table.version() == 0
    put(spark, table, [(2, "a", 2)])
    assert content(table) == [(1, "a", 1), (2, "a", 2)] and table.version() == 1


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(DDL), ["id", "part"], unwatched=["value"], buckets=8)
    put(spark, table, [(i, "a", i) for i in range(200)])
    assert put(spark, table, [(5, "a", 50), (500, "a", 1)]) == (2, 1, None)  # an unwatched column alone is no change
    assert len([p for p in (tmp_path / "t" / "v1").iterdir() if p.name.startswith("_bucket")]) == 1
    assert len(content(table)) == 201


def test_null_in_a_key_is_a_value(spark, table):
    put(spark, table, [(None, "a", 1), (1, None, 2)])
    put(spark, table, [(None, "a", 5)])
    assert content(table) == [(1, None, 2), (None, "a", 5)]


def test_changes_are_merged_without_moving_the_base(spark, tmp_path):
    base_path = str(tmp_path / "base")
    spark.range(20000).selectExpr("id", "id AS value").write.parquet(base_path)
    base = spark.read.parquet(base_path)
    changes = spark.range(3).selectExpr("id", "-1L AS value")
    merged = merge_latest(base, changes, ["id"])
    assert merged.agg(F.count("*"), F.sum("value")).first()[:] == (20000, sum(range(3, 20000)) - 3)
    assert "BroadcastHashJoin" in merged._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_keeps_one_per_key(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS at")
    got = latest_rows(df, ["k"], [F.col("at").desc()])
    assert sorted(row["at"] for row in got.collect()) == list(range(993, 1000))


def test_files_stay_few(spark, table, tmp_path):
    """However many batches there were, a bucket is there twice at most; old tokens still count."""
    reader = None
    for number in range(7):
        put(spark, table, [(1, "a", number), (number, "b", number)], token=f"s/{number}")
        assert reader is None or reader.count() > 0  # a reader keeps its version until the one after next
        reader = table.read()
    folders = [bucket for version in (tmp_path / "t").iterdir() for bucket in version.iterdir() if bucket.name.startswith("_bucket")]
    assert len(folders) <= 8
    assert put(spark, table, [(1, "a", 100)], token="s/3").rows == 0
    assert content(table) == sorted([(1, "a", 6), *((n, "b", n) for n in range(7))], key=str)


def test_many_rows_are_not_sent_to_the_driver(spark, table, monkeypatch):
    """Neither the stored keys nor those of a large batch are broadcast, however small Spark takes them to be."""
    plans, frame = [], type(spark.range(0))

    def spy(*args, join=frame.join, **options):
        joined = join(*args, **options)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(frame, "join", spy)
    monkeypatch.setattr(keyed_table, "BROADCAST_KEYS", 10, raising=False)
    put(spark, table, [(i, "a", i) for i in range(100)])
    assert put(spark, table, [(i, "a", -i) for i in range(50, 150)]) == (100, 100, None)
    assert plans and not any("Broadcast" in plan for plan in plans)
    assert content(table) == sorted([*((i, "a", i) for i in range(50)), *((i, "a", -i) for i in range(50, 150))], key=str)
