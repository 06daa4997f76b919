"""Plans that must hold when data is large and one key is hot."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierloom.operators.quality import relationship, run_checks, unique
from tierloom.operators.rank import top_k
from tierloom.plans.star import Star
from tierloom.sources import storage
from workload.documents import entity_documents, species_documents

TINY_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def settings(spark):
    changed = {}

    def apply(values):
        for key, value in values.items():
            changed[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield apply
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


@pytest.fixture
def hot_star(spark, tmp_path):
    """A star in which one order, one part and one supplier hold two thirds of all lines."""
    hot = "id % 3 != 0"
    lines = spark.range(60000).selectExpr(
        f"if({hot}, 5L, id % 900) AS l_orderkey",
        f"if({hot}, 7L, id % 50) AS l_partkey",
        f"if({hot}, 3L, id % 10) AS l_suppkey",
        "double(1 + id % 50) AS l_quantity",
        "substr('ANR', int(1 + id % 3), 1) AS l_returnflag",
        "substr('FO', int(1 + id % 2), 1) AS l_linestatus",
    )
    tables = {
        "lineitem": lines.repartition(8),
        "orders": spark.range(900).selectExpr("id AS o_orderkey", "id % 40 AS o_custkey"),
        "part": spark.range(50).selectExpr("id AS p_partkey", "concat('T', id % 4) AS p_type", "'n' AS p_name"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return Star(spark, str(tmp_path))


def test_hot_join_key_is_split(hot_star, settings):
    settings(TINY_SKEW)
    joined = hot_star._lines("l_partkey", "l_quantity").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    plan, rows = final_plan(joined)
    assert "skew=true" in plan
    lines = hot_star.table("lineitem")
    assert sum(row["q"] for row in rows) == lines.agg(F.sum("l_quantity")).first()[0]


def test_hot_order_is_added_up_before_the_join(hot_star, settings):
    settings(TINY_SKEW)
    plan, rows = final_plan(hot_star.stats())
    text = plan[plan.index("Initial Plan") :]
    assert "skew=true" not in plan  # nothing left to split
    assert text.index("SortMergeJoin") < text.index("partial_sum(CASE WHEN")
    total = hot_star.table("lineitem").agg(F.sum("l_quantity")).first()[0]
    assert sum(row["base_stat"] for row in rows) == total


def test_hot_group_sends_few_rows_to_top_k(hot_star):
    lines = hot_star.table("lineitem")
    order = [F.col(c).desc() for c in ("l_quantity", "l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")]
    best = top_k(lines, ["l_suppkey"], order, 3, "place")
    best.collect()
    exchange = best._jdf.queryExecution().executedPlan().toString()
    assert exchange.index("Exchange") < exchange.index("Partial")
    assert best.count() == 30


def test_hot_part_types(hot_star):
    """One customer holds most returned lines; its types are still at most one row per part type."""
    rows = hot_star.types().collect()
    assert max(row["slot"] for row in rows) <= 4
    assert {row["slot"] for row in rows if row["entity_id"] == 5} >= {1}


def test_checkpoint_folder_comes_from_the_session(spark):
    assert storage.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    df = storage.materialize(spark.range(3))
    assert df.inputFiles()[0].removeprefix("file://").startswith(storage.checkpoint_root(spark))


def test_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://somewhere:1"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.checkpoint_root(Session())


def test_lone_keys_are_grouped_by_their_own_columns(spark):
    """No key is turned into text, and rows dealt out by part of a key are not shuffled again; references still count."""
    rows = spark.range(100).selectExpr("id % 60 AS a", "string(id % 2) AS b").repartition(4, "a")
    lone = run_checks({"t": rows}, [unique("t", "a", "b")])
    plan = lone._jdf.queryExecution().executedPlan().toString()
    assert lone.first()["failures"] == 40 and "array(cast" not in plan and plan.count("hashpartitioning") == 1
    tables = {"t": rows, "u": spark.range(50)}
    checks = [unique("t", "a", "b"), unique("u", "id"), relationship("t", "a", "u", "id")]
    assert [row["failures"] for row in run_checks(tables, checks).collect()] == [40, 0, 10]


def test_small_file_lands_from_all_cores(spark, tmp_path):
    part = "1L AS p_partkey, 'a b' AS p_name, 'Brand#7' AS p_brand, 'T' AS p_type, 3 AS p_size, 9.5D AS p_retailprice"
    spark.range(100).selectExpr(*part.replace("1L", "id").split(", ")).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    entity_documents(spark, str(tmp_path), spread=True).write.json(str(tmp_path / "landed"))
    assert len(list((tmp_path / "landed").glob("part-*"))) == spark.sparkContext.defaultParallelism


def test_labels_are_not_sent_to_the_driver(spark, tmp_path):
    """Nothing that a pass lands is broadcast: a million labels fit into a file that Spark takes for a small table."""
    texts = spark.range(60).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    texts.write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(20).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    species = species_documents(spark, str(tmp_path))
    assert species.where("is_legendary").count() == 20 and species.count() == 60
    plan, _ = final_plan(species)
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
