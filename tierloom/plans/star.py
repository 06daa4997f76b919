"""The raw tables of the pipeline, derived from a star schema of orders.

The entity is the customer. Its stats are what it bought, by return flag and
line status; its types are the part types it returned in bulk; its moves are
the parts it ever bought. Part gives the moves, nation the species, and trade
between nations the relations. Everything is computed from the given tables,
so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierloom.naming import Naming
from tierloom.schemas import SYNCED_AT
from tierloom.sources.tables import read_star

# (return flag, line status) -> stat name.
STAT_FLAGS = {
    ("N", "F"): "hp",
    ("A", "F"): "attack",
    ("A", "O"): "defense",
    ("N", "O"): "special-attack",
    ("R", "F"): "special-defense",
    ("R", "O"): "speed",
}
# Remainder of the traded quantity -> relation of the two nations.
TRADE_RELATIONS = {0: "double_damage_to", 1: "half_damage_to", 2: "no_damage_to", 3: "double_damage_from"}
# Divisor of the traded quantity -> relation that the pair has besides.
MORE_RELATIONS = {7: "half_damage_to", 3: "no_damage_to"}
SYNCED = "2024-01-01 00:00:00"


class Star:
    """Derived raw tables of one data folder; every method is lazy."""

    def __init__(self, spark: SparkSession, directory: str, naming: Naming = Naming()):
        self._spark = spark
        self._directory = directory
        self._naming = naming

    def table(self, name: str) -> DataFrame:
        return read_star(self._spark, self._directory, name)

    def _lines(self, *columns: str) -> DataFrame:
        """Order lines with the customer of their order."""
        lines = self.table("lineitem").select("l_orderkey", *columns)
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias(self._naming.id))
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    def entities(self) -> DataFrame:
        balance = F.floor("c_acctbal").cast("bigint")
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.when(balance >= 0, balance).alias("base_experience"),
            F.col("c_nationkey").cast("bigint").alias("height"),
            F.abs(balance).alias("weight"),
            (F.col("c_mktsegment") != "BUILDING").alias("is_default"),
            F.col("c_custkey").alias("order"),
            F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_nationkey").cast("bigint")).alias("species_id"),
        )

    def stats(self) -> DataFrame:
        """Quantity and line count per customer and flag pair.

        Lines are added up per order before they meet the orders, so an order
        with very many lines is one row in the join, and the one shuffle by
        order serves both.
        """
        kinds = list(STAT_FLAGS.items())
        of_kind = [(F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status) for (flag, status), _ in kinds]
        per_order = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                *[F.sum(F.when(test, F.col("l_quantity"))).alias(f"q{i}") for i, test in enumerate(of_kind)],
                *[F.count_if(test).alias(f"n{i}") for i, test in enumerate(of_kind)],
            )
        )
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias(self._naming.id))
        totals = (
            per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(self._naming.id)
            .agg(*[F.sum(f"{kind}{i}").alias(f"{kind}{i}") for kind in "qn" for i in range(len(kinds))])
        )
        rows = [
            F.struct(
                F.lit(name).alias("stat_name"),
                F.col(f"q{i}").cast("bigint").alias("base_stat"),
                F.col(f"n{i}").alias("effort"),
            )
            for i, (_, name) in enumerate(kinds)
        ]
        long = totals.select(self._naming.id, F.inline(F.array(*rows)))
        return long.where(F.col("effort") > 0)

    def types(self) -> DataFrame:
        """Part types a customer bought, the largest quantity first."""
        lines = self._lines("l_partkey", "l_quantity")
        parts = self.table("part").select("p_partkey", F.col("p_type").alias("type_name"))
        bought = (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(self._naming.id, "type_name")
            .agg(F.sum("l_quantity").alias("_quantity"))
        )
        # After the sum a customer has at most one row per part type.
        place = Window.partitionBy(self._naming.id).orderBy(F.col("_quantity").desc(), "type_name")
        return bought.select(self._naming.id, "type_name", F.row_number().over(place).cast("bigint").alias("slot"))

    def abilities(self) -> DataFrame:
        """Order priorities a customer uses; hidden if any such order is still pending."""
        return (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias(self._naming.id), F.col("o_orderpriority").alias("ability_name"))
            .agg(F.bool_or(F.col("o_orderstatus") == "P").alias("is_hidden"))
            .withColumn("slot", F.substring("ability_name", 1, 1).cast("bigint"))
        )

    def learned(self) -> DataFrame:
        """Parts a customer ever bought, once each."""
        bought = self._lines("l_partkey").select(self._naming.id, "l_partkey").distinct()
        parts = self.table("part").select("p_partkey", self._move_name())
        return bought.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(self._naming.id, "move_name")

    @staticmethod
    def _move_name():
        return F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("move_name")

    def moves(self) -> DataFrame:
        brand = F.substring("p_brand", 7, 10).cast("bigint")
        size = F.col("p_size").cast("bigint")
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            self._move_name().alias("name"),
            F.when(size % 7 != 0, F.floor("p_retailprice").cast("bigint") % 101).alias("accuracy"),
            F.when((brand % 3 != 2) & (size % 11 != 0), size * 3).alias("power"),
            (size % 40 + 1).alias("pp"),
            F.col("p_type").alias("type"),
            F.when(brand % 3 == 0, "physical").when(brand % 3 == 1, "special").otherwise("status").alias("damage_class"),
            F.when(size % 2 == 0, size).alias("effect_chance"),
        )

    def species(self) -> DataFrame:
        key = F.col("n_nationkey").cast("bigint")
        regions = self.table("region")
        return self.table("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
            key.alias("id"),
            F.col("n_name").alias("name"),
            (key * 10).alias("capture_rate"),
            F.when(key % 4 != 0, key + 50).alias("base_happiness"),
            (F.col("n_regionkey") == 1).alias("is_legendary"),
            (key % 7 == 3).alias("is_mythical"),
            F.col("r_name").alias("generation"),
            F.when(F.col("n_regionkey") != 2, F.lower("r_name")).alias("habitat"),
            F.when(key % 3 != 0, F.lower("n_name")).alias("shape"),
        )

    def trade(self) -> DataFrame:
        """Quantity each nation's customers bought from each nation's suppliers.

        Each side first learns its nation and drops the wider key, so lines
        move twice in all, and the sum leaves every task with one row per pair
        of nations.
        """
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
        suppliers = self.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("target"))
        sold = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
            "l_orderkey", "target", "l_quantity"
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        customers = self.table("customer").select("c_custkey", F.col("c_nationkey").alias("source"))
        bought = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "source")
        return (
            sold.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("source", "target")
            .agg(F.sum("l_quantity").cast("bigint").alias("quantity"))
        )

    def relations(self) -> DataFrame:
        """Relations between nations; some pairs have two or three, so that their precedence counts."""
        nations = self.table("nation")
        sources = nations.select(F.col("n_nationkey").alias("source"), F.col("n_name").alias("name"))
        targets = nations.select(F.col("n_nationkey").alias("target"), F.col("n_name").alias("target_type"))
        relation = F.lit(None).cast("string")
        for remainder, name in TRADE_RELATIONS.items():
            relation = F.when(F.col("quantity") % 5 == remainder, F.lit(name)).otherwise(relation)
        more = [F.when(F.col("quantity") % divisor == 0, F.lit(name)) for divisor, name in MORE_RELATIONS.items()]
        return (
            self.trade()
            .withColumn("damage_relation", F.explode(F.array_distinct(F.array_compact(F.array(relation, *more)))))
            .join(sources, "source")
            .join(targets, "target")
            .select(F.col("source").cast("bigint").alias("id"), "name", "damage_relation", "target_type")
        )

    def raw(self, *names: str) -> dict[str, DataFrame]:
        """The named raw tables, or all eight."""
        n = self._naming
        builders = {
            n.raw(): self.entities,
            n.raw("stats"): self.stats,
            n.raw("types"): self.types,
            n.raw("abilities"): self.abilities,
            n.raw("moves"): self.learned,
            "moves": self.moves,
            "species": self.species,
            "types": self.relations,
        }
        synced = F.lit(SYNCED).cast("timestamp").alias(SYNCED_AT)
        return {name: builders[name]().select("*", synced) for name in names or builders}
