"""Nested documents built row by row from the star tables, sent through JSON and flattened again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.schemas import ENTITY_DOCUMENT, MOVE_DOCUMENT, SPECIES_DOCUMENT, TYPE_DOCUMENT
from tierloom.sources import documents
from tierloom.sources.tables import read_star
from workload.registry import query


def _named(value: Column) -> Column:
    return F.struct(value.alias("name"))


def _document(fields: list[Column]) -> Column:
    return F.to_json(F.struct(*fields)).alias("document")


def _star_rows(spark: SparkSession, directory: str, name: str, spread: bool) -> DataFrame:
    """A star table's rows; ``spread`` over all cores, as a small file is a single task however many documents it makes."""
    rows = read_star(spark, directory, name)
    return rows.repartition(spark.sparkContext.defaultParallelism) if spread else rows


def entity_documents(spark: SparkSession, directory: str, spread: bool = False) -> DataFrame:
    """One document per part: its words as moves, its brand as species, its numbers as stats.

    Lists are built within the row, so no document gathers rows of another.
    """
    size = F.col("p_size").cast("bigint")
    price = F.floor("p_retailprice").cast("bigint")
    brand = F.substring("p_brand", 7, 10)

    def stat(name: str, value: Column) -> Column:
        return F.struct(value.alias("base_stat"), (value % 4).alias("effort"), _named(F.lit(name)).alias("stat"))

    def slot(number: int, value: Column) -> Column:
        return F.struct(F.lit(number).alias("slot"), _named(value).alias("type"))

    def ability(number: int, value: Column, hidden: Column) -> Column:
        return F.struct(hidden.alias("is_hidden"), F.lit(number).alias("slot"), _named(value).alias("ability"))

    species = F.struct(
        F.col("p_brand").alias("name"), F.concat(F.lit("https://example.org/species/"), brand, F.lit("/")).alias("url")
    )
    texts = _star_rows(spark, directory, "part", spread).select(
        _document(
            [
                F.col("p_partkey").alias("id"),
                F.col("p_name").alias("name"),
                F.when(size % 5 != 0, size).alias("base_experience"),
                price.alias("height"),
                (price * 2).alias("weight"),
                (size > 25).alias("is_default"),
                F.col("p_partkey").alias("order"),
                F.when(size % 3 != 0, species).alias("species"),
                F.when(size % 4 != 0, F.array(stat("hp", size), stat("attack", price))).alias("stats"),
                F.array(slot(1, F.col("p_type")), slot(2, F.lower("p_type"))).alias("types"),
                F.array(ability(1, F.col("p_brand"), F.lit(False)), ability(3, F.col("p_type"), size < 9)).alias("abilities"),
                F.transform(F.split("p_name", " "), lambda word: F.struct(_named(word).alias("move"))).alias("moves"),
            ]
        )
    )
    return documents.parse_documents(texts, "document", ENTITY_DOCUMENT)


@query(
    "flatten_entity",
    """SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size % 5 <> 0 THEN p_size::BIGINT END AS base_experience,
              floor(p_retailprice)::BIGINT AS height, 2 * floor(p_retailprice)::BIGINT AS weight,
              p_size > 25 AS is_default, p_partkey AS "order",
              CASE WHEN p_size % 3 <> 0 THEN substr(p_brand, 7)::BIGINT END AS species_id
       FROM part""",
)
def flatten_entity(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_entity(entity_documents(spark, directory))


@query(
    "flatten_stats",
    """SELECT p_partkey AS entity_id, 'hp' AS stat_name, p_size::BIGINT AS base_stat, (p_size % 4)::BIGINT AS effort
       FROM part WHERE p_size % 4 <> 0
       UNION ALL SELECT p_partkey, 'attack', floor(p_retailprice)::BIGINT, floor(p_retailprice)::BIGINT % 4
       FROM part WHERE p_size % 4 <> 0""",
)
def flatten_stats(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_stats(entity_documents(spark, directory))


@query(
    "flatten_types",
    """SELECT p_partkey AS entity_id, p_type AS type_name, 1::BIGINT AS slot FROM part
       UNION ALL SELECT p_partkey, lower(p_type), 2 FROM part""",
)
def flatten_types(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_types(entity_documents(spark, directory))


@query(
    "flatten_abilities",
    """SELECT p_partkey AS entity_id, p_brand AS ability_name, false AS is_hidden, 1::BIGINT AS slot FROM part
       UNION ALL SELECT p_partkey, p_type, p_size < 9, 3 FROM part""",
)
def flatten_abilities(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_abilities(entity_documents(spark, directory))


@query(
    "flatten_entity_moves",
    "SELECT p_partkey AS entity_id, unnest(string_split(p_name, ' ')) AS move_name FROM part",
)
def flatten_entity_moves(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_entity_moves(entity_documents(spark, directory))


@query(
    "array_explode",
    """SELECT l_orderkey, l_linenumber, l_partkey, measure, value FROM (
           SELECT *, unnest(['quantity', 'discount']) AS measure, unnest([l_quantity, l_discount]) AS value
           FROM lineitem)""",
)
def array_explode(spark: SparkSession, directory: str) -> DataFrame:
    measures = F.array(
        F.struct(F.lit("quantity").alias("measure"), F.col("l_quantity").alias("value")),
        F.struct(F.lit("discount").alias("measure"), F.col("l_discount").alias("value")),
    )
    exploded = read_star(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.explode(measures).alias("item")
    )
    return exploded.select("l_orderkey", "l_linenumber", "l_partkey", "item.measure", "item.value")


@query(
    "map_explode",
    """SELECT event_id, 'k' AS name, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value FROM events""",
)
def map_explode(spark: SparkSession, directory: str) -> DataFrame:
    """The properties of an event as a map, one row per entry."""
    events = read_star(spark, directory, "events")
    entries = F.from_json("props", "map<string,bigint>", {"mode": "FAILFAST"})
    return events.select("event_id", F.explode(entries).alias("name", "value"))


@query(
    "flatten_moves",
    """SELECT event_id AS id, event_type || '-' || event_id AS name,
              CASE WHEN event_id % 3 <> 0 THEN floor(value)::BIGINT END AS accuracy,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS power, user_id AS pp, event_type AS type,
              CASE event_id % 3 WHEN 0 THEN 'physical' WHEN 1 THEN 'special' ELSE 'status' END AS damage_class,
              CAST(NULL AS BIGINT) AS effect_chance
       FROM events""",
)
def flatten_moves(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_moves(move_documents(spark, directory))


def move_documents(spark: SparkSession, directory: str) -> DataFrame:
    """One document per event; the last optional number is left out of every document."""
    third = F.col("event_id") % 3
    power = F.from_json("props", "k bigint", {"mode": "FAILFAST"})["k"]
    texts = read_star(spark, directory, "events").select(
        _document(
            [
                F.col("event_id").alias("id"),
                F.concat_ws("-", "event_type", F.col("event_id").cast("string")).alias("name"),
                F.when(third != 0, F.floor("value").cast("bigint")).alias("accuracy"),
                power.alias("power"),
                F.col("user_id").alias("pp"),
                _named(F.col("event_type")).alias("type"),
                _named(F.when(third == 0, "physical").when(third == 1, "special").otherwise("status")).alias("damage_class"),
            ]
        )
    )
    return documents.parse_documents(texts, "document", MOVE_DOCUMENT)


@query(
    "flatten_species",
    """SELECT d.doc_id AS id, source || '/' || d.doc_id AS name, n_chars % 256 AS capture_rate,
              CASE WHEN n_chars % 2 = 0 THEN n_chars // 2 END AS base_happiness, quality = 1 AS is_legendary,
              toxic = 1 AS is_mythical, lang AS generation,
              CASE WHEN quality = 1 THEN source END AS habitat, CASE WHEN toxic = 0 THEN lang END AS shape
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def flatten_species(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_species(species_documents(spark, directory))


def species_documents(spark: SparkSession, directory: str) -> DataFrame:
    """One document per text, flags missing without a label; habitat and shape are missing from some."""
    chars = F.col("n_chars")
    labels = read_star(spark, directory, "labels").hint("merge")  # compressed, more than a million of them look small
    rows = read_star(spark, directory, "documents").join(labels, "doc_id", "left")
    texts = rows.select(
        _document(
            [
                F.col("doc_id").alias("id"),
                F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("name"),
                (chars % 256).alias("capture_rate"),
                F.when(chars % 2 == 0, F.floor(chars / 2)).alias("base_happiness"),
                (F.col("quality") == 1).alias("is_legendary"),
                (F.col("toxic") == 1).alias("is_mythical"),
                _named(F.col("lang")).alias("generation"),
                F.when(F.col("quality") == 1, _named(F.col("source"))).alias("habitat"),
                F.when(F.col("toxic") == 0, _named(F.col("lang"))).alias("shape"),
            ]
        )
    )
    return documents.parse_documents(texts, "document", SPECIES_DOCUMENT)


@query(
    "flatten_relations",
    """SELECT o_orderkey AS id, o_orderpriority AS name, 'double_damage_to' AS damage_relation, o_orderstatus AS target_type
       FROM orders
       UNION ALL SELECT o_orderkey, o_orderpriority, 'double_damage_to', lower(o_orderstatus) FROM orders
       UNION ALL SELECT o_orderkey, o_orderpriority, 'half_damage_from', 'c' || o_custkey % 10 FROM orders""",
)
def flatten_relations(spark: SparkSession, directory: str) -> DataFrame:
    return documents.flatten_relations(relation_documents(spark, directory))


def relation_documents(spark: SparkSession, directory: str, spread: bool = False) -> DataFrame:
    """One document per order: a map of three relations, one of them without targets."""

    def target(name: Column) -> Column:
        return F.struct(name.alias("name"), F.lit("https://example.org/").alias("url"))

    status = F.col("o_orderstatus")
    customer = F.concat(F.lit("c"), (F.col("o_custkey") % 10).cast("string"))
    relations = F.create_map(
        F.lit("double_damage_to"), F.array(target(status), target(F.lower(status))),
        F.lit("half_damage_from"), F.array(target(customer)),
        F.lit("no_damage_to"), F.slice(F.array(target(status)), 1, 0),
    )
    texts = _star_rows(spark, directory, "orders", spread).select(
        _document(
            [
                F.col("o_orderkey").alias("id"),
                F.col("o_orderpriority").alias("name"),
                relations.alias("damage_relations"),
            ]
        )
    )
    return documents.parse_documents(texts, "document", TYPE_DOCUMENT)


@query(
    "flatten_variant_relations",
    """SELECT o_orderkey AS id, o_orderpriority AS name, 'double_damage_to' AS damage_relation, o_orderstatus AS target_type
       FROM orders WHERE o_orderkey % 5 <> 4
       UNION ALL SELECT o_orderkey, o_orderpriority, 'double_damage_to', lower(o_orderstatus)
       FROM orders WHERE o_orderkey % 5 IN (0, 1)
       UNION ALL SELECT o_orderkey, o_orderpriority, 'half_damage_from', 'c' || o_custkey % 10
       FROM orders WHERE o_orderkey % 5 <> 4""",
)
def flatten_variant_relations(spark: SparkSession, directory: str) -> DataFrame:
    """Documents of five shapes: lists of objects or of names, one object, one name, and lines cut off."""
    return documents.flatten_variant_relations(documents.variant_documents(shaped_lines(spark, directory), "line")[0])


@query(
    "variant_rejects",
    "SELECT o_orderkey, '{\"id\": ' || o_orderkey AS line FROM orders WHERE o_orderkey % 5 = 4",
)
def variant_rejects(spark: SparkSession, directory: str) -> DataFrame:
    return documents.variant_documents(shaped_lines(spark, directory), "line")[1]


def shaped_lines(spark: SparkSession, directory: str) -> DataFrame:
    """One line of JSON per order, whose form depends on its key."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    customer = F.concat(F.lit("c"), (F.col("o_custkey") % 10).cast("string"))

    def line(identity: Column, double: Column, half: Column) -> Column:
        relations = F.struct(double.alias("double_damage_to"), half.alias("half_damage_from"))
        return F.to_json(
            F.struct(identity.alias("id"), F.col("o_orderpriority").alias("name"), relations.alias("damage_relations"))
        )

    shape = key % 5
    lines = (
        F.when(shape == 0, line(key, F.array(_named(status), _named(F.lower(status))), F.array(_named(customer))))
        .when(shape == 1, line(key.cast("string"), F.array(status, F.lower(status)), F.array(customer)))
        .when(shape == 2, line(key, _named(status), _named(customer)))
        .when(shape == 3, line(key, status, customer))
        .otherwise(F.concat(F.lit('{"id": '), key.cast("string")))
    )
    return read_star(spark, directory, "orders").select("o_orderkey", lines.alias("line"))
