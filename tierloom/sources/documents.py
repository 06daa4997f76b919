"""Landed JSON documents and their flattening into raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.functions.derive import url_last_id
from tierloom.naming import Naming

# Place of a document in the delivery: later files win, then later rows of a
# file. Row ids grow along a file block, so the four together are a total order.
SEQUENCE = "_sequence"
_ORIGIN = "_origin"
_ANY_AGE = "36500d"


def _with_origin(df: DataFrame) -> DataFrame:
    origin = F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return df.select("*", origin.alias(_ORIGIN))


def sequenced(docs: DataFrame) -> DataFrame:
    """Documents with their place in the delivery."""
    place = F.struct(f"{_ORIGIN}.*", F.monotonically_increasing_id().alias("row"))
    return docs.withColumn(SEQUENCE, place).drop(_ORIGIN)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of a folder, one JSON object per line, under a declared schema.

    A line that is no such object is an error, so nothing is lost unseen.
    """
    return sequenced(_with_origin(spark.read.schema(schema).json(path, mode="FAILFAST")))


_BAD = "_bad_line"


def split_documents(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The documents of a folder, and the lines that are none under the schema: (path, line).

    A line that parses but whose values do not fit the schema is bad as a whole.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    lines = _with_origin(spark.read.text(path)).where(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", f"{schema}, {_BAD} string", options).alias("_document"), _ORIGIN)
    fine = F.col(f"_document.{_BAD}").isNull()
    good = sequenced(parsed.where(fine).select("_document.*", _ORIGIN).drop(_BAD))
    bad = parsed.where(~fine).select(F.col(f"{_ORIGIN}.path").alias("path"), F.col(f"_document.{_BAD}").alias("line"))
    return good, bad


def stream_documents(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """The same folder as a stream of newly landed files, oldest first; each batch is to be ``sequenced``.

    ``max_files`` bounds the files of one batch, so that a large backlog is
    taken in, and committed, piece by piece. Files count as new however old
    their time stamps are; Spark would by itself pass over those a week behind
    the newest one.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", _ANY_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_origin(reader.json(path, mode="FAILFAST"))


def variant_documents(lines: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Documents of any shape as a VARIANT ``document`` beside the other columns, and the rows that hold no JSON object.

    Both come from one expression over the text, so every row is in exactly one of them; a NULL text is in the second.
    """
    parsed = F.try_parse_json(column)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    others = [F.col(other) for other in lines.columns if other != column]
    return lines.where(is_object).select(*others, parsed.alias("document")), lines.where(~is_object)


def flatten_variant_relations(docs: DataFrame) -> DataFrame:
    """Relation rows of VARIANT documents: one per (document, relation, target), whatever form the targets take.

    A relation names its targets by a list or by one alone, each an object with a name or the bare name. A relation of
    NULL or without targets gives no row, nor does a document without relations; a target without a name has a NULL
    one. Ids may be numbers or their text; what is no id is NULL. Unknown fields are passed over.
    """
    typed = docs.select(
        F.try_variant_get("document", "$.id", "bigint").alias("id"),
        F.try_variant_get("document", "$.name", "string").alias("name"),
        F.try_variant_get("document", "$.damage_relations", "map<string,variant>").alias("_relations"),
    )
    lists = typed.select("id", "name", F.explode("_relations").alias("damage_relation", "_targets"))
    several = F.try_variant_get("_targets", "$", "array<variant>")
    lone = F.when(F.col("_targets").isNotNull() & ~F.is_variant_null("_targets"), F.array("_targets"))
    rows = lists.select("id", "name", "damage_relation", F.explode(F.coalesce(several, lone)).alias("_target"))
    is_object = F.schema_of_variant("_target").startswith("OBJECT")
    named = F.when(is_object, F.try_variant_get("_target", "$.name", "string")).otherwise(
        F.try_variant_get("_target", "$", "string")
    )
    return rows.select("id", "name", "damage_relation", named.alias("target_type"))


def parse_documents(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Documents held as JSON text in a column."""
    return df.select(F.from_json(column, schema, {"mode": "FAILFAST"}).alias("_document")).select("_document.*")


def _carried(df: DataFrame) -> list[str]:
    return [SEQUENCE] if SEQUENCE in df.columns else []


def _exploded(docs: DataFrame, items: str, naming: Naming, columns: Sequence[Column]) -> DataFrame:
    """One row per list item; an empty or absent list gives none.

    The outer form with a filter after it, as Spark would otherwise repeat the
    parsing of a JSON text in a filter of its own before the explode.
    """
    carried = _carried(docs)
    rows = docs.select(F.col("id").alias(naming.id), *carried, F.posexplode_outer(items).alias("_at", "_item"))
    rows = rows.where(F.col("_at").isNotNull())
    order = [F.struct(F.col(SEQUENCE), F.col("_at")).alias(SEQUENCE)] if carried else []
    return rows.select(naming.id, *columns, *order)


def flatten_entity(docs: DataFrame) -> DataFrame:
    """Core columns; no species gives a NULL species id."""
    return docs.select(
        "id",
        "name",
        "base_experience",
        "height",
        "weight",
        "is_default",
        "order",
        url_last_id(F.col("species.url")).alias("species_id"),
        *_carried(docs),
    )


def flatten_stats(docs: DataFrame, naming: Naming = Naming()) -> DataFrame:
    item = F.col("_item")
    return _exploded(
        docs,
        "stats",
        naming,
        [
            item["stat"]["name"].alias("stat_name"),
            item["base_stat"].alias("base_stat"),
            item["effort"].alias("effort"),
        ],
    )


def flatten_types(docs: DataFrame, naming: Naming = Naming()) -> DataFrame:
    item = F.col("_item")
    return _exploded(
        docs, "types", naming, [item["type"]["name"].alias("type_name"), item["slot"].alias("slot")]
    )


def flatten_abilities(docs: DataFrame, naming: Naming = Naming()) -> DataFrame:
    item = F.col("_item")
    return _exploded(
        docs,
        "abilities",
        naming,
        [
            item["ability"]["name"].alias("ability_name"),
            item["is_hidden"].alias("is_hidden"),
            item["slot"].alias("slot"),
        ],
    )


def flatten_entity_moves(docs: DataFrame, naming: Naming = Naming()) -> DataFrame:
    return _exploded(docs, "moves", naming, [F.col("_item")["move"]["name"].alias("move_name")])


def flatten_moves(docs: DataFrame) -> DataFrame:
    return docs.select(
        "id",
        "name",
        "accuracy",
        "power",
        "pp",
        F.col("type.name").alias("type"),
        F.col("damage_class.name").alias("damage_class"),
        "effect_chance",
        *_carried(docs),
    )


def flatten_species(docs: DataFrame) -> DataFrame:
    return docs.select(
        "id",
        "name",
        "capture_rate",
        "base_happiness",
        "is_legendary",
        "is_mythical",
        F.col("generation.name").alias("generation"),
        F.col("habitat.name").alias("habitat"),
        F.col("shape.name").alias("shape"),
        *_carried(docs),
    )


def flatten_relations(docs: DataFrame) -> DataFrame:
    """One row per (document, relation, target); a relation without targets gives none."""
    carried = _carried(docs)
    lists = docs.select(
        "id", "name", *carried, F.explode_outer("damage_relations").alias("damage_relation", "_targets")
    )
    rows = lists.select(
        "id", "name", "damage_relation", F.posexplode_outer("_targets").alias("_at", "_target"), *carried
    )
    return rows.where(F.col("_at").isNotNull()).select(
        "id", "name", "damage_relation", F.col("_target.name").alias("target_type"), *carried
    )
