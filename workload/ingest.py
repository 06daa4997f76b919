"""Documents landed as JSON files in two deliveries and taken into raw tables, in passes and as a stream.

The first delivery has every part, event, text and order. In the second, parts
larger than 25 come again, changed, and once more under new ids; a pass by id
cursor takes in the new ones alone, a stream takes in all. Orders come again
with one target changed in every document, and are always read in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.schemas import SYNCED_AT
from tierloom.sources.raw_store import RawStore
from tierloom.sources.storage import scratch_path
from tierloom.sources.tables import read_star
from tierloom.streaming.sync import sync, sync_stream
from workload.documents import entity_documents, move_documents, relation_documents, species_documents
from workload.registry import query

NEW_IDS = 1_000_000_000
_STORES: dict[tuple[str, str, bool], RawStore] = {}


def _land(spark: SparkSession, directory: str, landing: str, second: bool) -> None:
    parts, orders = entity_documents(spark, directory, spread=True), relation_documents(spark, directory, spread=True)
    if not second:
        move_documents(spark, directory).write.json(f"{landing}/move")
        species_documents(spark, directory).write.json(f"{landing}/species")
    else:
        changed = parts.where("base_experience > 25").withColumns({"name": F.upper("name"), "stats": _lower_first("stats")})
        parts = changed.unionByName(changed.withColumn("id", F.col("id") + NEW_IDS))
        targets = F.array(F.struct(F.lit("changed").alias("name"), F.lit(None).cast("string").alias("url")))
        orders = orders.withColumn("damage_relations", F.create_map(F.lit("half_damage_from"), targets))
    parts.write.mode("append").json(f"{landing}/entity")
    orders.write.mode("append").json(f"{landing}/type")


def _lower_first(stats: str) -> Column:
    """The stats with every base value one less."""
    return F.transform(stats, lambda stat: stat.withField("base_stat", stat.base_stat - 1))


def _store(spark: SparkSession, directory: str, streaming: bool) -> RawStore:
    """The store after both deliveries; one run serves all queries of a session."""
    key = (spark.sparkContext.applicationId, directory, streaming)
    if key not in _STORES:
        folder = scratch_path(spark)
        store = RawStore(spark, f"{folder}/store")
        for delivery in range(3):  # nothing new lands before the third pass
            if delivery < 2:
                _land(spark, directory, f"{folder}/landing", delivery == 1)
            (sync_stream if streaming else sync)(store, f"{folder}/landing")
        _STORES[key] = store
    return _STORES[key]


def _rows(spark: SparkSession, directory: str, table: str, streaming: bool = False) -> DataFrame:
    """Raw rows, with whether the rows of one id were synced at one time instead of the time itself."""
    rows = _store(spark, directory, streaming).table(table).read()
    return rows.withColumn("synced", F.col(SYNCED_AT).isNotNull()).drop(SYNCED_AT)


_ENTITY = """
    SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size % 5 <> 0 THEN p_size::BIGINT END AS base_experience,
           floor(p_retailprice)::BIGINT AS height, 2 * floor(p_retailprice)::BIGINT AS weight,
           p_size > 25 AS is_default, p_partkey AS "order",
           CASE WHEN p_size % 3 <> 0 THEN substr(p_brand, 7)::BIGINT END AS species_id, true AS synced FROM part"""
_CHANGED = f"SELECT * REPLACE (upper(name) AS name) FROM ({_ENTITY}) WHERE base_experience > 25"
_NEW = f"SELECT * REPLACE (id + {NEW_IDS} AS id) FROM ({_CHANGED})"


@query("sync_entities", f"{_ENTITY} UNION ALL {_NEW}")
def sync_entities(spark: SparkSession, directory: str) -> DataFrame:
    """By id cursor: changed documents with old ids are passed over, as declared; new ids come in."""
    return _rows(spark, directory, "entity")


@query("stream_entities", f"SELECT * FROM ({_ENTITY}) WHERE base_experience IS NULL OR base_experience <= 25 UNION ALL {_CHANGED} UNION ALL {_NEW}")
def stream_entities(spark: SparkSession, directory: str) -> DataFrame:
    """As a stream of files: changed documents replace the old ones."""
    return _rows(spark, directory, "entity", streaming=True)


_STATS = """
    SELECT p_partkey AS entity_id, 'hp' AS stat_name, p_size::BIGINT AS base_stat, (p_size % 4)::BIGINT AS effort,
           p_size FROM part WHERE p_size % 4 <> 0
    UNION ALL SELECT p_partkey, 'attack', floor(p_retailprice)::BIGINT, floor(p_retailprice)::BIGINT % 4, p_size
    FROM part WHERE p_size % 4 <> 0"""


@query(
    "sync_children",
    f"""SELECT * EXCLUDE (p_size), true AS synced FROM ({_STATS})
        UNION ALL SELECT entity_id + {NEW_IDS}, stat_name, base_stat - 1, effort, true FROM ({_STATS})
        WHERE p_size > 25 AND p_size % 5 <> 0""",
)
def sync_children(spark: SparkSession, directory: str) -> DataFrame:
    return _rows(spark, directory, "entity_stats")


@query(
    "sync_relations_refresh",
    """SELECT DISTINCT o_orderkey AS id, o_orderpriority AS name, damage_relation, target_type, true AS synced
       FROM (SELECT *, unnest(['double_damage_to', 'double_damage_to', 'half_damage_from', 'half_damage_from']) AS damage_relation,
                    unnest([o_orderstatus, lower(o_orderstatus), 'c' || o_custkey % 10, 'changed']) AS target_type
             FROM orders)""",
)
def sync_relations_refresh(spark: SparkSession, directory: str) -> DataFrame:
    """Read in full each time: new targets are added by key, and what is no longer delivered stays."""
    return _rows(spark, directory, "types")


# Keys that the parts of a relation deliver to each table.
_PER_PART = {
    "entity": "count(*)",
    "entity_stats": "2 * count(*) FILTER (p_size % 4 <> 0)",
    "entity_types": "2 * count(*)",
    "entity_abilities": "2 * count(*)",
    "entity_moves": "sum(len(list_distinct(string_split(p_name, ' '))))",
}
_SECOND = "(SELECT * FROM part WHERE p_size > 25 AND p_size % 5 <> 0)"
_RELATIONS = "(SELECT count(*) + count(*) FILTER (o_orderstatus <> lower(o_orderstatus)) + count(*) FROM orders)"


def _counted(source: str, number: int, table: str, rows: str, written: str) -> str:
    """A row of counts; ``rows`` and ``written`` are scalars."""
    return f"""SELECT '{source}' AS source, {number}::BIGINT AS pass, '{table}' AS "table",
                      coalesce({rows}, 0)::BIGINT AS rows, coalesce({written}, 0)::BIGINT AS written"""


def _of(counted: str, relation: str) -> str:
    return f"(SELECT {counted} FROM {relation})"


def _counts_sql(passes: list[tuple[str, int, str, str, str]]) -> str:
    return " UNION ALL ".join(_counted(*row) for row in passes)


_BATCH = [
    *[("entity", 1, name, _of(n, "part"), _of(n, "part")) for name, n in _PER_PART.items()],
    *[("entity", 2, name, _of(n, _SECOND), _of(n, _SECOND)) for name, n in _PER_PART.items()],
    *[("entity", 3, name, "0", "0") for name in _PER_PART],
    *[(source, 1, table, *[_of("count(*)", star)] * 2) for source, table, star in (("move", "moves", "events"), ("species", "species", "documents"))],
    *[(source, number, table, "0", "0") for source, table in (("move", "moves"), ("species", "species")) for number in (2, 3)],
    ("type", 1, "types", _RELATIONS, _RELATIONS),
    ("type", 2, "types", f"{_RELATIONS} + (SELECT count(*) FROM orders)", "(SELECT count(*) FROM orders)"),
    ("type", 3, "types", f"{_RELATIONS} + (SELECT count(*) FROM orders)", "0"),
]


@query("sync_counts", _counts_sql(_BATCH))
def sync_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Keys delivered and rows written by each pass, for all eight tables; relations that come unchanged write nothing."""
    return _store(spark, directory, streaming=False).counts()


# A changed document of an old id brings new names and stats, but the same types, abilities and moves.
_AGAIN = {"entity": "count(*) FILTER (p_name <> upper(p_name))", "entity_stats": _PER_PART["entity_stats"]}
_STREAM = [
    *[("entity stream", 1, name, _of(n, "part"), _of(n, "part")) for name, n in _PER_PART.items()],
    *[
        ("entity stream", 2, name, f"2 * {_of(n, _SECOND)}", f"{_of(n, _SECOND)} + {_of(_AGAIN.get(name, '0'), _SECOND if name in _AGAIN else '(SELECT 1)')}")
        for name, n in _PER_PART.items()
    ],
    ("move stream", 1, "moves", *[_of("count(*)", "events")] * 2),
    ("species stream", 1, "species", *[_of("count(*)", "documents")] * 2),
    ("type stream", 1, "types", _RELATIONS, _RELATIONS),
    ("type stream", 2, "types", *["(SELECT count(*) FROM orders)"] * 2),
]


@query("stream_counts", _counts_sql(_STREAM))
def stream_counts(spark: SparkSession, directory: str) -> DataFrame:
    """The same for each batch of the streams."""
    return _store(spark, directory, streaming=True).counts()


@query(
    "sync_cursors",
    f"""SELECT 'entity' AS source, max(id) AS last_id FROM ({_ENTITY} UNION ALL {_NEW})
        UNION ALL SELECT 'move', max(event_id) FROM events UNION ALL SELECT 'species', max(doc_id) FROM documents""",
)
def sync_cursors(spark: SparkSession, directory: str) -> DataFrame:
    return _store(spark, directory, streaming=False).cursors()


@query(
    "rejected_lines",
    """SELECT 'move' AS source, '{"id": "' || event_type || '"}' AS line FROM events WHERE event_id % 7 = 0 GROUP BY 1, 2
       UNION ALL SELECT 'move', 'no json ' || event_id FROM events WHERE event_id % 11 = 0""",
)
def rejected_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Events landed as documents, some of them with a bad id or as no JSON at all: those lines are kept aside."""
    folder = scratch_path(spark)
    for source, docs in (("move", move_documents), ("species", species_documents), ("type", relation_documents), ("entity", entity_documents)):
        docs(spark, directory).limit(0 if source != "move" else 1 << 30).write.json(f"{folder}/landing/{source}")
    events = read_star(spark, directory, "events")
    bad_ids = events.where("event_id % 7 = 0").select(F.format_string('{"id": "%s"}', "event_type").alias("value"))
    no_json = events.where("event_id % 11 = 0").select(F.format_string("no json %d", "event_id").alias("value"))
    bad_ids.unionByName(no_json).write.mode("append").text(f"{folder}/landing/move")
    store = RawStore(spark, f"{folder}/store")
    sync(store, f"{folder}/landing", keep_rejects=True)
    return store.rejects().select("source", "line").distinct()
