from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ENTITIES, MOVES, SPECIES, entity, land_all, relations, stats
from tierloom.__main__ import main
from tierloom.sources.raw_store import RawStore
from tierloom.sources.tables import TableFolder, order_of_files
from tierloom.streaming.sync import sync, sync_stream


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, str(tmp_path / "store"))


def table(store, name):
    return store.table(name).read().drop("_synced_at")


def contents(store):
    return {
        name: sorted((tuple(r) for r in table(store, name).collect()), key=str)
        for name in store.read()
    }


def test_batch_sync(store, land):
    land("entity", [entity(5, "older", {"hp": 1}), entity(5, "later", {"hp": 2})], "earlier")
    landing = land_all(land)
    os.utime(f"{landing}/entity/earlier.json", (1, 1))
    counts = sync(store, landing)
    assert counts["entity"].rows == len(ENTITIES) and counts["moves"].rows == len(MOVES) and counts["species"].rows == len(SPECIES)
    assert counts["entity_abilities"].rows == counts["entity_abilities"].written == 2
    assert [store.cursor(s) for s in ("entity", "move", "species", "type")] == [12, 29, 5, 0]
    first = contents(store)
    # Of one key's documents the last of the newest file wins.
    assert table(store, "entity").where("id = 5").first()["name"] == "echo"
    assert store.table("entity").read().where(F.col("_synced_at").isNull()).isEmpty()

    # Nothing new past the cursors; relations are read in full and stay the same.
    counts = sync(store, landing)
    assert counts["entity"].rows == counts["moves"].rows == 0 and counts["types"][:2] == (8, 0)
    assert contents(store) == first
    assert store.cursor("entity") == 12

    # A new entity is taken in; a changed one with an old id lies before the cursor.
    new = [entity(13, "moss", {"hp": 9}), entity(13, "moss", stats(1, 2, 3)), entity(1, "changed")]
    land("entity", new, "second")
    land("type", [relations(1, "fire", double_damage_to=["air"])], "second")
    counts = sync(store, landing)
    assert counts["entity"][:2] == (1, 1) and counts["entity_stats"][:2] == (6, 6)
    assert counts["types"].rows == 9 and counts["types"].written == 1
    kept = {(r["source"], r["pass"], r["table"]): (r["rows"], r["written"]) for r in store.counts().collect()}
    assert kept["type", 2, "types"] == (8, 0) and kept["entity", 3, "entity"] == (1, 1) and len(kept) == 24
    names = {r["id"]: r["name"] for r in table(store, "entity").collect()}
    assert names[13] == "moss" and names[1] == "ember"
    hp = table(store, "entity_stats").where("entity_id = 13 AND stat_name = 'hp'").first()
    assert hp["base_stat"] == 1  # the later document of the file
    assert store.cursor("entity") == 13 and store.cursor("move") == 29
    assert store.table("types").read().where("id = 1").count() == 4  # upserts never delete


def test_bad_lines_are_kept_aside(store, land, tmp_path):
    landing = land_all(land)
    with open(f"{landing}/move/bad.json", "w", encoding="utf-8") as lines:
        lines.write('no json\n\n{"id": "x"}\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        sync(store, landing)
    counts = sync(store, landing, keep_rejects=True)
    assert counts["moves"].rows == len(MOVES)
    rejects = [(r["source"], r["path"].rsplit("/", 1)[1], r["line"]) for r in store.rejects().collect()]
    assert sorted(rejects) == [("move", "bad.json", "no json"), ("move", "bad.json", '{"id": "x"}')]
    sync(store, landing, keep_rejects=True)
    assert store.rejects().count() == 2


def test_files_of_a_stored_table_follow_each_other(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path / "tables"))
    rows = spark.range(1000).withColumn("r", 1000 - F.col("id"))
    in_order = folder.rebuild("main", "t", rows.repartitionByRange(4, "r").sortWithinPartitions("r"))
    assert [tuple(x) for x in order_of_files(in_order, "r").collect()] == [("main", "t", 1000, "1", "1000", 0)]
    mixed = folder.rebuild("main", "u", rows.repartition(4))
    assert order_of_files(mixed, "r").first()["cut_files"] == 3


def test_stream_sync(store, land):
    landing = land_all(land)
    sync_stream(store, landing)
    streamed = contents(store)
    assert len(streamed["entity"]) == len(ENTITIES) and len(streamed["types"]) == 8
    lists = {"entity_stats": "stats", "entity_types": "types", "entity_abilities": "abilities", "entity_moves": "moves"}
    for name, key in lists.items():
        assert len(streamed[name]) == sum(len(document.get(key, [])) for document in ENTITIES)

    # No new files: nothing happens.
    versions = {name: store.table(name).version() for name in streamed}
    sync_stream(store, landing)
    assert {name: store.table(name).version() for name in streamed} == versions

    assert {(r["source"], r["pass"]) for r in store.counts().collect()} == {(f"{s} stream", 1) for s in ("entity", "move", "species", "type")}

    # A changed document comes through whatever its id; other rows stay.
    # With one file per batch the older file goes first.
    land("entity", [entity(1, "changed", {"hp": 7}, species=2)], "second")
    land("entity", [entity(1, "older", {"hp": 6, "speed": 6})], "third")
    os.utime(f"{landing}/entity/third.json", (1, 1))
    sync_stream(store, landing, max_files=1)
    assert store.table("entity").version() == versions["entity"] + 2
    row = table(store, "entity").where("id = 1").first()
    assert row["name"] == "changed" and row["species_id"] == 2
    values = {r["stat_name"]: r["base_stat"] for r in table(store, "entity_stats").where("entity_id = 1").collect()}
    assert values["hp"] == 7 and values["speed"] == 6 and values["attack"] == 149
    assert table(store, "entity").count() == len(ENTITIES)


def test_failed_pass_is_repeated(store, land, monkeypatch):
    landing = land_all(land)
    with monkeypatch.context() as patch:
        patch.setattr(RawStore, "advance", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            sync(store, landing)
    assert store.cursor("entity") == 0
    sync(store, landing)
    assert len(contents(store)["entity"]) == len(ENTITIES) and store.cursor("entity") == 12


def test_command(spark, store, land, tmp_path):
    """The whole pipeline from the command line, streaming, under another noun."""
    landing = land_all(land)
    (tmp_path / "landing" / "entity").rename(tmp_path / "landing" / "device")
    failed = main([landing, store.path, str(tmp_path / "tables"), "--entity", "device"])
    assert failed == 1  # the fixtures break some checks on purpose
    folder = TableFolder(spark, str(tmp_path / "tables"))
    assert folder.read("device_marts", "mart_top_attackers").columns[0] == "device_id"
    assert folder.read("device_marts", "mart_top_attackers").count() == 9
    assert folder.read("main", "checks").where("status = 'error'").count() == 1


def test_exit_code_ignores_failures_by_design(spark, store, land, tmp_path, monkeypatch):
    from tierloom import __main__ as command
    from tierloom.plans.checks import expected_failures

    landing = land_all(land)
    by_design = expected_failures()
    rows = [(*key, 1, "fail") for key in sorted(by_design)] + [("stg_moves", "move_id", "unique", 0, "pass")]
    results = spark.createDataFrame(rows, "table string, column string, check string, failures bigint, status string")
    monkeypatch.setattr(command, "run", lambda *_: ({}, results))
    monkeypatch.setattr(command, "release", lambda *_: None)
    assert main([landing, store.path, str(tmp_path / "tables")]) == 0
    worse = results.union(spark.createDataFrame([("stg_moves", "move_id", "not_null", 3, "fail")], results.schema))
    monkeypatch.setattr(command, "run", lambda *_: ({}, worse))
    assert main([landing, store.path, str(tmp_path / "tables")]) == 1


def test_failed_rebuild_leaves_the_table(spark, tmp_path):
    folder = TableFolder(spark, str(tmp_path / "tables"))
    for number in range(3):
        kept = folder.rebuild("main", "t", spark.range(number + 1))
    old = folder.read("main", "t")
    with pytest.raises(Exception, match="boom"):
        folder.rebuild("main", "t", spark.range(9).select(F.raise_error(F.lit("boom")).cast("long").alias("id")))
    assert folder.read("main", "t").count() == old.count() == kept.count() == 3
    assert folder.rebuild("main", "t", spark.range(7)).count() == 7 and old.count() == 3
    versions = sorted(p.name for p in (tmp_path / "tables" / "main" / "t").iterdir())
    assert versions[0] == "v2" and len(versions) == 2
