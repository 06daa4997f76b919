"""Documents to marts, reports and checks on the tiny world of fixtures.py."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ENTITIES, land_all
from tierloom.constants import AS_WRITTEN_RELATIONS, TILE_POWER_LABELS
from tierloom.naming import Naming
from tierloom.plans import marts, pipeline, reports
from tierloom.plans.checks import all_checks, mart_checks, source_checks, staging_checks
from tierloom.sources.raw_store import RawStore
from tierloom.sources.tables import TableFolder


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")

    def land(source, documents, name="first"):
        import json

        folder = root / "landing" / source
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text("\n".join(json.dumps(d) for d in documents), encoding="utf-8")
        return str(root / "landing")

    store = RawStore(spark, str(root / "store"))
    folder = TableFolder(spark, str(root / "tables"))
    built, checks = pipeline.run(store, land_all(land), folder, streaming=False)
    return built, checks.cache(), store, folder


@pytest.fixture(scope="module")
def built(world):
    return world[0]


def rows(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def test_all_marts_are_stored(world):
    built, _, _, folder = world
    assert len(built) == 8
    for name in built:
        assert folder.read("entity_marts", name).columns == built[name].columns


def test_staging_views(spark, world):
    staged = spark.sql("SELECT count(*) FROM stg_entity WHERE synced_at IS NOT NULL")
    assert staged.first()[0] == len(ENTITIES)


def test_dim(built):
    got = {row["entity_id"]: row for row in built["dim_entity"].collect()}
    assert len(got) == len(ENTITIES)
    assert (got[1]["primary_type"], got[1]["secondary_type"]) == ("fire", "air")
    assert (got[2]["primary_type"], got[2]["secondary_type"]) == ("water", None)
    assert (got[3]["primary_type"], got[3]["secondary_type"]) == ("earth", "rock")
    assert (got[4]["primary_type"], got[4]["secondary_type"]) == (None, None)
    assert got[5]["is_legendary"] is None and got[5]["species_name"] is None
    assert got[3]["is_legendary"] and got[3]["is_mythical"]
    assert built["dim_entity"].columns == [
        "entity_id", "entity_name", "base_experience", "height_decimeters", "weight_hectograms", "is_default_form",
        "catalog_order", "primary_type", "secondary_type", "species_name", "capture_rate", "base_happiness",
        "is_legendary", "is_mythical", "generation", "habitat", "body_shape",
    ]


def test_dim_moves(built):
    got = dict(rows(built["dim_moves"], "move_name", "expected_damage"))
    assert got["flare"] == 90.0 and got["slam"] == 60.0
    assert got["splash"] == 120.0  # no accuracy
    assert got["stare"] == 0.0 and got["drain"] == 0.0  # no power


def test_fact(built):
    got = {row["entity_id"]: row for row in built["fct_entity_stats"].collect()}
    assert 12 not in got  # no stats
    assert got[1]["total_base_stats"] == 100 + 149 + 149 + 150
    assert got[8]["attack"] is None and got[8]["total_base_stats"] == 25


def test_orphan_stats_are_dropped(spark):
    staged = {
        "stg_entity": spark.createDataFrame([(1, "a")], "entity_id bigint, entity_name string"),
        "stg_entity_stats": spark.createDataFrame(
            [(1, "hp", 5), (2, "hp", 6), (1, "luck", 9)], "entity_id bigint, stat_name string, base_stat_value bigint"
        ),
    }
    assert rows(marts.fct_stats(staged)) == [(1, "a", 5, None, None, None, None, None, 5)]


ATTACKERS = [
    # id, tier, overall rank, rank within legendary status
    (6, "S", 1, 1),
    (7, "S", 2, 1),
    (5, "A", 3, 2),
    (4, "A", 4, 1),
    (3, "B", 5, 2),
    (10, "B", 6, 2),  # no special attack sorts before any
    (11, "B", 7, 3),
    (2, "B", 8, 4),
    (1, "C", 9, 3),
]


def test_attackers(built):
    got = rows(built["mart_top_attackers"], "entity_id", "tier", "overall_rank", "rank_within_legendary_status")
    assert got == ATTACKERS  # stored in rank order
    assert built["mart_top_attackers"].columns == [
        "entity_id", "entity_name", "primary_type", "secondary_type", "attack", "sp_attack", "total_base_stats",
        "is_legendary", "is_mythical", "tier", "overall_rank", "rank_within_legendary_status",
    ]


def test_missing_special_attack_can_sort_last(built):
    fact, dim = built["fct_entity_stats"], built["dim_entity"]
    mart = marts.top_attackers(fact, dim, sp_attack_nulls_first=False)
    ranks = dict(rows(mart, "entity_id", "overall_rank"))
    assert ranks[11] == 6 and ranks[10] == 7


def test_defenders(built):
    got = rows(built["mart_top_defenders"], "entity_id", "combined_defensive_stat", "tier", "overall_rank")
    assert got == [
        (6, 350, "S", 1),
        (5, 349, "A", 2),
        (4, 300, "A", 3),
        (3, 299, "B", 4),
        (2, 250, "B", 5),
        (1, 249, "C", 6),
        (8, 20, "C", 7),
        (9, 20, "C", 8),
        (10, 2, "C", 9),
        (11, 2, "C", 10),
    ]


def test_movesets(built):
    got = rows(built["mart_best_movesets"], "entity_id", "move_rank", "move_name", "is_stab")
    assert got == [
        (1, 1, "flare", True),
        (1, 2, "slam", False),
        (1, 3, "gust", True),  # the secondary type
        (2, 1, "splash", True),
        (2, 2, "flare", False),
        (3, 1, "slam", True),  # secondary type rock
        (4, 1, "slam", False),  # no types
        (4, 2, "jab", False),
        (6, 1, "splash", True),
        (7, 1, "flare", True),
    ]


def test_legendaries(built):
    got = rows(
        built["mart_legendary_rankings"], "entity_id", "rarity_tier", "total_base_stats", "overall_rank", "rank_within_tier"
    )
    assert got == [
        (3, "Mythical", 648, 1, 1),
        (2, "Mythical", 550, 2, 2),
        (1, "Legendary", 548, 3, 1),
        (7, "Legendary", 490, 4, 2),
        (8, "Mythical", 25, 5, 3),
    ]


def test_effectiveness(built):
    matrix = built["mart_type_effectiveness"]
    got = {(a, d): (m, label) for a, d, m, label in rows(matrix)}
    assert (1.0, "Normal") not in got.values() and not any(a == "rock" for a, _ in got)
    assert got["fire", "water"] == (0.5, "Not Very Effective") and got["fire", "air"] == (0.0, "No Effect")


def test_effectiveness_as_written(world):
    types = world[2].read()["types"].withColumnRenamed("name", "type_name")
    got = {(a, d): (m, label) for a, d, m, label in rows(marts.type_effectiveness(types, AS_WRITTEN_RELATIONS))}
    assert ("fire", "water") not in got and got["fire", "air"] == (0.5, "No Effect")


# Reports.


def test_counts(built):
    dim = built["dim_entity"]
    assert rows(reports.total_entities(dim)) == [(12,)]
    assert rows(reports.total_moves(built["dim_moves"])) == [(17,)]
    assert rows(reports.total_rare(dim)) == [(5,)]
    assert rows(reports.total_dual_type(dim)) == [(3,)]
    assert rows(reports.scorecard(dim)) == [(12, 5, 3)]
    assert rows(reports.scorecard(dim.where("entity_id = 4"))) == [(1, None, None)]
    assert rows(reports.count_by_primary_type(dim)) == [("water", 4), ("air", 3), ("earth", 2), ("fire", 1)]
    assert rows(reports.count_by_tier(built["mart_top_attackers"])) == [("A", 2), ("B", 4), ("C", 1), ("S", 2)]
    assert rows(reports.count_by_rarity(built["mart_legendary_rankings"])) == [("Legendary", 2), ("Mythical", 3)]
    assert rows(reports.count_by_generation(built["mart_legendary_rankings"])) == [("generation-0", 2), ("generation-1", 3)]


def test_tiles_and_top_lists(built):
    attackers, defenders = built["mart_top_attackers"], built["mart_top_defenders"]
    assert [r[0] for r in rows(reports.tile_attackers(attackers, top=3))] == [1, 2, 3]
    assert reports.tile_attackers(attackers).columns[0] == "overall_rank"
    assert len(reports.tile_defenders(defenders).columns) == 12
    assert [r["entity_name"] for r in reports.app_attackers(attackers, top=2).collect()] == ["frost", "gale"]
    common = reports.app_attackers(attackers, with_rare=False).collect()
    assert [r["entity_name"] for r in common] == ["dune", "jade", "kelp"]  # NULL flags are not FALSE
    assert len(reports.app_defenders(defenders, top=4, with_rare=False).collect()) == 4
    legendaries = built["mart_legendary_rankings"]
    assert len(reports.tile_legendaries(legendaries).columns) == 9
    assert [r[0] for r in rows(reports.head_legendaries(legendaries, top=2))] == [1, 2]
    assert len(reports.app_legendaries(legendaries).columns) == 13


def test_move_lists(built):
    movesets = built["mart_best_movesets"]
    assert rows(reports.tile_moves(movesets, top=3), "entity_name", "move_name") == [
        ("brook", "splash"),
        ("frost", "splash"),
        ("brook", "flare"),
    ]
    filtered = reports.app_moves(movesets, stab_only=True, damage_class="physical")
    assert rows(filtered, "entity_name", "move_name") == [("cliff", "slam")]
    assert reports.app_moves(movesets).count() == 10


def test_stats_reports(built):
    fact, dim = built["fct_entity_stats"], built["dim_entity"]
    averages = {(t, s): v for t, s, v in rows(reports.average_stats(fact, dim))}
    assert averages["fire", "attack"] == 149.0
    assert averages["earth", "attack"] == 189.5
    assert averages["air", "attack"] == 249.5  # the missing one does not count
    assert ("earth", "special-attack") in averages and None not in averages.values()
    chosen = reports.choose_stats(reports.average_stats(fact, dim))
    assert {r["stat_name"] for r in chosen.collect()} == {"attack", "defense", "hp"}
    assert reports.long_stats(fact, ["entity_id"]).count() == sum(len(d.get("stats", [])) for d in ENTITIES)
    assert reports.long_stats(fact, ["entity_id"], keep_nulls=True).count() == 11 * 6
    breakdown = reports.defender_breakdown(built["mart_top_defenders"])
    assert breakdown.count() == 30
    assert breakdown.where("value IS NULL").count() == 2


def test_histogram(built):
    tile = rows(reports.power_histogram(built["dim_moves"], TILE_POWER_LABELS))
    assert tile[0] == ("physical", "1: < 40", 2) and sum(r[2] for r in tile) == 15
    assert rows(reports.power_histogram(built["dim_moves"]))[0][1] == "1: <40"


def test_scatter(built):
    fact, dim = built["fct_entity_stats"], built["dim_entity"]
    assert sorted(r["entity_name"] for r in reports.scatter_common(fact, dim).collect()) == ["dune", "ink", "jade", "kelp"]
    everyone = {r["entity_name"]: r["category"] for r in reports.scatter_all(fact, dim, with_category=True).collect()}
    assert len(everyone) == 10
    assert everyone["cliff"] == "Mythical" and everyone["ember"] == "Legendary"
    assert everyone["echo"] == "air" and everyone["dune"] is None


def test_compare(built):
    legendaries = built["mart_legendary_rankings"]
    default = dict(rows(reports.compare(legendaries)))
    assert set(default) == {"cliff", "brook", "ember"}
    assert default["cliff"] == [100, 199, 199, 50, 50, 50, 100]
    named = dict(rows(reports.compare(legendaries, ["haze", "nobody"])))
    assert named == {"haze": [10, None, 10, None, None, 5, 10]}
    doubled = legendaries.unionByName(legendaries.withColumn("overall_rank", F.col("overall_rank") + 9))
    assert reports.compare(doubled, ["gale"]).count() == 1
    assert reports.compare(legendaries, list("abcdefg")).count() == 0


def test_matrix_reports(built, world):
    pairs, names = built["mart_type_effectiveness"], ["air", "earth", "fire", "water"]
    types = world[2].read()["types"].withColumnRenamed("name", "type_name")
    assert rows(reports.attacking_types(types)) == [("air",), ("earth",), ("fire",), ("water",)]
    wide = reports.effectiveness_wide(pairs, names)
    assert wide.columns == ["attacking_type", *names]
    assert all(None not in row for row in rows(wide))
    assert [r[2] for r in rows(reports.one_attacker(pairs, "fire", names))] == [2.0, 1.0, 0.5, 0.0]
    assert len(reports.effectiveness_rows(pairs, with_label=False).columns) == 3


def test_first_rows_are_the_ranked_ones(built):
    fact, dim = built["fct_entity_stats"], built["dim_entity"]
    for first, mart in (
        (marts.first_attackers, "mart_top_attackers"),
        (marts.first_defenders, "mart_top_defenders"),
        (marts.first_legendaries, "mart_legendary_rankings"),
    ):
        found = first(fact, dim, 3)
        want = built[mart].where("overall_rank <= 3").select(found.columns)
        assert sorted(rows(found), key=str) == sorted(rows(want), key=str)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in text


# Checks.


def test_declared_checks_are_complete():
    assert [len(f()) for f in (source_checks, staging_checks, mart_checks)] == [19, 25, 23]


def test_check_results(world):
    checks = world[1].collect()
    assert len(checks) == len(all_checks())
    failed = {(r["table"], r["column"], r["check"]): r["failures"] for r in checks if r["status"] == "fail"}
    assert failed == {
        # One row per relation, so the id repeats by design.
        ("types", "id", "unique"): 2,
        ("stg_types", "type_id", "unique"): 2,
        ("stg_entity", "species_id", "not_null"): 2,
        ("stg_entity_types", "type_slot", "accepted_values"): 1,
        ("dim_entity", "primary_type", "not_null"): 2,
    }
    errors = [(r["table"], r["column"], r["failures"]) for r in checks if r["status"] == "error"]
    assert errors == [("stg_entity_moves", "learn_method", None)]


def test_names_follow_the_noun(spark, world):
    """Another noun gives other names throughout, and the same numbers."""
    naming = Naming("device", "position")
    raw = {
        name.replace("entity", "device"): df.withColumnsRenamed({"entity_id": "device_id"})
        for name, df in world[2].read().items()
    }
    from tierloom.plans.staging import build_staging

    built = marts.build_marts(build_staging(raw, naming), naming)
    assert "dim_device" in built and "position" in built["dim_device"].columns
    got = rows(built["mart_top_attackers"].orderBy("overall_rank"), "device_id", "tier", "overall_rank",
               "rank_within_legendary_status")
    assert got == ATTACKERS
    assert reports.total_entities(built["dim_device"], naming).columns == ["total_device"]


def test_layer_schemas():
    naming = Naming("device")
    assert naming.layer_schema(None, "main") == "main"
    assert naming.layer_schema("device_marts", "main") == "device_marts"
    assert naming.layer_schema("  other ", "main") == "other"
