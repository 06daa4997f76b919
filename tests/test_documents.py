from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ENTITIES, MOVES, SPECIES, TYPES, land_all
from tierloom.functions.derive import url_last_id
from tierloom.naming import Naming
from tierloom.schemas import ENTITY_DOCUMENT, MOVE_DOCUMENT, SPECIES_DOCUMENT, TYPE_DOCUMENT
from tierloom.sources import documents


@pytest.fixture
def entities(spark, land):
    return documents.read_documents(spark, f"{land_all(land)}/entity", ENTITY_DOCUMENT)


def rows(df):
    return sorted(tuple(row) for row in df.drop(documents.SEQUENCE).collect())


def test_entity_core_row(entities):
    flat = {row["id"]: row for row in documents.flatten_entity(entities).collect()}
    assert len(flat) == len(ENTITIES)
    assert flat[1]["species_id"] == 1 and flat[1]["order"] == 1 and flat[1]["base_experience"] is None
    assert flat[5]["species_id"] is None


def test_child_lists(entities):
    stats = rows(documents.flatten_stats(entities))
    assert len(stats) == sum(len(document.get("stats", [])) for document in ENTITIES)
    assert (1, "attack", 149, 1) in stats and (10, "attack", 180, 1) in stats
    assert [row for row in rows(documents.flatten_types(entities)) if row[0] == 3] == [
        (3, "earth", 1),
        (3, "extra", 3),
        (3, "rock", 2),
    ]
    assert rows(documents.flatten_abilities(entities)) == [(1, "glow", False, 1), (1, "haze", True, 3)]
    moves = rows(documents.flatten_entity_moves(entities))
    assert len(moves) == sum(len(document.get("moves", [])) for document in ENTITIES)


def test_empty_and_absent_lists_give_no_rows(entities):
    for flatten in (documents.flatten_stats, documents.flatten_types, documents.flatten_entity_moves):
        assert flatten(entities).where("entity_id = 12").isEmpty()


def test_child_columns_follow_the_noun(entities):
    assert documents.flatten_stats(entities, Naming("device")).columns[0] == "device_id"


def test_moves(spark, land):
    docs = documents.read_documents(spark, f"{land_all(land)}/move", MOVE_DOCUMENT)
    flat = {row["name"]: row for row in documents.flatten_moves(docs).collect()}
    assert len(flat) == len(MOVES)
    assert flat["splash"]["accuracy"] is None and flat["splash"]["damage_class"] == "special"
    assert flat["stare"]["power"] is None and flat["stare"]["type"] == "air"


def test_species(spark, land):
    docs = documents.read_documents(spark, f"{land_all(land)}/species", SPECIES_DOCUMENT)
    flat = {row["id"]: row for row in documents.flatten_species(docs).collect()}
    assert len(flat) == len(SPECIES)
    assert flat[4]["habitat"] is None and flat[4]["shape"] == "round"
    assert flat[5]["shape"] is None and flat[5]["generation"] == "generation-1"


def test_relations_keep_all_kinds_and_skip_empty_lists(spark, land):
    docs = documents.read_documents(spark, f"{land_all(land)}/type", TYPE_DOCUMENT)
    flat = rows(documents.flatten_relations(docs))
    assert len(flat) == sum(len(t) for document in TYPES for t in document["damage_relations"].values())
    assert (2, "water", "half_damage_from", "fire") in flat
    assert not [row for row in flat if row[1] == "rock"]


def test_relations_of_any_shape(spark, land):
    lines = [json.dumps(document) for document in TYPES]
    odd = [
        '{"id": "90", "name": "odd", "new": {"x": 1}, "damage_relations": {"a": "fire", "b": {"name": "ice"}, "c": ["x", {"name": "y"}]}}',
        '{"id": 91, "name": "none", "damage_relations": {"a": null, "b": [], "c": [{"url": "u"}, null]}}',
        '{"id": "no id", "damage_relations": {"a": "fire"}}',
        '{"id": 92}', '{"id": 93, "damage_relations": null}', '{"id": 94, "damage_relations": 5}',
    ]
    bad = ["[1]", '{"id": 1', "text", None, ""]
    texts = spark.createDataFrame([(line,) for line in [*lines, *odd, *bad]], "line string")
    good, rejected = documents.variant_documents(texts, "line")
    flat = sorted(map(tuple, documents.flatten_variant_relations(good).collect()), key=str)
    plain = documents.flatten_relations(documents.read_documents(spark, f"{land_all(land)}/type", TYPE_DOCUMENT))
    expected = [tuple(row) for row in plain.select("id", "name", "damage_relation", "target_type").collect()]
    expected += [(90, "odd", "a", "fire"), (90, "odd", "b", "ice"), (90, "odd", "c", "x"), (90, "odd", "c", "y")]
    expected += [(91, "none", "c", None), (91, "none", "c", None), (None, None, "a", "fire")]
    assert flat == sorted(expected, key=str)
    assert sorted([row.line for row in rejected.collect()], key=str) == sorted(bad, key=str)


@pytest.mark.parametrize(
    ("url", "expected"),
    [("https://h/api/type/10/", 10), ("https://h/api/type/10", 10), ("https://h/7//", 7), (None, None)],
)
def test_url_last_id(spark, url, expected):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(url_last_id(F.col("url"))).first()[0] == expected


def test_url_without_id(spark):
    df = spark.createDataFrame([("https://h/about",)], "url string")
    assert df.select(url_last_id(F.col("url"), missing_ok=True)).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(url_last_id(F.col("url"))).collect()


def test_bad_json_text_is_an_error(spark):
    texts = spark.createDataFrame([("{not json",)], "document string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        documents.parse_documents(texts, "document", MOVE_DOCUMENT).collect()


def test_bad_line_in_a_file_is_an_error(spark, land, tmp_path):
    landing = land_all(land)
    (tmp_path / "landing" / "move" / "bad.json").write_text('{"id": 1, "name"', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        documents.flatten_moves(documents.read_documents(spark, f"{landing}/move", MOVE_DOCUMENT)).collect()
