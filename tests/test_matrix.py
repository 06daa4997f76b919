from __future__ import annotations

import pytest

from tierloom.constants import AS_WRITTEN_RELATIONS, DOCUMENTED_RELATIONS
from tierloom.operators.matrix import matrix_row, relation_matrix, relation_pairs

ROWS = [
    ("fire", "earth", "double_damage_to"),
    ("fire", "water", "half_damage_to"),
    ("fire", "air", "no_damage_to"),
    ("water", "fire", "double_damage_to"),
    ("water", "void", "double_damage_to"),
    ("air", "earth", "no_damage_to"),
    ("earth", "fire", "half_damage_from"),
]
AXIS = ["air", "earth", "fire", "water"]


@pytest.fixture
def relations(spark):
    return spark.createDataFrame(ROWS, "source string, target string, relation string")


def dense(relations, mapping=DOCUMENTED_RELATIONS, names=AXIS):
    return relation_matrix(relation_pairs(relations, "source", "target", "relation", mapping), names)


def cells(df):
    return {(r[0], r[1]): (r[2], r[3]) for r in df.collect()}


def test_documented_meaning(relations):
    got = cells(dense(relations))
    assert set(got) == {(a, d) for a in AXIS for d in AXIS}
    special = {
        ("fire", "earth"): (2.0, "Super Effective"),
        ("fire", "water"): (0.5, "Not Very Effective"),
        ("fire", "air"): (0.0, "No Effect"),
        ("water", "fire"): (2.0, "Super Effective"),
        ("air", "earth"): (0.0, "No Effect"),
    }
    assert {pair: cell for pair, cell in got.items() if cell != (1.0, "Normal")} == special


def test_as_written(relations):
    got = cells(dense(relations, AS_WRITTEN_RELATIONS))
    assert got["fire", "earth"] == (2.0, "Super Effective")
    assert got["fire", "water"] == (1.0, "Normal")
    assert got["fire", "air"] == (0.5, "No Effect")
    assert got["earth", "fire"] == (1.0, "Normal")


def test_precedence_when_a_pair_has_several_relations(spark):
    rows = [("a", "a", "double_damage_to"), ("a", "a", "no_damage_to"), ("a", "a", "half_damage_to")]
    df = spark.createDataFrame(rows, "source string, target string, relation string")
    assert cells(dense(df, names=["a"])) == {("a", "a"): (2.0, "No Effect")}


def test_same_as_one_join_per_relation(relations, spark):
    """The straightforward form: all pairs, one left join per entry."""
    relations.createOrReplaceTempView("rel")
    for mapping in (DOCUMENTED_RELATIONS, AS_WRITTEN_RELATIONS):
        (dd, _, _), (hd, _, _), (nd, _, _) = mapping
        joined = spark.sql(f"""
            SELECT a.source, d.source,
                   double(coalesce(if(dd.target IS NULL, NULL, 2.0), if(hd.target IS NULL, NULL, 0.5),
                            if(nd.target IS NULL, NULL, 0.0), 1.0)),
                   CASE WHEN nd.target IS NOT NULL THEN 'No Effect' WHEN hd.target IS NOT NULL
                        THEN 'Not Very Effective' WHEN dd.target IS NOT NULL THEN 'Super Effective' ELSE 'Normal' END
            FROM (SELECT DISTINCT source FROM rel) a CROSS JOIN (SELECT DISTINCT source FROM rel) d
            LEFT JOIN rel dd ON dd.relation = '{dd}' AND dd.source = a.source AND dd.target = d.source
            LEFT JOIN rel hd ON hd.relation = '{hd}' AND hd.source = a.source AND hd.target = d.source
            LEFT JOIN rel nd ON nd.relation = '{nd}' AND nd.source = a.source AND nd.target = d.source""")
        assert cells(dense(relations, mapping)) == cells(joined)


def test_known_pairs_only(relations):
    got = cells(relation_pairs(relations, "source", "target", "relation"))
    assert got["water", "void"] == (2.0, "Super Effective") and len(got) == 6


def test_row_against_listed_names(relations):
    pairs = relation_pairs(relations, "source", "target", "relation")
    got = cells(matrix_row(pairs, "water", ["void", "fire", "air"]))
    assert got == {
        ("water", "void"): (2.0, "Super Effective"),
        ("water", "fire"): (2.0, "Super Effective"),
        ("water", "air"): (1.0, "Normal"),
    }


def test_no_join_without_a_key(relations):
    plan = dense(relations)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
