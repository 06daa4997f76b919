"""The whole pipeline over tables derived from the star schema: staging, marts, reports, checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.constants import (
    APP_LEGENDARIES,
    APP_POWER_LABELS,
    APP_TOP,
    AS_WRITTEN_RELATIONS,
    COMPARE_DEFAULT,
    DAMAGING_CLASSES,
    DOCUMENTED_RELATIONS,
    POWER_BOUNDS,
    TILE_LEGENDARIES,
    TILE_POWER_LABELS,
    TILE_TOP,
)
from tierloom.functions.derive import lower_columns
from tierloom.naming import Naming
from tierloom.operators.quality import Check, run_checks
from tierloom.plans import marts, reports
from tierloom.plans.checks import key_checks, mart_checks, source_checks, staging_checks
from tierloom.plans.staging import build_staging, register_staging
from tierloom.plans.star import Star
from tierloom.sources.storage import scratch_path
from tierloom.sources.tables import TableFolder, order_of_files
from workload.registry import query
from workload.star_sql import listed_sql, star_sql

NAMING = Naming()


class Pipeline:
    """Marts of one data folder, each built from the raw tables it needs."""

    def __init__(self, spark: SparkSession, directory: str):
        self.star = Star(spark, directory)
        self._staged: dict[str, DataFrame] = {}

    def staged(self, *raw: str) -> dict[str, DataFrame]:
        """Staging relations of the named raw tables, each described once."""
        missing = [name for name in raw if NAMING.staging(name) not in self._staged]
        if missing:
            self._staged |= build_staging(self.star.raw(*missing))
        return self._staged

    def dim(self) -> DataFrame:
        return marts.dim_entity(self.staged(NAMING.raw(), NAMING.raw("types"), "species"))

    def moves(self) -> DataFrame:
        return marts.dim_moves(self.staged("moves"))

    def fact(self) -> DataFrame:
        return marts.fct_stats(self.staged(NAMING.raw(), NAMING.raw("stats")))

    def attackers(self) -> DataFrame:
        return marts.top_attackers(self.fact(), self.dim())

    def attacker_rows(self) -> DataFrame:
        return marts.attacker_rows(self.fact(), self.dim())

    def first_attackers(self, k: int) -> DataFrame:
        return marts.first_attackers(self.fact(), self.dim(), k)

    def defenders(self) -> DataFrame:
        return marts.top_defenders(self.fact(), self.dim())

    def defender_rows(self) -> DataFrame:
        return marts.defender_rows(self.fact(), self.dim())

    def first_defenders(self, k: int) -> DataFrame:
        return marts.first_defenders(self.fact(), self.dim(), k)

    def legendaries(self) -> DataFrame:
        return marts.legendary_rankings(self.fact(), self.dim())

    def legendary_rows(self) -> DataFrame:
        return marts.legendary_rows(self.fact(), self.dim())

    def first_legendaries(self, k: int) -> DataFrame:
        return marts.first_legendaries(self.fact(), self.dim(), k)

    def movesets(self) -> DataFrame:
        return marts.best_movesets(
            self.staged(NAMING.raw("moves"))["stg_entity_moves"], self.moves(), self.dim()
        )

    def pairs(self, mapping=DOCUMENTED_RELATIONS) -> DataFrame:
        return marts.type_effectiveness(self.staged("types")["stg_types"], mapping)


def _staging(raw: str) -> None:
    table = NAMING.staging(raw)

    @query(table, star_sql(f"SELECT * FROM {table}"))
    def staged(spark: SparkSession, directory: str) -> DataFrame:
        return Pipeline(spark, directory).staged(raw)[table].drop("synced_at")


for _name in ("", "stats", "types", "abilities", "moves"):
    _staging(NAMING.raw(_name))
for _name in ("moves", "species", "types"):
    _staging(_name)


# Marts.


@query("dim_entity", star_sql("SELECT * FROM dim_entity"))
def dim_entity(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).dim()


@query("dim_moves", star_sql("SELECT * FROM dim_moves"))
def dim_moves(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).moves()


@query("fct_entity_stats", star_sql("SELECT * FROM fct"))
def fct_entity_stats(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).fact()


@query("mart_top_attackers", star_sql("SELECT * FROM attackers"))
def mart_top_attackers(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).attackers()


@query("mart_top_defenders", star_sql("SELECT * FROM defenders"))
def mart_top_defenders(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).defenders()


@query("mart_best_movesets", star_sql("SELECT * FROM movesets"))
def mart_best_movesets(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).movesets()


@query("mart_legendary_rankings", star_sql("SELECT * FROM legendaries"))
def mart_legendary_rankings(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).legendaries()


@query("mart_type_effectiveness", star_sql("SELECT * FROM pairs"))
def mart_type_effectiveness(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).pairs()


@query("mart_type_effectiveness_as_written", star_sql("SELECT * FROM pairs_as_written"))
def mart_type_effectiveness_as_written(spark: SparkSession, directory: str) -> DataFrame:
    return Pipeline(spark, directory).pairs(AS_WRITTEN_RELATIONS)


# Reports.


@query("report_total_entities", star_sql("SELECT count(*) AS total_entity FROM dim_entity"))
def report_total_entities(spark: SparkSession, directory: str) -> DataFrame:
    return reports.total_entities(Pipeline(spark, directory).dim())


@query("report_total_moves", star_sql("SELECT count(*) AS total_moves FROM dim_moves"))
def report_total_moves(spark: SparkSession, directory: str) -> DataFrame:
    return reports.total_moves(Pipeline(spark, directory).moves())


@query(
    "report_total_rare",
    star_sql("SELECT count(*) AS legendary_and_mythical FROM dim_entity WHERE is_legendary OR is_mythical"),
)
def report_total_rare(spark: SparkSession, directory: str) -> DataFrame:
    return reports.total_rare(Pipeline(spark, directory).dim())


@query(
    "report_total_dual_type",
    star_sql("SELECT count(secondary_type) AS dual_type_entity FROM dim_entity"),
)
def report_total_dual_type(spark: SparkSession, directory: str) -> DataFrame:
    return reports.total_dual_type(Pipeline(spark, directory).dim())


@query(
    "report_scorecard",
    star_sql("""
        SELECT count(*) AS total_entity,
               CAST(sum(1) FILTER (is_legendary OR is_mythical) AS BIGINT) AS legendary_mythical,
               CAST(sum(1) FILTER (secondary_type IS NOT NULL) AS BIGINT) AS dual_type
        FROM dim_entity"""),
)
def report_scorecard(spark: SparkSession, directory: str) -> DataFrame:
    return reports.scorecard(Pipeline(spark, directory).dim())


_ATTACKER = """overall_rank, entity_name, primary_type, secondary_type, attack, sp_attack, total_base_stats,
    tier, is_legendary, is_mythical"""
_DEFENDER = """overall_rank, entity_name, primary_type, secondary_type, hp, defense, sp_defense,
    combined_defensive_stat, total_base_stats, tier, is_legendary, is_mythical"""


@query("report_tile_attackers", star_sql(f"SELECT {_ATTACKER} FROM attackers WHERE overall_rank <= 20"))
def report_tile_attackers(spark: SparkSession, directory: str) -> DataFrame:
    return reports.tile_attackers(Pipeline(spark, directory).first_attackers(TILE_TOP))


@query("report_tile_defenders", star_sql(f"SELECT {_DEFENDER} FROM defenders WHERE overall_rank <= 20"))
def report_tile_defenders(spark: SparkSession, directory: str) -> DataFrame:
    return reports.tile_defenders(Pipeline(spark, directory).first_defenders(TILE_TOP))


@query(
    "report_count_by_primary_type",
    star_sql("""
        SELECT primary_type, count(*) AS entity_count FROM dim_entity
        WHERE primary_type IS NOT NULL GROUP BY 1"""),
)
def report_count_by_primary_type(spark: SparkSession, directory: str) -> DataFrame:
    return reports.count_by_primary_type(Pipeline(spark, directory).dim())


@query(
    "report_tile_legendaries",
    star_sql("""
        SELECT overall_rank, entity_name, primary_type, rarity_tier, total_base_stats, attack, defense, hp, generation
        FROM legendaries WHERE overall_rank <= 30"""),
)
def report_tile_legendaries(spark: SparkSession, directory: str) -> DataFrame:
    return reports.tile_legendaries(Pipeline(spark, directory).first_legendaries(TILE_LEGENDARIES))


_MOVE = """entity_name, primary_type, move_rank, move_name, move_type, damage_class, power, accuracy,
    expected_damage, is_stab"""


@query(
    "report_tile_moves",
    star_sql(f"""
        SELECT {_MOVE} FROM movesets
        ORDER BY expected_damage DESC NULLS LAST, entity_name, move_rank, entity_id LIMIT 100"""),
)
def report_tile_moves(spark: SparkSession, directory: str) -> DataFrame:
    return reports.tile_moves(Pipeline(spark, directory).movesets())


@query("report_effectiveness_rows", star_sql("SELECT * FROM pairs"))
def report_effectiveness_rows(spark: SparkSession, directory: str) -> DataFrame:
    return reports.effectiveness_rows(Pipeline(spark, directory).pairs())


@query(
    "report_effectiveness_rows_plain",
    star_sql("SELECT attacking_type, defending_type, effectiveness_multiplier FROM pairs"),
)
def report_effectiveness_rows_plain(spark: SparkSession, directory: str) -> DataFrame:
    return reports.effectiveness_rows(Pipeline(spark, directory).pairs(), with_label=False)


_LONG = """
    (SELECT entity_id, 'hp' AS stat_name, hp AS value FROM fct
     UNION ALL SELECT entity_id, 'attack', attack FROM fct
     UNION ALL SELECT entity_id, 'defense', defense FROM fct
     UNION ALL SELECT entity_id, 'special-attack', sp_attack FROM fct
     UNION ALL SELECT entity_id, 'special-defense', sp_defense FROM fct
     UNION ALL SELECT entity_id, 'speed', speed FROM fct)"""
_AVERAGES = f"""
    SELECT primary_type, stat_name, round(avg(value), 1) AS avg_base_stat
    FROM {_LONG} JOIN dim_entity USING (entity_id)
    WHERE primary_type IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2"""


@query("report_average_stats", star_sql(_AVERAGES))
def report_average_stats(spark: SparkSession, directory: str) -> DataFrame:
    pipeline = Pipeline(spark, directory)
    return reports.average_stats(pipeline.fact(), pipeline.dim())


@query(
    "report_chosen_stats",
    star_sql(f"SELECT * FROM ({_AVERAGES}) WHERE stat_name IN ('attack', 'defense', 'hp')"),
)
def report_chosen_stats(spark: SparkSession, directory: str) -> DataFrame:
    pipeline = Pipeline(spark, directory)
    return reports.choose_stats(reports.average_stats(pipeline.fact(), pipeline.dim()))


@query(
    "report_long_stats",
    star_sql(f"SELECT entity_id, stat_name, value AS base_stat_value FROM {_LONG} WHERE value IS NOT NULL"),
)
def report_long_stats(spark: SparkSession, directory: str) -> DataFrame:
    return reports.long_stats(Pipeline(spark, directory).fact(), ["entity_id"])


def _histogram_sql(labels: Sequence[str]) -> str:
    buckets = " ".join(f"WHEN power < {bound} THEN '{label}'" for bound, label in zip(POWER_BOUNDS, labels, strict=False))
    return star_sql(f"""
        SELECT damage_class, CASE {buckets} ELSE '{labels[-1]}' END AS power_bucket, count(*) AS move_count
        FROM dim_moves WHERE power IS NOT NULL AND damage_class IN {listed_sql(DAMAGING_CLASSES)} GROUP BY 1, 2""")


@query("report_power_histogram_tile", _histogram_sql(TILE_POWER_LABELS))
def report_power_histogram_tile(spark: SparkSession, directory: str) -> DataFrame:
    return reports.power_histogram(Pipeline(spark, directory).moves(), TILE_POWER_LABELS)


@query("report_power_histogram_app", _histogram_sql(APP_POWER_LABELS))
def report_power_histogram_app(spark: SparkSession, directory: str) -> DataFrame:
    return reports.power_histogram(Pipeline(spark, directory).moves(), APP_POWER_LABELS)


@query(
    "report_scatter_common",
    star_sql("""
        SELECT f.entity_name, primary_type, attack, defense, hp, total_base_stats
        FROM fct f JOIN dim_entity USING (entity_id)
        WHERE NOT is_legendary AND NOT is_mythical AND attack IS NOT NULL AND defense IS NOT NULL"""),
)
def report_scatter_common(spark: SparkSession, directory: str) -> DataFrame:
    pipeline = Pipeline(spark, directory)
    return reports.scatter_common(pipeline.fact(), pipeline.dim())


_SCATTER = """
    SELECT f.entity_name, primary_type, attack, defense, hp, total_base_stats, is_legendary, is_mythical{extra}
    FROM fct f JOIN dim_entity USING (entity_id) WHERE attack IS NOT NULL AND defense IS NOT NULL"""


@query("report_scatter_all", star_sql(_SCATTER.format(extra="")))
def report_scatter_all(spark: SparkSession, directory: str) -> DataFrame:
    pipeline = Pipeline(spark, directory)
    return reports.scatter_all(pipeline.fact(), pipeline.dim())


@query(
    "report_scatter_category",
    star_sql(
        _SCATTER.format(
            extra=""",
            CASE WHEN is_mythical THEN 'Mythical' WHEN is_legendary THEN 'Legendary' ELSE primary_type END AS category"""
        )
    ),
)
def report_scatter_category(spark: SparkSession, directory: str) -> DataFrame:
    pipeline = Pipeline(spark, directory)
    return reports.scatter_all(pipeline.fact(), pipeline.dim(), with_category=True)


@query("report_count_by_tier", star_sql("SELECT tier, count(*) AS entity_count FROM attackers GROUP BY 1"))
def report_count_by_tier(spark: SparkSession, directory: str) -> DataFrame:
    return reports.count_by_tier(Pipeline(spark, directory).attacker_rows())


@query("report_app_attackers", star_sql(f"SELECT {_ATTACKER} FROM attackers ORDER BY overall_rank LIMIT 25"))
def report_app_attackers(spark: SparkSession, directory: str) -> DataFrame:
    return reports.app_attackers(Pipeline(spark, directory).first_attackers(APP_TOP))


@query(
    "report_app_attackers_common",
    star_sql(f"""
        SELECT {_ATTACKER} FROM attackers WHERE NOT is_legendary AND NOT is_mythical
        ORDER BY overall_rank LIMIT 100"""),
)
def report_app_attackers_common(spark: SparkSession, directory: str) -> DataFrame:
    """The 100 rows' ranks are counted over all attackers; the mart is not ranked."""
    first = marts.first_common(Pipeline(spark, directory).attacker_rows(), marts.attacker_order(), 100)
    return reports.app_attackers(first, top=100, with_rare=False)


@query("report_app_defenders", star_sql(f"SELECT {_DEFENDER} FROM defenders ORDER BY overall_rank LIMIT 25"))
def report_app_defenders(spark: SparkSession, directory: str) -> DataFrame:
    return reports.app_defenders(Pipeline(spark, directory).first_defenders(APP_TOP))


@query(
    "report_app_defenders_common",
    star_sql(f"""
        SELECT {_DEFENDER} FROM defenders WHERE NOT is_legendary AND NOT is_mythical
        ORDER BY overall_rank LIMIT 10"""),
)
def report_app_defenders_common(spark: SparkSession, directory: str) -> DataFrame:
    first = marts.first_common(Pipeline(spark, directory).defender_rows(), marts.defender_order(), 10)
    return reports.app_defenders(first, top=10, with_rare=False)


_LEGENDARY = """overall_rank, entity_name, primary_type, secondary_type, rarity_tier, generation,
    total_base_stats, hp, attack, defense, sp_attack, sp_defense, speed"""


@query("report_app_legendaries", star_sql(f"SELECT {_LEGENDARY} FROM legendaries"))
def report_app_legendaries(spark: SparkSession, directory: str) -> DataFrame:
    return reports.app_legendaries(Pipeline(spark, directory).legendaries())


@query(
    "report_head_legendaries",
    star_sql(f"SELECT {_LEGENDARY} FROM legendaries ORDER BY overall_rank LIMIT 40"),
)
def report_head_legendaries(spark: SparkSession, directory: str) -> DataFrame:
    return reports.head_legendaries(Pipeline(spark, directory).first_legendaries(APP_LEGENDARIES))


@query(
    "report_app_moves",
    star_sql(f"SELECT {_MOVE} FROM movesets ORDER BY expected_damage DESC, entity_id, move_rank LIMIT 50"),
)
def report_app_moves(spark: SparkSession, directory: str) -> DataFrame:
    return reports.app_moves(Pipeline(spark, directory).movesets())


@query(
    "report_app_moves_filtered",
    star_sql(f"""
        SELECT {_MOVE} FROM movesets WHERE is_stab AND damage_class = 'special'
        ORDER BY expected_damage DESC, entity_id, move_rank LIMIT 200"""),
)
def report_app_moves_filtered(spark: SparkSession, directory: str) -> DataFrame:
    movesets = Pipeline(spark, directory).movesets()
    return reports.app_moves(movesets, stab_only=True, damage_class="special", top=200)


@query(
    "report_defender_breakdown",
    star_sql("""
        SELECT entity_name, 'hp' AS stat, hp AS value FROM defenders WHERE overall_rank <= 25
        UNION ALL SELECT entity_name, 'defense', defense FROM defenders WHERE overall_rank <= 25
        UNION ALL SELECT entity_name, 'sp_defense', sp_defense FROM defenders WHERE overall_rank <= 25"""),
)
def report_defender_breakdown(spark: SparkSession, directory: str) -> DataFrame:
    return reports.defender_breakdown(reports.app_defenders(Pipeline(spark, directory).first_defenders(APP_TOP)))


@query(
    "report_count_by_generation",
    star_sql("SELECT generation, count(*) AS count FROM legendaries WHERE generation IS NOT NULL GROUP BY 1"),
)
def report_count_by_generation(spark: SparkSession, directory: str) -> DataFrame:
    return reports.count_by_generation(Pipeline(spark, directory).legendary_rows())


@query("report_count_by_rarity", star_sql("SELECT rarity_tier, count(*) AS count FROM legendaries GROUP BY 1"))
def report_count_by_rarity(spark: SparkSession, directory: str) -> DataFrame:
    return reports.count_by_rarity(Pipeline(spark, directory).legendary_rows())


def _vectors(df: DataFrame) -> DataFrame:
    """Stat vectors as text, which any engine compares alike."""
    texts = F.transform("stats", lambda value: F.coalesce(value.cast("string"), F.lit("-")))
    return df.select("entity_name", F.array_join(texts, ",").alias("stats"))


_VECTOR = """
    concat_ws(',', ifnull(hp::VARCHAR, '-'), ifnull(attack::VARCHAR, '-'), ifnull(defense::VARCHAR, '-'),
              ifnull(sp_attack::VARCHAR, '-'), ifnull(sp_defense::VARCHAR, '-'), ifnull(speed::VARCHAR, '-'),
              ifnull(hp::VARCHAR, '-')) AS stats"""


@query(
    "report_compare_default",
    star_sql(f"SELECT entity_name, {_VECTOR} FROM legendaries WHERE overall_rank <= 3"),
)
def report_compare_default(spark: SparkSession, directory: str) -> DataFrame:
    return _vectors(reports.compare(Pipeline(spark, directory).first_legendaries(COMPARE_DEFAULT)))


_COMPARED = [f"Customer#{number:09d}" for number in (1, 2, 3, 5, 8)]


@query(
    "report_compare_named",
    star_sql(f"SELECT entity_name, {_VECTOR} FROM legendaries WHERE entity_name IN {tuple(_COMPARED)}"),
)
def report_compare_named(spark: SparkSession, directory: str) -> DataFrame:
    named = marts.named_rows(Pipeline(spark, directory).legendary_rows(), _COMPARED, marts.legendary_order())
    return _vectors(reports.compare(named, _COMPARED))


_NATIONS = [f"NATION_{number}" for number in range(25)]


@query(
    "report_effectiveness_wide",
    star_sql(
        "SELECT attacking_type, "
        + ", ".join(
            f"coalesce(max(effectiveness_multiplier) FILTER (defending_type = '{n}'), 1.0::DOUBLE) AS {n}" for n in _NATIONS
        )
        + " FROM pairs GROUP BY 1"
    ),
)
def report_effectiveness_wide(spark: SparkSession, directory: str) -> DataFrame:
    return reports.effectiveness_wide(Pipeline(spark, directory).pairs(), _NATIONS)


@query("report_attacking_types", star_sql("SELECT type_name AS attacking_type FROM axis"))
def report_attacking_types(spark: SparkSession, directory: str) -> DataFrame:
    return reports.attacking_types(Pipeline(spark, directory).staged("types")["stg_types"])


@query("report_one_attacker", star_sql("""
    SELECT 'NATION_7' AS attacking_type, n_name AS defending_type,
           coalesce(effectiveness_multiplier, 1.0::DOUBLE) AS effectiveness_multiplier,
           coalesce(effectiveness_label, 'Normal') AS effectiveness_label
    FROM nation LEFT JOIN pairs ON attacking_type = 'NATION_7' AND defending_type = n_name"""))
def report_one_attacker(spark: SparkSession, directory: str) -> DataFrame:
    return reports.one_attacker(Pipeline(spark, directory).pairs(), "NATION_7", _NATIONS)


@query("report_lower_columns", star_sql("SELECT move_id, upper(move_type) AS move_type FROM dim_moves"))
def report_lower_columns(spark: SparkSession, directory: str) -> DataFrame:
    moves = Pipeline(spark, directory).moves()
    return lower_columns(moves.select(F.col("move_id").alias("MOVE_ID"), F.upper("move_type").alias("Move_Type")))


# Checks. The SQL of every declared check, over the same tables under these names.

_SQL_TABLES = {"fct_entity_stats": "fct", "mart_top_attackers": "attackers", "mart_top_defenders": "defenders",
               "mart_best_movesets": "movesets", "mart_legendary_rankings": "legendaries",
               "mart_type_effectiveness": "pairs"}
_MISSING = {("stg_entity_moves", "learn_method")}


def _failures_sql(check: Check) -> str:
    table = _SQL_TABLES.get(check.table, check.table)
    column = check.columns[0]
    if check.kind == "not_null":
        return f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"
    if check.kind == "accepted_values":
        values = ", ".join(repr(value) for value in check.values)
        return f"(SELECT count(*) FROM {table} WHERE {column} NOT IN ({values}))"
    if check.kind == "relationships":
        parent, key = check.to
        return f"(SELECT count(*) FROM {table} WHERE {column} NOT IN (SELECT {key} FROM {parent}))"
    keys = ", ".join(check.columns)
    filled = " AND ".join(f"{name} IS NOT NULL" for name in check.columns)
    return (
        f"(SELECT count(*) FROM (SELECT {keys} FROM {table} WHERE {filled} GROUP BY {keys} HAVING count(*) > 1))"
    )


def _checks_sql(checks: Sequence[Check]) -> str:
    rows = []
    for check in checks:
        missing = (check.table, check.columns[0]) in _MISSING
        failures = "CAST(NULL AS BIGINT)" if missing else _failures_sql(check)
        rows.append(
            f"SELECT '{check.table}' AS \"table\", '{', '.join(check.columns)}' AS \"column\", "
            f"'{check.kind}' AS \"check\", {failures} AS failures"
        )
    body = " UNION ALL ".join(rows)
    return star_sql(
        "SELECT *, CASE WHEN failures IS NULL THEN 'error' WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status "
        f"FROM ({body})"
    )


@query("checks_staging", _checks_sql(staging_checks()))
def checks_staging(spark: SparkSession, directory: str) -> DataFrame:
    return run_checks(build_staging(Pipeline(spark, directory).star.raw()), staging_checks())


@query("checks_marts", _checks_sql(mart_checks()))
def checks_marts(spark: SparkSession, directory: str) -> DataFrame:
    staged = build_staging(Pipeline(spark, directory).star.raw())
    folder = TableFolder(spark, scratch_path(spark))
    return run_checks(marts.build_marts(staged, folder=folder), mart_checks())


def _raw_sql(checks: Sequence[Check]) -> str:
    """Raw tables are the staging ones under their raw names."""
    n = NAMING
    names = {n.raw(part): n.staging(n.raw(part)) for part in ("stats", "types", "abilities", "moves")}
    renamed = {n.raw(): "raw_entity"}
    text = _checks_sql(checks)
    extra = [f"{raw} AS (SELECT *, {columns} FROM {staged})" for raw, staged, columns in (
        (n.raw("stats"), names[n.raw("stats")], "base_stat_value AS base_stat"),
        (n.raw("types"), names[n.raw("types")], "type_slot AS slot"),
        (n.raw("abilities"), names[n.raw("abilities")], "ability_slot AS slot"),
        (n.raw("moves"), names[n.raw("moves")], "1 AS delivered"),
        ("moves", "stg_moves", "move_id AS id, move_name AS name"),
        ("species", "stg_species", "species_id AS id, species_name AS name"),
        ("types", "stg_types", "type_id AS id, type_name AS name"),
        (n.raw(), renamed[n.raw()], "1 AS delivered"),
    )]
    return text.replace("\nSELECT *, CASE WHEN failures", ",\n" + ",\n".join(extra) + "\nSELECT *, CASE WHEN failures", 1)


@query("checks_sources", _raw_sql(source_checks()))
def checks_sources(spark: SparkSession, directory: str) -> DataFrame:
    return run_checks(Pipeline(spark, directory).star.raw(), source_checks())


@query("checks_keys", _raw_sql(key_checks()))
def checks_keys(spark: SparkSession, directory: str) -> DataFrame:
    return run_checks(Pipeline(spark, directory).star.raw(), key_checks())


# Stored marts and the column that their rows are stored in the order of.
_STORED = {
    "mart_top_attackers": ("attackers", "overall_rank"),
    "mart_top_defenders": ("defenders", "overall_rank"),
    "mart_best_movesets": ("movesets", "entity_id"),
    "mart_legendary_rankings": ("legendaries", "overall_rank"),
    "mart_type_effectiveness": ("pairs", "attacking_type"),
}


@query(
    "stored_mart_ranges",
    star_sql(
        " UNION ALL ".join(
            f"""SELECT 'entity_marts' AS schema, '{mart}' AS "table", count(*) AS rows, min({key})::VARCHAR AS low,
                       max({key})::VARCHAR AS high, 0::BIGINT AS cut_files FROM {rows}"""
            for mart, (rows, key) in _STORED.items()
        )
    ),
)
def stored_mart_ranges(spark: SparkSession, directory: str) -> DataFrame:
    """The ranked marts as stored: their files follow each other in the marts' order, so a cut-off reads the first ones."""
    staged = build_staging(Pipeline(spark, directory).star.raw())
    stored = marts.build_marts(staged, folder=TableFolder(spark, scratch_path(spark)))
    return reduce(DataFrame.unionByName, [order_of_files(stored[mart], key) for mart, (_, key) in _STORED.items()])


_VIEW = """
    SELECT damage_class, move_type, count(*) AS moves, max(power) AS most, count(power) AS with_power
    FROM stg_moves WHERE pp > 5 GROUP BY damage_class, move_type"""


@query("staging_view_sql", star_sql(_VIEW))
def staging_view_sql(spark: SparkSession, directory: str) -> DataFrame:
    """The staging views by SQL, under their names."""
    register_staging(Star(spark, directory).raw("moves"))
    return spark.sql(_VIEW)
