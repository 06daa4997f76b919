"""The derived tables and marts in plain SQL, for comparison."""

from __future__ import annotations

from tierloom.constants import ATTACK_TIERS, DAMAGING_CLASSES, DEFENSE_TIERS, LOWEST_TIER, MOVES_PER_ENTITY


def steps_sql(value: str, steps, lowest: str) -> str:
    """``steps`` are (lowest value, label), the highest first."""
    cases = " ".join(f"WHEN {value} >= {least} THEN '{label}'" for least, label in steps)
    return f"CASE {cases} ELSE '{lowest}' END"


def listed_sql(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


_CTES = {
    "raw_entity": """
        SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS base_experience,
               CAST(c_nationkey AS BIGINT) AS height,
               abs(CAST(floor(c_acctbal) AS BIGINT)) AS weight,
               c_mktsegment <> 'BUILDING' AS is_default, c_custkey AS catalog,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_nationkey AS BIGINT) END AS species_id
        FROM customer""",
    "bought": """
        SELECT o_custkey AS entity_id, lineitem.* FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "stg_entity_stats": """
        SELECT entity_id,
               CASE l_returnflag || l_linestatus
                    WHEN 'NF' THEN 'hp' WHEN 'AF' THEN 'attack' WHEN 'AO' THEN 'defense'
                    WHEN 'NO' THEN 'special-attack' WHEN 'RF' THEN 'special-defense'
                    WHEN 'RO' THEN 'speed' END AS stat_name,
               CAST(sum(l_quantity) AS BIGINT) AS base_stat_value, count(*) AS effort_value
        FROM bought GROUP BY 1, 2""",
    "kinds": """
        SELECT entity_id, p_type AS type_name, sum(l_quantity) AS quantity
        FROM bought JOIN part ON p_partkey = l_partkey
        GROUP BY 1, 2""",
    "stg_entity_types": """
        SELECT entity_id, type_name,
               row_number() OVER (PARTITION BY entity_id ORDER BY quantity DESC, type_name) AS type_slot
        FROM kinds""",
    "stg_entity_abilities": """
        SELECT o_custkey AS entity_id, o_orderpriority AS ability_name,
               bool_or(o_orderstatus = 'P') AS is_hidden_ability,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS ability_slot
        FROM orders GROUP BY 1, 2, 4""",
    "stg_entity_moves": """
        SELECT DISTINCT entity_id, p_name || ' ' || p_partkey AS move_name
        FROM bought JOIN part ON p_partkey = l_partkey""",
    "branded": """
        SELECT *, CAST(substr(p_brand, 7) AS BIGINT) % 3 AS brand_class, CAST(p_size AS BIGINT) AS size FROM part""",
    "stg_moves": """
        SELECT p_partkey AS move_id, p_name || ' ' || p_partkey AS move_name,
               CASE WHEN size % 7 <> 0 THEN CAST(floor(p_retailprice) AS BIGINT) % 101 END AS accuracy,
               CASE WHEN brand_class <> 2 AND size % 11 <> 0 THEN size * 3 END AS power,
               size % 40 + 1 AS pp, p_type AS move_type,
               CASE brand_class WHEN 0 THEN 'physical' WHEN 1 THEN 'special' ELSE 'status' END AS damage_class,
               CASE WHEN size % 2 = 0 THEN size END AS effect_chance
        FROM branded""",
    "stg_species": """
        SELECT CAST(n_nationkey AS BIGINT) AS species_id, n_name AS species_name,
               CAST(n_nationkey * 10 AS BIGINT) AS capture_rate,
               CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_nationkey + 50 AS BIGINT) END AS base_happiness,
               n_regionkey = 1 AS is_legendary, n_nationkey % 7 = 3 AS is_mythical, r_name AS generation,
               CASE WHEN n_regionkey <> 2 THEN lower(r_name) END AS habitat,
               CASE WHEN n_nationkey % 3 <> 0 THEN lower(n_name) END AS body_shape
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "trade": """
        SELECT c_nationkey AS source, s_nationkey AS target, CAST(sum(l_quantity) AS BIGINT) AS quantity
        FROM bought JOIN customer ON c_custkey = entity_id JOIN supplier ON s_suppkey = l_suppkey
        GROUP BY 1, 2""",
    # One relation by the traded quantity; some pairs have a second one.
    "stg_types": """
        SELECT CAST(source AS BIGINT) AS type_id, a.n_name AS type_name, damage_relation, d.n_name AS target_type
        FROM (SELECT source, target,
                     CASE quantity % 5 WHEN 0 THEN 'double_damage_to' WHEN 1 THEN 'half_damage_to'
                                       WHEN 2 THEN 'no_damage_to' WHEN 3 THEN 'double_damage_from' END AS damage_relation
              FROM trade
              UNION SELECT source, target, 'half_damage_to' FROM trade WHERE quantity % 7 = 0
              UNION SELECT source, target, 'no_damage_to' FROM trade WHERE quantity % 3 = 0)
             JOIN nation a ON a.n_nationkey = source JOIN nation d ON d.n_nationkey = target
        WHERE damage_relation IS NOT NULL""",
    "slots": """
        SELECT entity_id, max(type_name) FILTER (type_slot = 1) AS primary_type,
               max(type_name) FILTER (type_slot = 2) AS secondary_type
        FROM stg_entity_types GROUP BY 1""",
    "stg_entity": """
        SELECT id AS entity_id, name AS entity_name, base_experience, height AS height_decimeters,
               weight AS weight_hectograms, is_default AS is_default_form, catalog AS catalog_order, species_id
        FROM raw_entity""",
    "dim_entity": """
        SELECT stg_entity.* EXCLUDE (species_id), primary_type, secondary_type,
               stg_species.* EXCLUDE (species_id)
        FROM stg_entity LEFT JOIN slots USING (entity_id)
             LEFT JOIN stg_species ON stg_species.species_id = stg_entity.species_id""",
    "dim_moves": """
        SELECT *, CASE WHEN power IS NULL THEN 0.0::DOUBLE WHEN accuracy IS NULL THEN power::DOUBLE
                       ELSE power::DOUBLE * accuracy / 100.0::DOUBLE END AS expected_damage
        FROM stg_moves""",
    "wide": """
        SELECT entity_id, max(base_stat_value) FILTER (stat_name = 'hp') AS hp,
               max(base_stat_value) FILTER (stat_name = 'attack') AS attack,
               max(base_stat_value) FILTER (stat_name = 'defense') AS defense,
               max(base_stat_value) FILTER (stat_name = 'special-attack') AS sp_attack,
               max(base_stat_value) FILTER (stat_name = 'special-defense') AS sp_defense,
               max(base_stat_value) FILTER (stat_name = 'speed') AS speed
        FROM stg_entity_stats GROUP BY 1""",
    "fct": """
        SELECT entity_id, entity_name, hp, attack, defense, sp_attack, sp_defense, speed,
               ifnull(hp, 0) + ifnull(attack, 0) + ifnull(defense, 0) + ifnull(sp_attack, 0)
               + ifnull(sp_defense, 0) + ifnull(speed, 0) AS total_base_stats
        FROM wide JOIN stg_entity USING (entity_id)""",
    "attackers": f"""
        SELECT entity_id, f.entity_name, primary_type, secondary_type, attack, sp_attack, total_base_stats,
               is_legendary, is_mythical,
               {steps_sql("attack", ATTACK_TIERS, LOWEST_TIER)} AS tier,
               row_number() OVER (ORDER BY attack DESC, sp_attack DESC NULLS FIRST, entity_id) AS overall_rank,
               row_number() OVER (PARTITION BY is_legendary
                                  ORDER BY attack DESC, sp_attack DESC NULLS FIRST, entity_id)
                   AS rank_within_legendary_status
        FROM fct f JOIN dim_entity USING (entity_id) WHERE attack > 0""",
    "defenders": f"""
        SELECT entity_id, f.entity_name, primary_type, secondary_type, hp, defense, sp_defense,
               defense + hp AS combined_defensive_stat, total_base_stats, is_legendary, is_mythical,
               {steps_sql("defense + hp", DEFENSE_TIERS, LOWEST_TIER)} AS tier,
               row_number() OVER (ORDER BY defense + hp DESC, entity_id) AS overall_rank,
               row_number() OVER (PARTITION BY is_legendary ORDER BY defense + hp DESC, entity_id)
                   AS rank_within_legendary_status
        FROM fct f JOIN dim_entity USING (entity_id) WHERE defense > 0 AND hp > 0""",
    "movesets": f"""
        SELECT entity_id, entity_name, primary_type, secondary_type, move_name, move_type, power, accuracy,
               damage_class, expected_damage, move_rank,
               coalesce(move_type = primary_type, false) OR coalesce(move_type = secondary_type, false) AS is_stab
        FROM (SELECT entity_id, m.*,
                     row_number() OVER (PARTITION BY entity_id
                                        ORDER BY power DESC, expected_damage DESC, move_name, move_id) AS move_rank
              FROM stg_entity_moves JOIN dim_moves m USING (move_name)
              WHERE damage_class IN {listed_sql(DAMAGING_CLASSES)} AND power IS NOT NULL)
             JOIN dim_entity USING (entity_id)
        WHERE move_rank <= {MOVES_PER_ENTITY}""",
    "legendaries": """
        SELECT f.*, primary_type, secondary_type, is_legendary, is_mythical, generation,
               if(is_mythical, 'Mythical', 'Legendary') AS rarity_tier,
               row_number() OVER (ORDER BY total_base_stats DESC, entity_id) AS overall_rank,
               row_number() OVER (PARTITION BY is_mythical ORDER BY total_base_stats DESC, entity_id) AS rank_within_tier
        FROM fct f JOIN dim_entity USING (entity_id) WHERE is_legendary OR is_mythical""",
    "axis": "SELECT DISTINCT type_name FROM stg_types",
    "related": """
        SELECT type_name AS attacking_type, target_type AS defending_type,
               bool_or(damage_relation = 'double_damage_to') AS doubled, bool_or(damage_relation = 'half_damage_to') AS halved,
               bool_or(damage_relation = 'no_damage_to') AS spared
        FROM stg_types GROUP BY 1, 2""",
    "pairs": """
        SELECT attacking_type, defending_type,
               CASE WHEN doubled THEN 2.0::DOUBLE WHEN halved THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS effectiveness_multiplier,
               CASE WHEN spared THEN 'No Effect' WHEN halved THEN 'Not Very Effective' ELSE 'Super Effective' END
                   AS effectiveness_label
        FROM related WHERE doubled OR halved OR spared""",
    "pairs_as_written": """
        SELECT attacking_type, defending_type,
               CASE WHEN doubled THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS effectiveness_multiplier,
               CASE WHEN spared THEN 'No Effect' ELSE 'Super Effective' END AS effectiveness_label
        FROM related WHERE doubled OR spared""",
}


def star_sql(select: str) -> str:
    """The statement with every derived table in reach; unused ones cost nothing."""
    ctes = ",\n".join(f"{name} AS ({body.strip()})" for name, body in _CTES.items())
    return f"WITH {ctes}\n{select.strip()}"
