"""Each operator on its own, over the star tables as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.constants import AS_WRITTEN_RELATIONS, DOCUMENTED_RELATIONS
from tierloom.functions.derive import any_match, bucket, category, expected_value, row_total, tier, url_last_id
from tierloom.operators.matrix import axis_values, matrix_row, relation_matrix, relation_pairs
from tierloom.operators.project import Projection, project
from tierloom.operators.quality import accepted, duplicate_keys, missing_parents, not_null, relationship, run_checks, unique
from tierloom.operators.rank import falling, rank_rows, ranks_of, rising, sorts, top_k, top_ranked
from tierloom.operators.reshape import matrix_wide, pivot_max, unpivot_cols
from tierloom.plans.star import Star
from tierloom.sources.keyed_table import latest_rows, merge_latest
from tierloom.sources.tables import read_star
from workload.registry import query

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_BY_TYPE = {kind: kind for kind in EVENT_TYPES}
_CELLS = ", ".join(f"max(value) FILTER (event_type = '{kind}') AS {kind}" for kind in EVENT_TYPES)
_TOTAL = " + ".join(f"ifnull({kind}, 0)" for kind in EVENT_TYPES)


def _wide_events(spark: SparkSession, directory: str, key: str = "user_id") -> DataFrame:
    return pivot_max(read_star(spark, directory, "events"), [key], "event_type", "value", _BY_TYPE)


# Pivots and joins.


@query(
    "pivot_event_max",
    f"SELECT *, {_TOTAL} AS total FROM (SELECT user_id, {_CELLS} FROM events GROUP BY 1)",
)
def pivot_event_max(spark: SparkSession, directory: str) -> DataFrame:
    return _wide_events(spark, directory).withColumn("total", row_total(EVENT_TYPES))


_SPARSE = f"SELECT event_id, {_CELLS} FROM events GROUP BY 1"


@query("pivot_event_max_sparse", f"SELECT *, {_TOTAL} AS total FROM ({_SPARSE})")
def pivot_event_max_sparse(spark: SparkSession, directory: str) -> DataFrame:
    """Per event, so that all cells but one are NULL."""
    return _wide_events(spark, directory, "event_id").withColumn("total", row_total(EVENT_TYPES))


@query(
    "slot_pivot",
    """SELECT conv_id, max(role) FILTER (turn = 0) AS primary_role, max(role) FILTER (turn = 1) AS secondary_role
       FROM conversations GROUP BY 1""",
)
def slot_pivot(spark: SparkSession, directory: str) -> DataFrame:
    turns = read_star(spark, directory, "conversations")
    return pivot_max(turns, ["conv_id"], "turn", "role", {0: "primary_role", 1: "secondary_role"})


_FLAGGED = """
    SELECT d.doc_id, lang, source, n_chars, quality = 1 AS good, toxic = 1 AS toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""


def _flagged(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with their label flags, NULL where there is no label."""
    labels = read_star(spark, directory, "labels").select(
        "doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")
    )
    documents = read_star(spark, directory, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(labels, "doc_id", "left")


@query("dim_left_join", _FLAGGED)
def dim_left_join(spark: SparkSession, directory: str) -> DataFrame:
    return _flagged(spark, directory)


@query(
    "fact_inner_join",
    f"""SELECT user_id, c_name, c_mktsegment, {", ".join(EVENT_TYPES)}, {_TOTAL} AS total
        FROM (SELECT user_id, {_CELLS} FROM events GROUP BY 1) JOIN customer ON c_custkey = user_id""",
)
def fact_inner_join(spark: SparkSession, directory: str) -> DataFrame:
    customers = read_star(spark, directory, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment"
    )
    return pivot_event_max(spark, directory).join(customers, "user_id")


@query(
    "expected_value",
    """SELECT p_partkey, CASE WHEN nullif(p_size, 10) IS NULL THEN 0.0::DOUBLE
                              WHEN nullif(p_size % 7, 3) IS NULL THEN p_size::DOUBLE
                              ELSE p_size::DOUBLE * (p_size % 7)::DOUBLE / 100.0::DOUBLE END AS expected
       FROM part""",
)
def expected(spark: SparkSession, directory: str) -> DataFrame:
    amount = F.nullif(F.col("p_size"), F.lit(10))
    percent = F.nullif(F.col("p_size") % 7, F.lit(3))
    parts = read_star(spark, directory, "part")
    return parts.select("p_partkey", expected_value(amount, percent).alias("expected"))


# Ranking.

_LENGTH_TIERS = ((10000, "S"), (4000, "A"), (1000, "B"))
_LENGTH_TIER_SQL = "CASE WHEN n_chars >= 10000 THEN 'S' WHEN n_chars >= 4000 THEN 'A' WHEN n_chars >= 1000 THEN 'B' ELSE 'C' END"
_RANKED_DOCUMENTS = f"""
    SELECT doc_id, n_chars, toxic, good, {_LENGTH_TIER_SQL} AS tier,
           row_number() OVER (ORDER BY n_chars DESC, doc_id) AS overall_rank,
           row_number() OVER (PARTITION BY toxic ORDER BY n_chars DESC, doc_id) AS rank_within_toxic
    FROM ({_FLAGGED}) WHERE n_chars > 0"""


_LENGTH_ORDER = [falling("n_chars"), rising("doc_id")]


def _tiered_documents(spark: SparkSession, directory: str) -> DataFrame:
    return _flagged(spark, directory).where(F.col("n_chars") > 0).select(
        "doc_id", "n_chars", "toxic", "good", tier(F.col("n_chars"), _LENGTH_TIERS).alias("tier")
    )


@query("tier_rank_global", _RANKED_DOCUMENTS)
def tier_rank_global(spark: SparkSession, directory: str) -> DataFrame:
    ranks = {"overall_rank": [], "rank_within_toxic": ["toxic"]}
    return rank_rows(_tiered_documents(spark, directory), _LENGTH_ORDER, ranks)


_RANKED_LINES = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS shipped,
           row_number() OVER (ORDER BY {order}) AS overall_rank,
           row_number() OVER (PARTITION BY l_returnflag ORDER BY {order}) AS rank_within_flag
    FROM lineitem"""
_LINE_ORDER = (
    "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


@query("line_rank_distributed", _RANKED_LINES.format(order=", ".join(f"{c} DESC" for c in _LINE_ORDER)))
def line_rank_distributed(spark: SparkSession, directory: str) -> DataFrame:
    """The largest table, ranked by a column of only fifty values with ties settled by the rest."""
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    lines = read_star(spark, directory, "lineitem")
    order = [falling(column) for column in _LINE_ORDER]
    ranks = {"overall_rank": [], "rank_within_flag": ["l_returnflag"]}
    ranked = rank_rows(lines, order, ranks)
    return ranked.select(
        *[c for c in lines.columns if c != "l_shipdate"], shipped, "overall_rank", "rank_within_flag"
    )


@query(
    "combined_rank",
    """SELECT *, CASE WHEN combined >= 95 THEN 'S' WHEN combined >= 80 THEN 'A' WHEN combined >= 65 THEN 'B'
                      ELSE 'C' END AS tier,
              row_number() OVER (ORDER BY combined DESC, p_partkey) AS overall_rank,
              row_number() OVER (PARTITION BY p_type ORDER BY combined DESC, p_partkey) AS rank_within_type
       FROM (SELECT p_partkey, p_type, p_size, max(l_quantity)::BIGINT AS most,
                    max(l_quantity)::BIGINT + p_size AS combined
             FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3)
       WHERE most > 0 AND p_size > 0""",
)
def combined_rank(spark: SparkSession, directory: str) -> DataFrame:
    lines = read_star(spark, directory, "lineitem")
    parts = read_star(spark, directory, "part")
    most = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.max("l_quantity").cast("bigint").alias("most")
    )
    combined = F.col("most") + F.col("p_size")
    rows = (
        most.where(F.col("most") > 0)
        .join(parts.where(F.col("p_size") > 0).select("p_partkey", "p_type", "p_size"), "p_partkey")
        .withColumn("combined", combined)
        .withColumn("tier", tier(F.col("combined"), ((95, "S"), (80, "A"), (65, "B"))))
    )
    order = [falling("combined"), rising("p_partkey")]
    return rank_rows(rows, order, {"overall_rank": [], "rank_within_type": ["p_type"]})


_TOP_LINE_ORDER = (
    "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


@query(
    "topk_per_group",
    f"""SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, p_type, l_quantity, l_extendedprice, place,
               p_type IN ('PROMO', 'LARGE') AS either
        FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
                                           ORDER BY {", ".join(f"{c} DESC" for c in _TOP_LINE_ORDER)}) AS place
              FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type IN ('PROMO', 'LARGE', 'SMALL'))
        WHERE place <= 3""",
)
def topk_per_group(spark: SparkSession, directory: str) -> DataFrame:
    kept = F.col("p_type").isin("PROMO", "LARGE", "SMALL")
    parts = read_star(spark, directory, "part").where(kept)
    parts = parts.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = read_star(spark, directory, "lineitem").join(parts, "l_partkey")
    order = [F.col(column).desc_nulls_last() for column in _TOP_LINE_ORDER]
    return top_k(lines, ["l_suppkey"], order, 3, "place").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "p_type", "l_quantity", "l_extendedprice", "place",
        any_match(F.col("p_type"), F.lit("PROMO"), F.lit("LARGE")).alias("either"),
    )


_BY_EXPRESSION = """
    SELECT o_orderkey, o_orderstatus, o_totalprice,
           row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS overall_rank,
           row_number() OVER (PARTITION BY CASE WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Open' END
                              ORDER BY o_totalprice DESC, o_orderkey) AS rank_within_tier
    FROM orders WHERE o_orderstatus = 'P' OR o_orderstatus = 'O'"""


@query("rank_by_expr", _BY_EXPRESSION)
def rank_by_expr(spark: SparkSession, directory: str) -> DataFrame:
    pending = F.col("o_orderstatus") == "P"
    orders = read_star(spark, directory, "orders")
    rows = orders.where(pending | (F.col("o_orderstatus") == "O")).select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    order = [falling("o_totalprice"), rising("o_orderkey")]
    ranks = {"overall_rank": [], "rank_within_tier": [F.when(pending, "Pending").otherwise("Open")]}
    return rank_rows(rows, order, ranks)


@query(
    "rank_cutoff",
    """SELECT doc_id, n_chars, overall_rank
       FROM (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS overall_rank FROM documents)
       WHERE overall_rank <= 20""",
)
def rank_cutoff(spark: SparkSession, directory: str) -> DataFrame:
    documents = read_star(spark, directory, "documents").select("doc_id", "n_chars")
    return top_ranked(documents, _LENGTH_ORDER, 20, "overall_rank")


@query(
    "topn_optional_filter",
    f"SELECT * FROM ({_RANKED_DOCUMENTS}) WHERE NOT toxic AND good ORDER BY overall_rank LIMIT 25",
)
def topn_optional_filter(spark: SparkSession, directory: str) -> DataFrame:
    """Both ranks of the 25 rows, counted over all rows; nothing else is ranked."""
    rows = _tiered_documents(spark, directory)
    chosen = rows.where(~F.col("toxic") & F.col("good")).orderBy(*sorts(_LENGTH_ORDER)).limit(25)
    return ranks_of(rows, chosen, _LENGTH_ORDER, {"overall_rank": None, "rank_within_toxic": ~F.col("toxic")})


@query(
    "topn_multi_key",
    """SELECT p_partkey, p_name, p_type, p_size, p_retailprice FROM part
       ORDER BY p_retailprice DESC, p_name, p_size, p_partkey LIMIT 100""",
)
def topn_multi_key(spark: SparkSession, directory: str) -> DataFrame:
    parts = read_star(spark, directory, "part")
    order = [F.col("p_retailprice").desc_nulls_last(), "p_name", "p_size", "p_partkey"]
    return parts.orderBy(*order).limit(100).select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")


# Relation matrix.

_REGION_PAIRS = """
    SELECT a.r_name AS source, d.r_name AS target, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
         JOIN supplier ON s_suppkey = l_suppkey
         JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN nation sn ON sn.n_nationkey = s_nationkey
         JOIN region a ON a.r_regionkey = cn.n_regionkey JOIN region d ON d.r_regionkey = sn.n_regionkey
    GROUP BY 1, 2"""
_REGION_RELATIONS = f"""
    SELECT source, target,
           CASE quantity % 4 WHEN 0 THEN 'double_damage_to' WHEN 1 THEN 'half_damage_to'
                             WHEN 2 THEN 'no_damage_to' END AS relation
    FROM ({_REGION_PAIRS})"""
_REGION_MATRIX = f"""
    WITH rel AS ({_REGION_RELATIONS}), axis AS (SELECT r_name AS source FROM region)
    SELECT a.source AS attacking_type, d.source AS defending_type,
           {{multiplier}} AS effectiveness_multiplier, {{label}} AS effectiveness_label
    FROM axis a, axis d LEFT JOIN rel ON rel.source = a.source AND rel.target = d.source"""
_AS_DOCUMENTED = _REGION_MATRIX.format(
    multiplier="""CASE relation WHEN 'double_damage_to' THEN 2.0::DOUBLE WHEN 'half_damage_to' THEN 0.5::DOUBLE
                                WHEN 'no_damage_to' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END""",
    label="""CASE relation WHEN 'double_damage_to' THEN 'Super Effective' WHEN 'half_damage_to'
             THEN 'Not Very Effective' WHEN 'no_damage_to' THEN 'No Effect' ELSE 'Normal' END""",
)
_AS_WRITTEN = _REGION_MATRIX.format(
    multiplier="""CASE relation WHEN 'double_damage_to' THEN 2.0::DOUBLE
                                WHEN 'no_damage_to' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END""",
    label="""CASE relation WHEN 'double_damage_to' THEN 'Super Effective'
             WHEN 'no_damage_to' THEN 'No Effect' ELSE 'Normal' END""",
)


def _region_relations(spark: SparkSession, directory: str) -> DataFrame:
    star = Star(spark, directory)
    regions = star.table("nation").join(star.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sources = regions.select(F.col("n_nationkey").alias("source"), F.col("r_name").alias("attacker"))
    targets = regions.select(F.col("n_nationkey").alias("target"), F.col("r_name").alias("defender"))
    traded = (
        star.trade()
        .join(sources, "source")
        .join(targets, "target")
        .groupBy("attacker", "defender")
        .agg((F.sum("quantity") % 4).alias("rest"))
    )
    relation = (
        F.when(F.col("rest") == 0, "double_damage_to")
        .when(F.col("rest") == 1, "half_damage_to")
        .when(F.col("rest") == 2, "no_damage_to")
    )
    return traded.select("attacker", "defender", relation.alias("relation")).where(F.col("relation").isNotNull())


_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _region_pairs(spark: SparkSession, directory: str, mapping=DOCUMENTED_RELATIONS) -> DataFrame:
    return relation_pairs(_region_relations(spark, directory), "attacker", "defender", "relation", mapping)


@query("relation_pairs", f"SELECT * FROM ({_AS_DOCUMENTED}) WHERE effectiveness_label <> 'Normal'")
def pairs_documented(spark: SparkSession, directory: str) -> DataFrame:
    return _region_pairs(spark, directory)


@query("relation_pairs_as_written", f"SELECT * FROM ({_AS_WRITTEN}) WHERE effectiveness_label <> 'Normal'")
def pairs_as_written(spark: SparkSession, directory: str) -> DataFrame:
    return _region_pairs(spark, directory, AS_WRITTEN_RELATIONS)


@query("relation_matrix", _AS_DOCUMENTED)
def matrix_documented(spark: SparkSession, directory: str) -> DataFrame:
    return relation_matrix(_region_pairs(spark, directory), _REGIONS)


@query("relation_matrix_as_written", _AS_WRITTEN)
def matrix_as_written(spark: SparkSession, directory: str) -> DataFrame:
    return relation_matrix(_region_pairs(spark, directory, AS_WRITTEN_RELATIONS), _REGIONS)


@query(
    "matrix_wide",
    "SELECT attacking_type, "
    + ", ".join(f"coalesce(max(effectiveness_multiplier) FILTER (defending_type = '{r}'), 1.0::DOUBLE) AS \"{r}\"" for r in _REGIONS)
    + f" FROM ({_AS_DOCUMENTED}) WHERE effectiveness_label <> 'Normal' GROUP BY 1",
)
def wide_matrix(spark: SparkSession, directory: str) -> DataFrame:
    pairs = _region_pairs(spark, directory)
    return matrix_wide(pairs, "attacking_type", "defending_type", "effectiveness_multiplier", _REGIONS, 1.0)


@query("axis_distinct", f"SELECT DISTINCT source AS attacking_type FROM ({_REGION_RELATIONS}) WHERE relation IS NOT NULL")
def axis_distinct(spark: SparkSession, directory: str) -> DataFrame:
    axis = axis_values(_region_relations(spark, directory), "attacker")
    return axis.select(F.col("attacker").alias("attacking_type")).orderBy("attacking_type")


@query("matrix_row", f"SELECT * FROM ({_AS_DOCUMENTED}) WHERE attacking_type = 'ASIA'")
def region_row(spark: SparkSession, directory: str) -> DataFrame:
    row = matrix_row(_region_pairs(spark, directory), "ASIA", _REGIONS)
    return row.orderBy(F.col("effectiveness_multiplier").desc(), "defending_type")


# Counts and shapes.


@query(
    "counts_scorecard",
    f"""SELECT count(*) AS total, count(*) FILTER (good OR toxic) AS flagged, count(good) AS labelled
        FROM ({_FLAGGED})""",
)
def counts_scorecard(spark: SparkSession, directory: str) -> DataFrame:
    return _flagged(spark, directory).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("good") | F.col("toxic")).alias("flagged"),
        F.count("good").alias("labelled"),
    )


@query(
    "count_if_sum_null",
    f"""SELECT CAST(sum(1) FILTER (toxic) AS BIGINT) AS toxic, CAST(sum(1) FILTER (lang = 'xx') AS BIGINT) AS none
        FROM ({_FLAGGED})""",
)
def count_if_sum_null(spark: SparkSession, directory: str) -> DataFrame:
    """A conditional sum over no matching row is NULL, unlike a count."""
    return _flagged(spark, directory).agg(
        F.sum(F.when(F.col("toxic"), F.lit(1))).alias("toxic"),
        F.sum(F.when(F.col("lang") == "xx", F.lit(1))).alias("none"),
    )


@query("count_by_group", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def count_by_group(spark: SparkSession, directory: str) -> DataFrame:
    counted = read_star(spark, directory, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
    return counted.orderBy(F.col("customers").desc(), "c_mktsegment")


@query("tier_distribution", f"SELECT {_LENGTH_TIER_SQL} AS tier, count(*) AS documents FROM documents GROUP BY 1")
def tier_distribution(spark: SparkSession, directory: str) -> DataFrame:
    documents = read_star(spark, directory, "documents")
    tiers = documents.groupBy(tier(F.col("n_chars"), _LENGTH_TIERS).alias("tier"))
    return tiers.agg(F.count(F.lit(1)).alias("documents")).orderBy("tier")


@query(
    "unpivot_avg",
    """SELECT p_type, measure, round(avg(value), 1) AS average
       FROM (SELECT p_type, 'size' AS measure, p_size::BIGINT AS value FROM part
             UNION ALL SELECT p_type, 'price', floor(p_retailprice)::BIGINT FROM part) GROUP BY 1, 2""",
)
def unpivot_avg(spark: SparkSession, directory: str) -> DataFrame:
    parts = read_star(spark, directory, "part").select(
        "p_type", F.col("p_size").cast("bigint").alias("size"), F.floor("p_retailprice").cast("bigint").alias("price")
    )
    long = unpivot_cols(parts, ["p_type"], {"size": "size", "price": "price"}, "measure", "value")
    return long.groupBy("p_type", "measure").agg(F.round(F.avg("value"), 1).alias("average"))


_LONG_EVENTS = " UNION ALL ".join(
    f"SELECT event_id, '{kind}' AS event_type, {kind} AS value FROM ({_SPARSE})" for kind in EVENT_TYPES
)


@query("unpivot_keep_nulls", _LONG_EVENTS)
def unpivot_keep_nulls(spark: SparkSession, directory: str) -> DataFrame:
    wide = _wide_events(spark, directory, "event_id")
    return unpivot_cols(wide, ["event_id"], _BY_TYPE, "event_type", "value", keep_nulls=True)


@query("unpivot_drop_nulls", f"SELECT * FROM ({_LONG_EVENTS}) WHERE value IS NOT NULL AND event_type IN ('click', 'view')")
def unpivot_drop_nulls(spark: SparkSession, directory: str) -> DataFrame:
    wide = _wide_events(spark, directory, "event_id")
    long = unpivot_cols(wide, ["event_id"], _BY_TYPE, "event_type", "value")
    return long.where(F.col("event_type").isin("click", "view"))


@query(
    "bucket_histogram",
    """SELECT l_returnflag, CASE WHEN l_quantity >= 40 THEN '5: 40+' WHEN l_quantity >= 30 THEN '4: 30-39'
                                 WHEN l_quantity >= 20 THEN '3: 20-29' WHEN l_quantity >= 10 THEN '2: 10-19'
                                 ELSE '1: <10' END AS quantity_bucket, count(*) AS lines
       FROM lineitem GROUP BY 1, 2""",
)
def bucket_histogram(spark: SparkSession, directory: str) -> DataFrame:
    labels = ("1: <10", "2: 10-19", "3: 20-29", "4: 30-39", "5: 40+")
    quantity = bucket(F.col("l_quantity"), (10, 20, 30, 40), labels)
    lines = read_star(spark, directory, "lineitem")
    return lines.groupBy("l_returnflag", quantity.alias("quantity_bucket")).agg(F.count(F.lit(1)).alias("lines"))


@query("scatter_nonflag", f"SELECT doc_id, lang, n_chars FROM ({_FLAGGED}) WHERE NOT good AND NOT toxic")
def scatter_nonflag(spark: SparkSession, directory: str) -> DataFrame:
    plain = _flagged(spark, directory).where(~F.col("good") & ~F.col("toxic"))
    return plain.select("doc_id", "lang", "n_chars")


@query(
    "category_case",
    f"""SELECT doc_id, CASE WHEN toxic THEN 'Mythical' WHEN good THEN 'Legendary' ELSE lang END AS category
        FROM ({_FLAGGED})""",
)
def category_case(spark: SparkSession, directory: str) -> DataFrame:
    named = category(F.col("toxic"), F.col("good"), F.col("lang"))
    return _flagged(spark, directory).select("doc_id", named.alias("category"))


@query(
    "entity_vector",
    f"""SELECT user_id, concat_ws(',', {", ".join(f"CAST(round({k} * 100) AS BIGINT)" for k in (*EVENT_TYPES, "click"))}) AS vector
        FROM (SELECT user_id, {_CELLS} FROM events GROUP BY 1) ORDER BY {_TOTAL} DESC, user_id LIMIT 5""",
)
def entity_vector(spark: SparkSession, directory: str) -> DataFrame:
    """Closed value vector, in hundredths, of the five users with the largest totals."""
    order = [falling("total"), rising("user_id")]
    leading = top_ranked(pivot_event_max(spark, directory), order, 5, "place")
    cents = F.transform(F.array(*EVENT_TYPES, EVENT_TYPES[0]), lambda v: F.round(v * 100).cast("bigint").cast("string"))
    return leading.select("user_id", F.array_join(cents, ",").alias("vector"))


# Ingest and upsert steps.


@query(
    "stage_project",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
              CAST(floor(o_totalprice) AS BIGINT) AS whole_price, o_orderpriority AS priority
       FROM orders WHERE o_orderkey IS NOT NULL AND o_orderstatus IS NOT NULL""",
)
def stage_project(spark: SparkSession, directory: str) -> DataFrame:
    spec = Projection(
        [
            ("o_orderkey", "bigint", "order_id"),
            ("o_custkey", "bigint", "customer_id"),
            ("o_orderstatus", "string", "status"),
            ("whole", "bigint", "whole_price"),
            ("o_orderpriority", "string", "priority"),
        ],
        ["o_orderkey", "o_orderstatus"],
    )
    orders = read_star(spark, directory, "orders").withColumn("whole", F.floor("o_totalprice"))
    project(orders, spec).createOrReplaceTempView("staged_orders")
    return spark.table("staged_orders")


@query(
    "url_last_id",
    r"""SELECT page_id, TRY_CAST(nullif(regexp_extract(regexp_replace(url, '[?#].*$', ''), '/(\d+)/*$', 1), '') AS BIGINT)
               AS last_id
        FROM pages""",
)
def url_last_ids(spark: SparkSession, directory: str) -> DataFrame:
    address = F.regexp_replace("url", r"[?#].*$", "")
    pages = read_star(spark, directory, "pages")
    return pages.select("page_id", url_last_id(address, missing_ok=True).alias("last_id"))


@query(
    "json_field",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_field(spark: SparkSession, directory: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint", {"mode": "FAILFAST"})
    return read_star(spark, directory, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "cursor_filter",
    "SELECT event_id, user_id, event_type FROM events WHERE event_id > (SELECT max(event_id) // 2 FROM events)",
)
def cursor_filter(spark: SparkSession, directory: str) -> DataFrame:
    """Events past a cursor that sits halfway through them."""
    events = read_star(spark, directory, "events")
    cursor = events.agg((F.floor(F.max("event_id") / 2)).alias("cursor"))
    return events.where(F.col("event_id") > cursor.scalar()).select("event_id", "user_id", "event_type")


@query("cursor_advance", "SELECT 'events' AS source, max(event_id) AS last_id FROM events")
def cursor_advance(spark: SparkSession, directory: str) -> DataFrame:
    events = read_star(spark, directory, "events")
    return events.agg(F.max("event_id").alias("last_id")).select(F.lit("events").alias("source"), "last_id")


_LATEST = """
    SELECT user_id, event_type, event_id, value FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS place
         FROM events) WHERE place = 1"""


def _event_order() -> list[Column]:
    return [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]


@query("upsert_latest", _LATEST)
def upsert_latest(spark: SparkSession, directory: str) -> DataFrame:
    events = read_star(spark, directory, "events")
    return latest_rows(events, ["user_id", "event_type"], _event_order()).select(
        "user_id", "event_type", "event_id", "value"
    )


@query("upsert_merge", _LATEST)
def upsert_merge(spark: SparkSession, directory: str) -> DataFrame:
    """The first half of the events as stored table, the second half put over it."""
    events = read_star(spark, directory, "events")
    middle = events.agg((F.floor(F.max("event_id") / 2)).alias("middle")).scalar()
    key = ["user_id", "event_type"]
    stored = latest_rows(events.where(F.col("event_id") <= middle), key, _event_order())
    changes = latest_rows(events.where(F.col("event_id") > middle), key, _event_order())
    return merge_latest(stored, changes, key).select("user_id", "event_type", "event_id", "value")


# Data checks.


@query(
    "dq_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
       WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_unique(spark: SparkSession, directory: str) -> DataFrame:
    return duplicate_keys(read_star(spark, directory, "lineitem"), ["l_orderkey", "l_linenumber"])


def _dq_row(table: str, column: str, check: str, failures: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", '{check}' AS "check", failures,
                      CASE failures WHEN 0 THEN 'pass' ELSE 'fail' END AS status FROM ({failures})"""


@query(
    "dq_not_null",
    " UNION ALL ".join(
        _dq_row(table, column, "not_null", f"SELECT count(*) AS failures FROM {table} WHERE {column} IS NULL")
        for table, column in (("orders", "o_orderkey"), ("orders", "o_custkey"), ("documents", "text"))
    ),
)
def dq_not_null(spark: SparkSession, directory: str) -> DataFrame:
    tables = {name: read_star(spark, directory, name) for name in ("orders", "documents")}
    checks = [not_null("orders", "o_orderkey"), not_null("orders", "o_custkey"), not_null("documents", "text")]
    return run_checks(tables, checks)


@query(
    "dq_accepted",
    " UNION ALL ".join(
        [
            _dq_row("part", "p_type", "accepted_values", "SELECT count(*) AS failures FROM part WHERE p_type NOT IN ('LARGE', 'SMALL')"),
            _dq_row("orders", "o_orderstatus", "accepted_values", "SELECT count(*) AS failures FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')"),
        ]
    ),
)
def dq_accepted(spark: SparkSession, directory: str) -> DataFrame:
    tables = {name: read_star(spark, directory, name) for name in ("part", "orders")}
    return run_checks(
        tables, [accepted("part", "p_type", ("LARGE", "SMALL")), accepted("orders", "o_orderstatus", ("F", "O", "P"))]
    )


@query(
    "dq_relationship",
    " UNION ALL ".join(
        [
            _dq_row("lineitem", "l_orderkey", "relationships", "SELECT count(*) AS failures FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
            _dq_row("documents", "doc_id", "relationships", "SELECT count(*) AS failures FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
            _dq_row("orders", "o_orderkey", "unique", "SELECT count(*) - count(DISTINCT o_orderkey) AS failures FROM orders"),
        ]
    ),
)
def dq_relationship(spark: SparkSession, directory: str) -> DataFrame:
    tables = {name: read_star(spark, directory, name) for name in ("lineitem", "orders", "documents", "labels")}
    return run_checks(
        tables,
        [
            relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
            relationship("documents", "doc_id", "labels", "doc_id"),
            unique("orders", "o_orderkey"),
        ],
    )


@query(
    "dq_orphan_keys",
    "SELECT doc_id, count(*) AS rows FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1",
)
def dq_orphan_keys(spark: SparkSession, directory: str) -> DataFrame:
    labels = read_star(spark, directory, "labels")
    return missing_parents(read_star(spark, directory, "documents"), "doc_id", labels, "doc_id")
