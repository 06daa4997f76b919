"""Registered queries of the operators over the given tables, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierloom.llm import (
    bpe, decontaminate, dialogue, exact_dedup, hard_negatives, language, line_dedup, mixing, quality_rules, simhash, token_store,
    toxicity, warc,
)
from tierloom.llm.common import table

QUERIES = {}
ORACLES = {}


def query(function):
    """Register a query under its function's name; a docstring, if any, is its SQL."""
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.round_trip(table(spark, folder, "documents"))


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.measure(table(spark, folder, "documents"))


@query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"))


@query
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, folder, "documents"))


def _words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _count(text: str, characters: str) -> str:
    return f"length(regexp_replace({text}, '[^{characters}]+', '', 'g'))"


_MENU = "|".join(quality_rules.NAVIGATION_WORDS)
_PHRASE = " OR ".join(f"contains(lower(x), '{phrase}')" for phrase in quality_rules.BOILERPLATE)
_FAILS = rf"""(
  {_count("x", "#*$%&|<>")} * 4 > len({_words("x")})
  OR (len({_words("x")}) >= 4 AND {_count("x", "!")} * 2 > len({_words("x")}))
  OR (len({_words("x")}) >= 25 AND NOT regexp_matches(x, '[.,;:!?…。，！？]'))
  OR ({_count("x", "|»›•·")} >= 2 AND {_count("x", "|»›•·")} * 5 >= len({_words("x")}))
  OR (len({_words("x")}) <= 6 AND regexp_matches(x, '(?i)^\W*(({_MENU})\W*)+$'))
  OR {_PHRASE})"""

ORACLES["op2_quality_rules"] = rf"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS w FROM documents),
lined AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l,
         list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS win FROM cut
),
repeated AS (
  SELECT doc_id, count(DISTINCT place + step) AS n
  FROM (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, win) AS times
        FROM (SELECT doc_id, unnest(win) AS win, generate_subscripts(win, 1) AS place FROM lined)),
       (SELECT unnest(range(5)) AS step)
  WHERE times > 1 GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
       length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
       len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
       lost AS n_lost_words, len(w) < 10 OR 100 * coalesce(n, 0) > 20 * len(w) AS base_failed,
       len(w) >= 10 AND 100 * coalesce(n, 0) <= 20 * len(w) AND lost * 100 <= 50 * len(w) AS kept
FROM (SELECT *, coalesce(list_sum(list_transform(l, lambda x: CASE WHEN {_FAILS} THEN len({_words("x")}) ELSE 0 END)), 0)::BIGINT
        AS lost FROM lined)
LEFT JOIN repeated USING (doc_id)
"""

ORACLES["op4_exact_dedup"] = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM hashed
WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(table(spark, folder, "documents"))


ORACLES["op8_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (keeper IS NULL OR keeper = doc_id), ''))
         AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id
"""


@query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.find_groups(table(spark, folder, "documents"))


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


# Base 32 by five bits a character: DuckDB has no such function.
ORACLES["op6_warc"] = r"""
WITH hashed AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages
),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: right(bin(('0x' || hex[i])::INT + 16), 4)), '') AS b
  FROM hashed
)
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[list_sum(list_transform(range(0, 5), lambda j:
           b[5 * i + j + 1]::INT * (16 // (2 ** j)::INT)))::INT + 1]), '') AS payload_digest,
       CASE WHEN min(page_id) OVER same = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN min(page_id) OVER same <> page_id THEN min(page_id) OVER same END AS refers_to
FROM bits WINDOW same AS (PARTITION BY hex)
"""


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings"))


ORACLES["op11_hard_negatives"] = """
WITH known AS (
  SELECT row_number() OVER () AS own, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.own AS anchor, a.vec_id AS anchor_id, b.own, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM known a JOIN known b ON a.own <> b.own WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor, p.own ORDER BY n.score DESC, n.vec_id NULLS LAST))::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


@query
def op12_dialogue_repair(spark: SparkSession, folder: str) -> DataFrame:
    return dialogue.report(table(spark, folder, "conversations"))


# A state's cell is the least of the ways into it: the cost in nine digits, then the audit; and the text that goes with it.
def _way(state: str, cost: str, edit: str, line: str) -> str:
    grown = f"{state}.t || {line}" if line else f"{state}.t"
    audit = f"printf('%09d', {state}.k[:9]::INT + {cost}) || {state}.k[10:] || '{edit}'"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'k': {audit}, 't': {grown}}} END"


def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda z: z IS NOT NULL))"


def _inserted(prefix: str = "") -> str:
    """Columns n0 to n3: the states after up to two inserts."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    once = [
        "s0 AS i0, s1 AS i1",
        f"{_least('s2', *(_way(s, '5', 'I', user) for s in ('s0', 's1', 's3')))} AS i2",
        f"{_least('s3', _way('s2', '5', 'I', assistant))} AS i3",
    ]
    twice = [
        "i0 AS n0, i1 AS n1",
        f"{_least('i2', _way('i3', '5', 'I', user))} AS n2",
        f"{_least('i3', _way('i2', '5', 'I', assistant))} AS n3",
    ]
    return f"SELECT * EXCLUDE (s0, s1, s2, s3, i0, i1, i2, i3), {', '.join(twice)} FROM (SELECT *, {', '.join(once)} FROM {prefix})"


_OWN, _USER, _ASSISTANT = (f"chr(10) || {role} || ':' || text" for role in ("role", "'user'", "'assistant'"))


def _when(condition: str, way: str) -> str:
    return f"CASE WHEN {condition} THEN {way} END"


_STAY = "NOT goes"
_ROW = [
    _way("n0", "2", "D", ""),
    _least(_way("n1", "2", "D", ""), _when(f"{_STAY} AND initial = 's'", _way("n0", "more", "K", _OWN))),
    _least(
        _way("n2", "2", "D", ""),
        *(_when(f"{_STAY} AND initial = 'u'", _way(s, "more", "K", _OWN)) for s in ("n0", "n1", "n3")),
        *(_when(_STAY, _way(s, "1 + more", "R", _USER)) for s in ("n0", "n1", "n3")),
    ),
    _least(
        _way("n3", "2", "D", ""),
        _when(f"{_STAY} AND initial = 'a'", _way("n2", "more", "K", _OWN)),
        _when(_STAY, _way("n2", "1 + more", "R", _ASSISTANT)),
    ),
]

ORACLES["op12_dialogue_repair"] = rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
),
-- CRC-32 bit by bit: a byte is mixed in, then eight shifts (-1) follow.
fated AS (
  SELECT *, xor(4294967295, list_reduce(
    flatten(list_transform(range(1, length(name) + 1), lambda i: [ascii(name[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c // 2, (c % 2) * 3988292384) END, 4294967295::BIGINT)) % 20 AS fate
  FROM named
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM fated, (SELECT unnest([1, 2]) AS copy) WHERE fate <> 0 AND (copy = 1 OR fate = 3)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place FROM damaged
),
judged AS (
  SELECT *, role[1] AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY place) AS last_initial
  FROM placed
),
faulty AS (
  SELECT *, body = '' AS blank, body <> '' AND again AS duplicate,
         body <> '' AND NOT again AND NOT regexp_matches(body, '[.!?]$') AS truncated
  FROM judged
),
marked AS (SELECT *, blank OR duplicate AS goes, CASE WHEN truncated THEN 5 ELSE 0 END AS more FROM faulty),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (last_initial IS NOT NULL AND (last_initial || initial) NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n
  FROM marked GROUP BY conv_id
),
ways AS (
  SELECT conv_id, 0::BIGINT AS place, {{'k': '000000000', 't': ''}} AS s0, NULL::STRUCT(k VARCHAR, t VARCHAR) AS s1,
         NULL::STRUCT(k VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(k VARCHAR, t VARCHAR) AS s3
  FROM sums
  UNION ALL
  SELECT conv_id, place, {_ROW[0]}, {_ROW[1]}, {_ROW[2]}, {_ROW[3]}
  FROM ({_inserted("(SELECT w.s0, w.s1, w.s2, w.s3, m.conv_id, m.place, m.role, m.text, m.initial, m.goes, m.more FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.place = w.place + 1)")})
),
ended AS (
  SELECT conv_id, {_least("n0", "n3")} AS best FROM ({_inserted("(SELECT w.* FROM ways w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.place)")})
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.k[:9]::BIGINT, 0) AS cost, coalesce(best.k[10:], '') AS audit,
       sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query
def op13_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLES["op13_decontaminate"] = r"""
WITH cut AS (
  SELECT row_number() OVER () AS own, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
tests AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win
  FROM tests WHERE len(w) > 0
),
places AS (
  SELECT own, size, unnest(range(1, len(w) - size + 2)) AS place,
         unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS win
  FROM cut, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
),
hits AS (SELECT own, place, size, item FROM places JOIN windows USING (size, win)),
covered AS (
  SELECT own, count(DISTINCT place + step) AS n_hit FROM (SELECT DISTINCT own, place, size FROM hits), (SELECT unnest(range(10)) AS step)
  WHERE step < size GROUP BY own
),
found AS (SELECT own, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT own, item FROM hits) GROUP BY own)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM cut LEFT JOIN covered USING (own) LEFT JOIN found USING (own)
"""
