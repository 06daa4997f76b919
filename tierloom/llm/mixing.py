"""Mixing sources to target weights by pivotal dependent rounding.

Each source's target is its weight's share of the mix, at most ``most`` times
what the source has; the excess is shared out again by weight. A document of
a source is to be copied target / size times: the whole part is certain, the
rest a probability. Pairs of probabilities then play against each other: words
move from one to the other, in a random direction whose odds keep every
expectation, until one of the two is 0 or 1; the other plays on. The words of
a pair never change in sum, so a source misses its target by less than one
document, however many it has.

The duels form a reduction tree. Documents are dealt by hash into blocks of
about BLOCK of one source; a block settles all but one, whose residual goes up
a level, until one is left per source, which is drawn by itself. A source that
holds most rows just has more blocks. Draws hash the seed and the two ids, so
reruns agree.

Column expressions only. One row per source is what the targets are computed
from; all else is grouped by (source, block). Rows that agree in id,
source and text are counted and numbered, so that many of them, or many rows
without an id, spread over blocks as others do.

Defined cases: a null text has size 0; documents of size 0 take nothing; null
is a source of its own, after all others; rows that repeat an id are mixed
each for itself; an empty table gives an empty result; other columns are not
read by ``mix`` and returned by ``take``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierloom.llm.common import fresh, words
from tierloom.sources.storage import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = 17
#: Documents of one block, on average.
BLOCK = 32
#: Equal rows that are numbered at a time.
STRETCH = 1 << 16


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and number of words of each document, and a lot that tells rows of one id and source apart."""
    size = F.size(words(F.coalesce("text", F.lit("")))).cast("long")
    alike = docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("mark"))
    counted = alike.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("rows"))
    first = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"), F.lit(STRETCH)))
    stretches = counted.withColumn("first", first)
    last = F.least(F.col("rows"), F.col("first") + (STRETCH - 1))
    return stretches.withColumn("nth", F.explode(F.sequence("first", last))).select(
        "doc_id", "source", "size", _lot(F.col("mark"), F.col("nth")).alias("lot")
    )


def _lot(mark: Column, nth: Column) -> Column:
    return F.xxhash64(mark, nth.cast("long"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, number, source_size, documents with words, target.

    A source is full if ``most * size`` is at most its weight's part of what
    the sources that are not full share. In the order of ``size / weight`` the
    full ones come first, so running sums find them in one pass.
    """
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("documents")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(by_name) - 1).alias("number")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("number") % len(weights))
    numbered = sources.select("*", number).withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    in_order = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = in_order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(from_here)
    levels = numbered.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    level = F.first("level", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.coalesce(level * F.col("weight"), F.col("cap")), F.col("cap"))
    return levels.select("source", "number", "source_size", "documents", target.alias("target"))


def _draw(*ids: Column) -> Column:
    """A number from 0 to 1 that depends on the ids and the seed."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *ids), 11) / F.lit(float(1 << 53))


ITEM = "struct<doc_id:bigint,size:bigint,lot:bigint,p:double>"


def _item(of: Column, p: Column) -> Column:
    return F.struct(of["doc_id"].alias("doc_id"), of["size"].alias("size"), of["lot"].alias("lot"), p.alias("p")).cast(ITEM)


def _duel(one: Column, other: Column) -> Column:
    """The two items after words moved between them: at least one has probability 0 or 1."""
    rise = F.least(one["size"] * (1 - one.p), other["size"] * other.p)
    fall = F.least(one["size"] * one.p, other["size"] * (1 - other.p))
    up = _draw(one.doc_id, one.lot, other.doc_id, other.lot) * (rise + fall) < fall
    one_up = F.when(one["size"] * (1 - one.p) <= other["size"] * other.p, 1.0).otherwise(one.p + rise / one["size"])
    other_down = F.when(one["size"] * (1 - one.p) >= other["size"] * other.p, 0.0).otherwise(other.p - rise / other["size"])
    one_down = F.when(one["size"] * one.p <= other["size"] * (1 - other.p), 0.0).otherwise(one.p - fall / one["size"])
    other_up = F.when(one["size"] * one.p >= other["size"] * (1 - other.p), 1.0).otherwise(other.p + fall / other["size"])
    return F.struct(
        _item(one, F.when(up, one_up).otherwise(one_down)).alias("one"),
        _item(other, F.when(up, other_down).otherwise(other_up)).alias("other"),
    )


def _open(item: Column) -> Column:
    return (item.p > 0) & (item.p < 1)


def _settle(items: Column) -> Column:
    """struct(left, done) of a block: the item still open, if any, and all others with probability 0 or 1."""
    start = F.struct(F.lit(None).cast(ITEM).alias("left"), F.array().cast(f"array<{ITEM}>").alias("done"))

    def step(state: Column, item: Column) -> Column:
        duel = _duel(state.left, item)
        # One of the two is settled by now; the first of them is taken to be it, unless it is the one still open.
        played = F.struct(
            F.when(_open(duel.one), duel.one).when(_open(duel.other), duel.other).alias("left"),
            F.when(_open(duel.one), F.array_append(state.done, duel.other))
            .when(_open(duel.other), F.array_append(state.done, duel.one))
            .otherwise(F.concat(state.done, F.array(duel.one, duel.other)))
            .alias("done"),
        )
        return F.when(state.left.isNull(), F.struct(item.alias("left"), state.done.alias("done"))).otherwise(played)

    return F.aggregate(items, start, step)


def round_probabilities(rows: DataFrame, most_rows: int) -> DataFrame:
    """(number, doc_id, size, lot, p) with p 0 or 1 of ``rows`` (number, documents, doc_id, size, p between 0 and 1).

    ``documents`` bounds the rows of each number, ``most_rows`` those of any. ``lot``, if there, tells rows of one id apart.
    """
    rows = rows if "lot" in rows.columns else rows.withColumn("lot", F.lit(0).cast("long"))
    settled, open_, blocks = [], rows, F.ceil(F.col("documents") / BLOCK).cast("long")
    for level in range(max(1, math.ceil(math.log(max(2, most_rows), BLOCK)))):
        turn = F.xxhash64(F.lit(SEED), F.lit(level), "doc_id", "size", "lot")
        dealt = open_.withColumn("blocks", blocks).withColumn("block", F.pmod(turn, F.col("blocks")))
        items = F.collect_list(F.struct(turn.alias("turn"), F.struct("doc_id", "size", "lot", "p").cast(ITEM).alias("item")))
        block = dealt.groupBy("number", "blocks", "block").agg(F.array_sort(items).alias("items"))
        played = block.withColumn("out", _settle(F.transform("items", lambda x: x.item)))
        level_done = materialize(played.select("number", "blocks", "out.left", "out.done"))
        settled.append(level_done.select("number", F.inline("done")))
        open_ = level_done.where("left IS NOT NULL").select("number", F.col("blocks").alias("documents"), "left.*")
    last = F.when(_draw(F.col("number"), F.col("doc_id"), F.col("lot")) < F.col("p"), 1.0).otherwise(0.0)
    out = open_.select("number", "doc_id", "size", "lot", last.alias("p"))
    for done in settled:
        out = out.unionByName(done)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, lot."""
    sizes = materialize(sized(docs))
    goals = materialize(targets(sizes, weights, share, most))
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(times).cast("long")
    rows = materialize(
        sizes.withColumnRenamed("source", "own")
        .join(goals, F.col("own").eqNullSafe(F.col("source")))
        .select("number", "documents", "doc_id", "size", "lot", (times - whole).alias("p"))
    )
    plays = (F.col("size") > 0) & (F.col("p") > 0)
    largest = goals.agg(F.max("documents")).first()[0] or 0
    drawn = round_probabilities(rows.where(plays), largest).unionByName(
        rows.where(~plays).select("number", "doc_id", "size", "lot", F.lit(0.0).alias("p"))
    )
    copies = F.when(F.col("size") > 0, whole + F.col("p").cast("long")).otherwise(0)
    return drawn.join(goals, "number").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"), "lot"
    )


def take(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: every document as often as it was taken, with all its columns.

    Rows that repeat an id are told apart by source and text; those that agree in these too take each other's copies.
    """
    key, own, size, lot, copies = (fresh(docs.columns, x) for x in ("key", "own", "size", "lot", "copies"))
    decided = mix(docs, weights, share, most).where(F.col("copies") > 0)
    decided = decided.select(*(F.col(x).alias(y) for x, y in zip(("doc_id", "source", "lot", "copies"), (key, own, f"{lot}_", copies))))
    words_ = F.size(words(F.coalesce("text", F.lit("")))).cast("long")
    named = docs.withColumn(size, words_).withColumn(lot, F.xxhash64("text"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "source", size, lot).orderBy(size))
    named = named.withColumn(lot, _lot(F.col(lot), nth))
    same = (F.col(lot) == F.col(f"{lot}_")) & F.col("doc_id").eqNullSafe(F.col(key)) & F.col("source").eqNullSafe(F.col(own))
    return named.join(decided, same).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(docs.columns)
