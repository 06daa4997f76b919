"""Repair of conversations' structure by dynamic programming over runs.

A row is one symbol: its role's initial and its fault. Cheapest edits lead a
row of symbols through four states (nothing yet, after system, after user,
after assistant), so a symbol is a min-plus matrix of four by four, inserts
before the row included. Equal symbols in a row are one run, which the binary
powers of its matrix, made once, carry over in as many steps as its length has
bits. The cost still to come is known before and after each run that way;
from the start on, each row then takes the ASCII-least edit that keeps to it.

Rows are sorted across partitions, so a conversation of any length is cut into
segments. A segment's runs multiply to one matrix; only matrices of segments
at partition borders, two a partition, come to the driver, which passes costs
back and states on between them. No task holds a conversation.

Defined cases: a null role or text is one space, a null turn comes first, null
conv_ids are one conversation; rows of one turn are ordered by role and digest
of the text; repeated rows are duplicates of the first; a role is judged by its
first character, an empty one fits nowhere; an empty table gives an empty
result; only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.sources.storage import materialize

DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
#: What a truncated row costs besides, if it stays.
TRUNCATED = 5
SPACES = " \t\n\x0b\x0c\r"
STOPS = [".", "!", "?"]

#: States by the last role: none, system, user, assistant. A conversation may end in the first and the last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
OTHER = 3
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: The state after a row whose role may be chosen: user and assistant take turns.
TURN = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: State after a kept row, by the state before it and the role's place in "sua".
KEPT = {(NONE, 0): SYSTEM, (NONE, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
LEGAL = {"su", "ua", "au"}
#: Symbols are 2 * role + truncated, and one for rows that must go.
GOES = 2 * (OTHER + 1)
FAR = 1 << 60
#: Runs of up to two to this power; more rows than any table has.
BIGGEST = 48

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]
Batches = Iterator[pa.RecordBatch]


def product(left: Matrix, right: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(row[k] + right[k][t] for k in range(4))) for t in range(4)) for row in left)


def before(matrix: Matrix, after: Vector) -> Vector:
    """Costs to come before what ``matrix`` stands for, from those after it."""
    return tuple(min(row[t] + after[t] for t in range(4)) for row in matrix)


UNIT: Matrix = tuple(tuple(0 if s == t else FAR for t in range(4)) for s in range(4))
ONE_INSERT: Matrix = tuple(tuple(COST[INSERT] if TURN[s] == t else FAR for t in range(4)) for s in range(4))
AT_MOST_ONE: Matrix = tuple(tuple(map(min, a, b)) for a, b in zip(UNIT, ONE_INSERT, strict=True))
#: Two inserts lead to every state that inserts reach.
INSERTS: Matrix = product(AT_MOST_ONE, AT_MOST_ONE)


def edits_of(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after it) of a row, in ASCII order."""
    found = [(DELETE, COST[DELETE], state)]
    if symbol != GOES:
        role, more = symbol // 2, TRUNCATED * (symbol % 2)
        if (state, role) in KEPT:
            found.append((KEEP, COST[KEEP] + more, KEPT[state, role]))
        found.append((REROLE, COST[REROLE] + more, TURN[state]))
    return found


EDITS = {(symbol, state): edits_of(symbol, state) for symbol in range(GOES + 1) for state in range(4)}


def matrix_of(symbol: int) -> Matrix:
    cells = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, after in EDITS[symbol, state]:
            cells[state][after] = min(cells[state][after], cost)
    return product(INSERTS, tuple(map(tuple, cells)))


def powers_of(matrix: Matrix) -> list[Matrix]:
    found = [matrix]
    for _ in range(BIGGEST):
        found.append(product(found[-1], found[-1]))
    return found


#: Binary powers of each symbol's matrix.
POWERS = [powers_of(matrix_of(symbol)) for symbol in range(GOES + 1)]
#: Costs at the end of a conversation: inserts up to an assistant's row.
AT_END: Vector = tuple(min(INSERTS[s][NONE], INSERTS[s][ASSISTANT]) for s in range(4))


def bits_of(length: int) -> Iterator[int]:
    return (bit for bit in range(length.bit_length()) if length >> bit & 1)


def runs_of(symbols: list[int]) -> list[tuple[int, int]]:
    return [(symbol, sum(1 for _ in run)) for symbol, run in groupby(symbols)]


def whole_matrix(symbols: list[int]) -> Matrix:
    whole = UNIT
    for symbol, length in runs_of(symbols):
        for bit in bits_of(length):
            whole = product(whole, POWERS[symbol][bit])
    return whole


def unroll(symbols: list[int], state: int, after: Vector, last: bool) -> Iterator[tuple[int, str, int, int]]:
    """(row, edit, cost, state after it) of the cheapest edits, ASCII-least; ``after``: the costs after the rows."""
    runs = runs_of(symbols)
    ahead = [after]
    for symbol, length in reversed(runs):
        costs = ahead[-1]
        for bit in bits_of(length):
            costs = before(POWERS[symbol][bit], costs)
        ahead.append(costs)
    row = 0
    for symbol, length in runs:
        ahead.pop()
        steps = [ahead[-1]]
        for _ in range(length):
            steps.append(before(POWERS[symbol][0], steps[-1]))
        while length:
            here, there = steps[length], steps[length - 1]
            delete, *others = EDITS[symbol, state]
            insert = (INSERT, COST[INSERT], TURN[state])
            for edit, cost, then in (delete, insert, *others):
                if cost + (here if edit == INSERT else there)[then] == here[state]:
                    break
            yield row, edit, cost, then
            state = then
            if edit != INSERT:
                row, length = row + 1, length - 1
    while last and AT_END[state]:
        state = TURN[state]
        yield row - 1, INSERT, COST[INSERT], state


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by a hash of conv_id and turn; a null is one space."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat_ws(":", *names)) % 20
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate"))
    cut = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", "".join(STOPS), "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    changed = rows.where("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), cut.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)),
    )
    return changed.drop("col")


def in_order(rows: DataFrame) -> DataFrame:
    """(pos, segment, conv_id, turn, role, text, digest) in order across partitions; a segment is a partition."""
    whole = dict(rows.dtypes)["conv_id"] != "string"
    plain = rows.select(
        F.col("conv_id").cast("long" if whole else "string"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.sha2(F.coalesce("text", F.lit(" ")), 256).alias("digest"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"), F.asc("copy")]
    dealt = plain.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().alias("pos"), F.spark_partition_id().alias("segment")
    return materialize(dealt.select(*place, "conv_id", "turn", "role", "text", "digest"))


def fault_of() -> Column:
    """blank, truncated or null; duplicates are not known from a row alone."""
    end = F.rtrim("text", F.lit(SPACES))
    return F.when(end == "", "blank").when(~F.substring(end, -1, 1).isin(STOPS), "truncated")


def with_faults(ordered: DataFrame) -> DataFrame:
    """(pos, segment, conv_id, fault, symbol) of the rows."""
    light = ordered.select("pos", "segment", "conv_id", "role", "digest", fault_of().alias("fault"))
    seen = light.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    seen = seen.where("n > 1").drop("n").toDF("conv", "as_role", "as_digest", "first")
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("role") == F.col("as_role")) & (F.col("digest") == F.col("as_digest"))
    blank, again = F.coalesce(F.col("fault") == "blank", F.lit(False)), F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    fault = F.when(again & ~blank, "duplicate").otherwise(F.col("fault"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    goes = F.coalesce(fault.isin("blank", "duplicate"), F.lit(False))
    symbol = F.when(goes, GOES).otherwise(2 * role + F.when(fault == "truncated", 1).otherwise(0))
    joined = light.join(seen, same, "left")
    return materialize(joined.select("pos", "segment", "conv_id", fault.alias("fault"), symbol.cast("int").alias("symbol")))


def _spans(batches: Batches) -> Iterator[tuple[int, object, list[int], list[int], bool]]:
    """(segment, conv_id, places, symbols, at a border) of each conversation's rows within a segment."""
    names = ("segment", "conv_id", "pos", "symbol")
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True))
    for segment, own in groupby(rows, itemgetter(0)):
        first, held = True, None
        for conv, span in groupby(own, itemgetter(1)):
            places, symbols = map(list, zip(*((pos, symbol) for _, _, pos, symbol in span), strict=True))
            if held:
                yield *held, first
                first = False
            held = segment, conv, places, symbols
        yield *held, True


def _by_segment(rows: DataFrame) -> DataFrame:
    # A stated number of partitions, as the rows are small and would be joined to one task otherwise.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("pos", "segment", "conv_id", "symbol").repartition(tasks, "segment").sortWithinPartitions("pos")


def _border_matrices(rows: DataFrame, kind: str) -> DataFrame:
    def scan(batches: Batches) -> Batches:
        for segment, conv, _, symbols, border in _spans(batches):
            if border:
                cells = [cell for row in whole_matrix(symbols) for cell in row]
                columns = [pa.array([segment], pa.int32()), pa.array([conv], conv_type), pa.array([cells], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["segment", "conv_id", "cells"])

    conv_type = _arrow_type(kind)
    return _by_segment(rows).mapInArrow(scan, f"segment int, conv_id {kind}, cells array<long>")


def _arrow_type(kind: str) -> pa.DataType:
    return pa.string() if kind == "string" else pa.int64()


def _ends(chains: list[list[tuple]]) -> dict:
    """Costs after each border span: (segment, conv_id) -> (costs, whether the conversation ends there)."""
    found = {}
    for chain in chains:
        costs = AT_END
        for segment, conv, cells in reversed(chain):
            found[segment, conv] = costs, (segment, conv) == chain[-1][:2]
            costs = before(tuple(tuple(cells[4 * s : 4 * s + 4]) for s in range(4)), costs)
    return found


def _exits(rows: DataFrame, ends: dict) -> dict:
    """State after each border span that goes on, for each state before it."""

    def scan(batches: Batches) -> Batches:
        for segment, conv, places, symbols, _ in _spans(batches):
            costs, last = ends.get((segment, conv), (AT_END, True))
            if last:
                continue
            after = []
            for state in range(4):
                for *_, state in unroll(symbols, state, costs, False):
                    pass
                after.append(state)
            columns = [pa.array(places[:1]), pa.array([segment], pa.int32()), pa.array([after], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["pos", "segment", "after"])

    found = _by_segment(rows).mapInArrow(scan, "pos long, segment int, after array<int>").collect()
    return {row.segment: row.after for row in found}  # one span of a segment, its last, goes on


def edits(rows: DataFrame) -> DataFrame:
    """(pos, step, edit, cost, new_role) of the cheapest edits of ``rows`` (pos, segment, conv_id, symbol)."""
    kind = dict(rows.dtypes)["conv_id"]
    chains = _chained(sorted(map(tuple, _border_matrices(rows, kind).collect()), key=itemgetter(0)))
    ends = _ends(chains)
    exits = _exits(rows, ends) if any(len(chain) > 1 for chain in chains) else {}
    starts = {}
    for chain in chains:
        state = NONE
        for segment, conv, _ in chain:
            starts[segment, conv] = state
            if (segment, conv) != chain[-1][:2]:
                state = exits[segment][state]

    def scan(batches: Batches) -> Batches:
        for segment, conv, places, symbols, _ in _spans(batches):
            costs, last = ends.get((segment, conv), (AT_END, True))
            out, step, at = [], 0, -1
            for row, edit, cost, state in unroll(symbols, starts.get((segment, conv), NONE), costs, last):
                step = step + 1 if row == at else 0
                at = row
                out.append((places[row], step, edit, cost, ROLE_OF[state] if edit in (INSERT, REROLE) else None))
                if len(out) == 1 << 16:
                    yield _edit_batch(out)
                    out = []
            if out:
                yield _edit_batch(out)

    return _by_segment(rows).mapInArrow(scan, "pos long, step long, edit string, cost long, new_role string")


def _edit_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["pos", "step", "edit", "cost", "new_role"])


def _chained(spans: list[tuple]) -> list[list[tuple]]:
    """Border spans (segment, conv_id, cells), in order, tied to chains where a conversation goes on in the next segment."""
    chains: list[list[tuple]] = []
    for span in spans:
        if chains and chains[-1][-1][1] == span[1]:
            chains[-1].append(span)
        else:
            chains.append([span])
    return chains


def repair(rows: DataFrame) -> DataFrame:
    """All rows in order with their edits, inserted rows among them.

    conv_id, pos and step (the order), turn, fault (of a given row), old_role
    (null: inserted), edit, cost, role and text (after the edit; of deleted
    rows as given).
    """
    ordered = in_order(rows)
    faults = with_faults(ordered)
    made = edits(faults).withColumnRenamed("pos", "at")
    given = ordered.select("pos", "conv_id", "turn", "role", "text")
    faulty = faults.select(F.col("pos").alias("place"), "fault")
    whole = made.join(given, F.col("at") == F.col("pos")).join(faulty, F.col("at") == F.col("place"))
    new = F.col("edit") == INSERT
    return whole.select(
        "conv_id", "pos", "step", F.when(~new, F.col("turn")).alias("turn"), F.when(~new, F.col("fault")).alias("fault"),
        F.when(~new, F.col("role")).alias("old_role"), "edit", "cost", F.coalesce("new_role", "role").alias("role"),
        F.when(new, "").otherwise(F.col("text")).alias("text"),
    )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(repaired: DataFrame) -> DataFrame:
    """A row per conversation of ``repaired``: the counts, the audit and the repaired text's SHA-256, read row by row."""
    kind = dict(repaired.dtypes)["conv_id"]
    conv_type = _arrow_type(kind)
    names = ("conv_id", "turn", "fault", "old_role", "edit", "cost", "role", "text")

    def scan(batches: Batches) -> Batches:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True))
        done: list[tuple] = []
        for conv, own in groupby(rows, itemgetter(0)):
            done.append((conv, *_digest(own)))
            if len(done) == 4096:
                yield batch_of(done)
                done = []
        if done:
            yield batch_of(done)

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        kinds = [conv_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
        columns = [pa.array(column, type_) for column, type_ in zip(zip(*done, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *COUNTS, "audit", "repaired_sha256"])

    dealt = repaired.select(*names, "pos", "step").repartition("conv_id")
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return dealt.sortWithinPartitions(F.asc_nulls_first("conv_id"), "pos", "step").mapInArrow(
        scan, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string"
    )


def _digest(rows: Iterator[tuple]) -> tuple:
    faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    audit, text_hash, low, high = bytearray(), hashlib.sha256(), None, None
    distinct = illegal = cost = 0
    last_role, begun = None, False
    for _, turn, fault, old_role, edit, price, role, text in rows:
        audit += edit.encode()
        cost += price
        if fault:
            faults[fault] += 1
        if old_role is not None:
            illegal += last_role is not None and last_role[:1] + old_role[:1] not in LEGAL
            last_role = old_role
        if turn is not None and turn != high:
            low, high, distinct = turn if low is None else low, turn, distinct + 1
        if edit != DELETE:
            text_hash.update((f"\n{role}:{text}" if begun else f"{role}:{text}").encode())
            begun = True
    gaps = 0 if low is None else high - low + 1 - distinct
    return gaps, *faults.values(), illegal, cost, audit.decode(), text_hash.hexdigest()


def report(rows: DataFrame) -> DataFrame:
    """Damage, then repair: one row for every conversation of ``rows``, those that lost all rows too."""
    found = digests(repair(damage(rows))).withColumnRenamed("conv_id", "conv")
    known = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    zeros = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in COUNTS]
    empty = hashlib.sha256().hexdigest()
    return known.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")
    )
