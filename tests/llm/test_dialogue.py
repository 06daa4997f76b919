from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from tierloom.llm import dialogue

ROWS = "conv_id long, turn long, role string, text string, cost string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text, _ in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(name.encode()) % 20
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def cheapest(rows):
    """Least (cost, audit) with the repaired lines, forward over all edits; rows of (goes, truncated, role, text)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def with_inserts(ways):
        ways = dict(ways)
        for _ in range(2):
            for state, (cost, audit, lines) in list(ways.items()):
                then = after[state]
                way = (cost + 5, audit + "I", [*lines, f"{name[then]}:"])
                ways[then] = min(ways.get(then, way), way)
        return ways

    ways = {"": (0, "", [])}
    for goes, truncated, role, text in rows:
        new = {}
        for state, (cost, audit, lines) in with_inserts(ways).items():
            options = [(state, (cost + 2, audit + "D", lines))]
            if not goes:
                more = 5 * truncated
                then = after[state]
                options.append((then, (cost + 1 + more, audit + "R", [*lines, f"{name[then]}:{text}"])))
                first = role[:1]
                if first == then or first == "s" and state == "":
                    options.append((first, (cost + more, audit + "K", [*lines, f"{role}:{text}"])))
            for then, way in options:
                new[then] = min(new.get(then, way), way)
        ways = new
    return min(way for state, way in with_inserts(ways).items() if state in ("", "a"))


def slow(rows):
    out = {}
    for conv in {row[0] for row in rows}:
        own = [row for row in damaged(rows) if row[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, judged, count = set(), [], Counter()
        for _, _, role, text in own:
            end = text.rstrip(SPACE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            judged.append((fault in ("blank", "duplicate"), fault == "truncated", role, text))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        turns = {row[1] for row in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = cheapest(judged)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha)
    return sorted(out.values(), key=str)


def talk(conv, n, roles="system user assistant tool user assistant s uA".split()):
    random.seed(conv or 0)
    texts = ["Yes.", "no", " ", "", "Why? ", "Oh!\n", "a.b", "été…", "one", "two."]
    return [
        (conv, random.choice([None, i, i, i + 3, i // 2]), random.choice([*roles, *roles, "", None]), random.choice([*texts, f"t{i}.", f"t{i}", None]), "x")
        for i in range(n)
    ]


def all_rows():
    rows = [row for conv in [None, *range(60)] for row in talk(conv, conv % 13 if conv else 40)]
    rows += [(100, i, "user", f"line {i}.", None) for i in range(300)] + [(101, i, "assistant", f"line {i}", None) for i in range(200)]
    rows += [(102, 5, "user", "Same.", None)] * 150 + [(103, 1, "user", "long. " * 50_000, None), (104, None, None, None, None)]
    return rows


@pytest.mark.parametrize("partitions", [1, 9])
def test_repairs_as_all_edits_do(spark, partitions):
    """Over nine range partitions long conversations are cut into segments."""
    rows = all_rows()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dialogue.report(spark.createDataFrame(rows, ROWS).repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, got), key=str) == slow(rows)


def test_lost_conversations_stay_in_the_result(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = dialogue.report(spark.createDataFrame([(lost, 0, "user", "Hi.", None)], ROWS)).collect()
    assert [tuple(r) for r in got] == [(lost, *[0] * 6, "", hashlib.sha256().hexdigest())]


def test_powers_are_repeated_steps():
    for symbol in range(dialogue.GOES + 1):
        costs = dialogue.AT_END
        for _ in range(13):
            costs = dialogue.before(dialogue.POWERS[symbol][0], costs)
        assert costs == dialogue.before(dialogue.whole_matrix([symbol] * 13), dialogue.AT_END)


def test_repair_returns_rows(spark):
    rows = [(7, 1, "assistant", "Hello."), (7, 2, "assistant", "How are you?"), (7, 3, "user", "Fine."), (7, 3, "user", "Fine.")]
    found = dialogue.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("pos", "step").collect()
    assert "".join(r.edit for r in found) == "RKDD" and [r.role for r in found[:2]] == ["user", "assistant"]
    assert [r.fault for r in found] == [None, None, None, "duplicate"] and found[1].text == "How are you?"


def test_empty(spark):
    empty = spark.createDataFrame([], ROWS)
    assert dialogue.report(empty).count() == 0 and dialogue.repair(empty).count() == 0
