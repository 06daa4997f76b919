from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from tierloom.llm import decontaminate

DOCS = "doc_id long, text string, spans string"
ITEMS = "item_id long, text string, row string"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow(docs, items):
    windows = {}
    for item_id, text, *_ in items:
        own = words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text, *_ in docs:
        own = words(text)
        hit, found = set(), set()
        for size in range(1, 11):
            for i in range(len(own) - size + 1):
                if names := windows.get(tuple(own[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= names
        out.append((doc_id, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def tables():
    random.seed(31)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "日本", "x1"]
    prose = lambda n: random.choices(vocabulary, k=n)
    shared = prose(25)
    items = [(i, " ".join(prose(random.randrange(10, 60))), "a") for i in range(40)]
    items += [(100 + i, " ".join([*prose(5), *shared, *prose(i)]), "b") for i in range(30)]
    items += [(200, "rare pair", "c"), (201, "Solo!", "c"), (202, "", "c"), (None, " ".join(prose(12)), None), (203, None, None)]
    items += [items[0], (None, " ".join(prose(9)), None)]
    docs = []
    for i in range(150):
        own = prose(random.randrange(0, 80))
        if i % 3:
            source = random.choice(items)[1] or ""
            part = source.split()
            a = random.randrange(max(1, len(part)))
            own[len(own) // 2 : len(own) // 2] = part[a : a + random.choice([8, 9, 10, 11, 30])]
        docs.append((i, random.choice([" ", ", ", "\n", "-"]).join(own).upper(), None))
    docs += [(1000 + i, " ".join([*prose(3), *shared, *prose(3)]), None) for i in range(100)]
    docs += [(None, None, None), (7, "", None), (None, f"so solo; RARE pair of {items[3][1]}", None), docs[1], docs[1]]
    docs.append((9000, " ".join([*prose(40_000), *shared, *prose(40_000), "rare", "pair", *shared[:10]]), "long"))
    return docs, items


@pytest.mark.parametrize("portion", [64, 1 << 20])
def test_finds_all_windows(spark, portion, monkeypatch):
    monkeypatch.setattr(decontaminate.portions, "__defaults__", (portion,))
    docs, items = tables()
    got = decontaminate.report(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS).repartition(3))
    assert Counter(map(tuple, got.collect())) == slow(docs, items)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BITS", 8)
    monkeypatch.setattr(decontaminate, "BLOCK", 8)
    docs, items = tables()
    docs = docs[:60]
    got = decontaminate.report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert Counter(map(tuple, got.collect())) == slow(docs, items)


def test_clean_keeps_the_columns(spark):
    docs, items = tables()
    frame = spark.createDataFrame(docs, DOCS)
    left = decontaminate.clean(frame, spark.createDataFrame(items, ITEMS))
    want = Counter(row[:2] for row in docs if not [x for x in slow([row], items) if x[-1]])
    assert left.columns == frame.columns and Counter((r.doc_id, r.text) for r in left.collect()) == want
    spans = decontaminate.find_spans(frame, spark.createDataFrame(items, ITEMS))
    assert spans.columns == ["doc_id", "spans", "n_words", "_spans", "items"]


def test_empty(spark):
    docs, items = tables()
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.report(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
    rows = decontaminate.report(spark.createDataFrame(docs[:20], DOCS), none).collect()
    assert len(rows) == 20 and not any(r.contaminated or r.n_hit for r in rows)
