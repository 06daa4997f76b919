from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tierloom.llm import components, line_dedup, simhash

DOCS = "doc_id long, text string"


def expect_lines(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    where = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            where[key(line)].add(line_dedup.NO_ID if doc_id is None else doc_id)
    lost = {k: max(ids) for k, ids in where.items() if len(k) >= 20 and len(ids) >= 3}
    out = []
    for doc_id, text in rows:
        own = line_dedup.NO_ID if doc_id is None else doc_id
        lines = (text or "").split("\n")
        stay = [line for line in lines if lost.get(key(line), own) == own]
        sha = hashlib.sha256("\n".join(stay).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(stay), sha))
    return Counter(out)


def line_rows():
    random.seed(4)
    lines = ["short", "", "  A passage that many documents share  ", "a passage THAT many documents share", "ÉTÉ " * 6]
    lines += [f"line number {i} of the whole set" for i in range(40)] + ["été " * 6, "exactly twenty chars"]
    rows = [(i, "\n".join(random.choices(lines, k=random.randrange(8)))) for i in range(200)]
    hot = [(1000 + i, f"unique text of document {i}\nThe line that a third of all have") for i in range(150)]
    return rows + hot + [(None, None), (7, "The line that a third of all have"), (None, lines[2])] + [rows[0]] * 2


@pytest.mark.parametrize("bound", [0, 1 << 30])
def test_line_dedup(spark, bound):
    rows = line_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = line_dedup.strip_repeats(docs, bound).collect()
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in found)
    assert got == expect_lines(rows)


def test_line_dedup_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    rows = line_rows()
    report = line_dedup.report(spark.createDataFrame(rows, DOCS).repartition(5))
    assert Counter(map(tuple, report.collect())) == expect_lines(rows)


def test_clean_returns_the_columns(spark):
    docs = spark.createDataFrame([(i, "the same long line of text", "x") for i in range(4)], "doc_id long, text string, kept_text string")
    rows = {row.doc_id: row for row in line_dedup.clean(docs).collect()}
    assert rows[3].text == "the same long line of text" and rows[0].text == "" and rows[0].kept_text == "x"
    assert line_dedup.report(docs.limit(0)).count() == 0


def test_second_filter_has_all_repeats():
    random.seed(5)
    hashes = np.array([random.getrandbits(64) for _ in range(3000)] * 2, np.uint64)[:4500]
    twice = line_dedup.second_filter(hashes, np.zeros(len(hashes), bool), 8192)
    assert line_dedup.known(twice, hashes[:1500]).all()
    assert line_dedup.known(twice, hashes[1500:3000]).mean() < 0.05


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [word for word in words.split(" ") if word]
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, ids):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, doc_id in enumerate(ids):
        root = find(i)
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    return [least[find(i)] for i in range(len(ids))]


def near_copies():
    random.seed(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(None, None), (3, ""), (2, " \n"), (900, "one two"), (901, "One  TWO"), (902, "É été"), (903, "é été")]
    for group in range(40):
        words = random.choices(vocabulary, k=random.choice([6, 80, 400]))
        for copy in range(random.randrange(1, 5)):
            changed = list(words)
            for _ in range(copy):
                changed[random.randrange(len(changed))] = random.choice(vocabulary)
            rows.append((1000 + 10 * group + copy, " ".join(changed)))
    hot = random.choices(vocabulary, k=300)
    for copy in range(120):
        changed = list(hot)
        changed[copy % 300] = f"x{copy}"
        rows.append((5000 + copy, " ".join(changed)))
    return rows


@pytest.mark.parametrize("most", [4, 8192])
def test_simhash_groups(spark, most):
    rows = near_copies()
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.find_groups(docs, most=most).collect())
    prints = [slow_fingerprint(text) for _, text in rows]
    ids = groups_of(prints, [doc_id for doc_id, _ in rows])
    assert got == Counter((row[0], f"{p:016x}", c) for row, p, c in zip(rows, prints, ids, strict=True))


def test_forest_connects_what_links_connect():
    random.seed(7)
    centre = random.getrandbits(64)
    prints = [centre]
    for _ in range(60):
        prints.append(random.choice(prints) ^ sum(1 << random.randrange(64) for _ in range(random.randrange(1, 7))) & (1 << 64) - 1)
    left, right = simhash.forest(np.unique(np.array(prints, np.uint64)))
    distinct = sorted(set(prints))
    want = groups_of(distinct, distinct)
    parent = {p: p for p in distinct}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        parent[find(a)] = find(b)
    assert len({find(p) for p in distinct}) == len(set(want))
    assert len(left) == len(distinct) - len(set(want))


def test_drop_near_copies(spark):
    rows = near_copies()
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, key int")
    prints = [slow_fingerprint(text) for _, text in rows]
    ids = groups_of(prints, [doc_id for doc_id, _ in rows])
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r, c in zip(rows, ids, strict=True) if r[0] == c)


def test_drop_near_copies_judges_rows_not_ids(spark):
    """Null ids and ids that repeat with other texts: one row of each group stays, and no text of its own is lost."""
    random.seed(8)
    own = [" ".join(random.choices([f"w{i}" for i in range(300)], k=90)) for _ in range(6)]
    near = lambda text: f"{text} more"
    texts = [(None, own[0]), (None, own[1]), (5, near(own[1])), (None, own[2]), (None, f"{near(own[2])} yet")]
    texts += [(7, own[3]), (7, own[4]), (6, near(own[4])), (8, own[5]), (8, own[5])]
    assert all(bin(slow_fingerprint(a) ^ slow_fingerprint(b)).count("1") <= 4 for a, b in [
        (own[1], near(own[1])), (own[2], f"{near(own[2])} yet"), (own[4], near(own[4]))])
    kept = simhash.drop_near_copies(spark.createDataFrame([(*row, "x") for row in texts], "doc_id long, text string, sha string"))
    left = Counter((r.doc_id, r.text) for r in kept.collect())
    group = min([own[2], f"{near(own[2])} yet"], key=lambda text: hashlib.sha256(text.encode()).hexdigest())
    assert left == Counter([(None, own[0]), (5, near(own[1])), (None, group), (7, own[3]), (6, near(own[4])), (8, own[5])])
    assert kept.columns == ["doc_id", "text", "sha"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 9), (9, 7), (3, 3)]
    found = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert all(found[i] == 100 for i in range(100, 161))
    assert all(found[i] == 500 for i in range(500, 540)) and found[7] == found[9] == 7


def test_empty(spark):
    assert simhash.find_groups(spark.createDataFrame([], DOCS)).count() == 0
