from __future__ import annotations

import gzip
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tierloom.llm import mixing, warc

DOCS = "doc_id long, text string, source string"
PAGES = "page_id long, url string, html string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def mix_rows():
    random.seed(11)
    rows = [(i, "w " * random.randrange(0, 60), "hot") for i in range(600)]
    rows += [(1000 + i, "w\tx\n" * random.randrange(1, 9), random.choice(["a", "Z", "é", None, "src9", "src10"])) for i in range(200)]
    return rows + [(None, "no id here", "a"), (3000, None, "empty"), (3001, "one", "one"), (3001, "one", "one")]


def expected_targets(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    own = defaultdict(int)
    for _, text, source in rows:
        own[source] += len(WORD.findall(text or ""))
    names = sorted((s for s in own if s is not None), key=lambda s: s.encode()) + [None] * (None in own)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(own.values()) - sum(most * own[s] for s in full)
        level = left / max(1, sum(weight[s] for s in names if s not in full))
        new = {s for s in names if s not in full and level * weight[s] > most * own[s]}
        if not new:
            return own, {s: most * own[s] if s in full else level * weight[s] for s in names}
        full |= new


def test_mix(spark):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mix(docs.repartition(3)).collect()
    own, target = expected_targets(rows)
    sizes = Counter((doc_id, len(WORD.findall(text or "")), source) for doc_id, text, source in rows)
    assert Counter((r.doc_id, r["size"], r.source) for r in out) == sizes
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.source_size == own[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for source in own:
        assert abs(taken[source] - target[source]) <= max(1, largest[source])
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_expected_copies_are_kept(spark, monkeypatch):
    """Over many seeds each document is taken about as often as its probability says."""
    monkeypatch.setattr(mixing, "BLOCK", 4)
    rows = spark.createDataFrame([(0, 6, i, 1 + 5 * i, 0.3) for i in range(6)], "number int, documents long, doc_id long, size long, p double")
    hits, runs = Counter(), 40
    for seed in range(runs):
        monkeypatch.setattr(mixing, "SEED", seed)
        drawn = mixing.round_probabilities(rows, 6).collect()
        assert {row.p for row in drawn} <= {0.0, 1.0} and len(drawn) == 6
        hits.update(row.doc_id for row in drawn if row.p)
    assert all(1 <= hits[i] <= 26 for i in range(6)) and 0.15 < sum(hits.values()) / (6 * runs) < 0.45


def test_many_rows_of_one_id(spark, monkeypatch):
    """Rows without an id, equal or not, spread over blocks, and each is taken by the same rule."""
    rows = [(None, "same three words", "hot") for _ in range(3000)]
    rows += [(None, f"other {i} words", "hot") for i in range(1000)] + [(7, "one more text of six words", "b")] * 400
    docs = spark.createDataFrame(rows, DOCS)
    sizes = mixing.sized(docs)
    turns = sizes.groupBy(F.pmod(F.xxhash64("doc_id", "size", "lot"), F.lit(100)).alias("block")).count().collect()
    assert sizes.count() == len(rows) and len(turns) == 100 and max(r["count"] for r in turns) < 90
    out = mixing.mix(docs.repartition(3)).collect()
    own, target = expected_targets(rows)
    for source in own:
        assert abs(sum(r.taken for r in out if r.source == source) - target[source]) <= 6
    assert Counter(map(tuple, mixing.mix(docs.repartition(5)).collect())) == Counter(map(tuple, out))
    mixed = mixing.take(docs)
    assert mixed.count() == sum(r.copies for r in out)
    monkeypatch.setattr(mixing, "STRETCH", 7)
    assert Counter(map(tuple, mixing.mix(docs).collect())) == Counter(map(tuple, out))


def test_take(spark):
    rows = mix_rows()
    docs = spark.createDataFrame([(*row, "x") for row in rows], DOCS + ", copies string")
    out = mixing.take(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[(r.doc_id, r.source, r["size"])] += r.copies
    got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in out.collect())
    assert got == +want


def test_mix_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, " ", None)], DOCS)
    assert [(r.taken, r.target) for r in mixing.mix(none).collect()] == [(0, 0.0)] * 2


def page_rows():
    random.seed(12)
    rows = [(i, f"http://x/{i}", random.choice([None, "", "<p>é</p>", "a\r\n\r\nb", f"own {i}"])) for i in range(120)]
    rows += [(500 + i, None, "hot page " * 50) for i in range(60)] + [(900, "u\r\nEvil: 1", "same"), (900, "v", "same")]
    return rows + [(None, "n", "same"), (None, "n", "no id"), (950, "big", "x" * 300_000)]


def expected_pages(rows):
    groups = defaultdict(list)
    for page_id, url, html in rows:
        groups[(html or "").encode()].append((page_id is None, page_id or 0))
    out = Counter()
    for payload, ids in groups.items():
        for turn, (missing, page_id) in enumerate(sorted(ids)):
            first = sorted(ids)[0]
            out[(None if missing else page_id, len(payload), warc.payload_digest(payload), "revisit" if turn else "response",
                 (None if first[0] else first[1]) if turn else None)] += 1
    return out


def test_round_trip(spark):
    rows = page_rows()
    pages = spark.createDataFrame([(*row, 7) for row in rows], PAGES + ", shard int").repartition(4)
    assert Counter(map(tuple, warc.round_trip(pages).collect())) == expected_pages(rows)


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc.files, "SMALLEST", 20_000)
    rows, folder = page_rows(), str(tmp_path / "one")
    pages = spark.createDataFrame(rows, PAGES)
    manifest = warc.write(pages.repartition(5), folder, file_bytes=3000).orderBy("file").collect()
    assert sum(row.records for row in manifest) == len(rows) and any(row.part for row in manifest)
    assert sorted(x for x in os.listdir(folder) if not x.startswith((".", "_"))) == [row.file for row in manifest]
    order = []
    for row in manifest:
        data = open(f"{folder}/{row.file}", "rb").read()
        assert len(data) == row.bytes
        records = gzip.decompress(data).split(b"WARC/1.1\r\n")[1:]
        assert len(records) == row.records + 1 and b"WARC-Type: warcinfo" in records[0]
        order += [int(m.group(1)) for m in (re.search(rb"X-Page-Id: (\d+)", record) for record in records) if m]
    assert order == sorted(order)
    payloads = {r.page_id: r.payload for r in warc.read(spark, folder).collect() if r.record_type == "response"}
    assert payloads[950] == b"x" * 300_000 and b"Evil" not in payloads[900]
    warc.write(pages.repartition(2), str(tmp_path / "two"), file_bytes=3000)
    for row in manifest:
        assert open(f"{folder}/{row.file}", "rb").read() == open(f"{tmp_path}/two/{row.file}", "rb").read()


def test_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "archive")
    row = warc.write(spark.createDataFrame([(1, "u", "payload " * 99)], PAGES), folder).first()
    data = gzip.decompress(open(f"{folder}/{row.file}", "rb").read()).replace(b"payload payload", b"payload Payload", 1)
    record = data[data.rindex(b"WARC/1.1") :]
    with pytest.raises(ValueError, match="digest"):
        warc._page_row(*warc.parse(record))


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
