from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

from tierloom.llm import exact_dedup, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


@pytest.fixture
def copies(spark):
    random.seed(1)
    texts = [None, "", " ", "a b", "a  b", "a\nb", "A b", "é x", "x" * 5000]
    rows = [(i, random.choice(texts), "en", "s", None) for i in range(400)]
    rows += [(i, "hot text", "en", "s", 3) for i in range(1000, 1300)]
    rows += [(5000, "same row", "en", "s", 1)] * 3 + [(None, "same row", "en", "s", 1), (None, "only null", "en", "s", 1)]
    return rows


def expect_copies(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(norm(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        ordered = known + [None] * (len(ids) - len(known))
        out += [(i, keep, len(ids), n == 0, sha) for n, i in enumerate(ordered)]
    return Counter(out)


@pytest.mark.parametrize("counters", [2, 1024])
def test_find_copies(spark, copies, counters):
    docs = spark.createDataFrame(copies, DOCS).repartition(5)
    assert Counter(map(tuple, exact_dedup.find_copies(docs, counters).collect())) == expect_copies(copies)


def test_heavy_digests_are_the_frequent_ones(spark, copies):
    docs = spark.createDataFrame(copies, DOCS).repartition(7)
    rows = docs.select("doc_id", exact_dedup.digest(docs.text).alias("digest")).withColumn("row", docs.doc_id)
    heavy = {row.digest: row.group_size for row in exact_dedup.heavy_digests(rows, 4).collect()}
    counts = Counter(hashlib.sha256(norm(text).encode()).hexdigest() for _, text, *_ in copies)
    assert heavy == {sha: n for sha, n in counts.items() if n >= len(copies) // 4}


def test_summary_keeps_its_bound():
    random.seed(2)
    stream = ["hot"] * 400 + [str(random.randrange(300)) for _ in range(600)]
    random.shuffle(stream)
    summary = {}
    for item in stream:
        summary[item] = summary.get(item, 0) + 1
        summary = exact_dedup.summarise(summary, 4)
    assert len(summary) <= 4
    assert 400 - 1000 / 5 <= summary["hot"] <= 400


def test_drop_copies_keeps_one_row_and_all_columns(spark, copies):
    docs = spark.createDataFrame(copies, DOCS).withColumnsRenamed({"lang": "key", "n_chars": "digest"})
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({norm(text) for _, text, *_ in copies})
    keepers = {(row.doc_id, norm(row.text)) for row in rows}
    assert keepers == {(k, t) for t, k in firsts(copies).items()}


def firsts(rows):
    best = {}
    for doc_id, text, *_ in rows:
        now = best.get(norm(text))
        if norm(text) not in best or (doc_id is not None and (now is None or doc_id < now)):
            best[norm(text)] = doc_id
    return best


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact_dedup.find_copies(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    assert quality_rules.measure(none).count() == 0
    assert quality_rules.clean(none).count() == 0


def figures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), failed,
    )


PROSE = "The cat sat on the mat, and it looked at us. Then it left by the door it had come in."
OTHER = "Nobody else in this house had ever heard such a strange noise before."


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        (PROSE, False),
        ("a short title", False),
        ("Wow### this*** is$$$ junk&&&", True),
        ("BUY!! NOW!! CHEAP!! GOODS!!", True),
        ("word " * 30, True),
        ("Home | Products | About | Contact", True),
        ("home login menu", True),
        ("We use cookies to improve your visit.", True),
        ("Copyright 2020 by nobody, all rights reserved.", True),
    ],
)
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    count = quality_rules.F.size(quality_rules.words(quality_rules.F.col("line")))
    assert df.select(quality_rules.line_fails(df.line, count, quality_rules.F.lit(True))).first()[0] is fails


def test_figures_and_cleaning(spark):
    random.seed(3)
    vocabulary = ["a", "bé", "c#", "d|", "日本", "x y"]
    gaps = [" ", "  ", "\n", "\t", "\r\n"]
    texts = [None, "", "  \n ", PROSE, f"{PROSE}\nHome | About | Login\n{OTHER}", "word " * 5000]
    texts += ["".join(random.choice(vocabulary) + random.choice(gaps) for _ in range(random.randrange(60))) for _ in range(80)]
    texts += [f"{PROSE}\n" + "SALE!! SALE!! NOW!! HERE!!\n" * 2, f"{PROSE}\n{'BUY!! IT!! NOW!! OK!! ' * 9}"]
    rows = [(i, text, "en", "s", 1) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "verdict")
    measured = {row.doc_id: row for row in quality_rules.measure(docs).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, text in enumerate(texts):
        assert tuple(measured[i][name] for name in names) == figures(text), text
        assert not (measured[i].kept and measured[i].base_failed)
    cleaned = {row.doc_id: row for row in quality_rules.clean(docs).collect()}
    assert set(cleaned) == {i for i, row in measured.items() if row.kept}
    assert cleaned[3].text == PROSE
    assert cleaned[4].text == f"{PROSE}\n{OTHER}" and cleaned[4].n_chars == len(cleaned[4].text)
    assert not measured[len(texts) - 1].kept


def test_a_phrase_does_not_cost_a_long_line(spark):
    long_ = f"{PROSE} {OTHER} She ate a cookie, read more of her book, and went to bed before anybody else came home to ask."
    footer = "Copyright 2020 by nobody, all rights reserved."
    rows = [(1, long_, "en", "s", 1), (2, f"{long_}\n{footer}", "en", "s", 1), (3, f"{footer}\n{footer} Powered by us.", "en", "s", 1)]
    kept = {row.doc_id: row.text for row in quality_rules.clean(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == {1: long_, 2: long_}
