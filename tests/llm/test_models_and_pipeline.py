from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tierloom.llm import common, language, queries, toxicity
from tierloom.sources.storage import materialize
from tools.compare import rows_of

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
with_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
TABLES = "documents pages labels".split()
SYLLABLES = {"aa": "the and ing tion er re", "bb": "sch ung keit der ein ich", "cc": "ção que os ar do mente"}


def prose(lang, n, extra=()):
    parts = SYLLABLES[lang].split()
    words = ["".join(random.choices(parts, k=random.randrange(1, 4))) for _ in range(n)]
    for word in extra:
        words.insert(random.randrange(len(words) + 1), word)
    return " ".join(words)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def spoken():
    random.seed(13)
    rows = [(i, prose(lang := random.choice("aa bb cc".split()), random.randrange(3, 80)), lang, "s", 1) for i in range(400)]
    odd = [(1000, None, "aa", "s", 1), (1001, "", "bb", None, 1), (1002, " 12 !?", "cc", "s", 1), (None, "the and", None, "s", 1)]
    return rows + odd + [rows[0]] * 2 + [(1003, "sch ung keit der " * 60_000, None, "s", 1)]


def test_language(spark, spoken):
    docs = spark.createDataFrame(spoken, DOCS).withColumn("score", F.lit("clash")).repartition(4)
    rows = language.identify(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(row[0] for row in spoken)
    found = {r.doc_id: r for r in rows}
    assert all(r.held_out is held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1000, 1001, 1002))
    right = [found[i].lang_pred == lang for i, _, lang, *_ in spoken[:400] if held(i)]
    assert len(right) > 50 and sum(right) / len(right) > 0.97
    assert found[1003].lang_pred == "bb"


def test_held_out_documents_teach_nothing(spark, spoken):
    plain = spark.createDataFrame(spoken, DOCS)
    wrong = plain.withColumn("lang", F.when(common.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert Counter(map(tuple, language.identify(plain).collect())) == Counter(map(tuple, language.identify(wrong).collect()))


def test_scores_are_plain_sums(monkeypatch):
    monkeypatch.setattr(language, "STEP", 50)
    matrix = np.random.default_rng(2).random((language.BUCKETS, 3)).astype(np.float32)
    texts, table = ["Ab c", "", None, "éé " * 70, "x" * 200, "!!"], language.LetterTable()
    total, known = language.score_texts(texts, matrix, table)
    assert known.tolist() == [True, False, False, True, True, False]
    for text, row in zip(texts, total, strict=True):
        clean = language.letters(text, table)
        want = np.zeros(3)
        for order in language.ORDERS:
            for at in range(len(clean) - order + 1):
                want += matrix[language.buckets(language._points(clean[at : at + order]), order)[0]]
        assert np.allclose(row, want, rtol=1e-5)


def test_more_languages_than_one_matrix_holds(spark, monkeypatch):
    random.seed(5)
    letters = "abcdefghijklmnop"
    tongues = {f"l{i:03d}": ["".join(random.choices(letters, k=5)) for _ in range(12)] for i in range(300)}
    rows = [(i * 10 + k, " ".join(random.choices(own, k=60)), name, "s", 1) for i, (name, own) in enumerate(tongues.items()) for k in range(4)]
    docs = spark.createDataFrame([*rows, (9000, None, "l001", "s", 1), (9001, "12", None, "s", 1)], DOCS).repartition(4)
    many = {r.doc_id: r for r in language.identify(docs).collect()}
    truth = {row[0]: row[2] for row in rows}
    assert sum(many[i].lang_pred == name for i, name in truth.items()) / len(truth) > 0.9
    assert (many[9000].lang_pred, many[9001].score) == ("und", 0.0)
    monkeypatch.setattr(language, "LANGUAGES", 1000)
    one = {r.doc_id: r for r in language.identify(docs).collect()}
    assert all(many[i].lang_pred == one[i].lang_pred and abs(many[i].score - one[i].score) < 1e-9 for i in one)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None, "s", 1)], DOCS)
    assert [(r.lang_pred, r.score) for r in language.identify(docs).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0)).count() == 0
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.assess(docs, labels).collect()] == [(0.0, 0)]


def test_sample_is_bounded(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 40, "b").otherwise("a").alias("kind"))
    sizes = dict(common.bounded_sample(rows, "kind", 500).groupBy("kind").count().collect())
    assert sizes["b"] == 40 and 400 < sizes["a"] < 600
    with pytest.raises(ValueError, match="more than 1"):
        common.bounded_sample(rows, "kind", 5, groups=1)


@pytest.fixture(scope="module")
def marked():
    random.seed(14)
    rude, docs, labels = ["zonkhead", "zonkface", "grimpling", "grimpler"], [], []
    for i in range(900):
        bad = random.random() < 0.2
        extra = random.choices(rude, k=random.randrange(1, 4)) if bad else ()
        docs.append((i, prose(random.choice("aa bb cc".split()), random.randrange(20, 120), extra), "x", "s", 1))
        labels.append((i, int(bad)))
    return [*docs, (2000, None, "x", "s", 1), (2001, "", "x", "s", 1), docs[5]], [*labels, labels[5], (None, 1), (7, None)]


def test_toxicity(spark, marked):
    docs, labels = marked
    frames = spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.assess(*frames).collect()
    assert Counter(r.doc_id for r in rows) == Counter(row[0] for row in docs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out is held(r.doc_id) for r in rows)
    found, truth = {r.doc_id: r.predicted for r in rows}, dict(labels[:900])
    apart = [i for i in truth if held(i)]
    assert sum(found[i] == truth[i] for i in apart) / len(apart) > 0.95
    assert found[2000] == found[2001] == 0
    flipped = frames[1].withColumn("toxic", F.when(common.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.assess(frames[0], flipped).collect()
    assert {r.doc_id: round(r.score, 9) for r in again} == {r.doc_id: round(r.score, 9) for r in rows}


def plain_gaps(counts):
    """Evidence of any word under the counts {word: (toxic, ordinary)}, in plain Python."""
    d, stems = toxicity.DISCOUNT, {}
    for word in counts:
        stems.setdefault(word[: toxicity.STEM], []).append(word)
    totals = [sum(own[k] for own in counts.values()) for k in (0, 1)]
    of_stem = {stem: [sum(counts[w][k] for w in words) for k in (0, 1)] for stem, words in stems.items()}
    back = [d * sum(own[k] > 0 for own in of_stem.values()) / totals[k] for k in (0, 1)]
    shared = {stem: (len(words) + 1) / (len(counts) + len(stems) + 1) for stem, words in stems.items()}
    first = {s: [max(own[k] - d, 0) / totals[k] + back[k] * shared[s] for k in (0, 1)] for s, own in of_stem.items()}
    for k in (0, 1):  # stems, seen and unseen, share all of the probability
        assert sum(own[k] for own in first.values()) + back[k] * (1 - sum(shared.values())) == pytest.approx(1)

    def gap(word):
        stem = word[: toxicity.STEM]
        if stem not in stems:
            p = back
        else:
            p = []
            for k in (0, 1):
                total = of_stem[stem][k]
                rest = d * sum(counts[w][k] > 0 for w in stems[stem]) / total if total else 1.0
                own, share = counts.get(word, (0, 0))[k], sum(counts.get(word, (0, 0))) / sum(of_stem[stem])
                p.append(first[stem][k] * (max(own - d, 0) / max(total, 1) + rest * share if word in counts else rest))
        whole = float(np.log(p[0]) - np.log(p[1]))
        return np.sign(whole) * max(abs(whole) - toxicity.MARGIN, 0)

    return gap


@pytest.mark.parametrize("margin", [2.0, 0.0])
def test_evidence_against_plain_python(spark, marked, monkeypatch, margin):
    """All words count, by broadcast as by joins; the curve is the operator's own."""
    monkeypatch.setattr(toxicity, "MARGIN", margin)
    docs, labels = marked
    known = {i: toxic for i, toxic in labels if i is not None and toxic is not None}
    counts = {}
    for i, text, *_ in docs:
        if i in known:
            for word in {toxicity.word_of(raw) for raw in (text or "").split()} - {""}:
                own = counts.setdefault(word, [0, 0])
                own[1 - known[i]] += 1
    gap = plain_gaps(counts)
    odd = [(3000, " !? ... zonkhead, ZONKHEAD!! zonkXYZ é日本語のテキスト", "x", "s", 1), (None, "the grimpling", None, None, 1)]
    frame = spark.createDataFrame([*docs, *odd, (3001, "sch zonkface " * 40_000, "x", "s", 1)], DOCS).repartition(3)
    told = spark.createDataFrame(list(known.items()), "doc_id long, label int")
    counted = materialize(toxicity.count_words(spark.createDataFrame(docs, DOCS).join(told, "doc_id")))
    want = Counter()
    for row in frame.collect():
        words = [toxicity.word_of(raw) for raw in (row.text or "").split()]
        want[(row.doc_id, len(words), round(sum(map(gap, words)), 4))] += 1
    for most in (1 << 20, 0):
        model = toxicity.fit_counts(counted, most)
        assert (model.arrays is None) == (most == 0)
        rows = toxicity.evidence(frame.select(F.col("doc_id"), "text"), model, ["doc_id"]).collect()
        assert Counter((r.doc_id, r.n_words, round(r.evidence, 4) + 0.0) for r in rows) == want


def test_joined_scores_are_the_same(spark, marked):
    frames = spark.createDataFrame(marked[0], DOCS).repartition(4), spark.createDataFrame(marked[1], "doc_id long, toxic int")
    few, many = (toxicity.assess(*frames, broadcast_bytes=most).collect() for most in (toxicity.BROADCAST_BYTES, 0))
    assert Counter((r.doc_id, r.predicted, round(r.score, 9)) for r in few) == Counter((r.doc_id, r.predicted, round(r.score, 9)) for r in many)


@with_data
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, cursor = queries.QUERIES[name](spark, FOLDER), duck.execute(queries.ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_registered():
    names = [name for name in __spark_entry__.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 11))
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@with_data
def test_pipeline(spark):
    """Each stage against plain Python over what the stage before it left."""
    import tiktoken

    import public_tokenizers
    from tests.llm.test_exact_and_quality import figures, norm
    from tests.llm.test_lines_and_simhash import groups_of, slow_fingerprint
    from tests.llm.test_mixing_and_warc import expected_targets

    docs = common.table(spark, FOLDER, "documents")
    columns, left = docs.columns, [docs.collect()]
    for position, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, FOLDER))
        assert docs.columns == columns or position == 4
        left.append(docs.collect())
    start, clean, unique, apart, mixed, coded = left
    assert {r.doc_id for r in clean} <= {r.doc_id for r in start if not figures(r.text)[-1]}
    assert all(r.n_chars == len(r.text) or (r.doc_id, r.text) in {(x.doc_id, x.text) for x in start} for r in clean)
    first = {}
    for r in sorted(clean, key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert sorted(r.doc_id for r in unique) == sorted(first.values())
    group = groups_of([slow_fingerprint(r.text) for r in unique], [r.doc_id for r in unique])
    assert sorted(r.doc_id for r in apart) == sorted(set(group))
    _, target = expected_targets([(r.doc_id, r.text, r.source) for r in apart])
    times = Counter(r.doc_id for r in mixed)
    for source, words in target.items():
        own = [(len(r.text.split()), times[r.doc_id]) for r in apart if r.source == source]
        assert abs(sum(n * k for n, k in own) - words) <= max(n for n, _ in own) and max(k for _, k in own) <= 2
    ranks = common.load_ranks(common.vocabulary_path("byte_bpe_multi_50k.tiktoken"))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in apart}
    assert Counter(r.doc_id for r in coded) == times
    for r in coded:
        assert r.decoded == texts[r.doc_id] and r.ids == plain.encode_ordinary(r.decoded) and r.n_tokens == len(r.ids)
    digest = hashlib.sha256(str(sorted(times.items())).encode()).hexdigest()
    again = Counter(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect())
    assert hashlib.sha256(str(sorted(again.items())).encode()).hexdigest() == digest
