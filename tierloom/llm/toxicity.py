"""Toxicity: two class-conditional Kneser-Ney models over the parts of words.

A word (lower case, no punctuation around it) is a stem, its first STEM
characters, and an ending. Each class, toxic and ordinary, has a model of
order two: stems by discounted counts that back off to how many endings a stem
is seen with, endings by discounted counts of the whole word that back off to
the word's share of its stem. Backoff counts are shared by the classes, so
what neither has seen often tells them apart no more than it should. Counts
are of documents, as one that repeats a word is one piece of evidence.

A document's evidence is the sum of its words' log-likelihood differences,
less MARGIN nats each: differences that small come from topic and language,
not from expressions. It is compared per word and per square root of words,
and a logistic curve over both, fitted on labelled documents that the counts
have not seen, makes it a score from 0 to 1.

The counts are of all labelled documents, and a table: every counted word and
stem takes part. What scoring needs of it are the words whose evidence is not
that of an unseen ending of their stem, and the stems whose evidence is not
that of an unseen stem. Keys and evidence of these are broadcast if they take
BROADCAST_BYTES at most; beyond that the documents' words are joined with
them, for the same sums. Only the logistic curve is fitted on a sample.

Defined cases: a null or empty text has no evidence, and the score that goes
with none; without labelled documents of both classes all scores are 0; a
null label is no label, and a null id has none; a document with several
labels counts as toxic if one of them says so; repeated rows are scored each
for itself; only doc_id and text, and of the labels doc_id and toxic, are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import bounded_sample, held_out
from tierloom.sources.storage import materialize

STEM = 5
DISCOUNT = 0.75
MARGIN = 2.0
#: Most bytes of words' and stems' evidence that every task gets, and of labels; 16 an entry.
BROADCAST_BYTES = 64 << 20
#: Documents that the logistic curve is fitted on, about, per class.
CURVE_DOCS = 10_000
THRESHOLD = 0.3
#: Words a task remembers the difference of.
REMEMBERED = 1 << 18
#: Documents that are cut into words at a time.
STEP = 256
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

Batches = Iterator[pa.RecordBatch]


def word_of(raw: str) -> str:
    return raw.strip(EDGES).lower()


def steps(batches: Batches) -> Batches:
    """The rows of ``batches``, a few at a time."""
    return (batch.slice(at, STEP) for batch in batches for at in range(0, batch.num_rows, STEP))


def count_words(rows: DataFrame) -> DataFrame:
    """(word, toxic, ordinary): documents of each class with the word; ``rows`` has text and label."""

    def scan(batches: Batches) -> Batches:
        sums = {0: Counter(), 1: Counter()}
        for batch in steps(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                sums[label].update({word_of(raw) for raw in set((text or "").split())} - {""})
            if len(sums[0]) + len(sums[1]) > REMEMBERED:
                yield _counted(sums)
                sums = {0: Counter(), 1: Counter()}
        yield _counted(sums)

    def _counted(sums: dict[int, Counter]) -> pa.RecordBatch:
        words = list(sums[0].keys() | sums[1].keys())
        columns = [pa.array(words, pa.string()), *(pa.array([sums[k][w] for w in words], pa.int64()) for k in (1, 0))]
        return pa.RecordBatch.from_arrays(columns, ["word", "toxic", "ordinary"])

    parts = rows.select("text", "label").mapInArrow(scan, "word string, toxic long, ordinary long")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def key_of(part: str) -> int:
    """The key that Spark's xxhash64 gives a string."""
    return xxhash.xxh64_intdigest(part.encode(), 42)


def keys_of(parts: list[str]) -> np.ndarray:
    return np.fromiter(map(key_of, parts), np.uint64, len(parts)).view(np.int64)


@dataclass
class Model:
    """Evidence of words and of stems, as tables (key, gap), and of a stem never seen; and the curve over it.

    ``arrays`` holds the tables' sorted keys and gaps if they are small enough to be broadcast.
    """

    words: DataFrame
    stems: DataFrame
    new_gap: float
    arrays: list[np.ndarray] | None
    curve: np.ndarray


def beyond_margin(gap: Column) -> Column:
    return F.signum(gap) * F.greatest(F.abs(gap) - MARGIN, F.lit(0.0))


def fit_counts(counted: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Model | None:
    """Both models of the counted words (word, toxic, ordinary), as the differences between them."""
    classes = ("toxic", "ordinary")

    def logs(likelihood) -> Column:
        return F.log(likelihood(classes[0])) - F.log(likelihood(classes[1]))

    stem = F.substring("word", 1, STEM).alias("stem")
    sums = [F.sum(c).alias(f"stem_{c}") for c in classes] + [F.count_if(F.col(c) > 0).alias(f"types_{c}") for c in classes]
    stems = materialize(counted.groupBy(stem).agg(*sums, F.count(F.lit(1)).alias("endings")))
    total = stems.agg(
        *[F.sum(f"stem_{c}").alias(c) for c in classes],
        *[F.count_if(F.col(f"stem_{c}") > 0).alias(f"stems_{c}") for c in classes],
        F.sum("endings").alias("endings"),
        F.count(F.lit(1)).alias("stems"),
    ).first()
    if not total.toxic or not total.ordinary:
        return None
    back = {c: DISCOUNT * total[f"stems_{c}"] / total[c] for c in classes}
    shared = (F.col("endings") + 1) / F.lit(float(total.endings + total.stems + 1))
    new_gap = float(np.log(back["toxic"]) - np.log(back["ordinary"]))
    new_gap = float(np.sign(new_gap) * max(abs(new_gap) - MARGIN, 0))

    def of_stem(c: str) -> Column:
        return F.greatest(F.col(f"stem_{c}") - DISCOUNT, F.lit(0.0)) / F.lit(float(total[c])) + F.lit(back[c]) * shared

    def unseen(c: str) -> Column:
        own = F.col(f"stem_{c}")
        return F.when(own > 0, DISCOUNT * F.col(f"types_{c}") / own).otherwise(F.lit(1.0))

    def of_word(c: str) -> Column:
        share = reduce(add, map(F.col, classes)) / reduce(add, [F.col(f"stem_{x}") for x in classes])
        return F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"stem_{c}"), F.lit(1)) + F.col(f"unseen_{c}") * share

    stems = stems.withColumns({f"unseen_{c}": unseen(c) for c in classes}).withColumn("stem_gap", logs(of_stem))
    stems = stems.withColumn("rest", beyond_margin(F.col("stem_gap") + logs(lambda c: F.col(f"unseen_{c}"))))
    gaps = counted.withColumn("stem", stem).join(stems, "stem")
    gaps = gaps.withColumn("gap", beyond_margin(F.col("stem_gap") + logs(of_word))).where("gap <> rest")
    words = materialize(gaps.select(F.xxhash64("word").alias("key"), "gap"))
    rests = materialize(stems.where(F.col("rest") != new_gap).select(F.xxhash64("stem").alias("key"), F.col("rest").alias("gap")))
    arrays = None
    if 16 * (words.count() + rests.count()) <= broadcast_bytes:
        arrays = []
        for table in (words, rests):
            held = table.toArrow()
            keys = held["key"].to_numpy()
            order = np.argsort(keys)
            arrays += [keys[order], held["gap"].to_numpy()[order]]
    return Model(words, rests, new_gap, arrays, np.zeros(3))


def _find(keys: np.ndarray, gaps: np.ndarray, wanted: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    if not len(keys):
        return otherwise
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, gaps[at], otherwise)


def evidence(docs: DataFrame, model: Model, extra: list[str]) -> DataFrame:
    """``extra`` columns, n_words and evidence of ``docs``, which has text and those columns."""
    if model.arrays is None:
        return joined_evidence(docs, model, extra)
    shared, new_gap = docs.sparkSession.sparkContext.broadcast(model.arrays), model.new_gap

    def scan(batches: Batches) -> Batches:
        known: dict[str, float] = {}
        for batch in steps(batches):
            texts = [(text or "").split() for text in batch.column("text").to_pylist()]
            new = list({raw for words in texts for raw in words if raw not in known})
            words, (keys, gaps, stems, rests) = list(map(word_of, new)), shared.value
            rest = _find(stems, rests, keys_of([word[:STEM] for word in words]), np.full(len(words), new_gap))
            known.update(zip(new, _find(keys, gaps, keys_of(words), rest).tolist(), strict=True))
            sums = [sum(map(known.__getitem__, words)) for words in texts]
            while len(known) > REMEMBERED:
                known.popitem()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in extra), pa.array(list(map(len, texts)), pa.int64()), pa.array(sums, pa.float64())],
                [*extra, "n_words", "evidence"],
            )

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in extra]
    return docs.select(*extra, "text").mapInArrow(scan, ", ".join([*kinds, "n_words long", "evidence double"]))


def joined_evidence(docs: DataFrame, model: Model, extra: list[str]) -> DataFrame:
    """The same by joins: a row per word of a document, with its times; a document without words has one of no times."""

    def scan(batches: Batches) -> Batches:
        for batch in steps(batches):
            texts = [(text or "").split() for text in batch.column("text").to_pylist()]
            counts = [Counter(map(word_of, words)) or Counter({"": 0}) for words in texts]
            of = pa.array(np.repeat(np.arange(len(texts)), list(map(len, counts))))
            words = [word for own in counts for word in own]
            times = [n for own in counts for n in own.values()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(of) for c in ("_row", *extra)),
                    pa.array(list(map(len, texts)), pa.int64()).take(of),
                    pa.array(keys_of(words)), pa.array(keys_of([word[:STEM] for word in words])), pa.array(times, pa.int64()),
                ],
                ["_row", *extra, "n_words", "_word", "_stem", "_times"],
            )

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in extra]
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), *extra, "text")
    out = ", ".join(["_row long", *kinds, "n_words long", "_word long", "_stem long", "_times long"])
    rows = materialize(numbered.mapInArrow(scan, out))
    words = model.words.select(F.col("key").alias("_word"), F.col("gap").alias("_gap"))
    stems = model.stems.select(F.col("key").alias("_stem"), F.col("gap").alias("_rest"))
    found = rows.join(words, "_word", "left").join(stems, "_stem", "left")
    gap = F.coalesce("_gap", "_rest", F.lit(model.new_gap))
    summed = found.groupBy("_row").agg(
        *[F.any_value(c).alias(c) for c in (*extra, "n_words")], F.sum(F.col("_times") * gap).alias("evidence")
    )
    return summed.drop("_row")


def features(n_words: np.ndarray, summed: np.ndarray) -> np.ndarray:
    n = np.maximum(n_words, 1)
    return np.stack([np.ones(len(n)), summed / n, summed / np.sqrt(n)], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (y - p)) - ridge * beta
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        beta += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Model | None:
    """Model of ``docs`` (doc_id, text) with ``labels`` (doc_id, label 0 or 1); none without documents of both classes.

    A third of the documents, by the hash of their id, fit the curve; all others are counted. Labels are broadcast under
    the same bound as evidence.
    """
    labels = materialize(labels)
    if 16 * labels.count() <= broadcast_bytes:  # else the documents' texts move to meet their labels
        labels = F.broadcast(labels)
    chosen = materialize(docs.select("doc_id", "text").join(labels, "doc_id"))
    for_curve = F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(3)) == 0
    model = fit_counts(materialize(count_words(chosen.where(~for_curve))), broadcast_bytes)
    sizes = dict(chosen.where(for_curve).groupBy("label").count().collect())
    if model is None or len(sizes) < 2:
        return None
    known = evidence(bounded_sample(chosen.where(for_curve), "label", CURVE_DOCS), model, ["label"]).toPandas()
    seen = known["label"].value_counts()
    weights = known["label"].map(lambda label: sizes[label] / seen[label]).to_numpy(float)
    x = features(known["n_words"].to_numpy(), known["evidence"].to_numpy())
    model.curve = fit_curve(x, known["label"].to_numpy(float), weights)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    n = F.greatest("n_words", F.lit(1))
    b = [F.lit(float(x)) for x in model.curve]
    height = b[0] + b[1] * F.col("evidence") / n + b[2] * F.col("evidence") / F.sqrt(n)
    return evidence(docs, model, ["doc_id"]).select("doc_id", (1 / (1 + F.exp(-height))).alias("score"))


def assess(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted; held-out documents teach nothing."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id")
    model = fit(docs, known.agg(F.max("toxic").cast("int").alias("label")), broadcast_bytes)
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
