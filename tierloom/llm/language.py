"""Language ID: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, runs of anything else become one space, and every 1,
2 and 3 neighbouring characters are hashed into BUCKETS buckets. Each training
task adds up counts per language, sums of these are the log-probability matrix
(BUCKETS x languages), which is broadcast; scoring gathers a text's rows from
it and sums them, a bounded number of characters at a time, so a text may have
any length. Beyond LANGUAGES languages there is a matrix for each so many of
them, by name; each scores in a pass of its own, and the best of all wins.

The classifier is fitted on at most about TRAINING documents per language
(chosen by a hash of their id); every document is scored whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0,
as is every text if there is nothing to learn from; a null language is never
learned; equal scores go to the language that comes first by name; repeated
rows are scored each for itself; of the table only doc_id, text and lang are
read, lang for training alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import held_out
from tierloom.sources.storage import materialize

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Documents per language that the classifier is fitted on, about.
TRAINING = 5000
#: Languages of one matrix; it has 4 bytes for each and bucket, so 64 MB at most.
LANGUAGES = 256
#: Added to each count.
SMOOTHING = 0.5
#: Tasks that count; each sends one row per language.
TASKS = 16
#: Positions that are scored together.
STEP = 1 << 19
#: Numbers that are gathered from the matrix together, and documents that are scored together.
GATHERED, TOGETHER = 1 << 24, 256
UNKNOWN = "und"

Batches = Iterator[pa.RecordBatch]


def letters(text: str | None, table: dict) -> str:
    """Lower-case letters with one space for what is between them, and a space at each end; empty without letters."""
    words = text.lower().translate(table).split() if text else []
    return f" {' '.join(words)} " if words else ""


class LetterTable(dict):
    """Translation of code points: letters stay, all else is a space; filled as characters are met."""

    def __missing__(self, point: int) -> int:
        self[point] = point if chr(point).isalpha() else 32
        return self[point]


def buckets(points: np.ndarray, order: int) -> np.ndarray:
    """Buckets of the n-grams that begin at each position."""
    n = len(points) - order + 1
    mixed = np.full(max(n, 0), order, np.uint64)
    for k in range(order):
        mixed = (mixed ^ points[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(13)) % np.uint64(BUCKETS)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def count(rows: DataFrame) -> DataFrame:
    """(lang, counts) of ``rows`` (lang, text), one row per language and task; counts are BUCKETS longs."""

    def scan(batches: Batches) -> Batches:
        table, sums = LetterTable(), {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                points = _points(letters(text, table))
                for at in range(0, len(points), STEP):
                    for order in ORDERS:
                        own += np.bincount(buckets(points[at : at + STEP + order - 1], order).astype(np.int64), minlength=BUCKETS)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(sums), pa.string()), "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())}
        )

    return rows.select("lang", "text").repartition(TASKS).mapInArrow(scan, "lang string, counts binary")


def _sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in table["counts"])
    return pa.table({"lang": table["lang"][:1], "counts": pa.array([total.tobytes()], pa.binary())})


def sample(rows: DataFrame, training: int) -> DataFrame:
    """About ``training`` rows at most of each language, chosen by a hash of doc_id; all rows of smaller languages."""
    known = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = materialize(known.groupBy("lang").agg(F.count("*").alias("own_rows")))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 11) / F.lit(float(1 << 53))
    return known.join(sizes, "lang").where(chance * F.col("own_rows") < training)


def fit(rows: DataFrame, training: int = TRAINING) -> Iterator[tuple[list[str], np.ndarray]]:
    """Languages, by name and LANGUAGES at a time, and their log-probabilities, learned from ``rows`` (doc_id, text, lang)."""
    summed = materialize(count(sample(rows, training)).groupBy("lang").applyInArrow(_sum, "lang string, counts binary"))
    names = sorted(row.lang for row in summed.select("lang").collect())
    for at in range(0, len(names), LANGUAGES):
        group = names[at : at + LANGUAGES]
        found = dict(summed.where(F.col("lang").between(group[0], group[-1])).toLocalIterator())
        counts = np.stack([np.frombuffer(found.pop(lang), np.int64) for lang in group], axis=1) + SMOOTHING
        yield group, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def score_texts(texts: list[str | None], matrix: np.ndarray, table: dict) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of each text under each language, and whether the text has letters."""
    clean = [letters(text, table) for text in texts]
    sizes = np.fromiter(map(len, clean), np.int64, len(clean))
    points, doc = _points("".join(clean)), np.repeat(np.arange(len(clean)), sizes)
    total = np.zeros((len(clean), matrix.shape[1]))
    step = min(STEP, max(1, GATHERED // max(1, matrix.shape[1])))
    for at in range(0, len(points), step):
        for order in ORDERS:
            found = buckets(points[at : at + step + order - 1], order)
            own = doc[at : at + len(found)]
            # A text's last n-grams would run into the next text.
            inside = doc[at + order - 1 : at + order - 1 + len(found)] == own
            found, own = found[inside], own[inside]
            if len(found):
                starts = np.flatnonzero(np.diff(own, prepend=-1))
                total[own[starts]] += np.add.reduceat(matrix[found], starts, axis=0, dtype=np.float64)
    return total, sizes > 0


SCORED = "doc_id long, text string, lang_pred string, top double, odds double"


def score(docs: DataFrame, languages: list[str], matrix: np.ndarray) -> DataFrame:
    """SCORED of rows that have these columns already, with what these languages add to them.

    ``top`` is the log-likelihood of the best language so far, ``odds`` the sum of all likelihoods divided by the best.
    """
    shared = docs.sparkSession.sparkContext.broadcast((languages, matrix))

    def part(rows: pa.RecordBatch, table: dict) -> pa.RecordBatch:
        names, logs = shared.value
        total, known = score_texts(rows.column("text").to_pylist(), logs, table)
        before = rows.column("top").to_numpy(zero_copy_only=False)
        best, own = total.argmax(axis=1), total.max(axis=1)
        top = np.maximum(before, own)
        odds = rows.column("odds").to_numpy(zero_copy_only=False) * np.exp(before - top) + np.exp(total - top[:, None]).sum(axis=1)
        better = known & (own > before)
        told = pc.if_else(pa.array(better), pa.array(np.array(names, object)[best], pa.string()), rows.column("lang_pred"))
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("text"), told, pa.array(top), pa.array(odds)], rows.schema.names
        )

    def scan(batches: Batches) -> Batches:
        table = LetterTable()
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                yield part(batch.slice(at, TOGETHER), table)

    return docs.mapInArrow(scan, SCORED)


def predict(docs: DataFrame, models: Iterable[tuple[list[str], np.ndarray]]) -> DataFrame:
    """(doc_id, lang_pred, score) of ``docs`` (doc_id, text); the score is the language's posterior, priors equal."""
    none = [F.lit(None).cast("string").alias("lang_pred"), F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("odds")]
    scored = docs.select(F.col("doc_id").cast("long"), "text", *none)
    for languages, matrix in models:
        scored = score(scored, languages, matrix)
    share = F.when(F.col("lang_pred").isNull(), 0.0).otherwise(1 / F.col("odds"))
    return scored.select("doc_id", F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"), share.alias("score"))


def identify(docs: DataFrame, training: int = TRAINING, hold_out: Column | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; held-out documents teach nothing."""
    apart = held_out(F.col("doc_id")) if hold_out is None else hold_out
    models = fit(docs.select("doc_id", "text", "lang").where(~apart), training)
    return predict(docs, models).select("doc_id", apart.alias("held_out"), "lang_pred", "score")
