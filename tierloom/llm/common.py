"""Small helpers that the operators share."""

from __future__ import annotations

import base64
import os
import sys
import types
from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One white-space character of a text (ASCII only, as the contracts say).
SPACE = r"[\x20\x09-\x0D]"
#: The vocabulary files' package, or a folder that holds files of the same names.
TOKENIZERS = os.environ.get("TIERLOOM_TOKENIZERS", "")


def vocabulary_path(name: str, folder: str = TOKENIZERS) -> str:
    """Place of a vocabulary file: in ``folder``, or in the installed package."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def words(text: Column) -> Column:
    """Words between white space; none for an empty text."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda word: word != "")


def fresh(columns: list[str], name: str) -> str:
    """``name``, with as many underscores in front as it takes to clash with no column."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, on which no model learns; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def per_worker(key: Hashable, make: Callable[[], object]):
    """``make()``, once per Python worker: the tasks that a worker runs one after the other share it."""
    held = vars(sys.modules.setdefault("_tierloom_worker", types.ModuleType("_tierloom_worker")))
    if key not in held:
        held[key] = make()
    return held[key]


def gather(flat, starts, sizes):
    """Spans of ``flat``, one after the other."""
    import numpy as np

    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def bounded_sample(rows: DataFrame, group: str, most: int, groups: int = 256) -> DataFrame:
    """About ``most`` rows at most of each value of ``group``, chosen by a hash of doc_id; all rows of smaller groups.

    ``group`` has ``groups`` values at most; their counts come to the driver, so that the rows need not move.
    """
    sizes = {row[0]: row[1] for row in rows.groupBy(group).count().limit(groups + 1).collect()}
    if len(sizes) > groups:
        raise ValueError(f"{group} has more than {groups} values")
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 11) / F.lit(float(1 << 53))
    share = F.lit(0.0)
    for value, size in sizes.items():
        share = F.when(F.col(group) == F.lit(value), most / size).otherwise(share)
    return rows.where(chance < share)
