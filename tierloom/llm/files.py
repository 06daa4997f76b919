"""Files that tasks write themselves, and cutting a sorted table into shards."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that shard borders are cut from; so many rows at most come to the driver and are broadcast.
CELLS = 1 << 16
#: Shards aimed at, and the bounds of a shard's size in bytes.
SHARDS, SMALLEST, LARGEST = 64, 4 << 20, 1 << 30


def open_place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a place in a shared store (file, hdfs, s3, gs, ...)."""
    return pafs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


@contextmanager
def committed(folder: str, name: str):
    """A new file that gets its name only when it is complete.

    Attempts write under names of their own. A task that is run again writes
    the same bytes, so whichever attempt is last leaves the same file.
    """
    store, root = open_place(folder)
    store.create_dir(root, recursive=True)
    own = f"{root}/_{name}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(own, compression=None) as out:
        yield out
    store.move(own, f"{root}/{name}")


def clear_temporary(folder: str) -> None:
    """Remove what lost attempts left under temporary names; to be called once all tasks are done."""
    store, root = open_place(folder)
    for entry in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        if entry.base_name.endswith(".tmp"):
            store.delete_file(entry.path)


def with_shard(rows: DataFrame, key: str, size: Column, name: str) -> tuple[DataFrame, int]:
    """``rows`` with a shard number that rises with ``key`` (a long), and the number of shards.

    Borders depend on the rows alone, not on partitions or samples: the keys'
    range is cut into at most CELLS cells, whose bytes are added up, and
    neighbouring cells fill a shard up to its size. A null key is first.
    """
    low, high, total = rows.agg(F.min(key), F.max(key), F.sum(size)).first()
    if total is None:
        return rows.withColumn(name, F.lit(0)), 1
    low, high = low or 0, high or 0
    width = (high - low) // CELLS + 1
    at = F.coalesce(F.floor((F.col(key) - F.lit(low)) / F.lit(width)).cast("int"), F.lit(-1))
    target = min(max(total // SHARDS, SMALLEST), LARGEST)
    shard, filled, borders = 0, 0, []
    for cell, n_bytes in sorted(tuple(x) for x in rows.groupBy(at.alias("cell")).agg(F.sum(size)).toLocalIterator()):
        if filled and filled + n_bytes > target:
            shard, filled = shard + 1, 0
        filled += n_bytes
        borders.append((cell, shard))
    cell = f"{name}_cell"
    known = rows.sparkSession.createDataFrame(borders, f"{cell} int, {name} int")
    return rows.withColumn(cell, at).join(F.broadcast(known), cell).drop(cell), shard + 1
