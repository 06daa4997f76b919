"""Taking landed documents into the raw tables, in batches or as a stream."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierloom.naming import Naming
from tierloom.schemas import ENTITY_DOCUMENT, MOVE_DOCUMENT, SPECIES_DOCUMENT, SYNCED_AT, TYPE_DOCUMENT
from tierloom.sources import documents
from tierloom.sources.keyed_table import Delivered
from tierloom.sources.raw_store import RawStore

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Source:
    """A landing folder, its document schema and the tables its documents feed."""

    folder: str
    schema: str
    tables: dict[str, Callable[[DataFrame], DataFrame]]
    by_cursor: bool = True


def sources(naming: Naming = Naming()) -> list[Source]:
    """All sources in the order they are taken in. Relations are few and always read in full."""
    n = naming
    entity = {
        n.raw(): documents.flatten_entity,
        n.raw("stats"): partial(documents.flatten_stats, naming=n),
        n.raw("types"): partial(documents.flatten_types, naming=n),
        n.raw("abilities"): partial(documents.flatten_abilities, naming=n),
        n.raw("moves"): partial(documents.flatten_entity_moves, naming=n),
    }
    return [
        Source(n.entity, ENTITY_DOCUMENT, entity),
        Source("move", MOVE_DOCUMENT, {"moves": documents.flatten_moves}),
        Source("species", SPECIES_DOCUMENT, {"species": documents.flatten_species}),
        Source("type", TYPE_DOCUMENT, {"types": documents.flatten_relations}, by_cursor=False),
    ]


@contextmanager
def _parsed(docs: DataFrame, source: Source) -> Iterator[DataFrame]:
    """Documents of several tables are parsed once and kept; lost pieces are parsed again from the files."""
    if len(source.tables) == 1:
        yield docs
        return
    docs = docs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield docs
    finally:
        docs.unpersist()


def take_in(store: RawStore, source: Source, docs: DataFrame, token: str | None = None) -> dict[str, Delivered]:
    """Flatten documents and upsert every table they feed; returns what was delivered to each.

    Tables are done one by one. After a failure the same documents are given
    again: with a token, tables already done skip them; without one, they
    find their rows unchanged.
    """

    def upsert(name: str) -> Delivered:
        rows = source.tables[name](docs).withColumn(SYNCED_AT, F.current_timestamp())
        greatest = "id" if "id" in rows.columns else None
        count = store.table(name).upsert(rows, [F.col(documents.SEQUENCE).desc()], token, greatest)
        log.info("upserted %d rows into %s, %d of them new or changed", count.rows, name, count.written)
        return count

    # The tables do not depend on each other, so their jobs run side by side.
    with ThreadPoolExecutor(len(source.tables)) as pool:
        return dict(zip(source.tables, pool.map(upsert, source.tables)))


def sync(store: RawStore, landing: str, keep_rejects: bool = False) -> dict[str, Delivered]:
    """One pass over the landing folders, past each source's cursor; returns what was delivered to each table.

    A line that is no document ends the pass, or with ``keep_rejects`` goes to
    the store's rejects with its file, and the others are taken in.

    Counts and the new cursor are observed as the rows are written. A cursor
    moves after its tables are done, so a pass that dies is repeated, never
    skipped.
    """
    counts: dict[str, dict[str, Delivered]] = {}
    for source in sources(store.naming):
        folder = f"{landing}/{source.folder}"
        if keep_rejects:
            docs, bad = documents.split_documents(store.spark, folder, source.schema)
            rejected = store.reject(source.folder, bad)
            if rejected.written:
                log.warning("%d lines of %s are no documents", rejected.written, folder)
        else:
            docs = documents.read_documents(store.spark, folder, source.schema)
        last = store.cursor(source.folder, None) if source.by_cursor else None
        if last is not None:
            docs = docs.where(F.col("id") > last)
        with _parsed(docs, source) as parsed:
            own = take_in(store, source, parsed)
        newest = max((count.greatest for count in own.values() if count.greatest is not None), default=None)
        if source.by_cursor and newest is not None:
            store.advance(source.folder, newest)
        counts[source.folder] = own
    store.record(counts)
    return {name: count for own in counts.values() for name, count in own.items()}


def start_stream(
    store: RawStore, landing: str, source: Source, max_files: int | None = None
) -> StreamingQuery:
    """Take in files as they land, up to those there now.

    The checkpoint lives in the store: it remembers the files taken in, so
    ids do not matter and changed documents with old ids come through. A batch
    that is replayed after a failure carries its number as token and is applied
    once per table; its counts are kept when all its tables are done.
    """

    def apply(docs: DataFrame, batch: int) -> None:
        with _parsed(documents.sequenced(docs), source) as parsed:
            counts = take_in(store, source, parsed, f"{source.folder}/{batch}")
            store.record({f"{source.folder} stream": counts}, batch + 1)

    folder = f"{landing}/{source.folder}"
    stream = documents.stream_documents(store.spark, folder, source.schema, max_files)
    writer = stream.writeStream.foreachBatch(apply).trigger(availableNow=True)
    return writer.option("checkpointLocation", f"{store.path}/checkpoints/{source.folder}").start()


def sync_stream(store: RawStore, landing: str, max_files: int | None = None) -> None:
    """The streaming form of a pass: every source in order, each to the end of what has landed."""
    for source in sources(store.naming):
        start_stream(store, landing, source, max_files).awaitTermination()
