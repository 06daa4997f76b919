"""From landed documents to checked marts in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierloom.constants import DOCUMENTED_RELATIONS
from tierloom.operators.quality import run_checks
from tierloom.plans.checks import all_checks
from tierloom.plans.marts import build_marts
from tierloom.plans.staging import register_staging
from tierloom.sources.raw_store import RawStore
from tierloom.sources.tables import TableFolder
from tierloom.streaming.sync import sync, sync_stream


def run(
    store: RawStore,
    landing: str,
    folder: TableFolder,
    streaming: bool = True,
    mapping=DOCUMENTED_RELATIONS,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Take in what has landed, rebuild the marts and check every layer.

    Returns the stored marts by name and the check results.
    """
    (sync_stream if streaming else sync)(store, landing)
    naming = store.naming
    raw = store.read()
    staged = register_staging(raw, naming)
    marts = build_marts(staged, naming, folder, mapping)
    return marts, run_checks({**raw, **staged, **marts}, all_checks(naming))
