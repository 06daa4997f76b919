"""Take in landed documents, rebuild the marts and check every layer.

    python -m tierloom <landing> <store> <tables>

All three folders, and the one that ``spark.checkpoint.dir`` names, must be
shared by the executors.
"""

from __future__ import annotations

import argparse
import logging

from tierloom.constants import AS_WRITTEN_RELATIONS, DOCUMENTED_RELATIONS
from tierloom.naming import Naming
from tierloom.plans.checks import expected_failures
from tierloom.plans.pipeline import run
from tierloom.session import build_session
from tierloom.sources.raw_store import RawStore
from tierloom.sources.storage import release
from tierloom.sources.tables import TableFolder

log = logging.getLogger(__name__)


def main(arguments: list[str] | None = None) -> int:
    """Returns 1 if a declared check failed that was not expected to."""
    parser = argparse.ArgumentParser(prog="tierloom", description=__doc__)
    parser.add_argument("landing", help="folder with one folder of JSON lines per source")
    parser.add_argument("store", help="folder of the raw tables, cursors and stream checkpoints")
    parser.add_argument("tables", help="folder of the marts and check results")
    parser.add_argument("--entity", default="entity", help="noun in table and column names")
    parser.add_argument("--order-column", default="catalog_order", help="name of the entity's sort position")
    parser.add_argument("--batch", action="store_true", help="read past id cursors instead of streaming new files")
    parser.add_argument("--as-written", action="store_true", help="relation preset that repeats the original model")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO)
    spark = build_session()
    naming = Naming(options.entity, options.order_column)
    folder = TableFolder(spark, options.tables)
    mapping = AS_WRITTEN_RELATIONS if options.as_written else DOCUMENTED_RELATIONS
    store = RawStore(spark, options.store, naming)
    _, checks = run(store, options.landing, folder, not options.batch, mapping)
    results = folder.rebuild(folder.default_schema, "checks", checks)
    expected = expected_failures(naming)
    # One row per declared check that did not pass.
    bad = [row for row in results.where("status <> 'pass'").collect() if tuple(row)[:3] not in expected]
    for row in bad:
        log.error("check %s of %s.%s: %s, %s failures", row["check"], row["table"], row["column"], row["status"], row["failures"])
    log.info("%d unexpected failures; all results in %s", len(bad), folder.path(folder.default_schema, "checks"))
    release(spark)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
