"""Declared data checks, answered as one DataFrame of failure counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "table string, column string, check string, failures bigint, status string"


@dataclass(frozen=True)
class Check:
    """One rule on a table.

    ``kind`` is unique, not_null, accepted_values or relationships. ``columns``
    holds one column, or several for a composite key. ``values`` belongs to
    accepted_values, ``to`` (table, column) to relationships.
    """

    table: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    to: tuple[str, str] | None = None


def unique(table: str, *columns: str) -> Check:
    return Check(table, "unique", columns)


def not_null(table: str, column: str) -> Check:
    return Check(table, "not_null", (column,))


def accepted(table: str, column: str, values: Sequence) -> Check:
    return Check(table, "accepted_values", (column,), values=tuple(values))


def relationship(table: str, column: str, to_table: str, to_column: str) -> Check:
    return Check(table, "relationships", (column,), to=(to_table, to_column))


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a NULL part do not count."""
    keyed = df.select(*columns).dropna("any")
    return keyed.groupBy(*columns).count().where(F.col("count") > 1)


def missing_parents(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null key has no parent.

    Keys are counted before the join, so a key with very many rows is one row
    in it; ``rows`` carries the count along.
    """
    keys = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")


def _row_test(check: Check) -> Column:
    column = F.col(check.columns[0])
    if check.kind == "not_null":
        return column.isNull()
    return column.isNotNull() & ~column.isin(list(check.values))


def _row(check: Check, failures: Column, status: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table"),
        F.lit(", ".join(check.columns)).alias("column"),
        F.lit(check.kind).alias("check"),
        failures.cast("bigint").alias("failures"),
        status.alias("status"),
    )


def _verdict(failures: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def _problem(check: Check, tables: Mapping[str, DataFrame]) -> bool:
    needed = [(check.table, name) for name in check.columns] + ([check.to] if check.to else [])
    return any(table not in tables or name not in tables[table].columns for table, name in needed)


def key_failures(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Results of ``unique`` and ``relationships`` checks.

    A key that no other refers to is grouped by its own columns, so a task holds no more than they do, and a table
    already dealt out by part of its key is not shuffled again. The others share one grouped pass.
    Every such key column's rows go in once, tagged with the key they belong to: the keys that must be unique or be met as
    the parents' side, those that refer to them as a child's. Rows are counted by key in the map tasks already, so a
    hot key is one row a task. A key with more than one parent row is a duplicate; the rows of one with none are orphans.
    """
    families: dict[tuple[str, tuple[str, ...]], list[Check]] = {}
    for check in checks:
        parent = (check.to[0], (check.to[1],)) if check.to else (check.table, check.columns)
        children = families.setdefault(parent, [])
        if check.to:
            children.append(check)
    alone = [parent for parent, children in families.items() if not children]
    counts = [_duplicates(tables[table], columns, list(families).index((table, columns))) for table, columns in alone]
    referred = {parent: children for parent, children in families.items() if children}
    if referred:
        counts.append(_met_keys(tables, families, referred))

    results = []
    for check in checks:
        parent = (check.to[0], (check.to[1],)) if check.to else (check.table, check.columns)
        name = f"child{families[parent].index(check)}" if check.to else "parents"
        # A family without any key has no row, hence the sum over all.
        failures = F.coalesce(F.sum(F.when(F.col("family") == list(families).index(parent), F.col(name))), F.lit(0))
        results.append(failures.alias(f"r{len(results)}"))
    rows = [_row(check, F.col(f"r{i}"), _verdict(F.col(f"r{i}"))) for i, check in enumerate(checks)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return every.agg(*results).select(F.inline(F.array(*rows)))


def _duplicates(df: DataFrame, columns: Sequence[str], family: int) -> DataFrame:
    """The number of keys that occur more than once, under their family's number."""
    by_key = df.select(*columns).dropna("any").groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    return by_key.agg(F.lit(family).alias("family"), F.count_if(F.col("_rows") > 1).alias("parents"))


def _met_keys(
    tables: Mapping[str, DataFrame], families: Mapping[tuple, list[Check]], referred: Mapping[tuple, list[Check]]
) -> DataFrame:
    """Per family its duplicate parents and the orphans of each child, from one grouped pass."""
    most = max(map(len, referred.values()))
    names = ["parents", *(f"child{i}" for i in range(most))]

    def side(family: int, table: str, columns: Sequence[str], name: str) -> DataFrame:
        key = F.array(*[F.col(column).cast("string") for column in columns])
        ones = [F.lit(int(name == own)).cast("bigint").alias(own) for own in names]
        return tables[table].select(*columns).dropna("any").select(F.lit(family).alias("family"), key.alias("key"), *ones)

    sides = [
        side(family, table, columns, name)
        for family, ((table_, columns_), children) in enumerate(families.items())
        if children
        for table, columns, name in [(table_, columns_, "parents"), *((c.table, c.columns, f"child{i}") for i, c in enumerate(children))]
    ]
    by_key = reduce(DataFrame.unionByName, sides).groupBy("family", "key").agg(*[F.sum(name).alias(name) for name in names])
    orphans = [F.sum(F.when(F.col("parents") == 0, F.col(name)).otherwise(0)).alias(name) for name in names[1:]]
    return by_key.groupBy("family").agg(F.count_if(F.col("parents") > 1).alias("parents"), *orphans)


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: (table, column, check, failures, status).

    All row-wise checks of a table share one scan of it, and all checks of keys
    one grouped pass over all tables. A check on a table or column that does
    not exist gets status ``error`` and no count. Failures are rows, except for
    ``unique``, where they are keys.
    """
    spark = next(iter(tables.values())).sparkSession
    broken = [check for check in checks if _problem(check, tables)]
    sound = [check for check in checks if check not in broken]
    parts: list[DataFrame] = []

    row_wise: dict[str, list[Check]] = {}
    for check in sound:
        if check.kind in ("not_null", "accepted_values"):
            row_wise.setdefault(check.table, []).append(check)
    for table, group in row_wise.items():
        counts = tables[table].agg(*[F.count_if(_row_test(check)).alias(f"c{i}") for i, check in enumerate(group)])
        rows = [_row(check, F.col(f"c{i}"), _verdict(F.col(f"c{i}"))) for i, check in enumerate(group)]
        parts.append(counts.select(F.inline(F.array(*rows))))

    keyed = [check for check in sound if check.kind in ("unique", "relationships")]
    if keyed:
        parts.append(key_failures(tables, keyed))

    if broken:
        rows = [(check.table, ", ".join(check.columns), check.kind, None, "error") for check in broken]
        parts.append(spark.createDataFrame(rows, RESULT))
    return reduce(DataFrame.unionByName, parts)
