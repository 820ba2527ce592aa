"""Versioned synchronisation: change sets, upserts, replacements and restores, as joins that end in one overwrite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def change_set(current: DataFrame, desired: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys and change: insert, update, keep or delete, comparing values null-safely."""
    a = current.select(*keys, F.struct(*values).alias("_old"))
    b = desired.select(*keys, F.struct(*values).alias("_new"))
    rows = a.join(b, keys, "full")
    same = reduce(lambda x, y: x & y, [F.col(f"_old.{v}").eqNullSafe(F.col(f"_new.{v}")) for v in values])
    change = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(same, "keep").otherwise("update")
    return rows.select(*keys, change.alias("change"))


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str], keep_old: list[str] = ()) -> DataFrame:
    """current with incoming rows put in place; columns in `keep_old` keep the old value where the new one is null. Of several incoming rows of one key the greatest in column order holds."""
    rest = [c for c in current.columns if c not in keys]
    incoming = incoming.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_x")).select(*keys, "_x.*")
    old = current.select(*keys, F.struct(*(c for c in current.columns if c not in keys)).alias("_old"))
    new = incoming.select(*keys, F.struct(*(c for c in current.columns if c not in keys)).alias("_new"))
    rows = old.join(new, keys, "full")

    def merged(c: str):
        fresh, stale = F.col(f"_new.{c}"), F.col(f"_old.{c}")
        return (F.coalesce(fresh, stale) if c in keep_old else F.when(F.col("_new").isNull(), stale).otherwise(fresh)).alias(c)

    return rows.select(*(F.col(c) if c in keys else merged(c) for c in current.columns))


def insert_new(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """current and those incoming rows whose keys it lacks; of several incoming rows of one key the first in column order."""
    order = Window.partitionBy(*keys).orderBy(*(c for c in incoming.columns if c not in keys) or keys)
    fresh = incoming.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    return current.unionByName(fresh.join(current.select(*keys).distinct(), keys, "left_anti"))


def replace_scopes(current: DataFrame, incoming: DataFrame, scope: list[str]) -> DataFrame:
    """Rows of the incoming scopes replaced as wholes; a scope without incoming rows stays as it is. Incoming rows that are the same count once, others of a scope all stay."""
    return current.join(incoming.select(*scope).distinct(), scope, "left_anti").unionByName(incoming.distinct())


def next_versions(versions: DataFrame, desired: DataFrame, key: str, values: list[str]) -> DataFrame:
    """key, version and values to append: where the latest version differs null-safely, or there is none."""
    latest = versions.groupBy(key).agg(F.max_by(F.struct("version", *values), "version").alias("x"))
    rows = desired.select(key, *values).join(latest, key, "left")
    same = reduce(lambda x, y: x & y, [F.col(f"x.{v}").eqNullSafe(F.col(v)) for v in values])
    return rows.filter(F.col("x").isNull() | ~same).select(key, (F.coalesce(F.col("x.version"), F.lit(0)) + 1).alias("version"), *values)


def restore_children(children: DataFrame, parents: DataFrame, natural: str, live: DataFrame | None = None, child_keys: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(restored, orphans) of a snapshot's child rows after their parents were rebuilt: they find their new parent by its natural key; rows that live already win."""
    ids = parents.select(natural, F.col("id").alias("parent_id"))
    restored = children.join(ids, natural)
    if live is not None:
        restored = restored.join(live.select(*child_keys).distinct(), list(child_keys), "left_anti")
    return restored, children.join(ids, natural, "left_anti")


def refuse_lost(orphans: DataFrame, manual: str, what: str = "rows set by hand", shown: int = 5) -> DataFrame:
    """The orphans of `restore_children`, or an error if one of them was set by hand (`manual` is an SQL condition): those must not be lost."""
    lost = orphans.filter(manual).limit(shown).collect()
    if lost:
        raise ValueError(f"{what} would be lost, among them {[tuple(r) for r in lost]}")
    return orphans


def registry_sync(current: DataFrame, desired: DataFrame, key: str, values: list[str], versions: DataFrame | None = None, versioned: list[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, report, new versions) of bringing a registry up to date: rows are inserted and updated, absent ones stay.

    `report` has the key and change ('insert', 'update', 'keep' or 'absent', which
    is a warning). A version is appended where one of the `versioned` columns
    differs null-safely from the latest.
    """
    changes = change_set(current, desired, [key], values)
    report = changes.select(key, F.when(F.col("change") == "delete", "absent").otherwise(F.col("change")).alias("change"))
    table = upsert(current.select(key, *values), desired.select(key, *values), [key])
    fresh = next_versions(versions, desired, key, list(versioned)) if versions is not None else report.limit(0)
    return table, report, fresh


def keep_best(df: DataFrame, key: str, present: list[str], order: str) -> DataFrame:
    """One row per key, folded in order: a later row replaces the kept one if it has a value, in the first column of `present` or else the next, that the kept one lacks; it takes the earliest order.

    The rule is no total order, so the fold runs over each key's rows in order.
    """
    columns = [c for c in df.columns if c != key]
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), *columns)))

    def better(kept, row):
        return reduce(lambda x, y: x | y, [row[c].isNotNull() & kept[c].isNull() for c in present])

    folded = F.aggregate(F.slice("_rows", 2, F.greatest(F.size("_rows"), F.lit(1))), F.col("_rows")[0], lambda kept, row: F.when(better(kept, row), row).otherwise(kept))
    out = df.groupBy(key).agg(rows.alias("_rows")).withColumn("_kept", folded)
    return out.select(key, *(F.col("_rows")[0]["_at"].alias(c) if c == order else F.col(f"_kept.{c}").alias(c) for c in columns))


def check_not_empty(incoming: DataFrame, what: str) -> DataFrame:
    """The rows, or an error where there are none, so that an empty result can't wipe what is there."""
    if incoming.isEmpty():
        raise ValueError(f"no {what}: what is there stays")
    return incoming
