"""Refresh by difference: which groups of a table changed, and writing only those.

A group's content digest is its number of rows and two sums of row hashes, so it doesn't
depend on the order of rows and is a partial aggregate: a task sends one row per group,
however many rows the group holds.  Old and new rows are summed in one aggregate, side by
side, without a join (a null group is a group of its own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import q
from .merge import conform_to

NEW, GONE, CHANGED = "new", "gone", "changed"


def _row_hashes(columns: list[str]) -> list[Column]:
    """Two hashes of a row; a null is told from its neighbours' values by a mark."""
    cells = [c for name in columns for c in (F.col(q(name)), F.col(q(name)).isNull())]
    return [F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)") for seed in (1, 2)]


def changed_groups(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """(by, change, rows_before, rows_after) of the groups whose rows differ, as bags.

    Both sides have the columns of ``old`` (see ``conform_to``).
    """
    first, second = _row_hashes(old.columns)
    sides = [df.select(F.col(q(by)).alias(by), F.lit(is_new).alias("_is_new"), first.alias("_a"), second.alias("_b"))
             for df, is_new in ((old, False), (new.select(*[q(c) for c in old.columns]), True))]

    def total(value: Column, is_new: bool) -> Column:
        return F.sum(F.when(F.col("_is_new") == is_new, value))

    sums = sides[0].unionByName(sides[1]).groupBy(by).agg(*[
        total(value, is_new).alias(f"_{name}_{is_new}") for name, value in (("n", F.lit(1)), ("a", F.col("_a")), ("b", F.col("_b")))
        for is_new in (False, True)])
    same = F.lit(True)
    for name in "nab":
        same = same & F.col(f"_{name}_False").eqNullSafe(F.col(f"_{name}_True"))
    before, after = (F.coalesce(f"_n_{side}", F.lit(0)).cast("long") for side in (False, True))
    change = F.when(before == 0, NEW).when(after == 0, GONE).otherwise(CHANGED)
    return sums.where(~same).select(by, change.alias("change"), before.alias("rows_before"), after.alias("rows_after"))


def stage_changes(store, table: str, source: DataFrame, schema: T.StructType, column: str, max_partitions: int = 100_000):
    """Full refresh of a partitioned table that writes only the partitions (values of ``column``)
    whose rows differ from the stored ones; returns what to commit.

    An equal source writes nothing and gives back the stored entry.  A table without
    partitions yet is written whole.  The driver gets one row per partition that
    changed, over ``max_partitions`` is an error.  Commit on the state this was read from (``base_seq``).
    """
    source = conform_to(schema, source)
    current = store.version(table)
    old = store.read(table, schema) if isinstance(current, dict) else store.spark.createDataFrame([], schema)
    text = F.col(column).cast("string")
    changes = {r[0]: r[1] for r in changed_groups(old, source, column).select(text, "change").limit(max_partitions + 1).collect()}
    if len(changes) > max_partitions:
        raise ValueError(f"{column} has over {max_partitions} values: not a partition column")
    if None in changes:
        raise ValueError(f"rows without {column}: a partition of {table} needs a value")
    if not changes and isinstance(current, dict):
        return current
    written = [value for value, change in changes.items() if change != GONE]
    parts = {value: v for value, v in (current["parts"] if isinstance(current, dict) else {}).items() if value not in changes}
    if written:
        version = store.stage(table, source.where(text.isin(written)), [column])
        parts.update(dict.fromkeys(written, version))
    return {"column": column, "parts": parts}
