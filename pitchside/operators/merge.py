"""Keyed merge (upsert) and full refresh, as DataFrame operators.

``upsert(target, source, keys)``: a source row whose key exists in the target
replaces that target row (every column, a null included); a new key is
inserted; target rows whose key is not in the source stay.  It is one full outer
join on the key in which the source wins where it is present, so target and source
are each computed once and shuffled once.

Duplicate keys inside one source batch are an error by default (a database
rejects updating one row twice in a statement).  ``on_duplicate="latest"``
keeps, per key, the row that is greatest by the caller's order, ties broken by
a hash of all columns so the choice is deterministic; it is a grouped
``max_by`` (partial on the map side), so a hot key never gathers in one task.

``newer`` names a column that orders the versions of a row (e.g. its landing time): a source
row that is older than the target row of its key changes nothing, so loads may come in
any order.

Null keys never match anything.  They are rejected by default, because a
rerun would append them again.

The key check runs inside the merge plan, not as a separate job: a window
count over the key, on the partitioning and order that the join needs anyway, and a
filter that raises on the first violation.  A valid source has unique keys, so this
partitioning cannot be skewed; the keyed target is unique by key as well.  After
``latest`` keys are unique and only nulls are checked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import q
from ..sources.snapshot import conform


class MergeError(ValueError):
    pass


def conform_to(target_schema: T.StructType, source: DataFrame, strict: bool = False) -> DataFrame:
    """Staging: align a source to the target's columns, order and types.

    Extra source columns are dropped; target columns the source lacks are null.
    """
    return conform(source, target_schema, strict)


def latest_per_key(source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by a hash of all columns.

    Every column is carried once: the order columns in the maximum, the rest beside it.
    """
    cols = source.columns
    order = ", ".join([*(q(c) for c in order_by if c not in keys), f"xxhash64({', '.join(q(c) for c in cols)})"])
    value = ", ".join(q(c) for c in cols if c not in keys and c not in order_by) or "true"
    out = source.groupBy(*keys).agg(F.expr(f"max_by(struct({value}), struct({order}))").alias("_row"),
                                    F.expr(f"max(struct({order}))").alias("_order"))
    where = {c: "_order" for c in order_by} | {c: "_row" for c in cols if c not in order_by}
    return out.selectExpr(*[q(c) if c in keys else f"{where[c]}.{q(c)}" for c in cols])


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           on_duplicate: str = "error", order_by: list[str] | None = None,
           allow_null_keys: bool = False, newer: str | None = None) -> DataFrame:
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        source = latest_per_key(source, keys, order_by)
    elif on_duplicate != "error":
        raise ValueError(f"unknown on_duplicate policy: {on_duplicate}")
    source = conform_to(target.schema, source)
    source = checked_keys(source, keys, allow_null_keys, unique=on_duplicate == "latest")
    rest = [c for c in target.columns if c not in keys]
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in rest], F.lit(True).alias("_new"))
    both = target.join(new, keys, "full")
    if newer is not None:  # a stored row without a version, like an absent one, is the older one
        both = both.withColumn("_new", F.col("_new") & F.coalesce(F.col(f"_new_{newer}") >= F.col(newer), F.lit(True)))
    return both.selectExpr(*[q(c) if c in keys else f"if(_new, {q(f'_new_{c}')}, {q(c)}) as {q(c)}" for c in target.columns])


def checked_keys(source: DataFrame, keys: list[str], allow_null_keys: bool = False, unique: bool = False) -> DataFrame:
    """The source unchanged, failing at run time on a null key or, unless known to be ``unique``, a duplicate."""
    key_text = F.to_json(F.struct(*[F.col(k) for k in keys]))
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    ok = F.lit(True)
    if not allow_null_keys:
        ok = F.when(null, F.raise_error(F.concat(F.lit("merge source has a null key: "), key_text))).otherwise(ok)
    if not unique:
        source = source.withColumn("_key_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        dup = (F.col("_key_rows") > 1) & ~null
        ok = F.when(dup, F.raise_error(F.concat(F.lit("merge source has a duplicate key: "), key_text))).otherwise(ok)
    return source.filter(ok).drop("_key_rows")


def refresh(target: DataFrame, source: DataFrame) -> DataFrame:
    """Full refresh: the source, shaped like the target, in place of all its rows."""
    return conform_to(target.schema, source)
