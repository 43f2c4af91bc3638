"""Join operators.

Broadcast policy: nothing is forced.  Spark broadcasts a side whose size in bytes
is known to be under ``spark.sql.autoBroadcastJoinThreshold`` (file sizes, or the
measured size of a shuffled side at run time) and otherwise joins by shuffle, so no
job runs while a plan is built.  The one hinted broadcast here, the hot keys of
``attach_per_key``, has a bound by construction.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dimension_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a fact to a dimension; Spark broadcasts the dimension if its bytes are few."""
    return fact.join(dim, on, how)


def join_full_outer(frames: list[DataFrame], key: str | list[str], fill=0) -> DataFrame:
    """Fold a list of keyed tables with full outer joins; missing cells → ``fill``.

    The key columns are merged (``join(..., on=key)`` keeps one copy).  Null keys
    never match (SQL semantics).
    """
    keys = [key] if isinstance(key, str) else list(key)
    out = reduce(lambda l, r: l.join(r, keys, "full"), frames)
    values = [c for c in out.columns if c not in keys]
    return out.na.fill(fill, subset=values) if fill is not None else out


# ------------------------------------------------------------ hot keys ----
# A key is hot if it holds HOT_KEY_ROWS rows or more and more than 1 / (2 * P) of
# all rows, P being the number of shuffle partitions: fewer keys than 2 * P can do
# so, whatever the data, and keys that are heavy but even need no split.
HOT_KEY_ROWS = 1_000_000
SALT_BUCKETS = 64


def hot_mark(count: str, total: Column, partitions: int, hot_key_rows: int = HOT_KEY_ROWS) -> Column:
    """True for a key with ``count`` rows that is hot among ``total`` rows."""
    return (F.col(count) >= hot_key_rows) & (F.col(count) * (2 * partitions) > total)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def attach_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], count: str, hint: str | None = None,
                   hot_key_rows: int = HOT_KEY_ROWS, buckets: int = SALT_BUCKETS, counts: DataFrame | None = None) -> DataFrame:
    """Left join of ``rows`` with ``per_key`` (one row per key), hot keys split.

    ``count`` is the column of ``per_key`` with the key's number of rows.  Rows of a
    hot key get a salt in [0, buckets) and that key's ``per_key`` row is repeated once
    per salt, so the key is spread over ``buckets`` join tasks; every other key keeps
    salt 0.  Rows with a null key can't match and are spread by the salt as well.
    ``per_key`` marks its own hot keys; the rows learn them from a broadcast of fewer than
    2 * P keys, found in ``counts`` (keys and ``count``; a plainer plan than ``per_key``'s, if
    there is one).  ``hint`` picks the join strategy (e.g. ``"shuffle_hash"`` when
    ``per_key`` grows with the data).
    """
    total = rows.agg(F.count(F.lit(1))).scalar()
    is_hot = hot_mark(count, total, shuffle_partitions(rows), hot_key_rows)
    hot = F.broadcast((per_key if counts is None else counts).where(is_hot).select(*keys, F.lit(True).alias("_hot")))
    zero = F.lit(0).cast("bigint")
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in rows.columns]), F.lit(buckets))
    salted_rows = rows.join(hot, keys, "left") \
        .withColumn("_salt", F.when(F.coalesce(F.col("_hot"), unknown), salt).otherwise(zero)).drop("_hot")
    all_salts = F.sequence(zero, F.lit(buckets - 1).cast("bigint"))
    salted_keys = per_key.withColumn("_salt", F.explode(F.when(is_hot, all_salts).otherwise(F.array(zero))))
    if hint:
        salted_keys = salted_keys.hint(hint)
    return salted_rows.join(salted_keys, keys + ["_salt"], "left").drop("_salt")
