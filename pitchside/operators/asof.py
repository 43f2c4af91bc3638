"""Dated snapshots read again: the state as of a time, and how long each state was valid.

A snapshot holds every key that exists on its date.  So the state of a key at a time
is its row in the newest snapshot at or before that time, or nothing if it isn't there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import q
from .joins import HOT_KEY_ROWS, attach_per_key


def snapshot_dates(snapshots: DataFrame, date: str) -> DataFrame:
    """One row, ``dates``: the snapshots' dates in order (an aggregate; one value per snapshot)."""
    return snapshots.agg(F.array_sort(F.collect_set(date)).alias("dates"))


def as_of(facts: DataFrame, snapshots: DataFrame, keys: list[str], at: str, date: str = "snapshot_date",
          hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``facts`` with the columns of ``snapshots`` as of ``at`` (null where there is no state).

    Each fact first gets the date of the newest snapshot at or before it, looked up in the list of
    dates (a scalar subquery), so the join is an equality on (keys, date): no range join, no
    product of a key's facts with its states.  Keys with very many facts are split.
    ``snapshots`` has unique (keys, date); facts before the first snapshot, or with
    a null key or time, stay with nulls.
    """
    dates = snapshot_dates(snapshots, date).scalar()
    before = F.array_max(F.filter("_dates", lambda d: d <= F.col(q(at))))
    dated = facts.withColumn("_dates", dates).withColumn(date, before).drop("_dates")
    on = [*keys, date]
    known = F.lit(True)
    for k in on:
        known = known & F.col(q(k)).isNotNull()
    counts = dated.where(known).groupBy(*on).agg(F.count(F.lit(1)).alias("_facts"))
    states = counts.join(snapshots, on, "inner")
    joined = attach_per_key(dated, states, on, "_facts", hot_key_rows=hot_key_rows, counts=counts)
    return joined.select(*[F.col(q(c)) for c in [*facts.columns, date, *(c for c in snapshots.columns if c not in on)]])


def valid_intervals(snapshots: DataFrame, keys: list[str], date: str = "snapshot_date",
                    valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """One row per key and stretch of consecutive snapshots with equal values (gaps and islands).

    ``valid_to`` is the first snapshot date after the stretch, null while it lasts.  A key that is
    missing from a snapshot has a gap there.  A window holds one key's snapshots, one row per date.
    """
    values = [c for c in snapshots.columns if c not in (*keys, date)]
    dates = snapshot_dates(snapshots, date).scalar()
    at = F.array_position(dates, F.col(q(date)))
    in_order = Window.partitionBy(*keys).orderBy(date)
    state = F.struct(*[F.col(q(c)) for c in values], F.lit(0).alias("_"))
    rows = snapshots.select("*", at.alias("_at"), state.alias("_state"))
    follows = (F.lag("_at").over(in_order) == F.col("_at") - 1) & F.lag("_state").over(in_order).eqNullSafe(F.col("_state"))
    rows = rows.withColumn("_island", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_island").over(in_order))
    spans = rows.groupBy(*keys, "_island").agg(F.min(date).alias(valid_from), F.max("_at").alias("_last"), F.first("_state").alias("_state"))
    return spans.select(*keys, *[F.col("_state")[c].alias(c) for c in values], valid_from,
                        F.try_element_at(dates, (F.col("_last") + 1).cast("int")).alias(valid_to))
