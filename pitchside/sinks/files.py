"""Flat-file snapshots (CSV) of result tables.

* ``write_snapshot``: header, no index, one folder per snapshot date
  (``<base>/snapshot_date=YYYY-MM-DD/``), so repeated runs keep history.  The
  date is a parameter, not the clock, so a rerun writes the same place.
* ``write_csv``: plain overwrite of one folder (the undated results file).
* ``with_row_index``: optional leading 0-based row number, ordered by a key
  (a dataframe-index column is a single-process artefact; off by default).

Nested columns (arrays / structs, e.g. fixture ``stats``) are written as JSON
text, since CSV has no nested types.  Output is UTF-8; ``bom=True`` starts every
part file with a byte-order mark (Spark's CSV writer has no UTF-8-with-BOM
charset, so the mark is put in front of the first header name, which is the
first thing each part file holds).
Spark writes one file per partition in parallel; nothing passes through the
driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def flat_for_csv(df: DataFrame) -> DataFrame:
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.withColumns({f.name: F.to_json(F.col(f.name))
                           for f in df.schema.fields if isinstance(f.dataType, nested)})


BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = False) -> None:
    out = flat_for_csv(df)
    if bom and out.columns:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    out.write.mode(mode).option("header", True).csv(path)


def write_snapshot(df: DataFrame, base: str, snapshot_date: dt.date | str,
                   bom: bool = False) -> str:
    path = f"{base.rstrip('/')}/snapshot_date={snapshot_date}"
    write_csv(df, path, mode="overwrite", bom=bom)
    return path


def with_row_index(df: DataFrame, order_by: list[str], name: str = "index") -> DataFrame:
    """Leading 0-based row number in ``order_by`` order.

    A global row number needs a total order; it is computed from per-partition
    counts (``spark_partition_id`` + a running sum of the small count table)
    instead of a single-partition window, so no task holds all rows.  The
    range-partitioned frame is checkpointed (to the shared checkpoint folder)
    so that the counts and the numbering see the same partitions.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    part = ordered.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    counts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n"))
                            .alias("_off"))
    local = Window.partitionBy("_pid").orderBy(*order_by)
    out = part.join(F.broadcast(offsets), "_pid") \
        .withColumn(name, F.col("_off") + F.row_number().over(local) - 1)
    return out.select(name, *df.columns)
