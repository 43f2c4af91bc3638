"""Keyed tables in the catalog, bucketed by key, whose merges move only the source.

A bucketed table is stored as it would be shuffled: the full outer join of an upsert reads
it bucket by bucket, and only the source is shuffled, to the table's buckets.  A merge
writes a new table of the same buckets, without another shuffle, and then points the
view ``name`` at it, so readers see the old or the new state.  The superseded table stays until
``drop_superseded``.  One writer at a time per table.

Choose at least ``spark.sql.shuffle.partitions`` buckets: with fewer, Spark takes a join on
the table's buckets for too little parallelism and shuffles the table after all.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import q
from ..operators import merge as MG


def _publish(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    version = f"{name}__{uuid.uuid4().hex[:12]}"
    df.write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(version)
    df.sparkSession.sql(f"create or replace view {q(name)} tblproperties ('version' = '{version}') as select * from {q(version)}")


def create(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """Publish ``df`` as the bucketed table ``name`` (one file per bucket)."""
    _publish(df.repartition(buckets, *keys), name, keys, buckets)


def version(spark: SparkSession, name: str) -> str:
    """The table behind the view ``name``."""
    return spark.sql(f"show tblproperties {q(name)}").where(F.col("key") == "version").first()["value"]


def bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"describe table extended {q(version(spark, name))}").where(F.col("col_name") == "Num Buckets")
    return int(rows.first()["data_type"])


def merged(spark: SparkSession, name: str, source: DataFrame, keys: list[str], **options) -> DataFrame:
    """The table ``name`` after an upsert of ``source`` (see ``operators.merge.upsert``)."""
    return MG.upsert(spark.table(version(spark, name)), source, keys, **options)


def upsert(spark: SparkSession, name: str, source: DataFrame, keys: list[str], **options) -> None:
    _publish(merged(spark, name, source, keys, **options), name, keys, bucket_count(spark, name))


def drop_superseded(spark: SparkSession, name: str) -> list[str]:
    """Drop the earlier tables of ``name``; returns their names."""
    current = version(spark, name)
    old = [t.name for t in spark.catalog.listTables() if re.fullmatch(re.escape(name) + r"__[0-9a-f]{12}", t.name) and t.name != current]
    for table in old:
        spark.sql(f"drop table {q(table)}")
    return old
