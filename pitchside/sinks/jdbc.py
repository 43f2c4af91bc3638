"""Relational database sink over JDBC (the driver jar comes with the cluster).

``write_jdbc`` appends or overwrites a table in parallel: each Spark partition
opens its own connection and inserts in batches (``batchsize``); the
partition count caps the concurrent connections (``num_connections``).

Keyed upserts are done in Spark (``operators.merge.upsert``) and the merged
table is written whole; the database needs no merge support of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas as SC
from .tables import TableStore


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batch_size: int = 10_000, num_connections: int = 16,
               truncate: bool = True) -> None:
    opts = dict(properties or {})
    opts.update({"batchsize": str(batch_size), "numPartitions": str(num_connections),
                 "truncate": str(truncate).lower()})
    df.write.mode(mode).jdbc(url, table, properties=opts)


def publish(store: TableStore, tables: list[str], url: str, properties: dict | None = None) -> None:
    """Replace the database tables by the published versions of ``tables``."""
    for table in tables:
        schema = SC.RESULT_TABLES.get(table)
        df = store.read(table, schema)
        write_jdbc(df.select(*schema.names) if schema else df, url, table, properties, mode="overwrite")
