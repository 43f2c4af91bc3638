"""Landed API snapshots (JSON) → typed DataFrames.

The API is polled elsewhere; each response is landed as one file:

* ``bootstrap/``       one document per snapshot with the arrays ``teams``,
                       ``elements``, ``element_types`` and ``events``;
* ``fixtures/``        one page per gameweek, a top-level array of fixtures;
* ``element-summary/`` one document per player with a ``history`` array.

All pages of a kind are read by one multi-file scan with a declared schema, so
the pages are read in parallel and a page that lacks a field gives null for it.
Pretty-printed responses need ``multi_line=True`` (a file is then one task); at
scale land JSON Lines (``multi_line=False``), which Spark splits freely.

A page that is not JSON (a truncated response) is an error in every mode, naming its
file: reading on would drop its records.  ``strict`` also turns a field that does not
fit its declared type into an error (``FAILFAST``); the default keeps the record and
nulls that one field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SC
from ..functions.casts import convert_expr, q


CORRUPT = "_unparsed"
LANDED = "_landed"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def parsable(df: DataFrame) -> DataFrame:
    """Rows read with a ``CORRUPT`` column: fails on a record that is not JSON, naming its file."""
    broken = F.col(CORRUPT).isNotNull() & F.get_json_object(CORRUPT, "$").isNull()
    message = F.concat(F.lit("a landed page cannot be parsed: "), F.col("_metadata.file_path"))
    return df.filter(F.when(broken, F.raise_error(message)).otherwise(F.lit(True)))


def read_documents(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   multi_line: bool = True, strict: bool = False, landed: bool = False) -> DataFrame:
    """``landed`` adds the file's time and path as column ``LANDED`` (newer files compare greater)."""
    df = (spark.read.schema(with_corrupt(schema))
          .option("multiLine", multi_line)
          .option("columnNameOfCorruptRecord", CORRUPT)
          .option("mode", "FAILFAST" if strict else "PERMISSIVE")
          .json(path))
    file = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"))
    return parsable(df).select(*schema.names, *([file.alias(LANDED)] if landed else []))


def newest_landed(df: DataFrame, key: str) -> DataFrame:
    """Of each ``key``, the rows of the newest file that has it (rows without a key all stay).

    A page that landed twice counts once.  The newest file per key is a partial
    aggregate joined back.
    """
    newest = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(LANDED).alias("_newest"))
    return df.join(newest, key, "left").filter(F.col("_newest").isNull() | (F.col(LANDED) == F.col("_newest"))) \
        .select(*[c for c in df.columns if c != LANDED])


def conform(df: DataFrame, schema: T.StructType, strict: bool = False,
            keep: list[str] = ()) -> DataFrame:
    """Shape ``df`` like ``schema``: declared order and types; absent fields are
    null.  ``keep`` names extra columns passed through after the declared ones."""
    have = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in schema.fields:
        e = convert_expr(f.name, have.get(f.name), f.dataType, strict)
        exprs.append(e if e == q(f.name) else f"{e} as {q(f.name)}")
    return df.selectExpr(*exprs, *[q(k) for k in keep if k not in schema.names])


# ------------------------------------------------------------ readers -----

def read_bootstrap(spark: SparkSession, path, multi_line: bool = True,
                   strict: bool = False) -> DataFrame:
    return read_documents(spark, path, SC.BOOTSTRAP, multi_line, strict)


def bootstrap_array(bootstrap: DataFrame, name: str) -> DataFrame:
    """One row per element of the array ``name`` of every bootstrap document."""
    return bootstrap.select(F.inline(name))


def read_fixture_pages(spark: SparkSession, path, multi_line: bool = True,
                       strict: bool = False, landed: bool = False) -> DataFrame:
    # A top-level JSON array gives one row per element; "[]" gives no rows.
    return read_documents(spark, path, SC.FIXTURE, multi_line, strict, landed)


def read_history_pages(spark: SparkSession, path, multi_line: bool = True,
                       strict: bool = False, landed: bool = False) -> DataFrame:
    df = read_documents(spark, path, SC.ELEMENT_SUMMARY, multi_line, strict, landed)
    return df.select(F.inline("history"), *([LANDED] if landed else []))


# ------------------------------------------------------- scan operators ----
# Each scan takes raw rows (from the readers above, or any table of the same
# fields) and returns the typed scan shape: declared fields, time parsed.

def scan_teams(raw: DataFrame, strict: bool = False) -> DataFrame:
    return conform(raw, SC.parsed(SC.TEAM), strict)


def scan_fixtures(raw: DataFrame, gameweeks: tuple[int, int] | None = None,
                  strict: bool = False, keep: list[str] = ()) -> DataFrame:
    """Fixture pages; a fixture without a gameweek is never on a page."""
    df = conform(raw, SC.parsed(SC.FIXTURE), strict, keep).filter(F.col("event").isNotNull())
    if gameweeks is not None:
        df = df.filter(F.col("event").between(*gameweeks))
    return df


def scan_positions(raw: DataFrame, strict: bool = False) -> DataFrame:
    return conform(raw, SC.parsed(SC.ELEMENT_TYPE), strict)


def scan_elements(raw: DataFrame, strict: bool = False) -> DataFrame:
    return conform(raw, SC.parsed(SC.ELEMENT), strict)


def scan_gameweeks(raw: DataFrame, strict: bool = False) -> DataFrame:
    return conform(raw, SC.parsed(SC.EVENT), strict)


def scan_history(raw: DataFrame, players: tuple[int, int] | None = None,
                 strict: bool = False, keep: list[str] = ()) -> DataFrame:
    df = conform(raw, SC.parsed(SC.HISTORY), strict, keep)
    if players is not None:
        df = df.filter(F.col("element").between(*players))
    return df


# ----------------------------------------------------------------- JSON -----

def parse_json_column(df: DataFrame, column: str, schema: T.StructType,
                      strict: bool = False) -> DataFrame:
    """Replace a JSON text column by the struct it holds."""
    opts = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    return df.withColumn(column, F.from_json(F.col(column), schema, opts))


def json_flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs become top-level columns named ``a<sep>b<sep>c``.

    Arrays (and structs inside arrays) are kept as values.  Driven by the schema
    only: a single projection, no data pass.
    """
    cols: list[Column] = []

    def walk(path: list[str], dtype: T.DataType):
        if isinstance(dtype, T.StructType) and dtype.fields:
            for f in dtype.fields:
                walk(path + [f.name], f.dataType)
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*cols)
