"""Column discovery: nested JSON whose fields are not known beforehand becomes columns.

Documents are parsed into VARIANT, which keeps any field.  One aggregate
(``schema_of_variant_agg``: partial per task, merged like any aggregate) gives the schema
that covers all of them, and one projection reads each leaf by its path.  The schema is
the only thing that reaches the driver; more than ``max_columns`` leaves (documents with ids as
field names) is an error.

Merged types: integers and fractions give double; whole numbers beyond bigint keep their
decimal; a field that is null everywhere, or has values of different kinds (a number here,
an object there), gives text, objects and arrays as JSON.  Arrays stay values, with the
merged type of their elements.  An object without fields gives no column.  A path is null
where a document lacks it.  As the columns depend on the data, the aggregate runs when the plan
is built.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import q

MAX_COLUMNS = 2000
QUOTED = re.compile(r"(`(?:[^`]|``)*`)")


def discovered_type(df: DataFrame, column: str) -> T.DataType:
    """The type that covers every value of a VARIANT column (one aggregate)."""
    text = df.agg(F.schema_of_variant_agg(column)).first()[0]
    unquoted = [s if s.startswith("`") else s.replace("OBJECT<", "STRUCT<") for s in QUOTED.split(text)]
    return T.DataType.fromDDL("".join(unquoted))


def column_type(found: T.DataType) -> T.DataType:
    """The type of the column that holds values of a discovered type."""
    if isinstance(found, T.StructType) and found.fields:
        return T.StructType([T.StructField(f.name, column_type(f.dataType)) for f in found.fields])
    if isinstance(found, T.ArrayType):
        return T.ArrayType(column_type(found.elementType))
    if isinstance(found, (T.FloatType, T.DoubleType)) or isinstance(found, T.DecimalType) and found.scale:
        return T.DoubleType()
    if isinstance(found, (T.LongType, T.DecimalType, T.BooleanType, T.StringType)):
        return found
    return T.StringType()


def _step(name: str) -> str | None:
    """A field as a step of a VARIANT path; None if no path can name it."""
    if not name or "'" in name and '"' in name:
        return None
    return f'["{name}"]' if "'" in name else f"['{name}']"


def leaves(found: T.DataType, path: str = "$", names: tuple[str, ...] = ()) -> list[tuple[str, tuple[str, ...], T.DataType]]:
    """(path, field names, column type) of every leaf of a discovered type."""
    if not isinstance(found, T.StructType):
        return [(path, names, column_type(found))]
    steps = [_step(f.name) for f in found.fields]
    if None in steps:
        return [(path, names, T.StringType())]
    return [leaf for f, step in zip(found.fields, steps) for leaf in leaves(f.dataType, path + step, (*names, f.name))]


def flatten_variant(df: DataFrame, column: str, found: T.DataType, sep: str = ".", prefix: bool = True,
                    max_columns: int = MAX_COLUMNS) -> DataFrame:
    """The other columns of ``df`` and one per leaf of ``found``, named by its path joined by ``sep``.

    ``prefix`` puts the column's own name in front.  A name given twice is an error.
    """
    parts = leaves(found)
    if len(parts) > max_columns:
        raise ValueError(f"{column} has {len(parts)} fields, over {max_columns}: field names hold data")
    others = [c for c in df.columns if c != column]
    named = [(sep.join([column, *names] if prefix or not names else names), path, t) for path, names, t in parts]
    taken = [*others, *(n for n, _, _ in named)]
    twice = sorted({n for n in taken if taken.count(n) > 1})
    if twice:
        raise ValueError(f"columns of the same name: {twice}")
    return df.select(*[F.col(q(c)) for c in others],
                     *[F.try_variant_get(F.col(q(column)), path, t.simpleString()).alias(n) for n, path, t in named])


def json_discover(df: DataFrame, column: str, sep: str = ".", prefix: bool = True, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """Flatten a JSON text column whose fields are found in the data.  Text that is not JSON is an error."""
    parsed = df.withColumn(column, F.parse_json(F.col(q(column))))
    return flatten_variant(parsed, column, discovered_type(parsed, column), sep, prefix, max_columns)


def read_records(spark: SparkSession, path: str | list[str], array: str | None = None, multi_line: bool = True) -> DataFrame:
    """Landed pages as one VARIANT column ``record``: the elements of the pages' field ``array``, or
    without it the pages (of a top-level array its elements).  A page that is not JSON is an error."""
    pages = spark.read.option("singleVariantColumn", "record").option("multiLine", multi_line).option("mode", "FAILFAST").json(path)
    if array is not None:
        return pages.select(F.explode(F.try_variant_get("record", f"${_step(array)}", "array<variant>")).alias("record"))
    elements = F.coalesce(F.try_variant_get("record", "$", "array<variant>"), F.array("record"))
    return pages.select(F.explode(elements).alias("record"))


def read_discovered(spark: SparkSession, path: str | list[str], array: str | None = None, sep: str = ".",
                    multi_line: bool = True, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """Landed pages as a table of the fields they have: nested ones as ``a<sep>b``, arrays as values."""
    records = read_records(spark, path, array, multi_line)
    return flatten_variant(records, "record", discovered_type(records, "record"), sep, False, max_columns)
