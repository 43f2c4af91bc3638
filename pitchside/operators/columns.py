"""Projection operators: rename, ordered selection, typed casts, null filling,
scaling.  Each is a single narrow projection that Catalyst folds into the scan
(column pruning reaches ``ReadSchema``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import convert_expr, q


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored (like a dict rename)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered column pick; a missing name is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*columns)


def cast_columns(df: DataFrame, types: dict[str, T.DataType], strict: bool = False) -> DataFrame:
    """Cast the listed columns; lenient by default (bad text → null).  Column
    order is kept; columns not listed pass through."""
    exprs = []
    for f in df.schema.fields:
        e = convert_expr(f.name, f.dataType, types[f.name], strict) if f.name in types \
            else q(f.name)
        exprs.append(e if e == q(f.name) else f"{e} as {q(f.name)}")
    return df.selectExpr(*exprs)


def cast_rejects(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """What a lenient cast loses: (column, values, rejected) for each listed column of ``df``, in one
    aggregate.  ``values`` counts the values that are there, ``rejected`` those that become null."""
    marked = mark_rejects(df, types)
    have = [c for c in df.columns if c in types]
    sums = marked.agg(*[F.expr(f"count({q('_from_' + c)})").alias(f"v{i}") for i, c in enumerate(have)],
                      *[F.expr(f"count_if({_lost(c)})").alias(f"r{i}") for i, c in enumerate(have)])
    lines = ", ".join(f"named_struct('column', {sql_text(c)}, 'values', v{i}, 'rejected', r{i})" for i, c in enumerate(have))
    return sums.selectExpr(f"inline(array({lines}))")


def _lost(c: str) -> str:
    return f"{q('_from_' + c)} is not null and {q(c)} is null"


def sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def mark_rejects(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """``cast_columns`` with the text each listed column was cast from, as ``_from_<column>``."""
    kept = df.withColumns({f"_from_{c}": F.col(q(c)).cast("string") for c in df.columns if c in types})
    return cast_columns(kept, types)


def cast_and_observe(df: DataFrame, types: dict[str, T.DataType], observation: Observation) -> DataFrame:
    """``cast_columns`` plus ``_rejects``, an array of the (column, value) pairs that a row lost.

    Whatever action runs on the result fills ``observation`` with the number of rejected
    values per column, in the same pass; rows with rejects can be written aside by
    ``_rejects`` without another scan of the source (e.g. as a partition of the same write).
    """
    marked = mark_rejects(df, types)
    have = [c for c in df.columns if c in types]
    marked = marked.observe(observation, *[F.expr(f"count_if({_lost(c)})").alias(c) for c in have])
    pairs = ", ".join(f"if({_lost(c)}, named_struct('column', {sql_text(c)}, 'value', {q('_from_' + c)}), null)" for c in have)
    return marked.selectExpr(*[q(c) for c in df.columns], f"filter(array({pairs}), r -> r is not null) as _rejects")


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def fill_nulls(df: DataFrame, value=0, columns: list[str] | None = None) -> DataFrame:
    """Null → ``value`` in numeric columns only.  Text, boolean and time columns
    keep their nulls: a name or a deadline is never 0."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, NUMERIC) and (columns is None or f.name in columns):
            exprs.append(f"coalesce({q(f.name)}, cast({value!r} as {f.dataType.simpleString()}))"
                         f" as {q(f.name)}")
        else:
            exprs.append(q(f.name))
    return df.selectExpr(*exprs)


def scale_columns(df: DataFrame, columns: list[str], divisor: float) -> DataFrame:
    """Divide each listed column by ``divisor`` (fractional result)."""
    return df.selectExpr(*[f"{q(c)} / {divisor!r} as {q(c)}" if c in columns else q(c)
                           for c in df.columns])


def label_booleans(df: DataFrame, columns: list[str]) -> DataFrame:
    """Boolean columns as 'True' / 'False' text."""
    return df.withColumns({c: F.initcap(F.col(c).cast("string")) for c in columns})
