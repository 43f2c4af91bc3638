"""Type conversion of a column to a declared type.

lenient (default): a value that does not parse becomes null (``try_cast``).
strict: it raises, like an ``astype`` that meets bad text.
Casting a fractional number to an integer truncates toward zero.

Conversions are produced as SQL expression text so that a wide projection
(a 30-column scan shape) is one ``selectExpr`` call instead of several
Python→JVM calls per column; the plan is the same.
"""

from __future__ import annotations

from pyspark.sql import types as T


def q(name: str) -> str:
    """Quoted column name for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def convert_expr(name: str, source: T.DataType | None, target: T.DataType,
                 strict: bool = False) -> str:
    """SQL text converting column ``name`` (of type ``source``) to ``target``.

    ``source=None`` means the column is absent: a typed null.
    """
    c, t = q(name), target.simpleString()
    if source is None:
        return f"cast(null as {t})"
    if source == target:
        return c
    if isinstance(target, T.TimestampNTZType) and isinstance(source, T.StringType):
        # UTC wall-clock time in any session zone; text without a zone is UTC already
        fn = "to_timestamp" if strict else "try_to_timestamp"
        zoned = (f"case when {c} rlike '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$' then {c} "
                 f"when length({c}) = 10 then concat({c}, 'T00:00:00Z') else concat({c}, 'Z') end")
        return f"timestampadd(MICROSECOND, unix_micros({fn}({zoned})), timestamp_ntz'1970-01-01 00:00:00')"
    if isinstance(target, T.StringType) and isinstance(source, T.BooleanType):
        return f"initcap(cast({c} as string))"
    if isinstance(target, T.BooleanType) and isinstance(source, T.StringType):
        low = f"lower(trim({c}))"
        bad = (f"cast(raise_error(concat('not a boolean: ', {c})) as boolean)" if strict
               else "cast(null as boolean)")
        return (f"case when {c} is null then cast(null as boolean) when {low} = 'true' then true "
                f"when {low} = 'false' then false else {bad} end")
    return f"{'cast' if strict else 'try_cast'}({c} as {t})"
