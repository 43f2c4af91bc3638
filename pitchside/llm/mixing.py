"""Mixing sources to target weights, in DataFrame operations only.

Sources in code-point order (null last) weigh ``weights[0], weights[1], ...``,
repeating, and share the words of all documents.  A target stops at ``most``
times its source's words; the excess goes to the others by weight until none is
above (solved at once: sorted by cap per weight, the stopped sources are a prefix).

Every document gets a hash-random key (md5 over doc_id, source and text).  Each
source is range-sorted by it, a distributed prefix sum of the word counts places
every document, and the source is cut at its exact budget: whole epochs first,
then the documents before the cut; the one at the cut gives the words that are
left.  The key depends on the row alone, so reruns agree.

Edge cases: null or empty texts have no words and take none; null sources are a
source of their own; rows equal in doc_id, source and text are neighbours, and
which of them the cut falls on makes no difference to the result; no rows give no
rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import running_total, saved

WORD = r"[^\x20\x09-\x0D]+"


def mix_key() -> Column:
    part = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source")]
    return F.md5(F.concat_ws(":", *part, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).cast("binary"))


def targets(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """One row per source (source, source_size) -> plus ``target`` (double).

    The windows here run over one row per source, not over documents.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int")))
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.lit(float(most)) * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    above = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "cap": F.lit(float(most)) * F.col("source_size"),
        "left": F.sum("source_size").over(every) - F.lit(float(most)) * F.coalesce(F.sum("source_size").over(above), F.lit(0)),
        "left_weight": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(above), F.lit(0.0)),
    }).withColumn("level", F.col("left") / F.col("left_weight"))
    free = F.col("cap") / F.col("weight") > F.col("level")
    rows = rows.withColumn("level", F.max(F.when(free, F.col("level"))).over(every))  # it falls after the first free source
    return rows.select("source", "source_size", F.coalesce(
        F.least("cap", F.col("weight") * F.col("level")), F.col("cap")).alias("target"))


def mix_to_weights(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, mix_key), one row per document."""
    rows = saved(docs.select(
        F.col("doc_id"), F.col("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        mix_key().alias("mix_key"),
    ), "sizes")
    sources = saved(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")
    part = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "source"))
    rows = rows.withColumns({"part": part, "bin": F.substring("mix_key", 1, 3)})
    rows = running_total(rows, ["part"], "bin", ["mix_key", "doc_id", "size"], F.col("size"), "before")
    sources = sources.select(part.alias("part"), "source_size", "target")
    rows = rows.join(sources, "part")
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("before")))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "mix_key")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3) -> DataFrame:
    """The mix as documents: each row as often as its taken words fill it (the one
    document at a source's cut is rounded to whole copies).

    Documents without words take no part in a mix of words and stay once.
    """
    plan = mix_to_weights(docs, weights, most).groupBy(F.col("mix_key").alias("__mix_key")).agg(F.when(
        F.sum("size") > 0, F.round(F.sum("taken") / F.sum("size"))).otherwise(F.lit(1)).cast("int").alias("__copies"))
    rows = docs.withColumn("__mix_key", mix_key()).join(plan.where("__copies > 0"), "__mix_key")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight FROM s),
l AS (SELECT *, 3.0::DOUBLE * source_size AS cap,
        (sum(source_size) OVER ())::DOUBLE - 3.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight,
          source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS room,
        sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight,
          source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room_weight FROM w),
v AS (SELECT *, max(CASE WHEN cap / weight > room / room_weight THEN room / room_weight END) OVER () AS level FROM l),
t AS (SELECT source, source_size, coalesce(least(cap, weight * level), cap) AS target FROM v),
b AS (SELECT source, source_size, target, CAST(round(target) AS BIGINT) AS budget,
        CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT p.doc_id, p.size, b.source_size, b.target,
       CAST(b.epochs * p.size + greatest(0, least(p.size, b.budget - b.epochs * b.source_size - p.before)) AS BIGINT) AS taken
FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source
"""
