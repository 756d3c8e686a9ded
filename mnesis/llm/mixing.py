"""Mixing sources to target weights, with DataFrame functions alone.

Every document gets a hash-random key. Within a source, documents stand in the order of their keys; a prefix sum of
their sizes says how much of the source comes before each, and the mix is cut where the source's budget ends, in the
middle of a document if need be. A budget over the source's size takes the source whole as often as it fits and cuts
the rest. The prefix sums are made in two steps: over ranges of the key (as many for each source as there would be of
``RANGE`` rows if it had all of them), and within each range. Only the sums of ranges, and one row for each source, meet in
one task.

Sources rank by code point, null last, and their weights repeat along that order. Targets share ``share`` times all
words by weight; a target stops at ``cap`` times its source's size, and what it leaves is shared again by weight. The
level at which that settles is computed at once: with sources in order of cap over weight, the highest of the levels
that result when the first 0, 1, 2, ... sources stop at their caps.

Defined results: a null text has size 0 and stays, with nothing taken; null sources are a source of their own; repeated
rows count each; a source without words has target 0; a text of any length counts whole; rows of equal keys (equal doc_id and text) follow each other; an
empty table gives an empty table. Clashing extra columns don't matter: only doc_id, source and text are read, and the
columns of ``carry`` go along.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The pattern of a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a range of keys, about.
RANGE = 256


def sized(docs: DataFrame, carry: list[str], seed: str) -> DataFrame:
    """Columns of carry as fields of ``row``, size, and what orders the mix: grp, bucket and key."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))  # so that rows without doc_id, and rows that share one, spread
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    digits = max(2, math.ceil(math.log(max(1, docs.count() / RANGE), 16)))
    return docs.select(
        F.struct(*carry).alias("row"),
        F.col("doc_id").alias("tie"),
        F.col("source").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("grp"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        key.alias("key"),
        F.substring(key, 1, digits).alias("bucket"),
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """grp, source_size, target. One row for each source meets in the windows."""
    rank = Window.orderBy(F.col("source").isNull(), "source")
    by_cap = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double")
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap * F.col("source_size")).over(by_cap), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0))
    )
    return (
        sizes.withColumn("rank", F.row_number().over(rank))
        .withColumn("weight", weight)
        .withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("target", F.least((cap * F.col("source_size")).cast("double"), F.col("weight") * F.max("level").over(everything)))
        .select("grp", "source_size", "target")
    )


def mix(docs: DataFrame, carry: list[str], weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: int = 2, seed: str = "mix") -> DataFrame:
    """The columns of ``carry`` with size, source_size, target and taken for every row of docs."""
    rows = sized(docs, carry, seed)
    ranges = rows.groupBy("grp", "source", "bucket").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("grp", "source").agg(F.sum("range_size").alias("source_size")), weights, share, cap)
    ahead = Window.partitionBy("grp").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("grp", "bucket", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("range_start")).join(targets, "grp")
    inside = Window.partitionBy("grp", "bucket").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("in_range", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["grp", "bucket"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - F.col("range_start") - F.col("in_range")
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), rest))
    return placed.select("row.*", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself, with docs' columns: a row for each copy that it takes. Only the document at a source's cut is
    shortened, to its first words; n_chars follows where docs has it."""
    names = docs.columns
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("whole"), "doc_id", "source", "text")
    planned = mix(carried, ["whole"], **settings).where(F.col("taken") > 0)
    full = F.floor(F.col("taken") / F.col("size")).cast("int")
    partial = (F.col("taken") - full * F.col("size")).cast("int")
    copies = planned.withColumn("partial", partial).withColumn("copy", F.explode(F.sequence(F.lit(1), full + (partial > 0).cast("int")))).withColumn("cut", F.col("copy") > full)
    start = F.array_join(F.slice(F.regexp_extract_all(F.col("whole.text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), F.greatest(F.col("partial"), F.lit(1))), "")
    text = F.when(F.col("cut"), start).otherwise(F.col("whole.text"))
    changed = {"text": text, "n_chars": F.when(F.col("cut"), F.length(start).cast("long")).otherwise(F.col("whole.n_chars")) if "n_chars" in names else None}
    return copies.select(*[changed.get(c, F.col(f"whole.`{c}`")).alias(c) for c in names])


#: DuckDB's SQL for ``mix`` with its defaults over documents.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM s),
w AS (SELECT *, CAST([5, 2, 1][(rank - 1) % 3 + 1] AS DOUBLE) AS weight FROM r),
q AS (SELECT *, 2 * source_size / weight AS ratio FROM w),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM q),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM v),
b AS (SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN budget // source_size * size + least(size, greatest(0, budget % source_size - before)) ELSE 0 END AS BIGINT) AS taken
FROM b
"""
