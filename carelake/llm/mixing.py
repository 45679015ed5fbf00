"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelake.llm.common import staged, take, whole_text

WORD = r"[^\x20\x09-\x0D]+"
SLICE_DIGITS = 3


def source_targets(
    sources: DataFrame, weights: Sequence[float], share: float, max_epochs: float
) -> DataFrame:
    """``target`` per row of (source, source_size).

    Sources by code point, null last, take the weights in turn. Targets add up
    to ``share`` of all sizes where the caps allow it; a target stops at
    ``max_epochs`` times its source and the excess goes to the others by
    weight. Clamping and resharing until nothing is above its cap ends at one
    water level: with the sources ordered by cap per weight, it is the largest
    of the levels that each suffix of them would get alone. One row per source
    passes through this step.
    """
    listed = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(listed) - 1) % len(weights)
    weighed = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    ).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    all_rows = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(all_rows)
    levels = weighed.withColumn("level", (F.lit(float(share)) * total - before) / rest)
    level = F.max("level").over(all_rows)
    return levels.select(
        "source", "source_size", F.least("cap", level * F.col("weight")).alias("target")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix-1",
) -> DataFrame:
    """How often each document enters the mix: one row per document.

    Columns: ``doc_id``, ``source``, ``size`` (words), ``source_size``,
    ``target`` (words, of the source), ``taken`` (words, repeats counted) and
    ``copies`` (whole documents).

    A source is repeated whole ``floor(target / source_size)`` times; the rest
    comes from its documents in an order drawn from the seed and ``doc_id``.
    ``taken`` cuts the last of them where the target is met; ``copies`` rounds
    that one to the nearer whole. The running sums of that order are taken
    within 4096 slices of each source and the slices are summed first, so a
    source of any size spreads over many tasks.

    A null text has no words, a null source is a source of its own, a null
    ``doc_id`` is drawn like any other value. Rows that repeat a document are
    documents of their own. A source without words has target 0. An empty
    table gives an empty result.
    """
    words = F.regexp_count(whole_text(), F.lit(WORD)).cast("long")
    sized = staged(
        take(docs, "doc_id", "text", "source").select("doc_id", "source", words.alias("size"))
    )
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    drawn = sized.withColumn("draw", F.md5(F.concat(F.lit(f"{seed}:"), named))).withColumn(
        "slice", F.substring("draw", 1, SLICE_DIGITS)
    )
    slices = drawn.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    sources = slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    targets = source_targets(sources, weights, share, max_epochs).withColumnRenamed("source", "of")
    ordered = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    started = slices.withColumn("before", F.coalesce(F.sum("slice_size").over(ordered), F.lit(0)))
    plan = started.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("of").alias("in_source"), F.col("slice").alias("in_slice"), "before", "source_size", "target"
    )
    same = F.col("source").eqNullSafe(F.col("in_source")) & (F.col("slice") == F.col("in_slice"))
    running = W.partitionBy("source", "slice").orderBy("draw", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = drawn.join(plan, same).withColumn(
        "start", F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    left = F.col("target") - F.col("epochs") * F.col("source_size") - F.col("start")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("left"))).cast("long")
    once_more = (F.col("left") > 0) & (F.col("left") * 2 >= F.col("size")) & (F.col("size") > 0)
    return (
        placed.withColumn("epochs", epochs)
        .withColumn("left", left)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("epochs") * F.col("size") + part).alias("taken"),
            (F.col("epochs") + once_more.cast("long")).alias("copies"),
        )
    )


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them whole, with all their columns.

    Rows with the same id, source and size are interchangeable; where the mix
    takes them differently often, each gets one of their counts.
    """
    names = list(docs.columns)
    doc_id, text, source = (f"__c{names.index(n)}" for n in ("doc_id", "text", "source"))
    plain = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    words = F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")
    alike = W.partitionBy("doc_id", "source", "size").orderBy("copies")
    counts = mix(docs, **options).select("doc_id", "source", "size", "copies")
    counts = counts.withColumn("nth", F.row_number().over(alike)).where("copies > 0")
    counts = counts.toDF("m_doc", "m_source", "m_size", "copies", "m_nth")
    rows = plain.withColumn("size", words)
    rows = rows.withColumn("nth", F.row_number().over(W.partitionBy(doc_id, source, "size").orderBy(F.xxhash64(text))))
    same = (
        F.col(doc_id).eqNullSafe(F.col("m_doc"))
        & F.col(source).eqNullSafe(F.col("m_source"))
        & (F.col("size") == F.col("m_size"))
        & (F.col("nth") == F.col("m_nth"))
    )
    joined = rows.join(counts, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return joined.select(*[f"__c{i}" for i in range(len(names))]).toDF(*names)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(cast(doc_id AS varchar), 'null')) AS draw
  FROM documents),
sources AS (
  SELECT source, cast(sum(size) AS bigint) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::double WHEN 1 THEN 2.0::double ELSE 1.0::double END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0::double * source_size AS cap,
    (1.5::double * cast(sum(source_size) OVER () AS bigint)
      - coalesce(sum(2.0::double * source_size) OVER (ORDER BY 2.0::double * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::double))
    / sum(weight) OVER (ORDER BY 2.0::double * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN cast(floor(t.target / t.source_size) AS bigint) ELSE 0 END AS epochs,
    cast(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  epochs * size + cast(greatest(0, least(size, floor(target - epochs * source_size - start))) AS bigint) AS taken
FROM placed
"""
