"""Counts, completeness and other quality metrics, one pass per table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def overview_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table``, ``rows`` for each table; 0 for an empty one."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def value_counts(df: DataFrame, column: str, key: str = "value") -> DataFrame:
    """Rows per non-null value, most frequent first, ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(key))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), key)
    )


def distinct_entities(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-null values of a column."""
    return df.agg(F.count_distinct(column).alias("distinct_entities"))


def _known(df: DataFrame, column: str) -> Column:
    """The column with NaN, which counts as missing, turned into null."""
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(column), F.lit(None).cast("double"))
    return F.col(column)


def _null_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(_known(df, c).isNull()).alias(c) for c in df.columns]


def missing_report(df: DataFrame) -> DataFrame:
    """``column``, ``n_missing`` for the columns that have nulls."""
    counts = df.agg(*_null_counts(df))
    return counts.unpivot([], df.columns, "column", "n_missing").where("n_missing > 0")


def _completeness(df: DataFrame) -> Column:
    """Mean over columns of the share of known values, in percent."""
    filled = reduce(Column.__add__, [F.count(_known(df, c)) for c in df.columns])
    cells = F.count(F.lit(1)) * F.lit(len(df.columns))
    return F.when(cells > 0, filled * F.lit(100.0) / cells)


def completeness(df: DataFrame) -> DataFrame:
    return df.agg(_completeness(df).alias("completeness_pct"))


def _rate(df: DataFrame, flag: str) -> Column:
    if flag not in df.columns:
        return F.lit(0.0)
    return F.avg(F.col(flag).cast("int")) * 100


def abnormal_rate(df: DataFrame, flag: str = "is_abnormal") -> DataFrame:
    """Share of flagged rows in percent; 0.0 if the table has no such flag."""
    return df.agg(_rate(df, flag).alias("abnormal_rate_pct"))


def quality_profile(df: DataFrame, dataset: str, flag: str = "is_abnormal") -> DataFrame:
    """Long table ``dataset, metric, column, value`` from a single aggregate."""
    columns = df.columns
    totals = df.agg(
        F.count(F.lit(1)).cast("double").alias("__rows"),
        _completeness(df).alias("__completeness"),
        _rate(df, flag).alias("__rate"),
        *[F.count_if(_known(df, c).isNull()).cast("double").alias(c) for c in columns],
    )

    def metric(name: str, column: Column, value: str) -> Column:
        return F.struct(
            F.lit(name).alias("metric"), column.alias("column"), F.col(value).alias("value")
        )

    none = F.lit(None).cast("string")
    entries = [
        metric("records", none, "__rows"),
        metric("completeness_pct", none, "__completeness"),
        metric("abnormal_rate_pct", none, "__rate"),
        *[metric("missing", F.lit(c), f"`{c}`") for c in columns],
    ]
    return totals.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*entries)))


@dataclass(frozen=True)
class Reference:
    """Every known value of ``column`` is to occur in ``key`` of ``parent``."""

    column: str
    parent: DataFrame
    key: str


def orphans(df: DataFrame, reference: Reference) -> DataFrame:
    """``column`` and ``n`` (rows) of the values that the parent does not have.

    Rows are counted by value before they meet the parent's distinct keys, so
    a value that many rows share travels once per task.
    """
    column = reference.column
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    keys = reference.parent.select(F.col(reference.key).alias(column)).distinct()
    return counted.join(keys, column, "left_anti")


def consistency(
    df: DataFrame,
    dataset: str,
    denials: Mapping[str, str] | None = None,
    references: Mapping[str, Reference] | None = None,
) -> DataFrame:
    """Long table ``dataset, metric, column, value`` of what contradicts itself or other tables.

    ``denials`` names conditions that no row may meet; all are counted in one
    aggregate (``violations`` by name, and in ``consistent_pct`` the share of
    rows that meet none; a condition that is null is not met). ``references``
    adds, by name, the rows (``orphan_rows``) and values (``orphan_keys``)
    without a parent. An empty table has no share.
    """
    denials, none = dict(denials or {}), F.lit(None).cast("string")
    met = {name: F.coalesce(F.expr(condition), F.lit(False)) for name, condition in denials.items()}
    clean = reduce(Column.__and__, [~m for m in met.values()], F.lit(True))
    rows = F.count(F.lit(1))
    totals = df.agg(
        F.when(rows > 0, F.count_if(clean) * F.lit(100.0) / rows).alias("__clean"),
        *[F.count_if(m).cast("double").alias(name) for name, m in met.items()],
    )

    def metric(name: str, column: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), column.alias("column"), value.alias("value"))

    entries = [metric("consistent_pct", none, F.col("__clean"))]
    entries += [metric("violations", F.lit(name), F.col(f"`{name}`")) for name in met]
    parts = [totals.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*entries)))]
    for name, reference in (references or {}).items():
        lost = orphans(df, reference).agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("rows"), F.count(F.lit(1)).cast("double").alias("keys")
        )
        pair = [metric("orphan_rows", F.lit(name), F.col("rows")), metric("orphan_keys", F.lit(name), F.col("keys"))]
        parts.append(lost.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*pair))))
    return reduce(DataFrame.unionByName, parts)
