"""Unit harmonisation, reference ranges, required fields and rule-based repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.standardize import out_of_range
from carelake.operators.lookup import Dictionary, lookup


def harmonize_units(
    df: DataFrame, rules: Dictionary, test: str = "test_name", value: str = "value", unit: str = "unit"
) -> DataFrame:
    """Convert values whose (test, unit) has a rule; leave all others unchanged.

    A rule rounds to its number of digits, which may be negative; a rule
    without one does not round. The distinct numbers are read off the rules
    first, since rounding takes a literal.
    """
    asked = rules.table.select("digits").where("digits IS NOT NULL").distinct().collect()
    if any(abs(row[0]) > 308 for row in asked):
        raise ValueError("a rule rounds to more digits than a double has")
    found = lookup(
        df, rules, {test: "test", unit: "from_unit"}, ["to_unit", "divisor", "digits"]
    )
    ratio = F.col(value) / F.col("divisor")
    rounded = [F.when(F.col("digits") == d, F.round(ratio, d)) for d in sorted(row[0] for row in asked)]
    new_value = F.when(F.col("to_unit").isNull(), F.col(value)).otherwise(
        F.coalesce(*rounded, ratio)
    )
    new_unit = F.coalesce(F.col("to_unit"), F.col(unit))
    replaced = {value: new_value, unit: new_unit}
    return found.select(*[replaced.get(c, F.col(c)).alias(c) for c in df.columns])


def flag_range(
    df: DataFrame, tests: Dictionary, test: str = "test_name", value: str = "value"
) -> DataFrame:
    """Add ``ref_low``, ``ref_high`` and ``is_abnormal`` by test name.

    Both limits are inclusive; an unknown test or a missing value is not abnormal.
    """
    found = lookup(df, tests, {test: "name"}, ["low", "high"])
    return found.select(
        *df.columns,
        F.col("low").alias("ref_low"),
        F.col("high").alias("ref_high"),
        out_of_range(F.col(value), F.col("low"), F.col("high")).alias("is_abnormal"),
    )


def _missing(df: DataFrame, columns: Sequence[str]) -> Column:
    nulls = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    return F.concat_ws(",", *nulls)


def assert_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; the job fails on the first row that lacks a required field.

    The check is a filter, so it holds whichever columns a consumer reads.
    """
    missing = _missing(df, columns)
    failure = F.raise_error(F.concat(F.lit("required field missing: "), missing))
    return df.where(F.when(missing == "", F.lit(True)).otherwise(failure.cast("boolean")))


def split_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Complete rows, and the quarantined rest with a ``missing_fields`` column."""
    missing = _missing(df, columns)
    return df.where(missing == ""), df.where(missing != "").withColumn("missing_fields", missing)


def repair(
    df: DataFrame,
    drop_if_null: Sequence[str] = (),
    fill: dict[str, object] | None = None,
    null_if: dict[str, Column | str] | None = None,
) -> DataFrame:
    """Rule-based repair: blank out incoherent values, fill defaults, drop the rest.

    ``null_if`` maps a column to the condition under which its value is
    incoherent. Rules apply in that order.
    """
    for column, condition in (null_if or {}).items():
        bad = F.expr(condition) if isinstance(condition, str) else condition
        df = df.withColumn(column, F.when(F.coalesce(bad, F.lit(False)), None).otherwise(F.col(column)))
    if fill:
        df = df.na.fill(fill)
    return df.na.drop(subset=list(drop_if_null)) if drop_if_null else df
