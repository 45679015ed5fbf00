import math

import pytest

from carelake.operators import quality


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", 1.0, True), ("a", None, False), ("b", math.nan, None), (None, 4.0, False)],
        "k string, v double, is_abnormal boolean",
    )


def test_value_counts_leave_out_nulls(table):
    assert [tuple(r) for r in quality.value_counts(table, "k").collect()] == [("a", 2), ("b", 1)]


def test_distinct_entities(table):
    assert quality.distinct_entities(table, "k").first()[0] == 2


def test_nan_counts_as_missing(table, rows):
    assert rows(quality.missing_report(table)) == [("is_abnormal", 1), ("k", 1), ("v", 2)]
    assert quality.completeness(table).first()[0] == pytest.approx((3 + 2 + 3) / 12 * 100)


def test_nothing_missing_gives_no_rows(table):
    assert quality.missing_report(table.where("k = 'a' and v = 1")).count() == 0


def test_abnormal_rate(table):
    assert quality.abnormal_rate(table).first()[0] == pytest.approx(100 / 3)
    assert quality.abnormal_rate(table.drop("is_abnormal")).first()[0] == 0.0


def test_profile_is_one_long_table(table):
    found = {(r.metric, r.column): r.value for r in quality.quality_profile(table, "t").collect()}
    assert found["records", None] == 4
    assert found["missing", "v"] == 2
    assert found["abnormal_rate_pct", None] == pytest.approx(100 / 3)


def test_overview_counts_empty_tables_too(table, rows):
    tables = {"full": table, "empty": table.where("false")}
    assert rows(quality.overview_counts(tables)) == [("empty", 0), ("full", 4)]


def test_consistency_counts_denied_rows_and_orphans(spark, rows):
    table = spark.createDataFrame(
        [("P1", "mg", "mg", "2024-01-01"), ("P2", "g", "mg", None), ("P9", None, "mg", "x"), ("P9", "g", "mg", "x"), (None, "mg", "mg", "x")],
        "patient_id string, unit string, expected string, date string",
    )
    parents = spark.createDataFrame([("P1",), ("P1",), ("P2",), (None,)], "id string")
    denials = {"other_unit": "unit <> expected", "undated": "date is null"}
    found = quality.consistency(table, "t", denials, {"patient": quality.Reference("patient_id", parents, "id")})
    assert rows(found) == sorted(
        [
            ("t", "consistent_pct", None, 60.0),
            ("t", "violations", "other_unit", 2.0),
            ("t", "violations", "undated", 1.0),
            ("t", "orphan_rows", "patient", 2.0),
            ("t", "orphan_keys", "patient", 1.0),
        ],
        key=repr,
    )
    nothing = quality.consistency(table.limit(0), "t", denials, {"patient": quality.Reference("patient_id", parents, "id")})
    assert {r.value for r in nothing.collect()} == {None, 0.0}
    assert rows(quality.consistency(table, "t")) == [("t", "consistent_pct", None, 100.0)]
