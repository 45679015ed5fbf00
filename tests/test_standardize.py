import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from carelake.functions import standardize as std
from carelake.functions.identity import node_id, pseudonym, surrogate_uid


def one(spark, expression, value=None, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expression(F.col("x"))).first()[0]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("value", ["P0001", "", "é µ", "a" * 500])
def test_pseudonym_is_the_hash_head(spark, value):
    assert one(spark, pseudonym, value) == sha(value)[:16]


def test_pseudonym_of_nothing_is_null(spark):
    assert one(spark, pseudonym, None) is None


def test_pseudonym_of_a_number_hashes_its_text(spark):
    assert one(spark, lambda c: pseudonym(c, 12), 42, "long") == sha("42")[:12]


def test_surrogate_uid_matches_big_integers(spark):
    seeds = [f"study-{i}-P{i % 7:04d}" for i in range(500)] + [""]
    df = spark.createDataFrame([(s,) for s in seeds], "seed string")
    for row in df.select("seed", surrogate_uid(F.col("seed")).alias("uid")).collect():
        number = int(sha(row.seed), 16) % 10**18
        assert row.uid == f"1.2.826.0.1.3680043.10.543.{number}"


def test_node_id_with_a_missing_part(spark):
    df = spark.createDataFrame([("P1", "Aspirin", None)], "p string, d string, t string")
    found = df.select(node_id(F.col("p"), F.col("d"), F.col("t")).alias("id")).first()
    assert found.id == sha("2:P17:Aspirin-")[:32]


def test_node_ids_of_keys_that_run_into_each_other_differ(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("123", ""), ("123", None)], "p string, d string")
    assert df.select(node_id(F.col("p"), F.col("d")).alias("id")).distinct().count() == 4


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("20240131", datetime.date(2024, 1, 31)),
        ("2024-01-31", datetime.date(2024, 1, 31)),
        ("31/01/2024", datetime.date(2024, 1, 31)),
        ("20241399", None),
        ("soon", None),
        (None, None),
    ],
)
def test_to_date(spark, raw, expected):
    assert one(spark, lambda c: std.to_date(c, ["dd/MM/yyyy"]), raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("20240131", "2024-01-31"), ("20241399", "2024-13-99"), ("2024-01-31", "2024-01-31"), ("x", "x")],
)
def test_date_text_cuts_without_checking(spark, raw, expected):
    assert one(spark, std.date_text, raw) == expected


@pytest.mark.parametrize(
    "first, last, expected",
    [("Leila", "El Amrani", "Leila El Amrani"), ("Leila", None, "Leila"), (None, "X", "X"), (None, None, "")],
)
def test_full_name(spark, first, last, expected):
    df = spark.createDataFrame([(first, last)], "a string, b string")
    assert df.select(std.full_name(F.col("a"), F.col("b"))).first()[0] == expected


@pytest.mark.parametrize("raw, expected", [("Patient/P1", "P1"), ("P1", "P1"), ("a/b/P1", "P1"), (None, None)])
def test_reference_id(spark, raw, expected):
    assert one(spark, std.reference_id, raw) == expected


@pytest.mark.parametrize(
    "value, expected",
    [(69.9, True), (70.0, False), (100.0, False), (140.0, False), (140.1, True), (None, False), (float("nan"), False)],
)
def test_range_limits_are_inclusive(spark, value, expected):
    flag = lambda c: std.out_of_range(c, F.lit(70.0), F.lit(140.0))
    assert one(spark, flag, value, "double") is expected


def test_no_range_is_never_abnormal(spark):
    none = F.lit(None).cast("double")
    assert one(spark, lambda c: std.out_of_range(c, none, none), 1e9, "double") is False


@pytest.mark.parametrize("raw, expected", [("1.5", 1.5), ("abc", None), (None, None), ("", None)])
def test_number(spark, raw, expected):
    assert one(spark, std.number, raw) == expected
