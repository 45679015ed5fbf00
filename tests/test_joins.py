import pytest
from pyspark.sql import functions as F

from carelake.operators.lookup import Dictionary, lookup, translate
from carelake.operators.skew import grid_join, hot_keys, hot_parts, salted_join, skew_join


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows share one key, a sixth have none, and copies occur."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 6 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    )
    return spark.range(6000).select(key.alias("key"), (F.col("id") % 900).alias("x"))


@pytest.fixture(scope="module")
def dims(spark):
    rows = [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("k2", 4), (None, 5), ("absent", 6)]
    return spark.createDataFrame(rows, "key string, y int")


def test_hot_keys_are_found_and_few(facts):
    assert set(hot_keys(facts, "key", share=0.1, min_rows=10)) == {"hot", None}
    assert hot_keys(facts, "key", share=0.1) == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("swap", [False, True])
def test_salted_join_equals_the_plain_join(facts, dims, rows, how, swap):
    left, right = (dims, facts) if swap else (facts, dims)
    expected = rows(left.join(right, "key", how).select("key", "x", "y"))
    assert rows(skew_join(left, right, "key", how, share=0.1, min_rows=1).select("key", "x", "y")) == expected
    hot_right = skew_join(right, left, "key", how, share=0.1, min_rows=1)
    assert rows(hot_right.select("key", "x", "y")) == rows(
        right.join(left, "key", how).select("key", "x", "y")
    )
    everything = salted_join(left, right, ["key"], ["hot", "k1", None], how, salts=5)
    assert rows(everything.select("key", "x", "y")) == expected


def test_hot_rows_spread_over_tasks(spark, facts, dims):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(facts, dims, ["key"], ["hot"], salts=16)
        tasks = joined.where("key = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks > 1


def test_parts_follow_the_share_of_a_key(spark, facts):
    assert hot_parts(facts, "key", share=0.1, min_rows=10) == {"hot": 4, None: 2}
    assert hot_parts(facts, "key", share=0.1, min_rows=1900) == {"hot": 2}
    assert hot_parts(facts.limit(0), "key", min_rows=0) == {}
    assert hot_parts(facts.where("key is null"), "key", min_rows=10) == {None: 50}




@pytest.mark.parametrize("a, b", [(1, 1), (4, 1), (1, 4), (3, 5)])
def test_grid_join_equals_the_plain_join(facts, rows, a, b):
    other = facts.select("key", (F.col("x") + 1).alias("y"), F.monotonically_increasing_id().alias("z")).where("x < 90")
    cells = {"hot": (a, b), "k2": (b, a), "absent": (2, 2), None: (2, 2)}
    expected = facts.join(other, "key").groupBy("key", "x", "y", "z").count()
    found = grid_join(facts, other, ["key"], cells).groupBy("key", "x", "y", "z").count()
    assert rows(found) == rows(expected)


def test_a_key_hot_on_the_right_is_cut_there_and_not_copied(spark, facts):
    """The left side has one row of the key: it is copied, the many right rows are not."""
    few = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, y int")
    text = skew_join(few, facts, "key", share=0.1, min_rows=10)
    logical = text._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Generate") == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = skew_join(few, facts, "key", share=0.05, min_rows=10).where("key = 'hot'")
        per_task = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(per_task) == 2000 and len(per_task) >= 3 and max(per_task) <= 1400


def test_a_left_join_does_not_cut_the_right_side(facts, dims):
    with pytest.raises(ValueError, match="right side"):
        grid_join(facts, dims, ["key"], {"hot": (1, 2)}, "left")


def test_other_join_kinds_are_refused(facts, dims):
    with pytest.raises(ValueError, match="full"):
        salted_join(facts, dims, ["key"], ["hot"], "full")


ENTRIES = [("hot", "warm"), ("k1", "one")]


def test_list_and_table_give_the_same_lookup(spark, facts, rows):
    table = spark.createDataFrame(ENTRIES, "key string, label string")
    fields = "key string, label string"
    small = Dictionary.of(spark, ENTRIES, fields, ["key"])
    checked = Dictionary.of(spark, table, fields, ["key"])
    large = Dictionary.of(spark, table, fields, ["key"], max_rows=1)
    assert (small.small, checked.small, large.small) == (True, True, False)
    found = [rows(translate(facts, "key", d, "label", "l", "?")) for d in (small, checked, large)]
    assert found[0] == found[1] == found[2]
    assert {r[2] for r in found[0]} == {"warm", "one", "?"}


def test_a_large_dictionary_is_not_broadcast_by_hint(spark, facts):
    table = spark.createDataFrame(ENTRIES, "key string, label string")
    large = Dictionary.of(spark, table, "key string, label string", ["key"], max_bytes=3)
    plan = lookup(facts, large, {"key": "key"}, ["label"])._jdf.queryExecution().logical().toString()
    assert not large.small and "broadcast" not in plan.lower()


def test_repeated_keys_are_refused(spark):
    twice = [("a", "1"), ("a", "2")]
    with pytest.raises(ValueError, match="not unique"):
        Dictionary.of(spark, twice, "key string, label string", ["key"])
    with pytest.raises(ValueError, match="not unique"):
        table = spark.createDataFrame(twice, "key string, label string")
        Dictionary.of(spark, table, "key string, label string", ["key"])


def test_hot_keys_of_a_large_dictionary_can_be_looked_for_elsewhere(spark, facts, rows):
    entries = Dictionary.of(spark, [("hot", 1), ("k1", 2)], "key string, y int", ["key"], max_rows=1)
    assert not entries.small
    # A key that cannot be worked out: whoever reads it to plan the join fails.
    dear = facts.select(F.raise_error(F.concat(F.lit("read "), "key")).cast("string").alias("key"), "x")
    lookup(dear, entries, {"key": "key"}, ["y"], keys=facts.select("key"))
    plain = facts.select("key", "x")
    found = lookup(plain, entries, {"key": "key"}, ["y"], keys=facts.select("key"))
    assert rows(found) == rows(lookup(plain, entries, {"key": "key"}, ["y"]))
