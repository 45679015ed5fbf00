"""Hard negatives against scoring all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from carelake.llm import negatives
from carelake.llm.common import table
from check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, LABEL int, number int, block int, held int, `a.b` int"


def by_all_rows(rows, every=100):
    good = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for a_id, a_label, a in good:
        if a_id % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a, v, strict=False)), i, lab) for i, lab, v in good if i != a_id))
        for p, p_id, _ in [s for s in scored if s[2] == a_label][:5]:
            fits = [s for s in scored if s[2] != a_label and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [(a_id, p_id, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(fits[:5])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def mine(df, **options):
    return negatives.mine(df, label=negatives.relabelled(), **options)


@pytest.mark.parametrize("dimensions", [1, 3, 64, 100])
def test_bounds_hold_the_product(dimensions):
    dice = np.random.default_rng(4)
    rows = np.floor(dice.normal(size=(300, dimensions)) * dice.choice([0, 1, 50, 4000], (300, 1)))
    anchors = rows[::7]
    assert np.allclose(negatives.rotated(rows) @ negatives.rotated(anchors).T, rows @ anchors.T, atol=1e-3)
    widths = []
    for levels in (1, 2, 4):
        codes = negatives.Codes(rows, levels)
        below, above = codes.bounds(anchors, slice(None))
        true = anchors @ rows.T
        assert (below <= true).all() and (true <= above).all()
        widths.append((above - below).sum())
    assert widths[0] > widths[1] > widths[2]
    part = negatives.Codes(rows).bounds(anchors, slice(10, 20))[0]
    assert np.allclose(part, negatives.Codes(rows).bounds(anchors, slice(None))[0][:, 10:20])


def test_intervals_rule_rows_out():
    dice = np.random.default_rng(4)
    rows = np.floor(256 * (lambda x: x / np.linalg.norm(x, axis=1)[:, None])(dice.normal(size=(4000, 64))))
    below, above = negatives.Codes(rows).bounds(rows[:40], slice(None))
    scores = rows[:40] @ rows.T
    limit = np.sort(scores, axis=1)[:, -6]
    assert (above >= 0.8 * limit[:, None]).mean() < 0.25


def test_given_vectors_equal_all_rows(spark):
    rows = [tuple(r) for r in table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    expected = by_all_rows(rows)
    assert expected and result(mine(table(spark, SF, "embeddings"))) == expected
    assert result(mine(table(spark, SF, "embeddings"), held=70)) == expected


def test_query_equals_its_sql(spark):
    key = "op12_hard_negatives"
    assert compare(spark, duck(SF), SF, key, contract.oracle_sql()[key]) == ""


def test_ties_hot_vectors_and_signs(spark):
    dice = random.Random(9)
    rows = [(i, [dice.choice([-1.0, 0.0, 0.5]) for _ in range(3)], dice.choice([0, 1])) for i in range(600)]
    rows += [(1000 + i, [0.5, 0.5, 0.5], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert result(mine(df, held=128)) == by_all_rows(rows)


def test_odd_rows_and_empty_tables(spark):
    good = [(i, [math.sin(i), math.cos(i), 0.1], i % 2) for i in range(0, 1000, 10)]
    bad = [
        (None, [1.0, 1.0, 1.0], 1), (100, None, 1), (200, [1.0, None, 1.0], 1), (300, [float("nan"), 1.0, 1.0], 1),
        (400, [float("inf"), 1.0, 1.0], 1), (500, [1.0, 1.0, 1.0], None), (1100, [], 0), (1200, [5.0], 0),
    ]
    rows = [*good, *bad]
    df = spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], SCHEMA)
    assert result(mine(df)) == by_all_rows(rows)
    assert mine(df.limit(0)).count() == 0
    assert mine(df.where("vec_id = 100 or vec_id = 1100")).count() == 0
    assert mine(df).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.8, 0.0], 2), (2, [0.8, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = result(negatives.mine(df, label=F.col("label")))
    score = 256 * 204
    assert found == sorted([(0, 1, k, 2, 256 * 230, score) for k in (1, 2)] * 2)
    large = [(i, [1e6 * (i + 1)] * 3, i % 2) for i in range(0, 40)]
    df = spark.createDataFrame(large, "vec_id long, embedding array<double>, label int")
    assert result(mine(df)) == by_all_rows(large)
