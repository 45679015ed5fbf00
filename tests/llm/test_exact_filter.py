"""The filter that keeps texts of unrepeated digests where they are."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import exact
from carelake.llm.common import table

SF = "/root/testdata/sf0.001"


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_bloom_filter_loses_no_key_and_passes_few_others(spark):
    rows = [(digest(i),) for i in range(20_000)]
    made = exact.build_bloom(spark.createDataFrame(rows, "digest binary").repartition(5), exact.bloom_bits(20_000))
    assert made.may_hold(exact._keys([r[0] for r in rows])).all()
    others = made.may_hold(exact._keys([digest(i) for i in range(50_000, 90_000)]))
    assert others.mean() < 0.02
    assert exact.bloom_bits(10**12) == exact.BLOOM_BITS and len(made.bits) * 8 == exact.bloom_bits(20_000)
    nothing = exact.build_bloom(spark.createDataFrame([], "digest binary"), 1 << 16)
    assert not nothing.may_hold(exact._keys([digest(1)])).any()


@pytest.mark.parametrize("width", [32, 1])
def test_a_small_limit_shows_the_same_rows(spark, width):
    docs = table(spark, SF, "documents")

    def result(keys):
        return sorted(tuple(r) for r in exact.dedup(docs, digest_bytes=width, screen_keys=keys).collect())

    assert result(0) == result(exact.MAX_SCREEN_KEYS)


def test_texts_of_unrepeated_digests_are_not_shuffled(spark):
    words = F.concat(F.lit("text "), F.when(F.col("id") % 100 == 0, F.lit(0)).otherwise(F.col("id")).cast("string"))
    texts = spark.range(10_000).select(F.col("id").alias("doc_id"), words.alias("text"))
    repeated = spark.createDataFrame([(hashlib.sha256(b"text 0").digest(),)], "digest binary")
    read = exact._wanted(texts, repeated, 32, screen_keys=0)
    assert 100 <= read.count() <= 100 + 10_000 * 0.02
    text = exact._wanted(texts, repeated, 32, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
