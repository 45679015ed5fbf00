"""What is staged keeps no shuffle files."""

from carelake.llm.common import staged
from carelake.session import TIDY


def test_staging_removes_its_shuffle_files(spark, rows, shuffle_files):
    key = next(iter(TIDY))
    kept, before = spark.conf.get(key), shuffle_files()
    found = staged(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count())
    assert shuffle_files(since=before) == set()
    assert spark.conf.get(key) == kept
    assert len(rows(found)) == 7 and sum(n for _, n in rows(found)) == 100
