"""Session settings and the shared scratch folder."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Found = TypeVar("Found")
JOBS_AT_ONCE = 4

# Runtime SQL settings the jobs rely on. AQE re-plans joins from measured
# sizes, so a side is only broadcast once its real size is known, and it
# splits skewed shuffle partitions even where that costs one more exchange.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Shuffle files of an action go when it ends. Else they stay until the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_SETTINGS` to a session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, **wanted: str) -> Iterator[None]:
    """Settings of the session that hold for one action and are then as before."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the folder all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session
    without that setting falls back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="carelake-")
    return posixpath.join(base, f"{purpose}-{uuid.uuid4().hex}")


def concurrently(spark: SparkSession, actions: Sequence[Callable[[], Found]]) -> list[Found]:
    """Results of independent actions, a few of them submitted at a time.

    While the last tasks of one job run, those of the next fill the cluster.
    """
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        return [job.result() for job in running]
