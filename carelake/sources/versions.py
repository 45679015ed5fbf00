"""Folders whose content is replaced in one step.

A writer fills a folder of its own and then adds one row to the manifest; a
reader takes the newest row. Whoever reads while another writes, or after a
writer failed, sees the version before, whole.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from carelake.operators.lookup import local_table
from carelake.sources.tables import path_exists

MANIFEST = "number long, version string, options map<string,string>"


@dataclass(frozen=True)
class Version:
    """One complete content of a folder: its own ``path`` and what its writer noted."""

    path: str
    number: int
    options: dict[str, str] = field(default_factory=dict)


def new_version(root: str) -> str:
    """A path for the next content of ``root``, which no reader looks at yet."""
    return f"{root}/version-{uuid.uuid4().hex}"


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest committed version, or None."""
    if not path_exists(spark, f"{root}/manifest"):
        return None
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    newest = rows.orderBy(F.desc("number"), F.desc("version")).first()
    return Version(f"{root}/{newest['version']}", newest["number"], dict(newest["options"])) if newest else None


def commit(spark: SparkSession, root: str, path: str, **options: str) -> Version:
    """Make the content written to ``path`` the current one of ``root``.

    The manifest grows by one file with one row, which is there or not. Of two
    writers at once the one that commits last wins, and both contents stay.
    """
    before = current(spark, root)
    number = before.number + 1 if before else 1
    row = (number, path.removeprefix(f"{root}/"), options)
    local_table(spark, [row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return Version(path, number, options)
