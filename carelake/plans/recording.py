"""Writes that note what went into them: lineage from the plans, records from the writes themselves."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from carelake.operators.lookup import local_table
from carelake.session import TIDY, concurrently, settings
from carelake.sources.tables import NEIGHBOURS, PARQUET

LINEAGE = "derived string, source string, step string, records long"
Writer = Callable[[DataFrame, str], None]


def folder(location: str) -> str:
    """The path of a location, without its file system."""
    return urlsplit(location).path.rstrip("/")


def source_paths(df: DataFrame) -> set[str]:
    """Paths of the files and folders that the analysed plan of ``df`` reads, used columns or not."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            roots = relation.location().rootPaths()
            found |= {folder(roots.apply(j).toString()) for j in range(roots.size())}
    return found


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**PARQUET, **NEIGHBOURS).parquet(path)


class Recorder:
    """Writes tables and keeps, for each, the known datasets that its plan reads.

    ``known`` maps locations to dataset names; a path belongs to the dataset
    whose location it lies in. What is staged on the way stands for its own
    sources. Paths of no known dataset are left out.
    """

    def __init__(self, spark: SparkSession, known: dict[str, str]) -> None:
        self.spark = spark
        self.names = {folder(location): {name} for location, name in known.items()}
        self.rows: list[tuple[str, str, str, int]] = []

    def sources(self, df: DataFrame) -> set[str]:
        """The datasets that ``df`` reads."""
        found: set[str] = set()
        for path in source_paths(df):
            held = [location for location in self.names if path == location or path.startswith(f"{location}/")]
            if held:
                found |= self.names[max(held, key=len)]
        return found

    def stage(self, df: DataFrame, path: str) -> DataFrame:
        """``df`` written and read back; whoever reads it has read its sources."""
        self.names[folder(path)] = self.sources(df)
        _replace(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write(self, dataset: str, df: DataFrame, path: str, step: str, writer: Writer = _replace) -> None:
        """Write a dataset; its records are counted as they pass, by the write itself."""
        sources, passed = self.sources(df), Observation()
        writer(df.observe(passed, F.count(F.lit(1)).alias("records")), path)
        records = passed.get["records"]
        self.rows += [(dataset, source, step, records) for source in sorted(sources)]
        self.names[folder(path)] = {dataset}

    def write_all(self, path: str, zone: str, tables: dict[str, tuple[DataFrame, str]], writers: dict[str, Writer] | None = None) -> None:
        """Write the tables (each with the step that made it) of a zone below ``path``, some at a time."""
        writers = writers or {}
        writes = [
            partial(self.write, f"{zone}/{name}", df, f"{path}/{name}", step, writers.get(name, _replace))
            for name, (df, step) in tables.items()
        ]
        with settings(self.spark, **TIDY):
            concurrently(self.spark, writes)

    def lineage(self) -> DataFrame:
        """``derived, source, step, records`` of each write and each dataset it read."""
        return local_table(self.spark, sorted(self.rows), LINEAGE)
