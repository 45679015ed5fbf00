"""Graphs kept as Parquet: one directory per predicate, bucketed and sorted by subject.

All triples of a subject lie in the bucket of the same number, whatever their
predicate, so patterns that share a subject are joined without an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from carelake import schemas
from carelake.operators.match import HOT_SHARE, Graph, graph_of, hot_terms, profile, surveyed
from carelake.operators.skew import MIN_HOT_ROWS
from carelake.session import TIDY, settings
from carelake.sources import versions
from carelake.sources.tables import PARQUET, write_tables

HOT_TERMS = "p string, kind string, position string, term string, parts int"
PROFILE = "p string, subject string, position string, kind string, rows long, distinct long, numbers array<double>, sketch binary"
# Triples that a bucket should hold, and the least and most buckets.
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 4_000_000, 8, 1 << 14
# A task then sorts the triples of one bucket, not of several.
ONE_BY_ONE = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
# Subjects are sorted; this version of the format stores of each only what differs from the one before, if it has no dictionary.
# At a higher level the codec spends more on chance repeats of hex digits than they save.
SORTED = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#s": "false", "parquet.compression.codec.zstd.level": "2"}

# Predicates of a bucket that are written at the same time, each in the order of its subjects, so that Spark does not sort
# the triples by predicate first. Those of more predicates are sorted.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "48"}


def buckets_for(triples: int) -> int:
    """The power of two that gives each bucket about :data:`BUCKET_ROWS` triples."""
    wanted = -(-triples // BUCKET_ROWS)
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(wanted - 1, 0).bit_length()))


def save_graph(
    triples: DataFrame | Sequence[DataFrame],
    path: str,
    share: float = HOT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
    buckets: int | None = None,
    by_subject: bool = False,
) -> None:
    """Write the triples, then the hot terms and the profile of what was written, and commit all three as one version.

    A pattern with a constant predicate then reads one directory only. Files
    are sorted by subject, so that a node kind is a run of row groups. Without
    ``buckets`` there are as many as the session's shuffle partitions; take
    :func:`buckets_for` where the number of triples is known. ``by_subject``
    tells that the triples' own plan deals them by subject and sorts those of a
    kind, as that of ``build_graph`` can, so they need no exchange and no sort more; its
    exchanges then have one partition a bucket. Otherwise a bucket would only
    have more files, and less dense ones.

    Several DataFrames are parts that share no triple. They are written one
    after the other, and the shuffle files of one go before the next begins.
    """
    parts = [triples] if isinstance(triples, DataFrame) else list(triples)
    spark = parts[0].sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    version = versions.new_version(path)
    name = _table_name(version)
    by_bucket = {**ONE_BY_ONE, "spark.sql.shuffle.partitions": str(count)} if by_subject else {}
    with settings(spark, **TIDY, **UNSORTED, **by_bucket):
        for part in parts:
            placed = part.select(schemas.TRIPLES.names)
            if not by_subject:
                placed = placed.repartition(count, "s").sortWithinPartitions("s")
            writer = placed.write.mode("append").options(**PARQUET, **SORTED).partitionBy("p").bucketBy(count, "s")
            writer.option("path", f"{version}/triples").saveAsTable(name)
    # The files are the graph; whoever reads it declares them again.
    spark.sql(f"DROP TABLE {name}")
    written = spark.read.schema(schemas.TRIPLES).parquet(f"{version}/triples")
    sketches = surveyed(written).persist()
    try:
        write_tables({"hot_terms": hot_terms(written, share, min_rows, sketches)}, version)
        write_tables({"profile": profile(written, sketches)}, version)
    finally:
        sketches.unpersist()
    versions.commit(spark, path, version, buckets=str(count))


def _table_name(version: str) -> str:
    return "carelake_" + version.rpartition("/")[2].replace("-", "_")


def _declared(spark: SparkSession, version: versions.Version) -> DataFrame:
    """The written triples as a table of this session, which knows their buckets."""
    name = _table_name(version.path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.TRIPLES.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (p) "
            f"CLUSTERED BY (s) SORTED BY (s) INTO {int(version.options['buckets'])} BUCKETS "
            f"LOCATION '{version.path}/triples'"
        )
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name).select(schemas.TRIPLES.names)


def load_graph(spark: SparkSession, path: str) -> Graph:
    """The graph as last committed."""
    version = versions.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"no graph at {path}")
    hot = spark.read.schema(HOT_TERMS).parquet(f"{version.path}/hot_terms")
    return graph_of(_declared(spark, version), hot, spark.read.schema(PROFILE).parquet(f"{version.path}/profile"))


def graph_exists(spark: SparkSession, path: str) -> bool:
    return versions.current(spark, path) is not None
