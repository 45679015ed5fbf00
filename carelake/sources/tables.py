"""Readers and writers of flat and nested tables."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.session import concurrently

# Where a reader puts a record that it could not parse, and the file it was in.
CORRUPT, FILE = "__corrupt", "__file"
# Ids are hex digits, which Spark's default codec stores as they are and this one in half the bytes.
PARQUET = {"compression": "zstd"}
# Ids of things that have few rows each mostly follow their neighbours; without a dictionary, this version of the format
# stores what differs from the one before.
NEIGHBOURS = {"parquet.writer.version": "PARQUET_2_0"} | {
    f"parquet.enable.dictionary#{c}": "false" for c in ("dicom_id", "study_uid", "series_uid", "file_path")
}
NOT_FOUND = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")

# ----------------------------------------------------------------------- read


@dataclass(frozen=True)
class Parsed:
    """Rows that could be read, and the ``file`` and ``record`` of those that could not."""

    table: DataFrame
    quarantine: DataFrame

    def counts(self) -> DataFrame:
        """``file``, ``n_rejected``: how many records of each file were set aside."""
        return self.quarantine.groupBy("file").agg(F.count(F.lit(1)).alias("n_rejected"))


def _split(read: DataFrame) -> Parsed:
    """Divides rows read with :data:`CORRUPT` by whether that column is filled."""
    kept = [F.col(f"`{c}`") for c in read.columns if c not in (CORRUPT, FILE)]
    # Spark reads that column only together with another one; this holds for every row.
    with_another = F.length(F.concat_ws("", kept[0].cast("string"))) >= 0
    bad = read.where(F.col(CORRUPT).isNotNull() & with_another)
    return Parsed(read.where(F.col(CORRUPT).isNull()).select(*kept), bad.select(F.col(FILE).alias("file"), F.col(CORRUPT).alias("record")))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def csv_headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """The distinct header lines below ``path``, as names, and the files that have each.

    The first line of a file is the first row of its first block, so this is
    one pass over the text, without parsing it; only file names and headers
    reach the driver. An empty file has no header.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = lines.where("file_block_start = 0").withColumn("at", F.monotonically_increasing_id())
    headers = first.groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found = headers.groupBy("header").agg(F.array_sort(F.collect_list("file_path")).alias("files")).orderBy("files").collect()
    return [(next(csv.reader([r["header"].removeprefix("\ufeff")]), []), r["files"]) for r in found]


def _csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, object], set_aside: bool) -> DataFrame:
    parts = []
    for names, files in csv_headers(spark, path):
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {files[0]}")
        # Every place of the header gets a column; a name that repeats counts where it stands first.
        places = [
            T.StructField(name, schema[name].dataType) if name in schema.names and names.index(name) == i else T.StructField(f"__{i}", T.StringType())
            for i, name in enumerate(names)
        ]
        whole = T.StructType(places)
        reader = spark.read.schema(_with_corrupt(whole) if set_aside else whole).options(**options)
        read = reader.csv([unquote(f) if f.startswith("file:") else f for f in files])
        extra = [F.col("_metadata.file_path").alias(FILE), CORRUPT] if set_aside else []
        parts.append(read.select(*[F.col(f"`{n}`") for n in schema.names], *extra))
    if parts:
        return reduce(DataFrame.unionByName, parts)
    more = [T.StructField(FILE, T.StringType()), T.StructField(CORRUPT, T.StringType())] if set_aside else []
    return spark.createDataFrame([], T.StructType([*schema.fields, *more]))


def _csv_options(multi_line: bool, set_aside: bool) -> dict[str, object]:
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} if set_aside else {"mode": "FAILFAST"}
    # A row with too few or too many fields is noticed only if all of its columns are parsed.
    return {"header": True, "escape": '"', "multiLine": multi_line, "columnPruning": False, **mode}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.EHR_PATIENTS, multi_line: bool = False
) -> DataFrame:
    """CSV files with a header line each; columns are found by their names in the file's own header.

    Columns that ``schema`` does not name are left out; a file that lacks one
    of its columns is refused. A row that is shorter or longer than its header,
    or a value that is not of its type, fails the job; see
    :func:`read_csv_set_aside`. Quotes inside a quoted field are doubled. With
    ``multi_line``, a quoted field may hold line breaks, and a file is then
    read by one task.
    """
    return _csv(spark, path, schema, _csv_options(multi_line, False), False)


def read_csv_set_aside(
    spark: SparkSession, path: str, schema: T.StructType = schemas.EHR_PATIENTS, multi_line: bool = False
) -> Parsed:
    """The same, but rows that :func:`read_csv` would fail at come back on their own."""
    return _split(_csv(spark, path, schema, _csv_options(multi_line, True), True))


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType = schemas.LAB_DOCUMENT
) -> DataFrame:
    """Files that each hold one JSON array of objects.

    Such a file cannot be split: it is one task. Have many files, and land the
    result as Parquet once if it is read again.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)


def read_ndjson(
    spark: SparkSession, path: str, schema: T.StructType = schemas.CLINICAL_RESOURCE
) -> DataFrame:
    """One JSON object per line; blank lines are skipped, a malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_ndjson_set_aside(
    spark: SparkSession, path: str, schema: T.StructType = schemas.CLINICAL_RESOURCE
) -> Parsed:
    """The same, but lines that are no JSON of the schema's types come back on their own."""
    reader = spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    read = reader.json(path)
    return _split(read.select(*schema.names, F.col("_metadata.file_path").alias(FILE), CORRUPT))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def text_head(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` lines of a text file."""
    return spark.read.text(path).limit(n)


def _found(df_of) -> DataFrame | None:
    """The DataFrame, or null if its table or path does not exist; other errors surface."""
    try:
        return df_of()
    except AnalysisException as error:
        if error.getCondition() in NOT_FOUND:
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return _found(lambda: spark.read.text(path)) is not None


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """True if ``root`` holds a written table ``name``."""
    return path_exists(spark, f"{root}/{name}")


def table_or_empty(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A written table; an empty one of its schema if it is not there."""
    schema = schema or schemas.INTEGRATED_TABLES[name]
    found = _found(lambda: spark.read.schema(schema).parquet(f"{root}/{name}"))
    return found if found is not None else spark.createDataFrame([], schema)


def list_files(spark: SparkSession, roots: str | list[str], pattern: str = "*") -> DataFrame:
    """``path, modificationTime, length`` of all files under folders; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(roots)
        .select("path", "modificationTime", "length")
    )


def count_files(spark: SparkSession, root: str, pattern: str = "*.dcm") -> int:
    """Number of matching files under a folder, 0 if the folder does not exist."""
    files = _found(lambda: list_files(spark, root, pattern))
    return files.count() if files is not None else 0


# ---------------------------------------------------------------------- write


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that :func:`read_csv` reads back, but for an empty text, which comes back as null."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**options).csv(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_ndjson_as_parquet(
    spark: SparkSession, source: str, path: str, schema: T.StructType = schemas.CLINICAL_RESOURCE
) -> None:
    """Land resource lines as Parquet, to be parsed once however often they are read."""
    read_ndjson(spark, source, schema).write.mode("overwrite").options(**PARQUET).parquet(path)


def write_json_array(df: DataFrame, path: str, rows_per_document: int = 100_000) -> None:
    """JSON array documents of at most ``rows_per_document`` objects, one per file.

    Rows are numbered within their partition, so a document never collects
    more than that many rows, whatever the data looks like.
    """
    document = F.monotonically_increasing_id() / F.lit(rows_per_document)
    objects = df.select(
        F.floor(document).alias("document"), F.to_json(F.struct("*")).alias("object")
    )
    joined = F.concat(F.lit("["), F.concat_ws(",\n", F.collect_list("object")), F.lit("]"))
    (
        objects.groupBy("document")
        .agg(joined.alias("value"))
        .select("value")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )


def write_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Write each table as Parquet under ``root``, replacing what is there."""

    def write(name: str, df: DataFrame) -> None:
        df.write.mode("overwrite").options(**PARQUET).parquet(f"{root}/{name}")

    spark = next(iter(tables.values())).sparkSession
    concurrently(spark, [partial(write, name, df) for name, df in tables.items()])


def write_partitioned(
    df: DataFrame, path: str, *columns: str, sort_by: Sequence[str] = ()
) -> None:
    """Write Parquet partitioned by ``columns``, each file sorted by ``sort_by``.

    The rebalance hint gathers each partition's rows into files of the advisory
    size and splits a partition that holds most of the rows over several tasks.
    """
    balanced = df.hint("rebalance", *columns)
    if sort_by:
        balanced = balanced.sortWithinPartitions(*columns, *sort_by)
    balanced.write.mode("overwrite").options(**PARQUET).partitionBy(*columns).parquet(path)


def export_csv(tables: dict[str, DataFrame], root: str) -> None:
    """Curated tables as CSV for secondary use."""
    for name, df in tables.items():
        write_csv(df, f"{root}/{name}")
