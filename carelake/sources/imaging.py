"""Imaging inventory: header attributes of every image file under a folder."""

from __future__ import annotations

import os
import struct
import sys
import zlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.functions.identity import pseudonym
from carelake.functions.standardize import present
from carelake.sources.tables import PARQUET

# Workers get the parser itself and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the file format: attribute tags, transfer syntaxes, and the
# value types whose length field has 32 bits.
TEXT_TAGS = {
    (0x0008, 0x0018): "dicom_id",
    (0x0008, 0x0020): "study_date",
    (0x0008, 0x0060): "modality",
    (0x0010, 0x0020): "patient_id",
    (0x0020, 0x000D): "study_uid",
    (0x0020, 0x000E): "series_uid",
}
NUMBER_TAGS = {(0x0028, 0x0010): "rows", (0x0028, 0x0011): "cols"}
TRANSFER_SYNTAX = (0x0002, 0x0010)
ITEM_END, SEQUENCE_END = (0xFFFE, 0xE00D), (0xFFFE, 0xE0DD)
IMPLICIT_LITTLE = "1.2.840.10008.1.2"
EXPLICIT_BIG = "1.2.840.10008.1.2.2"
DEFLATED = "1.2.840.10008.1.2.1.99"
LONG_TYPES = {b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"SQ", b"SV", b"UC", b"UN", b"UR", b"UT", b"UV"}
PREAMBLE = 128
UNDEFINED = 0xFFFFFFFF
PIXEL_GROUP = 0x7FE0
FIRST_READ = 16 * 1024
# Paths that a task that lists files gives at a time.
LISTED = 10_000

HEADER = T.StructType(
    [T.StructField("file_path", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in TEXT_TAGS.values()]
    + [T.StructField(n, T.IntegerType()) for n in NUMBER_TAGS.values()]
    + [T.StructField("error", T.StringType())]
)


class _Elements:
    """Walks the data elements of one encoded data set."""

    def __init__(self, data: bytes, at: int, explicit: bool, order: str) -> None:
        self.data, self.at, self.explicit, self.order = data, at, explicit, order
        self.met_pixels = False

    def _unpack(self, layout: str, size: int) -> tuple:
        if self.at + size > len(self.data):
            raise ValueError("file ends inside an element")
        values = struct.unpack_from(self.order + layout, self.data, self.at)
        self.at += size
        return values

    def head(self) -> tuple[tuple[int, int], bytes, int]:
        """Tag, value type and length of the next element."""
        tag = self._unpack("HH", 4)
        if tag[0] == 0xFFFE or not self.explicit:
            return tag, b"", self._unpack("I", 4)[0]
        kind, short = self._unpack("2sH", 4)
        if not kind.isalpha():
            raise ValueError("not a value type")
        return tag, kind, self._unpack("I", 4)[0] if kind in LONG_TYPES else short

    def value(self, length: int) -> bytes:
        if self.at + length > len(self.data):
            raise ValueError("file ends inside a value")
        self.at += length
        return self.data[self.at - length : self.at]

    def skip_open(self) -> None:
        """Pass a sequence or item of undefined length, with all that nests in it."""
        depth = 1
        while depth:
            tag, _, length = self.head()
            if tag in (ITEM_END, SEQUENCE_END):
                depth -= 1
            elif length == UNDEFINED:
                depth += 1
            else:
                self.value(length)

    def __iter__(self) -> Iterator[tuple[tuple[int, int], bytes]]:
        """Top-level elements of defined length, up to the pixels."""
        while self.at < len(self.data):
            tag, _, length = self.head()
            if tag[0] >= PIXEL_GROUP:
                self.met_pixels = True
                return
            if length == UNDEFINED:
                self.skip_open()
            else:
                yield tag, self.value(length)


def _parse(content: bytes) -> tuple[dict[str, object], bool]:
    """Wanted attributes, and whether the header was read to its end at the pixels."""
    if content[PREAMBLE : PREAMBLE + 4] != b"DICM":
        raise ValueError("no DICM marker")
    syntax = ""
    meta = _Elements(content, PREAMBLE + 4, True, "<")
    while content[meta.at : meta.at + 2] == b"\x02\x00":
        tag, _, length = meta.head()
        value = meta.value(length)
        if tag == TRANSFER_SYNTAX:
            syntax = value.rstrip(b"\0 ").decode("ascii")
    data, at = content, meta.at
    if syntax == DEFLATED:
        data, at = zlib.decompressobj(-zlib.MAX_WBITS).decompress(content[at:]), 0
    order = ">" if syntax == EXPLICIT_BIG else "<"
    found: dict[str, object] = {}
    elements = _Elements(data, at, syntax != IMPLICIT_LITTLE, order)
    for tag, value in elements:
        if tag in TEXT_TAGS:
            found[TEXT_TAGS[tag]] = value.decode("utf-8", "replace").strip("\0 ")
        elif tag in NUMBER_TAGS and len(value) == 2:
            found[NUMBER_TAGS[tag]] = struct.unpack(order + "H", value)[0]
    return found, elements.met_pixels


def read_header(content: bytes) -> dict[str, object]:
    """Wanted attributes of one file; a missing attribute is absent from the result."""
    return _parse(content)[0]


def read_file_header(path: str, first: int = FIRST_READ) -> dict[str, object]:
    """Wanted attributes of a file, reading on only until the pixels are met."""
    size = os.path.getsize(path)
    with open(path, "rb") as file:
        content = file.read(max(first, PREAMBLE + 4))
        while len(content) < size:
            try:
                found, complete = _parse(content)
                if complete:
                    return found
            except (ValueError, zlib.error):
                if content[PREAMBLE : PREAMBLE + 4] != b"DICM":
                    raise
            content += file.read(3 * len(content))
    return read_header(content)


def _headers(batches: Iterator[pd.DataFrame], column: str, read) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, source in zip(batch["path"], batch[column], strict=True):
            try:
                rows.append({"file_path": path, **read(source)})
            except (OSError, ValueError, struct.error, zlib.error) as error:
                rows.append({"file_path": path, "error": str(error)})
        out = pd.DataFrame(rows, columns=HEADER.names).astype(object)
        yield out.where(out.notna(), None)


def parse_headers(files: DataFrame) -> DataFrame:
    """Headers of ``path, content`` rows; ``error`` tells why a file was unreadable."""
    return files.select("path", "content").mapInPandas(
        lambda batches: _headers(batches, "content", read_header), HEADER
    )


def parse_mounted(files: DataFrame, tasks: int) -> DataFrame:
    """Headers of ``path`` rows on a folder mounted on every executor.

    Only the head of each file is read. The paths are dealt out to ``tasks``.
    """
    located = files.select(
        "path", F.regexp_replace("path", "^file:/*", "/").alias("mounted")
    ).repartition(tasks)
    return located.mapInPandas(
        lambda batches: _headers(batches, "mounted", read_file_header), HEADER
    )


def _walk(folder: str, pattern: str) -> Iterator[str]:
    """Paths below a folder whose name fits; hidden ones are passed over, as Spark's readers do."""
    with os.scandir(folder) as entries:
        for entry in entries:
            if entry.name.startswith((".", "_")):
                continue
            if entry.is_dir():
                yield from _walk(entry.path, pattern)
            elif entry.is_file() and fnmatchcase(entry.name, pattern):
                yield entry.path


def mounted_files(spark: SparkSession, root: str, pattern: str, tasks: int) -> DataFrame:
    """``path`` of all matching files below a folder mounted on every executor.

    One task lists the folder itself; what lies in it is dealt out to
    ``tasks``, which walk its folders. No list of files reaches the driver.
    """
    top = "/" + root.removeprefix("file:").lstrip("/")

    def chunks(paths: Iterator[str]) -> Iterator[pd.DataFrame]:
        while some := list(islice(paths, LISTED)):
            yield pd.DataFrame({"path": some})

    def entries(_batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in _batches:
            with os.scandir(top) as found:
                yield from chunks(entry.path for entry in found if not entry.name.startswith((".", "_")))

    def files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                if os.path.isdir(path):
                    yield from chunks(f"file:{file}" for file in _walk(path, pattern))
                elif os.path.isfile(path) and fnmatchcase(os.path.basename(path), pattern):
                    yield pd.DataFrame({"path": [f"file:{path}"]})

    listed = spark.range(0, 1, 1, 1).select(F.lit(top).alias("path")).mapInPandas(entries, "path string")
    return listed.repartition(tasks).mapInPandas(files, "path string")


def image_files(spark: SparkSession, root: str, pattern: str = "*.dcm") -> DataFrame:
    """``path, content`` of all image files under a folder.

    Tasks are cut by file size, so one huge study spreads over many tasks.
    ``spark.sql.sources.binaryFile.maxLength`` bounds what is read per file.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "content")
    )


def inventory(headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The imaging table of the readable files, and ``file_path, error`` of the others."""
    patient = F.col("patient_id")
    pseudo = F.when(present(patient), pseudonym(patient))
    table = headers.where("error is null").withColumn("patient_id_pseudo", pseudo)
    return table.select(*schemas.IMAGING.names), headers.where("error is not null").select(
        "file_path", "error"
    )


def scan_imaging(
    spark: SparkSession,
    root: str,
    pattern: str = "*.dcm",
    mounted_tasks: int | None = None,
    staging: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Imaging table and error table of a folder of image files.

    Spark reads each file whole. Where the folder is mounted on every
    executor, ``mounted_tasks`` tasks list the files and read their heads only.
    With ``staging``, the headers are written there at once and both tables
    come from them, so each file is opened once.
    """
    if mounted_tasks is None:
        headers = parse_headers(image_files(spark, root, pattern))
    else:
        headers = parse_mounted(mounted_files(spark, root, pattern, mounted_tasks), mounted_tasks)
    if staging is not None:
        headers.write.mode("overwrite").options(**PARQUET).parquet(staging)
        headers = spark.read.schema(HEADER).parquet(staging)
    return inventory(headers)
