"""Joins with reference dictionaries whose size is checked before a broadcast."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from carelake.operators.skew import grid_join, hot_parts

# A dictionary is broadcast up to these bounds; beyond them the join shuffles.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def local_table(spark: SparkSession, rows: Iterable[tuple], fields: str | T.StructType) -> DataFrame:
    """A literal table from Python tuples, held in the plan itself."""
    schema = fields if isinstance(fields, T.StructType) else T.StructType.fromDDL(fields)
    named = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(
        pa.Table.from_pylist(named, schema=to_arrow_schema(schema)), schema=schema
    )


@dataclass(frozen=True)
class Dictionary:
    """A reference table with unique keys, and whether it may be broadcast."""

    table: DataFrame
    keys: tuple[str, ...]
    small: bool

    @staticmethod
    def of(
        spark: SparkSession,
        rows: DataFrame | Iterable[tuple],
        fields: str | T.StructType,
        keys: Sequence[str],
        max_rows: int = MAX_BROADCAST_ROWS,
        max_bytes: int = MAX_BROADCAST_BYTES,
    ) -> "Dictionary":
        """Check a dictionary once: unique keys, and its measured size."""
        keys = tuple(keys)
        if isinstance(rows, DataFrame):
            schema = fields if isinstance(fields, T.StructType) else T.StructType.fromDDL(fields)
            table = rows.select(*schema.names)
            measured = table.limit(max_rows + 1).agg(
                F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("size"),
            )
            n, size = measured.first()
            small = n <= max_rows and size <= max_bytes
            repeated = table.groupBy(*keys).count().where("count > 1").limit(1).count()
        else:
            rows = list(rows)
            table = local_table(spark, rows, fields)
            small = len(rows) <= max_rows and len(repr(rows)) <= max_bytes
            places = [table.columns.index(k) for k in keys]
            repeated = len(rows) - len({tuple(r[i] for i in places) for r in rows})
        if repeated:
            raise ValueError(f"dictionary keys {list(keys)} are not unique")
        return Dictionary(table, keys, small)


def lookup(
    df: DataFrame,
    entries: Dictionary,
    on: dict[str, str],
    take: Sequence[str],
    how: str = "left",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Join ``df`` with a dictionary and add its columns ``take``.

    ``on`` maps columns of ``df`` to the dictionary's keys. The dictionary is
    broadcast if its check allows; otherwise both sides shuffle, with the hot
    keys of ``df`` cut into parts. Those are looked for in ``keys`` if given: a
    table with the same column that is cheaper to read than ``df`` is to make.
    """
    if sorted(on.values()) != sorted(entries.keys):
        raise ValueError(f"join needs the dictionary keys {list(entries.keys)}")
    table = entries.table.select(
        *[F.col(key).alias(column) for column, key in on.items()], *take
    )
    columns = list(on)
    if entries.small:
        return df.join(F.broadcast(table), columns, how)
    cells = {key: (parts, 1) for key, parts in hot_parts(df if keys is None else keys, columns[0]).items()}
    return grid_join(df, table, columns, cells, how)


def translate(
    df: DataFrame, column: str, entries: Dictionary, value: str, into: str, default: str, keys: DataFrame | None = None
) -> DataFrame:
    """Add ``into``: the dictionary's ``value`` for ``column``, or ``default``; ``keys`` as in :func:`lookup`."""
    found = lookup(df, entries, {column: entries.keys[0]}, [value], keys=keys)
    return found.select(*df.columns, F.coalesce(value, F.lit(default)).alias(into))
