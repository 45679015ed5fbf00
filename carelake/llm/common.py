"""What the operators share: exact column picking, staged tables, vectorised words."""

from __future__ import annotations

import ctypes
import functools
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import TIDY, settings

# ------------------------------------------------------------------- DataFrames


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def take(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, whatever else ``df`` holds.

    A name that differs only in case from another column, repeats, or holds a
    dot would be ambiguous for ``select``; columns are found by position, the
    exact spelling first.
    """
    spelled, lowered = list(df.columns), [c.lower() for c in df.columns]
    places = [spelled.index(n) if n in spelled else lowered.index(n.lower()) for n in names]
    numbered = df.toDF(*[f"__c{i}" for i in range(len(spelled))])
    return numbered.select(*[F.col(f"__c{i}").alias(n) for i, n in zip(places, names, strict=True)])


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="carelake-llm-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once to the folder all executors share; its lineage ends there, and its shuffle files go."""
    shared_folder(df.sparkSession)
    with settings(df.sparkSession, **TIDY):
        return df.select("*").checkpoint()  # what is made under a setting follows it


_caches: list[Callable[[], None]] = []


def forgettable(clear: Callable[[], None]) -> None:
    """Names what empties a cache that a worker need not keep through the stages of others."""
    _caches.append(clear)


def lean(run: Callable) -> Callable:
    """``run`` over a task's batches, which gives its memory back to the machine when it ends.

    Workers live on from task to task and from stage to stage; what one stage
    needed at its peak, or keeps for its next task, would else stay with them.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for clear in _caches:
            clear()
        yield from run(batches)
        _forget_powers()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:  # the C library of most Linux systems; others give memory back by themselves
            trim(0)

    return wrapped


def arrow_rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of plain values."""
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        yield from zip(*columns, strict=True)


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) == size:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


# ------------------------------------------------------------------------ words

PIECE = 1 << 18
BASE = 0x100000001B3
MASK = (1 << 64) - 1
_WORD = np.zeros(256, bool)
_WORD[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = True
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _forget_powers() -> None:
    global _powers
    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        up = np.full(size, BASE, np.uint64)
        down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


def _word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of a text, and the byte each word starts at in its lower case.

    A word is a run of ASCII letters and digits and of characters beyond
    ASCII; case does not count.
    """
    return hash_words(np.frombuffer(text.lower().encode(), np.uint8))


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for text given as bytes in lower case.

    Long texts are worked through in pieces cut between words, so the memory
    besides the result stays bounded.
    """
    if len(data) <= PIECE:
        starts, ends = _word_places(data)
        return _hash_spans(data, starts, ends), starts
    hashes, places, at = [], [], 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        while stop < len(data) and _WORD[data[stop]] and _WORD[data[stop - 1]]:
            stop += 1
        starts, ends = _word_places(data[at:stop])
        hashes.append(_hash_spans(data[at:stop], starts, ends))
        places.append(starts + at)
        at = stop
    return np.concatenate(hashes), np.concatenate(places)


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """A hash per run of ``width`` words; a shorter text is one run, an empty one has none."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mix64(out)


def occurrence_labelled(values: np.ndarray) -> np.ndarray:
    """Each value with the number of its earlier occurrences hashed in, so that all differ."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if new.all():
        return values
    first = np.flatnonzero(new)
    seen = np.arange(len(values)) - np.repeat(first, np.diff(np.append(first, len(values))))
    labelled = np.empty_like(values)
    labelled[order] = mix64(ranked + seen.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    return np.where(np.isin(values, ranked[~new]), labelled, values)


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as the signed values that Spark's long holds."""
    return values.view(np.int64)
