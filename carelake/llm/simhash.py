"""SimHash fingerprints, likeness along a sequence of documents, and search by Hamming radius."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import arrow_rows, in_batches, mix64, shingles, take, whole_text, word_hashes

BITS = 128
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1.0
_LANES = np.arange(BITS // 8) * 256


def fingerprint(text: str, width: int = 5) -> bytes:
    """128 bits: each distinct run of five words votes on every bit, weighted by 1 + ln(count).

    A shorter text is one run; a text without words has all bits 0.
    """
    terms, count = np.unique(shingles(word_hashes(text)[0], width), return_counts=True)
    if not len(terms):
        return bytes(BITS // 8)
    hashed = np.stack([mix64(terms), mix64(terms ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
    lanes = hashed.astype("<u8").view(np.uint8).reshape(len(terms), BITS // 8) + _LANES
    weights = np.repeat(1.0 + np.log(count), BITS // 8)
    tally = np.bincount(lanes.ravel(), weights, 256 * BITS // 8).reshape(-1, 256)
    return np.packbits(tally @ _SIGNS > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal bits."""
    return 1.0 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range after another, each range in order and ended by the row that follows it."""

    def row(doc_id, text, mine, following, its):
        changed = edited(text, following)
        print_ = fingerprint(changed)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        return doc_id, len(text), digest, mine.hex(), print_.hex(), likeness(mine, print_), likeness(mine, its)

    def rows():
        last = None
        for at, is_next, doc_id, text in arrow_rows(batches, "at", "is_next", "doc_id", "text"):
            its = fingerprint(text)
            if last is not None and last[0] == at:
                yield row(*last[1:], text, its)
                last = None
            if doc_id is None:
                yield row(doc_id, text, its, text, its)
            elif not is_next and (last is None or last[0] != at):
                last = (at, doc_id, text, its)

    yield from in_batches(rows(), _SCHEMA, 2048)


def fingerprints(docs: DataFrame, ranges_per_task: int = 4) -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness; see :data:`RESULT`.

    The edited text has the last half replaced by the start of the next
    document in ascending ``doc_id`` (after the last: the first). The ids are
    cut into ranges at their quantiles; the first document of each range also
    goes to the range before it. So texts shuffle once, and a range is read in
    order with one document held back.

    A null text is an empty one. Rows with the same id follow one another in
    the order of their texts. A null id has no place in the order: such a row
    is its own next. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = tasks * ranges_per_task
    cuts = [i / ranges for i in range(1, ranges)]
    found = texts.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, cuts)), 20 * ranges)).first()[0]
    bounds = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf(T.IntegerType())
    def range_of(ids: pd.Series) -> pd.Series:
        filled = ids.fillna(0).astype("int64").to_numpy() if ids.isna().any() else ids.to_numpy()
        return pd.Series(np.searchsorted(bounds, filled, side="left").astype("int32"))

    firsts = texts.where("doc_id IS NOT NULL").groupBy(range_of("doc_id").alias("at")).agg(F.min("doc_id"))
    heads = sorted(tuple(r) for r in firsts.collect())  # one row per range
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def places(ids: pd.Series) -> pd.Series:
        filled = [0 if missing else int(i) for i, missing in zip(ids, ids.isna(), strict=True)]
        own = np.searchsorted(bounds, np.array(filled, np.int64), side="left")
        also = [None if missing else before.get(i) for i, missing in zip(filled, ids.isna(), strict=True)]
        return pd.Series([[int(a)] if b is None else [int(a), b] for a, b in zip(own, also, strict=True)])

    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(ranges)).cast("int"))
    dealt = (
        texts.withColumn("ats", places("doc_id"))
        .select("doc_id", "text", F.posexplode("ats").alias("nth", "at"))
        .withColumn("at", F.coalesce(spread, F.col("at")))
        .withColumn("is_next", F.col("nth") == 1)
    )
    ordered = dealt.repartition(tasks, "at").sortWithinPartitions("at", "is_next", "doc_id", "text")
    return ordered.select("at", "is_next", "doc_id", "text").mapInArrow(_compare, RESULT)


def near_fingerprints(queries: DataFrame, prints: DataFrame, radius: int = 12) -> DataFrame:
    """All (``query_id``, ``doc_id``, ``distance``) within ``radius`` bits.

    Both tables have an id column (``query_id``, ``doc_id``) and a hex
    ``fingerprint`` of 128 bits. The bits fall into ``radius + 1`` blocks; two
    fingerprints within the radius agree on a whole block, so one table per
    block finds every one. Equal fingerprints are looked up once and a pair is
    reported at the first block it agrees on. Null fingerprints match nothing.
    """
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    bits = F.concat(*[F.lpad(F.conv(F.substring("fingerprint", 8 * i + 1, 8), 16, 2), 32, "0") for i in range(4)])

    def distinct(df: DataFrame, name: str) -> DataFrame:
        return df.where("fingerprint IS NOT NULL").select("fingerprint").distinct().select(
            F.col("fingerprint").alias(name),
            F.array(*[F.substring(bits, a + 1, b - a) for a, b in zip(edges, edges[1:])]).alias(f"{name}_blocks"),
        )

    left, right = distinct(queries, "a"), distinct(prints, "b")
    tabled = [
        side.select("*", F.posexplode(f"{name}_blocks").alias("block", "value"))
        for side, name in ((left, "a"), (right, "b"))
    ]
    halves = [(F.conv(F.substring(s, i, 8), 16, 10).cast("long"), F.conv(F.substring(t, i, 8), 16, 10).cast("long"))
              for i in (1, 9, 17, 25) for s, t in [("a", "b")]]
    distance = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in halves), F.lit(0))
    agree = F.zip_with("a_blocks", "b_blocks", lambda x, y: x == y)
    pairs = (
        tabled[0]
        .join(tabled[1], ["block", "value"])
        .where(distance <= radius)
        .where(F.array_position(agree, True) == F.col("block") + 1)
        .select("a", "b", distance.alias("distance"))
    )
    named = queries.select("query_id", F.col("fingerprint").alias("a"))
    return pairs.join(named, "a").join(prints.select("doc_id", F.col("fingerprint").alias("b")), "b").select(
        "query_id", "doc_id", "distance"
    )
