"""Exact dedup: binary-fuse filters over a snapshot screen a batch before the exact check."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import MASK, arrow_rows, in_batches, mix64, staged, take, whole_text

BUCKET_KEYS = 1 << 15
# Up to this many repeated digests (8 bytes each, 2 MB) are sent to all
# executors to screen the texts as they are read; more stay in Spark as a join.
MAX_SCREEN_KEYS = 1 << 18
# Most bits of the filter that is sent to all tasks (64 MB), and bits that a key sets.
BLOOM_BITS, BLOOM_HASHES = 1 << 29, 4
FILTER = "bucket long, seed long, segment long, span long, slots binary"


class FuseFilter:
    """A static 3-wise binary-fuse filter with 8-bit fingerprints over distinct 64-bit keys.

    It has no false negatives; about one in 256 other keys passes.
    """

    def __init__(self, seed: int, segment: int, span: int, slots: np.ndarray):
        self.seed, self.segment, self.span, self.slots = seed, segment, span, slots

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        n = len(keys)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8))
        segment = 4 if n < 2 else 1 << max(2, min(18, int(math.log(n) / math.log(3.33) + 2.25)))
        factor = 0 if n < 2 else max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        segments = max(1, -(-round(n * factor) // segment) - 2)
        for seed in range(1, 1000):
            made = cls(seed, segment, segments * segment, np.zeros((segments + 2) * segment, np.uint8))
            if made._fill(keys):
                return made
        raise ValueError("keys are not distinct")

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(keys + np.uint64((self.seed * 0x9E3779B97F4A7C15) & MASK))
        low = np.uint64(self.segment - 1)
        first = ((h >> np.uint64(32)) * np.uint64(self.span)) >> np.uint64(32)
        second = (first + np.uint64(self.segment)) ^ ((h >> np.uint64(18)) & low)
        third = (first + np.uint64(2 * self.segment)) ^ (h & low)
        return np.stack([first, second, third]).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)

    def _fill(self, keys: np.ndarray) -> bool:
        places, prints = self._places(keys)
        ids = np.arange(len(keys))
        count = np.bincount(places.ravel(), minlength=len(self.slots))
        owner = np.zeros(len(self.slots), np.int64)
        for row in places:
            np.bitwise_xor.at(owner, row, ids)
        rounds, left = [], len(keys)
        alone = np.flatnonzero(count == 1)
        while len(alone):
            key, first = np.unique(owner[alone], return_index=True)
            rounds.append((key, alone[first]))
            touched = places[:, key]
            for row in touched:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(owner, row, key)
            left -= len(key)
            near = np.unique(touched)
            alone = near[count[near] == 1]
        if left:
            return False
        for key, place in reversed(rounds):
            # The key's own slot is still 0, so all three slots may be folded in.
            a, b, c = places[:, key]
            self.slots[place] = prints[key] ^ self.slots[a] ^ self.slots[b] ^ self.slots[c]
        return True

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.slots):
            return np.zeros(len(keys), bool)
        (a, b, c), prints = self._places(keys)
        return (self.slots[a] ^ self.slots[b] ^ self.slots[c]) == prints


def folded(text: str) -> bytes:
    """UTF-8 of the text with A-Z lower-cased and nothing else changed."""
    return text.encode().lower()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])
    rows = ((i, hashlib.sha256(folded(t)).digest()) for i, t in arrow_rows(batches, "doc_id", "text"))
    yield from in_batches(rows, schema, 8192)


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _keys(digests: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8].ljust(8, b"\0") for d in digests), "<u8")


class BloomFilter:
    """A filter of a fixed number of bits over 64-bit keys: more keys let more others pass, none is lost.

    Unlike :class:`FuseFilter` it has one size for any number of keys, so it
    can be sent to every task.
    """

    def __init__(self, bits: np.ndarray, hashes: int = BLOOM_HASHES):
        self.bits, self.hashes = bits, hashes

    @staticmethod
    def places(keys: np.ndarray, n_bits: int, hashes: int = BLOOM_HASHES) -> np.ndarray:
        a, b = mix64(keys), mix64(keys ^ np.uint64(0x6A09E667F3BCC909)) | np.uint64(1)
        return np.stack([(a + np.uint64(i) * b) & np.uint64(n_bits - 1) for i in range(hashes)]).astype(np.int64)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at = self.places(keys, len(self.bits) * 8, self.hashes)
        return ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def bloom_bits(count: int, most: int = BLOOM_BITS) -> int:
    """A power of two of about twelve bits a key, ``most`` at most."""
    return min(most, 1 << max(16, (12 * count - 1).bit_length()))


def build_bloom(digests: DataFrame, n_bits: int) -> BloomFilter:
    """The filter of all ``digest`` values: set bits are merged by ranges in Spark; ``n_bits`` / 8 bytes reach the driver."""
    span = min(n_bits, 1 << 20)
    schema = pa.schema([("span", pa.int32()), ("bits", pa.binary())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.unique(BloomFilter.places(_keys(batch.column("digest").to_pylist()), n_bits))
                cuts = np.flatnonzero(np.diff(at // span)) + 1
                rows = ((int(p[0] // span), (p % span).astype("<u4").tobytes()) for p in np.split(at, cuts))
                yield from in_batches(rows, schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for number, at in arrow_rows(batches, "span", "bits"):
            held.setdefault(number, np.zeros(span, bool))[np.frombuffer(at, "<u4")] = True
        yield from in_batches(((k, np.packbits(v, bitorder="little").tobytes()) for k, v in held.items()), schema, 8)

    bits = np.zeros(n_bits // 8, np.uint8)
    marked = digests.select("digest").mapInArrow(mark, "span int, bits binary").repartition(max(1, n_bits // span), "span")
    for number, part in marked.mapInArrow(merge, "span int, bits binary").collect():
        bits[number * span // 8 : (number + 1) * span // 8] = np.frombuffer(part, np.uint8)
    return BloomFilter(bits)


def _bodies(known: np.ndarray | None, width: int, sent=None):
    """Digest and folded text of the rows whose digest starts with a known key, or passes the filter that was ``sent``.

    Of all rows if there is neither.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("body", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = None if known is None else frozenset(known.tolist())

        def rows():
            for batch in batches:
                bodies = [folded(t) for t in batch.column("text").to_pylist()]
                digests = [hashlib.sha256(b).digest()[:width] for b in bodies]
                if sent is not None:
                    passed = sent.value.may_hold(_keys(digests)) if digests else []
                elif keys is not None:
                    passed = [_key(d.ljust(8, b"\0")) in keys for d in digests]
                else:
                    passed = [True] * len(digests)
                for i, digest, body, pick in zip(batch.column("doc_id").to_pylist(), digests, bodies, passed, strict=True):
                    if pick:
                        yield i, digest, body

        yield from in_batches(rows(), schema, 256)

    return read


def build_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the snapshot's distinct ``digest`` values."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(np.unique(_keys(pdf["digest"])))
        row = (pdf["bucket"].iloc[0], made.seed, made.segment, made.span, made.slots.tobytes())
        return pd.DataFrame([row], columns=["bucket", "seed", "segment", "span", "slots"])

    return _bucketed(snapshot, buckets).groupBy("bucket").applyInPandas(build, FILTER)


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``incoming`` whose digest may be in the snapshot."""

    def test(pdf: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        if not len(stored) or not len(pdf):
            return pdf[["digest"]].iloc[:0]
        f = stored.iloc[0]
        made = FuseFilter(int(f.seed), int(f.segment), int(f.span), np.frombuffer(f.slots, np.uint8))
        return pdf[["digest"]][made.may_hold(_keys(pdf["digest"]))]

    return (
        _bucketed(incoming.select("digest"), buckets)
        .groupBy("bucket")
        .cogroup(filters.groupBy("bucket"))
        .applyInPandas(test, "digest binary")
    )


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.select("digest", F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"))


def dedup(
    docs: DataFrame, digest_bytes: int = 32, bucket_keys: int = BUCKET_KEYS, screen_keys: int = MAX_SCREEN_KEYS
) -> DataFrame:
    """The group of equal texts each document is in, and the row that stays.

    Texts are equal when identical after lower-casing A-Z only. Columns, one
    row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256`` (of the folded text).

    The lower half of the ids is the snapshot, the rest the incoming batch.
    Per bucket of the snapshot's digests a binary-fuse filter is built; what
    the filters let through joins the exact buckets, the batch's own repeats
    are grouped apart, and every digest that then occurs twice has its texts
    compared byte by byte. Texts that share a digest but differ are told
    apart; ``digest_bytes`` shortens the digest so that tests can show it.
    Digests travel without their texts; texts shuffle only for digests that
    repeat, after equal ones have met within each task. The tasks that read
    them know up to ``screen_keys`` repeated digests by heart, of more a filter
    of 64 MB at most, which may let a few others pass.

    A null text is an empty one. A null ``doc_id`` counts as the smallest. Of
    rows that repeat id and text, one stays. An empty table gives an empty
    result.
    """
    texts = take(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    rows = staged(
        texts.mapInArrow(_digests, "doc_id long, digest binary")
        .select("doc_id", F.col("digest").alias("full"), F.expr(f"substring(digest, 1, {digest_bytes})").alias("digest"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    middle = rows.agg(F.percentile_approx("doc_id", 0.5)).first()[0] or 0
    old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    counted = staged(
        rows.groupBy("digest", old.alias("old")).agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", (-F.col("row")).alias("back"))).alias("last")
        )
    )
    columns = ["digest", "n", "last"]
    snapshot, batch = counted.where("old").select(columns), counted.where("NOT old").select(columns)
    buckets = max(1, -(-counted.count() // bucket_keys))
    passed = staged(screen(batch, build_filters(snapshot, buckets), buckets))
    # What the filters reject is in no snapshot bucket: the batch's own groups are whole.
    known = snapshot.union(batch.join(passed, "digest", "left_semi")).groupBy("digest")
    known = known.agg(F.sum("n").alias("group_size"), F.max("last").alias("last"))
    own = batch.join(passed, "digest", "left_anti").select("digest", F.col("n").alias("group_size"), "last")
    groups = staged(known.union(own.select(*known.columns)))
    repeated = staged(groups.where("group_size > 1").select("digest"))
    mixed = _unequal(texts, repeated, digest_bytes, screen_keys)
    ready = _assigned(rows.join(mixed, "digest", "left_anti"), groups, ["digest"])
    if mixed.isEmpty():
        return ready
    inside = texts.mapInArrow(_bodies(None, digest_bytes), "doc_id long, digest binary, body binary")
    apart = inside.join(mixed, "digest").withColumn("row", F.monotonically_increasing_id())
    apart = staged(apart.withColumn("full", F.unhex(F.sha2("body", 256))))
    told = apart.groupBy("digest", "body").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", (-F.col("row")).alias("back"))).alias("last")
    )
    return ready.unionByName(_assigned(apart, told, ["digest", "body"]))


def _unequal(texts: DataFrame, repeated: DataFrame, width: int, screen_keys: int) -> DataFrame:
    """Digests among ``repeated`` whose folded texts are not all the same bytes; staged."""
    bodies = _wanted(texts, repeated, width, screen_keys)
    same = bodies.join(repeated, "digest", "left_semi").groupBy("digest", "body").count()
    return staged(same.groupBy("digest").count().where("count > 1").select("digest"))


def _wanted(texts: DataFrame, repeated: DataFrame, width: int, screen_keys: int) -> DataFrame:
    """Folded texts of at least all rows with a repeated digest, picked where they are read."""
    count = repeated.count()
    if count <= screen_keys:
        known = np.array([_key(bytes(r[0]).ljust(8, b"\0")) for r in repeated.collect()], np.int64)
        run = _bodies(known, width)
    else:
        made = build_bloom(repeated, bloom_bits(count))
        run = _bodies(None, width, texts.sparkSession.sparkContext.broadcast(made))
    return texts.mapInArrow(run, "doc_id long, digest binary, body binary")


def _assigned(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(groups, on).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("last.back") == -F.col("row")).alias("kept"),
        F.lower(F.hex("full")).alias("text_sha256"),
    )


ORACLE = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents),
numbered AS (
  SELECT doc_id, body, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
         row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) AS place
  FROM folded WINDOW same AS (PARTITION BY body))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM numbered
"""
