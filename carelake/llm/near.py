"""Near-duplicate documents: order MinHash candidates, verified by banded alignment."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import (
    arrow_rows,
    in_batches,
    lean,
    mix64,
    occurrence_labelled,
    shingles,
    signed,
    staged,
    take,
    whole_text,
    word_hashes,
)

WIDTH = 5
VECTORS = 16
SAMPLED = 3
SIMILARITY = 0.8
# Members of a bucket that a task holds and about how many it compares them with, and the words of either.
HELD = 1024
STREAMED = 4096
HELD_WORDS = 1 << 19
STREAMED_WORDS = 1 << 22
# Common items that are counted at once.
HITS = 1 << 20
SKETCHED = "doc_id long, text_hash long, set_id binary, words long, vectors array<long>"


def labelled_shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """The text's runs of five words in order, each with its occurrence number hashed in."""
    return occurrence_labelled(shingles(word_hashes(text)[0], width))


def order_min_hash(items: np.ndarray, vectors: int = VECTORS, sampled: int = SAMPLED) -> np.ndarray:
    """Per vector a hash of its ``sampled`` smallest items, taken in the order of the text."""
    if not len(items):
        return np.zeros(0, np.uint64)
    seeds = mix64(np.arange(1, vectors + 1, dtype=np.uint64)) | np.uint64(1)
    ranks = (items[None, :] ^ (seeds[:, None] >> np.uint64(7))) * seeds[:, None]
    if len(items) > sampled:
        places = np.sort(np.argpartition(ranks, sampled - 1, axis=1)[:, :sampled], axis=1)
    else:
        places = np.tile(np.arange(len(items)), (vectors, 1))
    out = seeds.copy()
    for column in places.T:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + items[column])
    return out


def alignment(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Aligned items over all items, in order; 0.0 if surely below ``similarity``.

    Both sequences have distinct items (occurrence-labelled), so the best
    alignment is the longest run of matches that rises in both. A match may lie
    off the diagonal by no more than the gaps that the similarity allows; that
    band loses nothing a pair at or above the similarity needs.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    need = similarity * (n + m) / (1 + similarity)
    if min(n, m) < need - 1e-9:
        return 0.0
    order = np.argsort(b, kind="stable")
    at = np.searchsorted(b[order], a)
    at[at == m] = 0
    place = order[at]
    hit = b[place] == a
    i, j = np.flatnonzero(hit), place[hit]
    inside = np.abs(i - j) <= n + m - 2 * need + 1e-9
    if inside.sum() < need - 1e-9:
        return 0.0
    ends: list[int] = []
    for x in j[inside].tolist():
        k = bisect_left(ends, x)
        if k == len(ends):
            ends.append(x)
        else:
            ends[k] = x
    return len(ends) / (n + m - len(ends))


def _sketch(width: int, vectors: int, sampled: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("set_id", pa.binary()),
            ("words", pa.int64()), ("vectors", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text_hash, text in arrow_rows(batches, "doc_id", "text_hash", "text"):
                words = word_hashes(text)[0]
                name = hashlib.blake2b(words.astype("<u8").tobytes(), digest_size=16).digest()
                items = occurrence_labelled(shingles(words, width))
                yield doc_id, text_hash, name, len(words), signed(order_min_hash(items, vectors, sampled))

        yield from in_batches(rows(), schema, 2048)

    return run


def _verify(width: int, similarity: float):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, items = None, None
            for a, b, text_a, text_b in arrow_rows(batches, "a", "b", "text_a", "text_b"):
                if a != held:
                    held, items = a, labelled_shingles(text_a, width)
                if alignment(items, labelled_shingles(text_b, width), similarity) >= similarity:
                    yield a, b

        yield from in_batches(rows(), schema, 8192)

    return run


class Block:
    """Members of a bucket held in a task, with an index of their items and what is known to be connected."""

    def __init__(self, held: list[tuple[bytes, bytes, np.ndarray]], similarity: float):
        self.names, roots, self.items = zip(*held, strict=True)
        self.similarity = similarity
        self.numbers: dict[bytes, int] = {}
        self.label = np.zeros(0, np.int64)
        self.of = np.array([self._number(r) for r in roots])
        self.sizes = np.array([len(x) for x in self.items])
        flat = np.concatenate(self.items)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(held)), self.sizes)[order]

    def _number(self, root: bytes) -> int:
        if root not in self.numbers:
            self.label = np.append(self.label, len(self.numbers))
            self.numbers[root] = len(self.numbers)
        return self.numbers[root]

    def links(self, root: bytes, items: np.ndarray, start: int = 0) -> Iterator[bytes]:
        """Held members from ``start`` on that reach the similarity and connect what was not connected."""
        low, high = np.searchsorted(self.flat, items, "left"), np.searchsorted(self.flat, items, "right")
        # Aligned items are common items: too few of these rule a pair out.
        common = np.zeros(len(self.names), np.int64)
        step = max(1, HITS // len(self.names))
        for at in range(0, len(items), step):
            first, spans = low[at : at + step], (high - low)[at : at + step]
            hits = np.repeat(first - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            common += np.bincount(self.owner[hits], minlength=len(self.names))
        need = self.similarity * (self.sizes + len(items)) / (1 + self.similarity)
        near = np.flatnonzero(common >= need - 1e-9)
        near, mine = near[near >= start], self._number(root)
        while True:
            near = near[self.label[self.of[near]] != self.label[mine]]
            if not len(near):
                return
            k, near = near[0], near[1:]
            if alignment(self.items[k], items, self.similarity) >= self.similarity:
                self.label[self.label == self.label[self.of[k]]] = self.label[mine]
                yield self.names[k]


def _block_links(members: Iterable[tuple], inside: bool, width: int, similarity: float) -> Iterator[tuple[bytes, bytes]]:
    """Links of the held members, which come first, with each other (if ``inside``) and with the others."""
    held, block = [], None
    for is_held, set_id, root, text in members:
        items = labelled_shingles(text, width)
        if is_held:
            held.append((set_id, root, items))
            continue
        if not held:
            continue
        block = block or Block(held, similarity)
        for name in block.links(root, items):
            yield name, set_id
    if held and inside:
        block = block or Block(held, similarity)
        for k, (set_id, root, items) in enumerate(held):
            for name in block.links(root, items, k + 1):
                yield name, set_id


def _across(width: int, similarity: float):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            each = arrow_rows(batches, "key", "block", "slice", "held", "set_id", "root", "text")
            for place, members in groupby(each, lambda r: r[:3]):
                yield from _block_links((r[3:] for r in members), place[2] == 0, width, similarity)

        yield from in_batches(rows(), schema, 8192)

    return run


def blocks(
    members: DataFrame,
    held: int = HELD,
    streamed: int = STREAMED,
    held_words: int = HELD_WORDS,
    streamed_words: int = STREAMED_WORDS,
) -> DataFrame:
    """Bucket members (``key``, ``set_id``, ``root``, if known ``words``) dealt out so that all pairs of different roots meet.

    Columns: ``key``, ``block``, ``slice``, ``held``, ``set_id``, ``root``. In
    a bucket the members outside its largest root are cut into blocks of about
    ``held`` members and ``held_words`` words. A block meets itself, those after
    it and the members of the largest root, in slices of about ``streamed``
    members and ``streamed_words`` words. Buckets of a single root are left out.
    """
    words = F.col("words") if "words" in members.columns else F.lit(0)
    counts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum(words).alias("w"))
    whole = counts.groupBy("key").agg(
        F.max(F.struct("n", "w", "root")).alias("top"), F.sum("n").alias("members"), F.sum("w").alias("words")
    )
    outside = F.greatest((F.col("members") - F.col("top.n")) / held, (F.col("words") - F.col("top.w")) / held_words)
    whole = whole.where("members > top.n").select(
        "key",
        F.col("top.root").alias("largest"),
        F.ceil(outside).cast("int").alias("blocks"),
        F.ceil(F.greatest(F.col("members") / streamed, F.col("words") / streamed_words)).cast("int").alias("slices"),
    )
    other = F.col("root") != F.col("largest")
    rows = members.join(whole, "key").withColumn("own", F.when(other, F.expr("pmod(xxhash64(set_id), blocks)")).cast("int"))
    rows = rows.withColumn("at", F.expr("cast(pmod(xxhash64(set_id, 7), slices) as int)"))
    kept = rows.where(other).select(
        "key", F.col("own").alias("block"), F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"),
        F.lit(True).alias("held"), "set_id", "root",
    )
    met = rows.withColumn("until", F.coalesce("own", "blocks")).where("until > 0").select(
        "key", F.explode(F.expr("sequence(0, until - 1)")).alias("block"), F.col("at").alias("slice"),
        F.lit(False).alias("held"), "set_id", "root",
    )
    return kept.union(met)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of all linked nodes but the roots.

    Alternating large and small stars: each pass links all neighbours of a
    node to the smallest one, until nothing changes. Edges stay in Spark and a
    pass shuffles at most one row per edge.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = staged(tidy(links.toDF("u", "v")))
    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").select("v", "m").toDF("u", "v").union(nearest.toDF("u", "v"))
        edges = staged(tidy(small))
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_links(sketches: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame | None:
    """Links (``a``, ``b``) whose components are the groups, staged; None if there are none.

    First in each bucket of a vector value the text with the largest buckets is
    the centre, and every other member is aligned with it: one candidate per
    member, not a pair of members. Then, where the other members of a bucket
    are not all in one component of those links, all pairs of them that are
    not are compared, linked members too. So every two texts that share a
    bucket are either aligned (or ruled out by their number of common items)
    or already connected.
    """
    words = F.col("words") if "words" in sketches.columns else F.lit(0)
    entries = sketches.select("set_id", words.alias("words"), F.posexplode("vectors").alias("nth", "value"))
    entries = entries.select("set_id", "words", F.xxhash64("nth", "value").alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = entries.join(sizes, "key")
    weight = shared.groupBy("set_id").agg(F.sum("members").alias("weight"))
    left = staged(shared.join(weight, "set_id").select("key", "set_id", "words", "weight"))
    # Only texts that share a bucket are fetched, one row per distinct text.
    wanted = sketches.join(left.select("set_id").distinct(), "set_id", "left_semi")
    places = wanted.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    places = places.select("set_id", F.col("first.doc_id").alias("in_doc"), F.col("first.text_hash").alias("in_text"))
    same = texts["doc_id"].eqNullSafe(places["in_doc"]) & (texts["text_hash"] == places["in_text"])
    bodies = staged(texts.join(places, same).select("set_id", "text").dropDuplicates(["set_id"]))
    parts = int(sketches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    centres = left.groupBy("key").agg(F.max(F.struct("weight", "set_id")).alias("top"))
    tried = left.join(centres.select("key", F.col("top.set_id").alias("a")), "key")
    tried = staged(tried.where("a <> set_id").select("key", "a", F.col("set_id").alias("b"), "words"))
    pairs = tried.select("a", "b").distinct()
    with_b = pairs.join(bodies.toDF("b", "text_b"), "b")
    with_both = with_b.join(bodies.toDF("a", "text_a"), "a").select("a", "b", "text_a", "text_b")
    found = staged(with_both.mapInArrow(lean(_verify(width, similarity)), "a binary, b binary"))
    stars = components(found).toDF("a", "b")
    # The centre of a bucket has met all of it; its other members may not have met each other.
    others = tried.select("key", F.col("b").alias("set_id"), "words").join(stars.toDF("set_id", "root"), "set_id", "left")
    others = staged(others.select("key", "set_id", F.coalesce("root", "set_id").alias("root"), "words"))
    dealt = staged(blocks(others))
    met = dealt.join(bodies, "set_id").repartition(parts, "key", "block", "slice")
    met = met.sortWithinPartitions("key", "block", "slice", F.desc("held"))
    fresh = met.mapInArrow(lean(_across(width, similarity)), "a binary, b binary")
    links = staged(stars.union(fresh))
    return None if links.isEmpty() else links


def classes(
    docs: DataFrame,
    width: int = WIDTH,
    vectors: int = VECTORS,
    sampled: int = SAMPLED,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The group of near-duplicates each document is in; one row per row of ``docs``.

    Columns: ``doc_id``, ``text_hash`` (of the whole text), ``class_id`` (the
    smallest ``doc_id`` of the group), ``class_size``, ``kept`` (one row of a
    group).

    Texts with the same words are one text from the start. Others are
    candidates when one of ``vectors`` order MinHash values agrees, and linked
    when the aligned runs of ``width`` words make up at least ``similarity`` of
    all; a group is what links connect. Texts travel only where they share a
    bucket. A pair at the similarity shares a vector with probability
    ``1 - (1 - similarity ** sampled) ** vectors`` (0.99999 by default).

    A null text is an empty one; texts without words are one group. A null
    ``doc_id`` comes after all others; a group of such rows has a null id. Of
    repeated rows one is kept. An empty table gives an empty result.
    """
    texts = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    run = _sketch(width, vectors, sampled)
    rows = staged(
        texts.select("doc_id", "text_hash", "text").mapInArrow(lean(run), SKETCHED)
        .withColumn("row", F.monotonically_increasing_id())
    )
    sketches = rows.groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("words").alias("words"), F.first("vectors").alias("vectors")
    )
    sketches = staged(
        sketches.select("set_id", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"), "words", "vectors")
    )
    links = near_links(sketches, texts, width, similarity)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    members = rows.select("doc_id", "text_hash", "set_id", "row")
    own = members.groupBy("set_id").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    if links is None:
        groups = own.select("set_id", F.col("n").alias("class_size"), "first")
    else:
        roots = own.join(components(links).withColumnRenamed("node", "set_id"), "set_id", "left")
        roots = staged(roots.withColumn("root", F.coalesce("root", "set_id")))
        whole = roots.groupBy("root").agg(F.sum("n").alias("class_size"), F.min("first").alias("first"))
        groups = roots.select("set_id", "root").join(whole, "root").select("set_id", "class_size", "first")
    return members.join(staged(groups), "set_id").select(
        "doc_id",
        "text_hash",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, with all its columns."""
    found = staged(classes(docs, **options).where("kept").select("doc_id", "text_hash"))
    return keep_rows(docs, found)


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` listed by ``doc_id`` and ``text_hash``; of equal rows one."""
    names = list(docs.columns)
    at = {n: f"__c{names.index(n)}" for n in ("doc_id", "text")}
    plain = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    plain = plain.withColumn("__hash", F.xxhash64(whole_text(at["text"])))
    same = F.col(at["doc_id"]).eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash"))
    rows = plain.join(kept, same, "left_semi")
    repeated = take(docs, "doc_id", "text").groupBy("doc_id", F.xxhash64(whole_text()).alias("h")).count()
    if not repeated.where("count > 1").isEmpty():
        rows = rows.dropDuplicates([at["doc_id"], "__hash"])
    return rows.drop("__hash").toDF(*names)
