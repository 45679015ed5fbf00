"""Near-duplicate documents: 64-bit SimHash joined within a Hamming radius by the general pigeonhole principle.

The bits are cut into partitions, and each fingerprint gets a threshold for
each of them so that ``threshold + 1`` adds up to ``radius + 1``. Two
fingerprints within the radius then agree within the threshold in at least one
partition: if they did not, they would differ in ``radius + 1`` bits. A
threshold of -1 leaves a partition out, 0 looks up the value alone, 1 also all
values one bit away, and so on. Which thresholds are cheapest depends on how
common the values are, so they are chosen for each fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import accumulate, combinations, groupby
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow_rows, in_batches, signed, staged, take, whole_text
from carelake.llm.near import components

WIDTH = 3
SEED = 42
RADIUS = 3
BITS = 64
LANES = 8
# Ways to cut the eight lanes of eight bits into partitions.
LAYOUTS = ((4, 4), (3, 3, 2), (2, 2, 2, 2))
# Candidates that cost as much as looking up one more value; members of a value that a task holds,
# and looks up at once; the share of rows from which a key counts as hot.
LOOK_UP = 1000
HELD = 1024
STREAMED = 8192
HOT_SHARE = 1000
# Sums that travel in one row.
TOGETHER = 256
_PIECE = 1 << 16
_APART = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])

# ------------------------------------------------------------------ fingerprints


def fingerprint(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """The bits set in over half of the XXH64 hashes of all runs of ``width`` words, repeats included.

    A-Z count as a-z; words lie between ASCII blanks and are joined by one
    space. A shorter text is one run; a text without words gives zero.
    """
    # bytes.lower changes A to Z alone, bytes.split parts at ASCII white space.
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    width = min(width, len(words))
    total, votes = len(words) - width + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, _PIECE):
        until = min(at + _PIECE, total)
        spans = zip(starts[at:until], starts[at + width : until + width], strict=True)
        hashed = np.array([xxhash.xxh64_intdigest(joined[a : b - 1], seed) for a, b in spans], "<u8")
        votes += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<u8")[0])


def _fingerprints(width: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                found = fingerprint(text, width, seed)
                yield doc_id, found - (1 << BITS) if found >> (BITS - 1) else found

        yield from in_batches(rows(), schema, 8192)

    return run


# ------------------------------------------------- statistics of all fingerprints


def _column(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("bits").to_numpy(zero_copy_only=False).view(np.uint64)


def _unpacked(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def in_lanes(values: np.ndarray, order: list[int]) -> np.ndarray:
    """The bits of each value in the given order, as eight bytes."""
    return np.packbits(_unpacked(values)[:, order], axis=1, bitorder="little")


def _totals(groups: DataFrame, measure, size: int) -> np.ndarray:
    """``measure`` of all fingerprints, an array of a fixed ``size``: summed in the tasks, then over them."""
    schema = pa.schema([("part", pa.int32()), ("amounts", pa.binary())])

    def rows(total: np.ndarray) -> Iterator[tuple[int, bytes]]:
        for at in range(0, size, TOGETHER):
            yield at // TOGETHER, total[at : at + TOGETHER].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total, some = total + measure(_column(batch)).ravel(), True
        if some:
            yield from in_batches(rows(total), schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for part, amounts in arrow_rows(batches, "part", "amounts"):
            total[part] = total.get(part, 0.0) + np.frombuffer(amounts)
        yield from in_batches(((k, v.tobytes()) for k, v in total.items()), schema)

    columns, parts = "part int, amounts binary", -(-size // TOGETHER)
    counted = groups.select("bits").mapInArrow(run, columns).repartition(parts, "part")
    out = np.zeros(size)
    for part, amounts in counted.mapInArrow(add, columns).collect():
        out[part * TOGETHER : (part + 1) * TOGETHER] = np.frombuffer(amounts)
    return out


def _joint(values: np.ndarray) -> np.ndarray:
    bits = _unpacked(values).astype(np.float64)
    return bits.T @ bits


def lane_order(joint: np.ndarray, total: int) -> list[int]:
    """The bits so that those which vary together lie side by side.

    ``joint`` counts the values that have both bits. Each bit put next has the
    largest mean correlation with those of its lane so far, or, at the start
    of a lane, with the lane before; of equal ones the lowest bit.
    """
    share = np.diag(joint) / total
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(joint / total - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0.0)
    left, order = list(range(BITS)), []
    while left:
        start = len(order) // LANES * LANES
        mates = order[start:] or order[start - LANES : start] if order else list(range(BITS))
        pull = np.round(related[np.ix_(left, mates)].mean(axis=1), 9)
        order.append(left.pop(int(np.argmax(pull))))
    return order


def _lane_counts(order: list[int]):
    def measure(values: np.ndarray) -> np.ndarray:
        lanes = in_lanes(values, order) + np.arange(LANES, dtype=np.int64) * 256
        return np.bincount(lanes.ravel(), minlength=LANES * 256)

    return measure


class CostModel:
    """What it costs to look a fingerprint up, from how common the values of each lane are.

    The lanes of a partition count as independent of each other here; that
    only decides the thresholds, what is found is the same for all of them.
    """

    def __init__(self, order: list[int], lane_counts: np.ndarray, total: int, layout: tuple[int, ...], radius: int, look_up: float):
        self.order, self.layout, self.radius = order, layout, radius
        counts = lane_counts.reshape(LANES, 256)
        self.share = np.stack([counts @ (_APART == k) for k in range(radius + 1)], axis=2) / max(total, 1)
        self.total, self.look_up = total, look_up
        ends = list(accumulate(layout))
        self.lanes = [range(end - n, end) for end, n in zip(ends, layout, strict=True)]

    def costs(self, lanes: np.ndarray) -> np.ndarray:
        """Per value and partition the cost of thresholds -1 to ``radius``: look-ups and estimated candidates."""
        out = np.zeros((len(lanes), len(self.layout), self.radius + 2))
        for i, part in enumerate(self.lanes):
            apart = np.zeros((len(lanes), self.radius + 1))
            apart[:, 0] = 1.0
            for lane in part:
                near = self.share[lane][lanes[:, lane]]
                apart = np.stack([(apart[:, : k + 1] * near[:, k::-1]).sum(axis=1) for k in range(self.radius + 1)], axis=1)
            looks = np.cumsum([comb(8 * len(part), k) for k in range(self.radius + 1)])
            out[:, i, 1:] = looks * self.look_up + np.cumsum(apart, axis=1) * self.total
        return out

    def thresholds(self, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per value the thresholds of least cost whose ``threshold + 1`` add up to ``radius + 1``, and that cost.

        Dynamic programming over the partitions: the least cost of sharing out
        ``s`` units among the first ``i`` of them.
        """
        cost, units = self.costs(lanes), self.radius + 2
        least = np.full((len(lanes), units), np.inf)
        least[:, 0] = 0.0
        taken = []
        for i in range(len(self.layout)):
            ways = np.stack(
                [np.stack([least[:, s - t] + cost[:, i, t] if t <= s else np.full(len(lanes), np.inf) for t in range(units)], axis=1) for s in range(units)],
                axis=1,
            )
            taken.append(ways.argmin(axis=2))
            least = ways.min(axis=2)
        out, left, rows = np.zeros((len(lanes), len(self.layout)), np.int64), np.full(len(lanes), units - 1), np.arange(len(lanes))
        for i in reversed(range(len(self.layout))):
            chosen = taken[i][rows, left]
            out[:, i], left = chosen - 1, left - chosen
        return out, least[:, -1]


def _least_costs(models: list[CostModel]):
    def measure(values: np.ndarray) -> np.ndarray:
        lanes = in_lanes(values, models[0].order)
        return np.array([m.thresholds(lanes)[1].sum() for m in models])

    return measure


# ---------------------------------------------------------------- probe and verify


def _flips(width: int, most: int) -> list[tuple[int, ...]]:
    return [c for k in range(1, most + 1) for c in combinations(range(width), k)]


def entries(values: np.ndarray, model: CostModel) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``key``, ``bits``, ``listed`` and ``looks``: where each value is listed, and the keys that it looks up.

    A value is listed once in each partition, under the partition's own bits;
    it looks there itself unless its threshold is -1, and under the values
    within its threshold.
    """
    lanes = in_lanes(values, model.order)
    thresholds, _ = model.thresholds(lanes)
    for i, part in enumerate(model.lanes):
        padded = np.zeros((len(values), 8), np.uint8)
        padded[:, : len(part)] = lanes[:, part.start : part.stop]
        own = padded.view("<u8").ravel() | np.uint64(i << 56)
        yield own, values, np.ones(len(values), bool), thresholds[:, i] >= 0
        for t in range(1, model.radius + 1):
            some = thresholds[:, i] >= t
            if some.any():
                masks = np.array([sum(1 << b for b in c) for c in _flips(8 * len(part), t) if len(c) == t], np.uint64)
                keys = (own[some][:, None] ^ masks[None, :]).ravel()
                yield keys, np.repeat(values[some], len(masks)), np.zeros(len(keys), bool), np.ones(len(keys), bool)


def _entries(model: CostModel):
    schema = pa.schema([("key", pa.int64()), ("bits", pa.int64()), ("listed", pa.bool_()), ("looks", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _column(batch)
            for at in range(0, len(values), 2048):
                for key, bits, listed, looks in entries(values[at : at + 2048], model):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(key)), pa.array(signed(np.ascontiguousarray(bits))), pa.array(listed), pa.array(looks)], schema=schema
                    )

    return run


def _links(held: np.ndarray, looking: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links of ``looking`` with ``held`` values, but none between what earlier ones already connect."""
    label, of = np.arange(len(held)), {int(v): k for k, v in enumerate(held)}
    for value in looking:
        near = np.flatnonzero(np.bitwise_count(held ^ value) <= radius)
        mine = of.get(int(value))
        if mine is not None:
            near = near[label[near] != label[mine]]
        while len(near):
            yield int(value), int(held[near[0]])
            if mine is None:
                # From here on this value stands with the first one it meets.
                mine = near[0]
            else:
                label[label == label[near[0]]] = label[mine]
            near = near[label[near] != label[mine]]


def _verify(radius: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            each = arrow_rows(batches, "key", "block", "slice", "held", "bits")
            for _, members in groupby(each, lambda r: r[:3]):
                yield from _unit(members, radius)

        def as_signed(pairs):
            for u, v in pairs:
                yield u - (1 << 64) if u >> 63 else u, v - (1 << 64) if v >> 63 else v

        yield from in_batches(as_signed(rows()), schema, 8192)

    return run


def _unit(members: Iterable[tuple], radius: int) -> Iterator[tuple[int, int]]:
    held, looking = [], []
    for *_, is_held, bits in members:
        (held if is_held else looking).append(bits)
    if held and looking and (len(held) > 1 or held != looking):
        yield from _links(np.array(held, np.int64).view(np.uint64), np.array(looking, np.int64).view(np.uint64), radius)


def dealt(listed: DataFrame, held: int, streamed: int) -> DataFrame:
    """``key``, ``block``, ``slice``, ``held``, ``bits``: units in which those that look meet those that are listed.

    A key with many members is cut into blocks of about ``held`` listed and
    slices of about ``streamed`` looking values, and every block meets every
    slice; other keys are one unit.
    """
    counts = listed.groupBy("key").agg(
        F.count_if("listed").alias("members"), F.count_if("looks").alias("visits")
    ).where(f"members > {held} or visits > {streamed} and members > 0")
    cut = counts.select(
        "key",
        F.ceil(F.greatest("members", F.lit(1)) / held).cast("int").alias("blocks"),
        F.ceil(F.greatest("visits", F.lit(1)) / streamed).cast("int").alias("slices"),
    )
    rows = listed.join(cut, "key", "left").select(
        "key", "bits", "listed", "looks", F.coalesce("blocks", F.lit(1)).alias("blocks"), F.coalesce("slices", F.lit(1)).alias("slices")
    )
    block = F.expr("cast(pmod(xxhash64(bits), blocks) as int)")
    part = F.expr("cast(pmod(xxhash64(bits, 7), slices) as int)")
    kept = rows.where("listed").select(
        "key", block.alias("block"), F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"), F.lit(True).alias("held"), "bits"
    )
    come = rows.where("looks").select(
        "key", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), part.alias("slice"), F.lit(False).alias("held"), "bits"
    )
    return kept.union(come)


def links(
    groups: DataFrame,
    radius: int = RADIUS,
    layouts: tuple[tuple[int, ...], ...] = LAYOUTS,
    look_up: float = LOOK_UP,
    held: int = HELD,
    streamed: int = STREAMED,
) -> DataFrame:
    """Pairs ``u``, ``v`` of distinct fingerprints (column ``bits``) whose graph connects all within the radius.

    Bits are grouped by their correlation over all fingerprints, the layout
    with the least estimated cost over all of them is taken, thresholds are
    chosen for each. Pairs that a task has already connected are left out.
    """
    total = groups.count()
    order = lane_order(_totals(groups, _joint, BITS * BITS).reshape(BITS, BITS), max(total, 1))
    counts = _totals(groups, _lane_counts(order), LANES * 256)
    models = [CostModel(order, counts, total, layout, radius, look_up) for layout in layouts]
    cost = _totals(groups, _least_costs(models), len(models))
    model = models[int(np.argmin(cost))]
    listed = groups.select("bits").mapInArrow(_entries(model), "key long, bits long, listed boolean, looks boolean")
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = dealt(listed, held, streamed).repartition(parts, "key", "block", "slice")
    units = units.sortWithinPartitions("key", "block", "slice", F.desc("held"))
    return units.mapInArrow(_verify(radius), "u long, v long")


# -------------------------------------------------------------------------- query


def _joined(rows: DataFrame, named: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``named``, which has each key once and in ``n`` how many rows have it.

    Keys with over a ``HOT_SHARE``-th of all rows, fewer than ``HOT_SHARE`` by
    that, are broadcast, so that their rows stay where they are.
    """
    hot = named.where(F.col("n") * HOT_SHARE > total).withColumn("hot", F.lit(True))
    renamed = reduce(lambda d, c: d.withColumnRenamed(c, f"__{c}") if c != key else d, hot.columns, hot)
    marked = rows.join(F.broadcast(renamed), key, "left")
    others = [c for c in named.columns if c != key]
    met = marked.where("__hot").select(*rows.columns, *[F.col(f"__{c}").alias(c) for c in others])
    rest = marked.where("__hot is null").select(*rows.columns).join(named.where(F.col("n") * HOT_SHARE <= total), key)
    return met.union(rest.select(*rows.columns, *others))


def near_components(docs: DataFrame, width: int = WIDTH, seed: int = SEED, radius: int = RADIUS, **options) -> DataFrame:
    """The component of each document among fingerprints linked within ``radius`` bits; one row per row of ``docs``.

    Columns: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``
    (the smallest ``doc_id`` that links reach, its own included).

    A null text is an empty one; texts without words share fingerprint zero and
    are linked like any other. Equal texts, and repeated rows, share a
    fingerprint and so a component. A null ``doc_id`` counts for no
    ``component_id``; a component of such rows alone has null. An empty table
    gives an empty result.
    """
    texts = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), whole_text().cast("string").alias("text"))
    rows = staged(texts.mapInArrow(_fingerprints(width, seed), "doc_id long, bits long"))
    groups = staged(rows.groupBy("bits").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    roots = components(links(groups, radius, **options))
    linked = roots.select(F.col("node").alias("bits"), "root")
    named = staged(groups.join(linked, "bits", "left").withColumn("root", F.coalesce("root", "bits")))
    whole = staged(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")))
    found = _joined(named.select("bits", "root", F.col("n").alias("rows")), whole, "root", named.count())
    found = staged(found.select("bits", "component_id", F.col("rows").alias("n")))
    out = _joined(rows, found, "bits", rows.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
