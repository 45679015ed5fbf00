"""Hard negatives: rotated one-bit codes rule out rows, what is left is scored in integers.

A row is rotated and coded in levels. A level keeps one sign bit per dimension
of what the levels before left over, and the alignment of that remainder with
its signs, so the codes of a row rebuild it up to a remainder of known length.
The rotated anchor is rounded to a few bits per dimension; its product with
the signs is a sum of popcounts over its bit planes. By Cauchy and Schwarz the
true product lies within ``|rebuilt| * |rounding error| + |remainder| *
|anchor|`` of that estimate, always, so no row is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import arrow_rows, in_batches, staged, take

ANCHORS = 100
POSITIVES = 5
NEGATIVES = 5
LEAST_SHARE = 80
SCALE = 256
LEVELS = 4
PLANES = 6
SEED = 20_231
# Components of the rows that a task holds at once, and of those it compares them with in a step.
HELD_COMPONENTS = 1 << 22
STEP_PAIRS = 1 << 20
EXACT = 2.0**53

# -------------------------------------------------------------------------- codes


def padded_width(dimensions: int) -> int:
    """The power of two that holds the dimensions, 64 at least."""
    return max(64, 1 << max(dimensions - 1, 0).bit_length())


def rotated(vectors: np.ndarray, seed: int = SEED) -> np.ndarray:
    """The same rotation of each row: three rounds of random signs and a Hadamard transform."""
    width = padded_width(vectors.shape[1])
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    signs = np.random.default_rng(seed).integers(0, 2, (3, width)) * 2.0 - 1.0
    for row in signs:
        out = out * row
        step = 1
        while step < width:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), width)
            step *= 2
        out /= np.sqrt(width)
    return out


def _words(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


class Codes:
    """Rows as one-bit codes: ``signs`` per level, ``weights`` (alignments), lengths of rebuilt row and remainder."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        rest, width = rotated(vectors), padded_width(vectors.shape[1])
        whole, signs, weights = rest.copy(), [], []
        for _ in range(levels):
            bits = rest > 0
            # The product with the unit vector of the signs, and that vector's components.
            weight = np.abs(rest).sum(axis=1) / width
            rest = rest - np.where(bits, weight[:, None], -weight[:, None])
            signs.append(_words(bits))
            weights.append(weight)
        self.signs, self.weights, self.width = np.stack(signs), np.stack(weights), width
        self.rebuilt = np.linalg.norm(whole - rest, axis=1)
        self.rest = np.linalg.norm(rest, axis=1)

    def bounds(self, anchors: np.ndarray, chosen: slice, planes: int = PLANES) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor and chosen row two bounds that hold the product between them."""
        turned = rotated(anchors)
        low, high = turned.min(axis=1), turned.max(axis=1)
        step = np.maximum(high - low, 1e-300) / ((1 << planes) - 1)
        steps = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        rounded = low[:, None] + step[:, None] * steps
        error = np.linalg.norm(turned - rounded, axis=1)
        total = rounded.sum(axis=1)
        slices = [_words((steps >> k & 1).astype(bool)) for k in range(planes)]
        estimate = np.zeros((len(anchors), len(self.rest[chosen])))
        for signs, weight in zip(self.signs[:, chosen], self.weights[:, chosen], strict=True):
            ones = np.bitwise_count(signs).sum(axis=1, dtype=np.int64)
            inside = low[:, None] * ones[None, :]
            for k, plane in enumerate(slices):
                common = np.bitwise_count(plane[:, None, :] & signs[None, :, :]).sum(axis=2, dtype=np.int64)
                inside = inside + (step * (1 << k))[:, None] * common
            # Components with a positive sign less all others.
            estimate += weight[None, :] * (2 * inside - total[:, None])
        length = np.linalg.norm(turned, axis=1)
        apart = error[:, None] * self.rebuilt[None, chosen] + length[:, None] * self.rest[None, chosen]
        apart += 1e-9 * (1.0 + length[:, None] * (self.rebuilt + self.rest)[None, chosen])
        return estimate - apart, estimate + apart


# ------------------------------------------------------------------ blocks of rows


class Block:
    """Rows that a task holds, in the order of their labels."""

    def __init__(self, rows: list[tuple], width: int, levels: int, planes: int):
        rows.sort(key=lambda r: (r[2], r[1], r[0]))
        self.number = np.array([r[0] for r in rows], np.int64)
        self.vec_id = np.array([r[1] for r in rows], np.int64)
        self.label = np.array([r[2] for r in rows], np.int64)
        self.vectors = _matrix([r[3] for r in rows], width)
        self.codes, self.planes = Codes(self.vectors.astype(np.float64), levels), planes
        largest = float(np.abs(self.vectors).max(initial=0))
        # Below 2**53 a product in doubles is that in integers.
        self.exact = self.vectors.astype(np.float64) if largest**2 * max(width, 1) < EXACT else self.vectors
        self.largest = largest

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Integer inner products."""
        if self.exact is self.vectors or self.largest * float(np.abs(anchor).max(initial=0)) * max(len(anchor), 1) >= EXACT:
            return self.vectors[rows] @ anchor
        return (self.exact[rows] @ anchor.astype(np.float64)).astype(np.int64)

    def positives(self, anchors: list[tuple], most: int) -> Iterator[tuple]:
        """Per anchor the first ``most`` other rows of its label in this block: number, id and score."""
        ends = np.searchsorted(self.label, [[a[2], a[2] + 1] for a in anchors])
        vectors = _matrix([a[3] for a in anchors], self.vectors.shape[1])
        for low, high in sorted(set(map(tuple, ends.tolist()))):
            mine = np.flatnonzero((ends[:, 0] == low) & (ends[:, 1] == high))
            if low == high:
                continue
            for part in np.array_split(mine, -(-len(mine) * (high - low) // STEP_PAIRS)):
                below, above = self.codes.bounds(vectors[part].astype(np.float64), slice(low, high), self.planes)
                for a, lower, upper in zip(part.tolist(), below, above, strict=True):
                    number, vec_id = anchors[a][0], anchors[a][1]
                    lower[self.vec_id[low:high] == vec_id] = -np.inf
                    # A row below the bounds of ``most`` others is not among the first.
                    least = -np.inf if high - low <= most else np.partition(lower, -most)[-most]
                    left = low + np.flatnonzero(upper >= least)
                    left = left[self.vec_id[left] != vec_id]
                    scores = self.scores(vectors[a], left)
                    for k in np.lexsort((self.number[left], self.vec_id[left], -scores))[:most].tolist():
                        yield number, vec_id, int(self.number[left[k]]), int(self.vec_id[left[k]]), int(scores[k])

    def negatives(self, anchors: list[tuple], least_share: int, most: int) -> Iterator[tuple]:
        """Per anchor and positive the first ``most`` rows of other labels in this block within its limits."""
        vectors = _matrix([a[3] for a in anchors], self.vectors.shape[1])
        for part in np.array_split(np.arange(len(anchors)), max(1, len(anchors) * len(self.label) // STEP_PAIRS)):
            if not len(part):
                continue
            below, above = self.codes.bounds(vectors[part].astype(np.float64), slice(None), self.planes)
            for a, lower, upper in zip(part.tolist(), below, above, strict=True):
                number, vec_id, label, _, chosen = anchors[a]
                limits = [p[2] for p in chosen]
                # Python's integers: a hundred times a score need not fit in a long.
                least = [-(-least_share * limit // 100) for limit in limits]
                inside = (upper >= float(min(least))) & (lower <= float(max(limits))) & (self.label != label)
                left = np.flatnonzero(inside)
                scores = self.scores(vectors[a], left)
                order = np.lexsort((self.number[left], self.vec_id[left], -scores))
                left, scores = left[order], scores[order]
                for (positive, positive_id, limit), low in zip(chosen, least, strict=True):
                    fits = np.flatnonzero((low <= scores) & (scores <= limit))[:most]
                    for k in fits.tolist():
                        yield number, vec_id, positive, positive_id, limit, int(self.number[left[k]]), int(self.vec_id[left[k]]), int(scores[k])


def _matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


_POSITIVE = "anchor long, anchor_id long, positive long, positive_id long, positive_score long"
_NEGATIVE = f"{_POSITIVE}, negative long, negative_id long, negative_score long"


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(part.split()[0], pa.int64()) for part in schema.split(", ")])


def _in_units(schema: str, width: int, levels: int, planes: int, work):
    """Runs ``work`` (block, anchors) in each unit: its rows, which come first, are held, anchors stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            each = arrow_rows(batches, "block", "slice", "held", "number", "vec_id", "label", "vector", "positives")
            for _, members in groupby(each, lambda r: r[:2]):
                yield from _unit(members)

        def _unit(members: Iterable[tuple]):
            held, waiting, block = [], [], None
            for _, _, is_held, number, vec_id, label, vector, chosen in members:
                if is_held:
                    held.append((number, vec_id, label, vector))
                    continue
                if not held:
                    continue
                block = block or Block(held, width, levels, planes)
                chosen = [(p["positive"], p["positive_id"], p["positive_score"]) for p in chosen or []]
                waiting.append((number, vec_id, label, vector, chosen))
                if len(waiting) >= 4096:
                    yield from work(block, waiting)
                    waiting = []
            if waiting:
                yield from work(block, waiting)

        yield from in_batches(rows(), _arrow(schema), 8192)

    return run


def usable(
    table: DataFrame, scale: int = SCALE, id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``number`` (of the row), ``vec_id``, ``label``, ``vector`` (integers) of the rows that take part."""
    rows = take(table, id_column, vector, label).toDF("vec_id", "given", "given_label")
    scaled = F.transform(F.col("given").cast("array<double>"), lambda x: x * scale)
    rows = rows.select(F.col("vec_id").cast("long"), F.col("given_label").cast("long").alias("label"), scaled.alias("scaled"))
    finite = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("scaled").isNotNull() & finite)
    return rows.select(
        F.monotonically_increasing_id().alias("number"), "vec_id", "label", F.transform("scaled", lambda x: F.floor(x)).alias("vector")
    )


def _first(rows: DataFrame, most: int, group: list[str], score: str, rank: str | None = None) -> DataFrame:
    """The first rows of each group by score, id and number; blocks have sent no more than ``most`` each."""
    name = score.removesuffix("_score")
    order = Window.partitionBy(*group).orderBy(F.desc(score), f"{name}_id", name)
    kept = rows.withColumn(rank or "__rank", F.row_number().over(order)).where(F.col(rank or "__rank") <= most)
    return kept if rank else kept.drop("__rank")


def mine(
    table: DataFrame,
    is_anchor: Column | None = None,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_share: int = LEAST_SHARE,
    levels: int = LEVELS,
    planes: int = PLANES,
    held: int | None = None,
) -> DataFrame:
    """Hard negatives of each anchor and positive: ``anchor_id, positive_id, rank, negative_id`` and both scores.

    ``is_anchor`` says which rows are anchors (default: ``vec_id`` divisible
    by 100), ``label`` what a row's label becomes (default: itself). A row's
    score is the inner product of ``floor(256 * x)`` with the anchor's; higher
    scores come first, then smaller ids. An anchor's positives are its first
    rows of the same label with another id; a positive's negatives are the
    first rows of other labels whose score is at least ``least_share`` percent
    of the positive's and not above it.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part. A shorter vector counts as filled with zeros; an empty one
    scores 0. Scores must fit in a long. Repeated rows are rows of their own
    (each repeated anchor gives its rows). An anchor without positives, a
    positive without negatives and an empty table give no rows.

    Every block of rows meets every slice of anchors in one task, in two
    passes: positives first, then negatives, whose limits they set. Only the
    first rows of each block leave a task.
    """
    rows = usable(table)
    if label is not None:
        rows = rows.withColumn("label", label)
    anchor = F.col("vec_id") % ANCHORS == 0 if is_anchor is None else is_anchor
    rows = staged(rows.withColumn("is_anchor", anchor))
    size = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.max(F.size("vector"))).first()
    width = size[2] or 0
    held = held or max(256, HELD_COMPONENTS // padded_width(width))
    blocks, slices = max(1, -(-size[0] // held)), max(1, -(-size[1] // (4 * held)))
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Small tables are cut further, so that all tasks have work.
    blocks = max(blocks, min(parts, -(-size[0] // 1024)))
    anchors = rows.where("is_anchor").select("number", "vec_id", "label", "vector")
    kind = "array<struct<positive:bigint,positive_id:bigint,positive_score:bigint>>"
    listed = rows.select(
        F.expr(f"cast(pmod(xxhash64(number), {blocks}) as int)").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.lit(True).alias("held"), "number", "vec_id", "label", "vector", F.lit(None).cast(kind).alias("positives"),
    )

    def units(asking: DataFrame, schema: str, work) -> DataFrame:
        come = asking.select(
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
            F.expr(f"cast(pmod(xxhash64(number, 7), {slices}) as int)").alias("slice"),
            F.lit(False).alias("held"), "number", "vec_id", "label", "vector", "positives",
        )
        every = min(parts, blocks * slices)
        placed = listed.union(come).repartitionById(every, F.expr(f"cast((block * {slices}L + slice) % {every} as int)"))
        placed = placed.sortWithinPartitions("block", "slice", F.desc("held"))
        return placed.mapInArrow(_in_units(schema, width, levels, planes, work), schema)

    near = units(anchors.withColumn("positives", F.lit(None).cast(kind)), _POSITIVE, lambda b, a: b.positives(a, positives))
    first = _first(near, positives, ["anchor"], "positive_score")
    chosen = first.groupBy("anchor").agg(F.collect_list(F.struct("positive", "positive_id", "positive_score")).alias("positives"))
    asking = staged(anchors.join(chosen, anchors["number"] == chosen["anchor"]).select("number", "vec_id", "label", "vector", "positives"))
    hard = units(asking, _NEGATIVE, lambda b, a: b.negatives(a, least_share, negatives))
    ranked = _first(hard, negatives, ["anchor", "positive"], "negative_score", "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def relabelled(every: int = 7, labels: int = 10) -> Column:
    """The label, or where ``every`` divides the id the next one of ``labels``."""
    return F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))


ORACLE = """
WITH good AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score, n.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
