"""Quality classifier: ordinal cumulative-link regression on graded ratings, over hashed text."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow_rows, in_batches, lean, take, whole_text

TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
HASHED = 1 << 18
SHAPES = 8
TERM_SCALE, SHAPE_SCALE = 3.0, 5.0
# A place of the hash counts if that many of the labelled documents use it.
LEAST_ROWS = 3
# At most this many labelled documents are fitted on, drawn by a hash of the id.
MAX_LABELLED = 6000
CACHED = 1 << 20
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def _shape(text: str, tokens: list[str]) -> list[float]:
    """Shares of capitals, digits, punctuation, other bytes, new and repeated tokens; length."""
    data = text.encode()
    size, n = max(len(data), 1), max(len(tokens), 1)
    capitals, digits, marks = (size - len(data.translate(None, b)) for b in (_UPPER, _DIGIT, _PUNCTUATION))
    repeats = sum(map(eq, tokens, tokens[1:]))
    if not data:
        return [0.0] * SHAPES
    odd = sum(not t[0].isalnum() for t in tokens)
    letters = sum(map(len, tokens))
    shares = [capitals / size, digits / size, marks / size, letters / size, len(set(tokens)) / n, repeats / n]
    return [SHAPE_SCALE * x for x in (*shares, odd / n, min(n, 100) / 100)]


def _place(token: str) -> int:
    return zlib.crc32(token.encode()) % HASHED


def _terms(tokens: list[str]) -> set[str]:
    """The distinct tokens, and the distinct beginnings of the longer ones."""
    distinct = set(tokens)
    return distinct | {f"^{t[:4]}" for t in distinct if len(t) > 4}


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values: each distinct term 1 / sqrt(distinct terms) at its hash, then the shapes."""
    tokens = TOKEN.findall(text.lower())
    terms = _terms(tokens)
    places = np.array([_place(t) for t in terms] + list(range(HASHED, HASHED + SHAPES)), np.int64)
    values = np.full(len(places), TERM_SCALE / np.sqrt(max(len(terms), 1)))
    values[len(terms) :] = _shape(text, tokens)
    return places, values


@dataclass
class OrdinalModel:
    """``P(grade >= k) = sigmoid(score - cuts[k - 1])``: one set of weights, ordered cuts."""

    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: float) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        return 1.0 / (1.0 + np.exp(np.clip(self.cuts - score, -500, 500)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, steps: int = 150, ridge: float = 0.3) -> OrdinalModel:
    """Most likely weights and cuts for (grade, places, values) rows, by Adam over all rows.

    The cuts are a first one and positive gaps, so that they stay in order.
    Without rows every grade is as likely as the top one, so nothing is rejected.
    """
    if not rows:
        return OrdinalModel(np.zeros(HASHED + SHAPES), np.full(grades - 1, -50.0))
    grade = np.array([r[0] for r in rows])
    places, value = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    common = (np.bincount(places, minlength=HASHED + SHAPES) >= LEAST_ROWS)[places]
    value, row = value[common], row[common]
    used, place = np.unique(places[common], return_inverse=True)
    shrink = np.where(used < HASHED, ridge, 0.0)
    theta = np.zeros(len(used) + grades - 1)
    theta[len(used)] = -1.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, first, gaps = theta[: len(used)], theta[len(used)], np.exp(theta[len(used) + 1 :])
        cuts = first + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, weights[place] * value, len(rows))
        # Cumulative probabilities with the fixed ends, and their slopes.
        upper = np.column_stack([np.ones(len(rows)), 1 / (1 + np.exp(np.clip(cuts - score[:, None], -500, 500))), np.zeros(len(rows))])
        slope = upper * (1 - upper)
        here = np.arange(len(rows))
        chance = np.maximum(upper[here, grade] - upper[here, grade + 1], 1e-12)
        low, high = slope[here, grade] / chance, slope[here, grade + 1] / chance
        by_cut = np.zeros((len(rows), grades + 1))
        by_cut[here, grade] = low
        by_cut[here, grade + 1] -= high
        d_cuts = by_cut[:, 1:-1].mean(axis=0)
        gradient = np.empty_like(theta)
        gradient[: len(used)] = np.bincount(place, -(low - high)[row] * value, len(used)) / len(rows) + shrink * weights / len(rows)
        gradient[len(used)] = d_cuts.sum()
        gradient[len(used) + 1 :] = gaps * np.cumsum(d_cuts[::-1])[::-1][1:]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta -= 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(HASHED + SHAPES)
    weights[used] = theta[: len(used)]
    cuts = theta[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(theta[len(used) + 1 :]))])
    return OrdinalModel(weights, cuts)


def grade_of(quality: Column, toxic: Column) -> Column:
    """The rating: 0 for junk, 1 for readable but toxic, 2 for good."""
    good = F.coalesce(quality, F.lit(0)) > 0
    return F.when(~good, 0).when(F.coalesce(toxic, F.lit(0)) > 0, 1).otherwise(2)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("grade", pa.int32()), ("places", pa.binary()), ("data", pa.binary())])

    def rows():
        for grade, text in arrow_rows(batches, "grade", "text"):
            places, values = features(text)
            yield grade, places.astype("<i4").tobytes(), values.astype("<f4").tobytes()

    yield from in_batches(rows(), schema, 256)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, seed: str = "quality-1") -> OrdinalModel:
    """The model for the labelled documents; at most ``max_labelled`` of them, drawn by a hash.

    Labels of the same document count once, the worst of them. Labels or
    documents without an id are not used.
    """
    rated = take(labels, "doc_id", "quality", "toxic").where("doc_id IS NOT NULL")
    rated = rated.groupBy("doc_id").agg(F.min(grade_of(F.col("quality"), F.col("toxic"))).alias("grade"))
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))
    chosen = rated.orderBy(draw, "doc_id").limit(max_labelled)
    texts = take(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    # Its size is bounded by max_labelled rows of two numbers.
    sample = texts.join(F.broadcast(chosen), "doc_id").select(F.col("grade").cast("int"), "text")
    found = sample.mapInArrow(_featured, "grade int, places binary, data binary").collect()
    rows = [(r[0], np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<f4").astype(float)) for r in found]
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    return fit(rows, 3)


def _scored(model: OrdinalModel, min_grade: int, least: float):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64()), ("keep", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, known = model.weights, {}
        by_shape = weights[HASHED:]

        def rows():
            for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                tokens = TOKEN.findall(text.lower())
                terms = _terms(tokens)
                if len(known) > CACHED:
                    known.clear()
                for t in terms:
                    if t not in known:
                        known[t] = weights[_place(t)]
                score = math.fsum(map(known.__getitem__, terms)) * TERM_SCALE / math.sqrt(max(len(terms), 1))
                tails = model.tails(score + float(by_shape @ _shape(text, tokens)))
                keep = bool(tokens) and tails[min_grade - 1] >= least
                yield doc_id, float(tails.sum()), float(tails[min_grade - 1]), bool(keep)

        yield from in_batches(rows(), schema, 4096)

    return run


SCORES = "doc_id long, expected_grade double, tail_probability double, keep boolean"


def classify(
    docs: DataFrame,
    labels: DataFrame,
    min_grade: int = 2,
    least: float = 0.5,
    max_labelled: int = MAX_LABELLED,
    model: OrdinalModel | None = None,
) -> DataFrame:
    """Expected grade and P(grade >= ``min_grade``) of every document, and whether it is kept.

    A document is kept when that probability is at least ``least``. The model
    is fitted once on a bounded sample and sent along with the tasks that read
    the texts; nothing shuffles. A null or empty text, or one without any
    token, is not kept. Null ids pass through, repeated rows are scored each.
    Without labels every document with a token is kept.
    """
    fitted = model or train(docs, labels, max_labelled)
    texts = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return texts.mapInArrow(_scored(fitted, min_grade, least), SCORES)


def select_documents(
    docs: DataFrame,
    labels: DataFrame,
    min_grade: int = 2,
    least: float = 0.5,
    max_labelled: int = MAX_LABELLED,
    train_on: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    ``train_on`` has the labelled texts (``docs`` if None).
    """
    fitted = train(docs if train_on is None else train_on, labels, max_labelled)
    run, place = _scored(fitted, min_grade, least), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).fill_null("")
            plain = pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), texts], ["doc_id", "text"])
            kept = [k for out in run([plain]) for k in out.column("keep").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    plain = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(lean(keep), plain.schema).toDF(*docs.columns)
