"""Spelling variants: words one edit apart, found by scanning sorted word lists.

A word list in order is a list of edit-matrix rows that are shared: a word
needs rows only for the characters that follow its longest common prefix (LCP)
with the word before. A word with one edit agrees with its variant in at least
half of its start or half of its end, so the vocabulary is sorted twice, by the
words and by the words read backwards, each list is cut into segments, and a
word scans only the stretch of either list that shares its half.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow_rows, in_batches, staged, take

RUN = re.compile("[a-zA-ZÀ-ÿ]+")
ERASE = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
FACTOR = 2
# Words of a segment, sampled bounds per segment, most sampled bounds, distinct words held while counting.
SEGMENT = 8192
SAMPLED = 16
MOST_BOUNDS = 1 << 17
HELD_WORDS = 1 << 18
# Cells of edit-matrix rows that a task holds at once.
HELD_CELLS = 1 << 22
BOUND_LENGTH = 64

# ------------------------------------------------------------------ edit matrix

# A row of the matrix, cut to the band of cells that one edit can reach: the
# cells left of, on and right of the diagonal, each 0, 1 or 2 ("beyond one edit").
BEYOND = 2
_CELLS = [(s % 3, s // 3 % 3, s // 9) for s in range(27)]


def _next_row(row: tuple[int, int, int], equal: tuple[bool, bool, bool]) -> tuple[int, int, int]:
    """The band one character further; ``equal`` compares it with the three characters of the band."""
    left = min(row[0] + (not equal[0]), row[1] + 1)
    on = min(row[1] + (not equal[1]), row[2] + 1, left + 1)
    right = min(row[2] + (not equal[2]), on + 1)
    return min(left, BEYOND), min(on, BEYOND), min(right, BEYOND)


def _code(row: tuple[int, int, int]) -> int:
    return row[0] + 3 * row[1] + 9 * row[2]


_STEP = np.array(
    [[_code(_next_row(row, (bool(e & 1), bool(e & 2), bool(e & 4)))) for e in range(8)] for row in _CELLS], np.uint8
)
_LEAST = np.array([min(row) for row in _CELLS], np.uint8)
_CELL = np.array(_CELLS, np.uint8)
_EQUAL_SO_FAR = _code((1, 0, 1))


class SortedWords:
    """Distinct words in order, as the rows that their prefixes do not share.

    Row ``r`` stands for one character (``char``) of one word at one ``depth``;
    ``past`` is the first row after all words that share the prefix up to it,
    and ``ends`` the word that ends there, or -1.
    """

    def __init__(self, words: list[bytes]):
        self.words = words
        lengths = np.array([len(w) for w in words], np.int64)
        common = np.array([0, *(_common(a, b) for a, b in zip(words, words[1:], strict=False))], np.int64)[: len(words)]
        self.common = common
        self.first = np.concatenate([[0], np.cumsum(lengths - common)])
        owner = np.repeat(np.arange(len(words)), lengths - common)
        self.depth = common[owner] + 1 + np.arange(self.first[-1]) - self.first[owner]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        self.char = np.frombuffer(b"".join(words), np.uint8)[starts[owner] + self.depth - 1]
        self.ends = np.where(self.depth == lengths[owner], owner, -1)
        past, open_rows = np.full(len(owner), len(owner), np.int64), []
        depths = self.depth.tolist()
        for row, depth in enumerate(depths):
            while open_rows and depths[open_rows[-1]] >= depth:
                past[open_rows.pop()] = row
            open_rows.append(row)
        self.past = past

    def stretch(self, prefix: bytes) -> tuple[int, int]:
        """The rows behind ``prefix`` of the words that start with it."""
        low = bisect_left(self.words, prefix)
        high = bisect_right(self.words, prefix, low, key=lambda w: w[: len(prefix)])
        if low == high:
            return 0, 0
        return int(self.first[low] + len(prefix) - self.common[low]), int(self.first[high])

    def one_edit(self, queries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries and of words that are exactly one edit apart and share the query's first half."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        order = sorted(range(len(queries)), key=lambda k: len(queries[k]))
        while order:
            most = max(1, HELD_CELLS // (len(queries[order[0]]) + 4))
            part = order[:most]
            while len(part) > 1 and len(part) * (len(queries[part[-1]]) + 4) > HELD_CELLS:
                part = part[: len(part) // 2]
            order = order[len(part) :]
            mine, words = self._scan([queries[k] for k in part])
            found.append((np.array(part, np.int64)[mine], words))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _scan(self, queries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(q) for q in queries], np.int64)
        width = int(lengths.max()) + 3
        text = np.frombuffer(b"".join(b"\0" + q.ljust(width - 1, b"\0") for q in queries), np.uint8).reshape(-1, width)
        rows = np.full((len(queries), width), _EQUAL_SO_FAR, np.uint8)
        rows[:, 0] = _code((BEYOND, 0, 1))
        spans = np.array([self.stretch(q[: _half(q)]) for q in queries], np.int64)
        who = np.flatnonzero(spans[:, 0] < spans[:, 1])
        at, end = spans[who, 0], spans[who, 1]
        out = []
        while len(who):
            depth, length = self.depth[at], lengths[who]
            fits = depth <= length + 1
            d = np.where(fits, depth, 1)
            char = self.char[at]
            equal = (text[who, d - 1] == char) + 2 * (text[who, d] == char) + 4 * (text[who, d + 1] == char)
            row = _STEP[rows[who, d - 1], equal]
            rows[who[fits], d[fits]] = row[fits]
            cell = length - depth + 1
            hit = fits & (self.ends[at] >= 0) & (cell <= 2)
            hit[hit] = _CELL[row[hit], cell[hit]] == 1
            if hit.any():
                out.append((who[hit], self.ends[at[hit]]))
            alive = fits & (_LEAST[row] < BEYOND)
            at = np.where(alive, at + 1, self.past[at])
            left = at < end
            who, at, end = who[left], at[left], end[left]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _half(word: bytes | str) -> int:
    """Length of the start that a word shares with its near words, in one of the two lists."""
    return len(word) // 2 if len(word) > 2 else 0


def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low = 0
    while a[low] == b[low]:
        low += 1
    return low


# ------------------------------------------------------------------------ words


def erased(doc_id: int | None, word: str, every: int = ERASE) -> str:
    """The word, or without one of its code points if ``every`` divides the hash of document and word."""
    return _erased(zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), word, every)


def _erased(seed: int, word: str, every: int) -> str:
    hashed = zlib.crc32(word.encode(), seed)
    if hashed % every:
        return word
    at = hashed % len(word)
    return word[:at] + word[at + 1 :]


def _counted(every: int, least_length: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            total: Counter[str] = Counter()
            for doc_id, text in arrow_rows(batches, "doc_id", "text"):
                # bytes.lower changes A to Z alone.
                runs = Counter(RUN.findall(text.encode().lower().decode()))
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in runs.items():
                    word = _erased(seed, run, every)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) >= HELD_WORDS:
                    yield from total.items()
                    total.clear()
            yield from total.items()

        yield from in_batches(rows(), schema, 8192)

    return run


def vocabulary(
    docs: DataFrame, every: int = ERASE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """``word`` and ``n`` (how often it occurs in all texts), counted in the tasks before the shuffle."""
    texts = take(docs, "doc_id", "text").where("text is not null").select("doc_id", F.col("text").cast("string"))
    counted = texts.mapInArrow(_counted(every, least_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# --------------------------------------------------------------------- segments


def _bounds(vocab: DataFrame, segment: int) -> list[list[str]]:
    """Where the list of words and that of words read backwards are cut.

    Every ``SAMPLED``-th of the words that a hash picks; at most about
    ``MOST_BOUNDS`` words, cut to ``BOUND_LENGTH``, reach the driver however
    long the vocabulary is.
    """
    keys = vocab.select(F.explode(F.array(*_both())).alias("k")).select("k.*")
    total = vocab.count() * 2
    every = max(1, segment // SAMPLED, total * 2 // MOST_BOUNDS)
    picked = keys.where(F.expr(f"pmod(xxhash64(key, backward), {every}) = 0"))
    rows = picked.select("backward", F.substring("key", 1, BOUND_LENGTH).alias("key")).collect()
    sides = [sorted({r.key for r in rows if r.backward is side}) for side in (False, True)]
    return [side[SAMPLED - 1 :: SAMPLED] for side in sides]


def _both() -> list:
    return [
        F.struct(F.lit(False).alias("backward"), F.col("word").alias("key"), "n"),
        F.struct(F.lit(True).alias("backward"), F.reverse("word").alias("key"), "n"),
    ]


_DEALT = pa.schema([("segment", pa.int32()), ("query", pa.bool_()), ("key", pa.string()), ("n", pa.int64())])


def _deal(bounds: list[list[str]]):
    """Each word into its segment of either list, and as a query to all segments that its first half reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            offset = len(bounds[0]) + 1
            for word, n in arrow_rows(batches, "word", "n"):
                for side, key in enumerate((word, word[::-1])):
                    cuts, start = bounds[side], side * offset
                    yield start + bisect_right(cuts, key), False, key, n
                    half = key[: _half(key)]
                    last = bisect_left(cuts, half + "Ā")
                    for place in range(bisect_right(cuts, half), last + 1):
                        yield start + place, True, key, n

        yield from in_batches(rows(), _DEALT, 8192)

    return run


_NEAR = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())]
)


def _near_rows(segment: Iterable[tuple], backward: bool) -> Iterator[tuple]:
    """Per query its near words in this segment: their number, the largest count and the first word that has it."""
    words, counts, queries, own = [], [], [], []
    for is_query, key, n in segment:
        (queries if is_query else words).append(key.encode("latin-1"))
        (own if is_query else counts).append(n)
    best: dict[int, tuple[int, bytes]] = {}
    near = Counter()
    if words and queries:
        mine, found = SortedWords(words).one_edit(queries)
        for q, w in zip(mine.tolist(), found.tolist(), strict=True):
            a, b = queries[q], words[w]
            half = max(len(a), len(b)) // 2
            # Both lists hold a pair that shares both halves; the list of words read forward counts it.
            if backward:
                a, b = a[::-1], b[::-1]
            if (a[:half] == b[:half]) is backward:
                continue
            near[q] += 1
            rank = (-counts[w], b)
            if q not in best or rank < best[q]:
                best[q] = rank
    for q, (key, n) in enumerate(zip(queries, own, strict=True)):
        word = (key[::-1] if backward else key).decode("latin-1")
        if q in best:
            yield word, n, near[q], -best[q][0], best[q][1].decode("latin-1")
        else:
            yield word, n, 0, None, None


def _scan_segments(forward_segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            each = arrow_rows(batches, "segment", "query", "key", "n")
            for number, members in groupby(each, lambda r: r[0]):
                yield from _near_rows((r[1:] for r in members), number >= forward_segments)

        yield from in_batches(rows(), _NEAR, 8192)

    return run


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: where following ``form`` from word to word ends.

    Each round joins the table with itself, so a chain of ``c`` forms takes
    about ``log2(c)`` rounds; counts at least double along a chain, so there
    are few.
    """
    now = staged(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = staged(now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), "ahead"))
        if moved.where("ahead is not null").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(
    docs: DataFrame,
    every: int = ERASE,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    factor: int = FACTOR,
    segment: int = SEGMENT,
) -> DataFrame:
    """The words of all texts with their near words; one row per word.

    Columns: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``. Words
    are runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case, after
    :func:`erased`, that have ``least_length`` code points and occur
    ``least_count`` times. Near words differ by one inserted, deleted or
    replaced code point. ``form`` is the near word with the largest ``n`` (of
    equal ones the first in code-point order) if that is at least ``factor``
    times the word's own; ``root`` is where forms lead in the end.

    A null or empty text has no words. A null ``doc_id`` is hashed as an empty
    one. Repeated rows count as often as they occur. An empty table, or one
    without words, gives an empty result.
    """
    vocab = staged(vocabulary(docs, every, least_length, least_count))
    bounds = _bounds(vocab, segment)
    segments = sum(len(side) + 1 for side in bounds)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = vocab.mapInArrow(_deal(bounds), "segment int, query boolean, key string, n long")
    # Segments are about equally long: each task gets as many.
    placed = dealt.repartitionById(min(parts, segments), F.expr(f"segment % {min(parts, segments)}"))
    sorted_lists = placed.sortWithinPartitions("segment", "query", "key")
    scanned = sorted_lists.mapInArrow(
        _scan_segments(len(bounds[0]) + 1), "word string, n long, n_near long, form_n long, form string"
    )
    merged = staged(
        scanned.groupBy("word").agg(
            F.first("n").alias("n"),
            F.sum("n_near").alias("n_near"),
            F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best"),
        ).select(
            "word", "n", "n_near",
            F.when(-F.col("best.less") >= factor * F.col("n"), F.struct(F.col("best.form"), (-F.col("best.less")).alias("n"))).alias("f"),
        ).select("word", "n", "n_near", F.col("f.form").alias("form"), F.col("f.n").alias("form_n"))
    )
    ends = roots(merged.where("form is not null"))
    return merged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
