"""Line dedup by an exact set-similarity join over the words of lines."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import hash_words, lean, mix64, signed, staged, take, whole_text

SIMILARITY = 0.8
# Words are counted by this many hash slots (one byte each, 4 MB), however many words there are.
RARITY_SLOTS = 1 << 22
# Up to this many line ids (8 bytes each, 2 MB) are sent to the tasks that read
# their words; more stay in Spark as a join.
MAX_SENT = 1 << 18
# Lines of several words that are compared together, and columns of a matrix of
# lines by words.
TOGETHER, COLUMNS = 64, 4096
# The blocks of a word have numbers of this many bits.
BLOCK_BITS = 9
# Characters of text worked through at once; a longer text is alone.
GROUP = 1 << 20
# A word is this many bits of its hash. Above them stands its class of rarity,
# and above that the number of the line among those that are sorted together.
WORD_BITS, CLASS_BITS, SLICE_BITS = 46, 6, 12
PACKED = 6
_WORD = np.uint64((1 << WORD_BITS) - 1)
_CODE = np.uint64((1 << WORD_BITS + CLASS_BITS) - 1)


class Limits(NamedTuple):
    """How the work is cut up; the result is the same for all values."""

    #: Lines with more words are paired one by one.
    long: int = 512
    #: Lines that may meet at a word before their prefix entries are dealt into blocks.
    crowd: int = 1 << 14
    #: Lines of a word that are compared with each other at once.
    block: int = 1024
    #: Pairs that are filtered at once.
    pairs: int = 1 << 18


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[str], pa.RecordBatch]]:
    """Texts of about ``GROUP`` characters together, with the rows they come from."""
    for batch in batches:
        texts, first, size = batch.column("text").to_pylist(), 0, 0
        for i, text in enumerate(texts):
            if i > first and size + len(text) > GROUP:
                yield texts[first:i], batch.slice(first, i - first)
                first, size = i, 0
            size += len(text)
        if texts:
            yield texts[first:], batch.slice(first)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, and the line of each, counted through all texts."""
    data = np.frombuffer("\n".join(texts).lower().encode(), np.uint8)
    words, starts = hash_words(data)
    return words >> np.uint64(64 - WORD_BITS), np.searchsorted(np.flatnonzero(data == 10), starts)


class Lines:
    """The distinct words of each line of some texts, rarest first, as flat arrays.

    ``first`` and ``size`` tell where the words of each line with a word are,
    ``repeats`` how often each word stands in its line, ``text`` and ``number`` which line of which text it is.
    """

    def __init__(self, texts: list[str], classes: np.ndarray | None = None):
        words, line = _words(texts)
        if classes is not None:
            rarity = classes[(words & np.uint64(len(classes) - 1)).astype(np.int64)]
            words |= rarity.astype(np.uint64) << np.uint64(WORD_BITS)
        codes, owners, repeats = [], [], []
        step = 1 << SLICE_BITS
        cuts = np.searchsorted(line, np.arange(0, (line[-1] if len(line) else 0) + step + 1, step))
        for nth, (start, stop) in enumerate(itertools.pairwise(cuts.tolist())):
            key = line[start:stop].astype(np.uint64) - np.uint64(nth * step)
            key = key << np.uint64(WORD_BITS + CLASS_BITS) | words[start:stop]
            key.sort()
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            repeats.append(np.diff(np.append(np.flatnonzero(new), len(key))))
            key = key[new]
            codes.append(key & _CODE)
            owners.append((key >> np.uint64(WORD_BITS + CLASS_BITS)).astype(np.int64) + nth * step)
        codes, owner, self.repeats = np.concatenate(codes), np.concatenate(owners), np.concatenate(repeats)
        self.words, self.rarity = codes & _WORD, codes >> np.uint64(WORD_BITS)
        self.first = np.flatnonzero(np.diff(owner, prepend=-1))
        self.size = np.diff(np.append(self.first, len(owner)))
        begins = np.cumsum([0] + [t.count("\n") + 1 for t in texts])
        line = owner[self.first]
        self.text = np.searchsorted(begins, line, "right") - 1
        self.number = line - begins[self.text]

    def ids(self) -> np.ndarray:
        """A 64-bit id per line that depends on its set of words alone."""
        if not len(self.first):
            return np.zeros(0, np.uint64)
        a = np.add.reduceat(mix64(self.words), self.first)
        b = np.bitwise_xor.reduceat(mix64(self.words ^ np.uint64(0x2545F4914F6CDD1D)), self.first)
        return mix64(a + b * np.uint64(3) + self.size.astype(np.uint64))

    def bitmaps(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits per line, one for the hash of each word."""
        bit = np.uint64(1) << ((self.words >> np.uint64(30)) & np.uint64(63))
        upper = (self.words >> np.uint64(40)) & np.uint64(1) == 1
        zero = np.uint64(0)
        return (
            np.bitwise_or.reduceat(np.where(upper, zero, bit), self.first),
            np.bitwise_or.reduceat(np.where(upper, bit, zero), self.first),
        )

    def words_of(self, lines: np.ndarray) -> pa.BinaryArray:
        """The words of some lines, packed."""
        size = self.size[lines]
        offsets = np.append(0, np.cumsum(size))
        at = np.arange(offsets[-1]) + np.repeat(self.first[lines] - offsets[:-1], size)
        data = np.ascontiguousarray(_packed(self.words[at]))
        buffers = [None, pa.py_buffer((offsets * PACKED).astype(np.int32)), pa.py_buffer(data)]
        return pa.BinaryArray.from_buffers(pa.binary(), len(lines), buffers)


class _Met:
    """Line ids this task has met lately; forgets all when they become many."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.ids = most, set()

    def fresh(self, names: np.ndarray) -> np.ndarray:
        """Places of the ids not met before, the first of each."""
        if len(self.ids) > self.most:
            self.ids.clear()
        names, place = np.unique(names, return_index=True)
        new = np.array([n not in self.ids for n in names.tolist()], bool)
        self.ids.update(names[new].tolist())
        return np.sort(place[new])


SURVEY = "doc_id long, text_hash long, line int, id long, counts binary"
# Slots whose counts travel in one row.
SLOT_RANGE = 1 << 16


def _survey(slots: int):
    """One pass over the texts: a row per line with its id, one per text with its number of lines, then word counts.

    A text's row has no ``id``. Rows with ``counts`` hold pairs of a slot and
    the number of its words in this task, for the range of slots numbered ``line``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for texts, rows in _groups(batches):
            lines = Lines(texts)
            if len(lines.words):
                np.add.at(total, (lines.words & np.uint64(slots - 1)).astype(np.int64), lines.repeats)
            every = np.concatenate([lines.text, np.arange(len(texts))])
            number = np.concatenate([lines.number, [t.count("\n") + 1 for t in texts]])
            columns = [rows.column(n).take(pa.array(every)) for n in ("doc_id", "text_hash")]
            ids = pa.concat_arrays([pa.array(signed(lines.ids())), pa.nulls(len(texts), pa.int64())])
            columns += [pa.array(number, pa.int32()), ids, pa.nulls(len(every), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "line", "id", "counts"])
        for nth in range(0, slots, SLOT_RANGE):
            used = np.flatnonzero(total[nth : nth + SLOT_RANGE])
            if len(used):
                pairs = np.stack([used, total[nth + used]], axis=1).astype("<i8").tobytes()
                none = pa.nulls(1, pa.int64())
                columns = [none, none, pa.array([nth // SLOT_RANGE], pa.int32()), none, pa.array([pairs], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "line", "id", "counts"])

    return run


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range of slots one byte a slot: twice the binary logarithm of its number of words."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for nth, pairs in zip(batch.column("line").to_pylist(), batch.column("counts"), strict=True):
            slot, n = np.frombuffer(pairs.as_buffer(), "<i8").reshape(-1, 2).T
            total.setdefault(nth, np.zeros(SLOT_RANGE, np.int64))[slot] += n
    for nth, n in total.items():
        level = np.minimum(np.floor(np.log2(np.maximum(n, 1)) * 2), (1 << CLASS_BITS) - 1).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([nth], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["nth", "level"])


def rarity_classes(survey: DataFrame, slots: int = RARITY_SLOTS) -> np.ndarray:
    """How common the words of each hash slot are in all texts: twice the binary logarithm of their number.

    ``slots`` bytes, whatever the input; 0 stands for one occurrence.
    """
    parts = int(survey.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = survey.where("counts IS NOT NULL").select("line", "counts").repartition(parts, "line")
    classes = np.zeros(slots, np.uint8)
    for nth, level in counts.mapInArrow(lean(_levels), "nth int, level binary").collect():
        at = nth * SLOT_RANGE
        classes[at : at + SLOT_RANGE] = np.frombuffer(level, np.uint8)[: slots - at]
    return classes


ENTRIES = "key long, id long, shape long, low long, high long"


def _entries(sent, similarity: float, crowd: int):
    """Prefix entries of each line set met first in this task.

    Sets at the similarity share a word among the first ``size - need + 1`` of
    each, rarest first. A word whose slot counts 1 occurs once and joins
    nothing. ``shape`` holds the size and the word's position. ``key`` is the
    word and, where its class allows more than ``crowd`` lines, a pair of blocks:
    an entry goes to all pairs with its own block.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("key", "id", "shape", "low", "high")])
    most = np.exp2((np.arange(1 << CLASS_BITS) + 1) / 2)
    blocks_of = np.clip(np.ceil(most / crowd), 1, 1 << BLOCK_BITS).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = _Met()
        for texts, _ in _groups(batches):
            lines = Lines(texts, sent.value)
            if not len(lines.first):
                continue
            names = signed(lines.ids())
            fresh = np.zeros(len(names), bool)
            fresh[met.fresh(names)] = True
            prefix = np.where(fresh, lines.size - np.ceil(similarity * lines.size - 1e-9).astype(np.int64) + 1, 0)
            owner = np.repeat(np.arange(len(names)), lines.size)
            place = np.arange(len(owner)) - lines.first[owner]
            pick = np.flatnonzero((place < prefix[owner]) & (lines.rarity > 0))
            blocks = blocks_of[lines.rarity[pick].astype(np.int64)]
            other = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            pick = np.repeat(pick, blocks)
            owner, place = owner[pick], place[pick]
            block = (mix64(names[owner].view(np.uint64)) % np.repeat(blocks, blocks).astype(np.uint64)).astype(np.int64)
            key = signed(lines.words[pick]) | np.minimum(block, other) << WORD_BITS
            key |= np.maximum(block, other) << WORD_BITS + BLOCK_BITS
            low, high = lines.bitmaps()
            columns = key, names[owner], lines.size[owner] << 32 | place, signed(low)[owner], signed(high)[owner]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _whole_groups(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows that come sorted by these columns, cut between groups, and the number of each row's group."""
    held: pa.RecordBatch | None = None
    for batch in itertools.chain(batches, [None]):
        parts = [b for b in (held, batch) if b is not None and b.num_rows]
        if not parts:
            continue
        rows = parts[0] if len(parts) == 1 else pa.concat_batches(parts)
        keys = [rows.column(n).to_numpy() for n in names]
        new = np.zeros(rows.num_rows, bool)
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        end = rows.num_rows if batch is None else int(np.flatnonzero(new)[-1]) if new.any() else 0
        held = rows.slice(end)
        if end:
            yield rows.slice(0, end), np.cumsum(new[:end])


def _candidates(similarity: float, limits: Limits):
    """Entries with a partner that passes the filters, once each; of long lines the pairs (``id`` < ``other``)."""
    schema = pa.schema([(n, pa.int64()) for n in ("word", "id", "other")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in _whole_groups(batches, "key"):
            word, name, shape, low, high = (rows.column(i).to_numpy() for i in range(5))
            low, high = low.view(np.uint64), high.view(np.uint64)
            size = shape >> 32
            order = np.lexsort((name, size, group))
            again = np.zeros(len(order), bool)
            again[1:] = (np.diff(group[order]) == 0) & (np.diff(name[order]) == 0)
            order = order[~again]
            group, word, name, size, low, high = (c[order] for c in (group, word, name, size, low, high))
            later = size - (shape[order] & ((1 << 32) - 1))
            # Partners of a line stand after it, up to the largest size at the similarity.
            reach = group << 32 | np.floor(size / similarity + 1e-9).astype(np.int64)
            partners = np.searchsorted(group << 32 | size, reach, "right") - np.arange(len(order)) - 1
            total = np.cumsum(partners)
            cuts = np.searchsorted(total, np.arange(limits.pairs, (total[-1] if len(total) else 0) + limits.pairs, limits.pairs)) + 1
            some, long_pairs = np.zeros(len(order), bool), []
            for start, stop in itertools.pairwise([0, *np.unique(np.minimum(cuts, len(order))).tolist()]):
                n = partners[start:stop]
                i = np.repeat(np.arange(start, stop), n)
                j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
                both = size[i] + size[j]
                need = np.ceil(similarity / (1 + similarity) * both - 1e-9).astype(np.int64)
                at = np.flatnonzero(np.minimum(later[i], later[j]) >= need)
                i, j, both, need = i[at], j[at], both[at], need[at]
                differ = np.bitwise_count(low[i] ^ low[j]).astype(np.int64) + np.bitwise_count(high[i] ^ high[j])
                may = both - differ >= 2 * need
                short = may & (size[j] <= limits.long)
                some[i[short]] = some[j[short]] = True
                pair = np.stack([name[i[may & ~short]], name[j[may & ~short]]])
                long_pairs.append(np.sort(pair, axis=0))
            at = np.flatnonzero(some)
            pairs = np.concatenate([*long_pairs, np.zeros((2, 0), np.int64)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[at] & int(_WORD)), pa.array(name[at]), pa.nulls(len(at), pa.int64())], schema=schema
            )
            yield pa.RecordBatch.from_arrays([pa.nulls(pairs.shape[1], pa.int64()), *map(pa.array, pairs)], schema=schema)

    return run


def _packed(words: np.ndarray) -> np.ndarray:
    """The words as bytes, ``PACKED`` each."""
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PACKED]


def _unpacked(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all rows of packed words, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    words = np.zeros(((offsets[-1] - offsets[0]) // PACKED, 8), np.uint8)
    words[:, :PACKED] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, PACKED)
    return words.view("<u8").ravel(), np.diff(offsets) // PACKED


def _word_lists(sent, known: np.ndarray | None):
    """The words of lines, rarest first; with ``known`` (sorted) of these lines alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = _Met()
        for texts, _ in _groups(batches):
            lines = Lines(texts, sent.value)
            names = signed(lines.ids())
            place = np.arange(len(names))
            if known is not None:  # sorted, so that a look-up does not go through all of it
                at = np.minimum(np.searchsorted(known, names), max(len(known) - 1, 0))
                place = place[known[at] == names] if len(known) else place[:0]
            place = place[met.fresh(names[place])]
            yield pa.RecordBatch.from_arrays([pa.array(names[place]), lines.words_of(place)], ["id", "words"])

    return run


def _incidence(row: np.ndarray, key: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """Rows by keys that several rows hold, as matrices of zeros and ones with ``COLUMNS`` keys each."""
    _, at, times = np.unique(key, return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    shared = times[at] > 1
    row, at = row[shared], number[at[shared]]
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        part = (at >= start) & (at < start + COLUMNS)
        matrix = np.zeros((rows, min(COLUMNS, int(number[-1]) + 1 - start)), np.float32)
        matrix[row[part], at[part] - start] = 1
        yield matrix


def _links_of(rows: pa.RecordBatch, group: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """How many links each row has in its group, and whether one of them comes earlier in the corpus.

    A pair counts only in the group of its first common word, so once in all
    groups. Where two blocks of a word meet, only pairs across them count.
    """
    words, size = _unpacked(rows.column("words"))
    n = rows.num_rows
    row = np.repeat(np.arange(n), size)
    key = group[row].astype(np.uint64) << np.uint64(WORD_BITS) | words
    hit = words == rows.column("word").to_numpy().view(np.uint64)[row]
    place = np.zeros(n, np.int64)
    place[row[hit]] = np.flatnonzero(hit)
    before = np.arange(len(row)) < place[row]
    common, earlier = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)
    for matrix in _incidence(row, key, n):
        common += matrix @ matrix.T
    for matrix in _incidence(row[before], key[before], n):
        earlier += matrix @ matrix.T
    block, cross = rows.column("block").to_numpy(), rows.column("lo").to_numpy() != rows.column("hi").to_numpy()
    link = common >= (similarity - 1e-9) * (size[:, None] + size[None, :] - common)
    link &= (earlier == 0) & (group[:, None] == group[None, :]) & (~cross[:, None] | (block[:, None] != block[None, :]))
    np.fill_diagonal(link, False)
    unnamed = rows.column("doc_id").is_null().to_numpy(zero_copy_only=False)
    doc = rows.column("doc_id").fill_null(0).to_numpy()
    order = np.lexsort((rows.column("line").to_numpy(), rows.column("text_hash").to_numpy(), doc, unnamed))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    return link.sum(1), (link & (rank[None, :] < rank[:, None])).any(1)


def _linked(similarity: float):
    """Links of the rows of each group (``word``, ``lo``, ``hi``), which stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in _whole_groups(batches, "word", "lo", "hi"):
            ends = [*np.flatnonzero(np.diff(group)) + 1, rows.num_rows]
            first = 0
            for end in ends:
                if end - first < TOGETHER and end != ends[-1]:
                    continue
                part, own = rows.slice(first, end - first), group[first:end]
                links, matched = _links_of(part, own - own[0], similarity)
                some = np.flatnonzero(links)
                columns = [part.column("id").take(pa.array(some)), pa.array(links[some]), pa.array(matched[some])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "links", "matched"])
                first = end

    return run


def _verified(similarity: float):
    """The pairs at the similarity, one after the other: those of long lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [_unpacked(batch.column(n)) for n in ("in_a", "in_b")]
            at, alike = [0, 0], []
            for sizes in zip(*(s[1].tolist() for s in sides), strict=True):
                a, b = (words[i : i + n] for (words, _), i, n in zip(sides, at, sizes, strict=True))
                common = len(np.intersect1d(a, b, assume_unique=True))
                alike.append(common >= (similarity - 1e-9) * (sum(sizes) - common))
                at = [i + n for i, n in zip(at, sizes, strict=True)]
            keep = pa.array(alike, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(keep) for n in ("a", "b")], ["a", "b"])

    return run


def linked_lines(
    texts: DataFrame, survey: DataFrame, places: DataFrame, similarity: float = SIMILARITY, limits: Limits = Limits()
) -> DataFrame:
    """``id``, ``links`` and ``matched`` of each line set with Jaccard at least ``similarity`` to another.

    ``links`` counts those sets, ``matched`` tells whether one of them stands
    earlier in the corpus than the set does first (``places`` has each
    ``id`` with its ``first``); staged. ``survey`` has the word counts of the texts.

    Lines meet by prefix word, in blocks where many may share one. Length and
    positional filters and a bound on the overlap from 128 bits per line leave
    the prefix entries that have any partner, never pairs. Their words are
    brought together by prefix word, in blocks of about ``limits.block`` lines
    where many still share one, and each pair of blocks is one matrix product.
    So a group of similar lines costs rows in proportion to its size and number
    of blocks. Words of a line are repeated per entry; of lines above
    ``limits.long`` words that would be too many, so pairs with such a line are
    listed and verified one by one. None of the filters loses a pair.
    """
    spark = texts.sparkSession
    sent = spark.sparkContext.broadcast(rarity_classes(survey))
    entries = texts.select("text").mapInArrow(lean(_entries(sent, similarity, limits.crowd)), ENTRIES)
    entries = entries.repartition("key").sortWithinPartitions("key")
    found = staged(entries.mapInArrow(lean(_candidates(similarity, limits)), "word long, id long, other long").distinct())
    short_entries, pairs = found.where("other IS NULL"), found.where("other IS NOT NULL").select("id", "other").distinct()
    named = found.select("id").union(pairs.select("other")).distinct()
    if named.count() <= MAX_SENT:
        known = np.sort(np.array([r[0] for r in named.collect()], np.int64))
        lists = texts.select("text").mapInArrow(lean(_word_lists(sent, known)), "id long, words binary")
    else:
        lists = texts.select("text").mapInArrow(lean(_word_lists(sent, None)), "id long, words binary").join(named, "id", "left_semi")
    lists = lists.groupBy("id").agg(F.first("words").alias("words"))
    first = [F.col(f"first.{n}").alias(n) for n in ("doc_id", "text_hash", "line")]
    lists = staged(lists.join(places, "id").select("id", "words", *first))

    many = short_entries.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limits.block)
    blocks = F.coalesce(F.ceil(F.col("n") / limits.block), F.lit(1)).cast("int")
    dealt = short_entries.join(many, "word", "left").select("word", "id", blocks.alias("blocks"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.select("word", "id", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("word", "id", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    together = dealt.join(lists, "id").repartition("word", "lo", "hi").sortWithinPartitions("word", "lo", "hi")
    counted = together.mapInArrow(lean(_linked(similarity)), "id long, links long, matched boolean")

    words = lists.select("id", "words")
    joined = pairs.toDF("a", "b").join(words.toDF("a", "in_a"), "a").join(words.toDF("b", "in_b"), "b")
    sure = joined.select("a", "b", "in_a", "in_b").mapInArrow(lean(_verified(similarity)), "a long, b long")
    at = lists.select("id", F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "line").alias("at"))
    sure = sure.join(at.toDF("a", "at_a"), "a").join(at.toDF("b", "at_b"), "b")
    one = F.lit(1).cast("long")
    counted = counted.union(sure.select("a", one, F.col("at_b") < F.col("at_a"))).union(sure.select("b", one, F.col("at_a") < F.col("at_b")))
    total = staged(counted.groupBy("id").agg(F.sum("links").alias("links"), F.max("matched").alias("matched")))
    sent.unpersist()
    return total


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, limits: Limits = Limits()) -> DataFrame:
    """Every document without the lines that match an earlier one; one row per distinct document.

    Columns: ``doc_id``, ``text_hash`` (of the whole text), ``n_lines``,
    ``n_removed``, ``n_links`` (pairs of its lines with lines of another set of
    words) and ``removed`` (numbers of the removed lines, from 0).

    A line is its set of words without case. It is removed if any line before
    it, in the order of ``doc_id``, text hash and place, has the same set or
    one with Jaccard at least ``similarity``. Lines without a word stay. The
    decisions are one row per repeated or linked set of words; hot sets meet
    the places of their lines in a join that adaptive execution splits.

    A null text is an empty one. A null ``doc_id`` comes last. Rows that repeat
    id and text are one document and get the same result. An empty table gives
    an empty result.
    """
    texts = take(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text_hash", "text")
    survey = staged(texts.mapInArrow(lean(_survey(RARITY_SLOTS)), SURVEY))
    places = survey.where("id IS NOT NULL").select("doc_id", "text_hash", "line", "id")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "line")
    sets = places.groupBy("id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    judged = linked_lines(texts, survey, sets.select("id", "first"), similarity, limits)
    decided = sets.join(judged, "id", "left").where("n > 1 OR links IS NOT NULL")
    decided = staged(
        decided.select("id", "first", F.coalesce("matched", F.lit(False)).alias("matched"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    met = places.join(decided, "id").withColumn("removed", F.col("matched") | (place != F.col("first")))
    by_doc = met.groupBy("doc_id", "text_hash").agg(
        F.sum("links").alias("n_links"), F.array_sort(F.collect_set(F.when(F.col("removed"), F.col("line")))).alias("removed")
    )
    listed = survey.where("id IS NULL AND counts IS NULL").groupBy("doc_id", "text_hash").agg(F.max("line").alias("n_lines"))
    return join_documents(listed, by_doc).select(
        "doc_id",
        "text_hash",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size(F.coalesce("removed", F.expr("cast(array() as array<int>)"))).cast("long").alias("n_removed"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("removed", F.expr("cast(array() as array<int>)")).alias("removed"),
    )


def join_documents(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join by ``doc_id`` (null equals null) and ``text_hash``."""
    other = right.withColumnsRenamed({"doc_id": "__doc", "text_hash": "__text"})
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__text"))
    return left.join(other, same, "left").drop("__doc", "__text")


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines of these numbers."""
    lines = F.split(text, "\n", -1)
    kept = F.filter(F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i"))), lambda x: ~F.array_contains(removed, x["i"]))
    return F.array_join(F.transform(kept, lambda x: x["line"]), "\n")


def remove_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with all columns and rows, the text without the lines that match an earlier one.

    ``n_chars``, where there is such a column, follows the text. A null text
    stays null.
    """
    names = list(docs.columns)
    found = dedup_lines(docs, similarity).where("n_removed > 0").select("doc_id", "text_hash", "removed")
    doc_id, text = (f"__c{names.index(n)}" for n in ("doc_id", "text"))
    plain = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    plain = plain.withColumns({"doc_id": F.col(doc_id).cast("long"), "text_hash": F.xxhash64(whole_text(text))})
    joined = join_documents(plain, found)
    cleaned = F.when(F.col("removed").isNotNull(), without_lines(F.col(text), F.col("removed"))).otherwise(F.col(text))
    columns = [cleaned.alias("text") if n == "text" else F.length(cleaned).cast(docs.schema[i].dataType).alias(n)
               if n == "n_chars" else F.col(f"__c{i}").alias(n) for i, n in enumerate(names)]
    return joined.select(*columns)
