"""Packing documents into training sequences: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow_rows, forgettable, in_batches, take, whole_text

# Words and line starts that are kept, and places for words met once.
CACHED, STARTS, ONCE = 1 << 19, 1 << 17, 1 << 22
PUNCTUATION = ".,;:!?%&$#*|"
LATIN_END = "\u0250"
TWO_BLANKS = re.compile(r"\s\s")


class ChunkedTokenizer:
    """Token ids of a text as bytes (little-endian 32-bit), equal to encoding it whole.

    A byte-level BPE never merges across a blank or line break between two
    words, nor between the letters of a word and the punctuation after them.
    So a text without adjacent white space is looked up word by word; what was
    not met before goes to the tokenizer in one call. Any other text is
    encoded whole. Most words of a large table are met once; so
    a word is kept from its second time on, and of the first a mark remains.
    The table of known words is emptied when it holds :data:`CACHED` (some
    100 MB).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.met, self.marks = bytearray(ONCE), 0
        # Special tokens may be recognised anywhere in a text, across words too.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        splits = self.tokenizer.pre_tokenizer
        # In joined words each token that holds a blank or a line break begins a word.
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] in ("\u0120", "\u010a")]] = True
        self.by_word = "ByteLevel" in str(splits) and "add_prefix_space=False" in str(splits) and not self.tokenizer.normalizer

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text that stands at the start of a line or after letters."""
        ids = self.known.get(text)
        if ids is None:
            if len(self.known) >= STARTS:
                self.known.clear()
            ids = self.known[text] = self._encode(text)
        return ids

    def _keep(self, words: dict[str, bytes]) -> None:
        """Of words with their ids, add those met before to the known ones, and mark the others."""
        if len(self.spaced) >= CACHED:
            self.spaced.clear()
        if self.marks >= ONCE // 2:
            self.met, self.marks = bytearray(ONCE), 0
        met, spaced, before = self.met, self.spaced, len(self.spaced)
        for word, ids in words.items():
            place = hash(word) & ONCE - 1
            if met[place]:
                spaced[word] = ids
            else:
                met[place] = 1
        self.marks += len(words) - (len(spaced) - before)

    def _apart(self, starts: list[str], words: list[str]) -> list[bytes]:
        """Ids of starts of lines and of words after a blank, none of which holds white space."""
        joined = "".join(["\n" + start for start in starts] + [" " + word for word in words])
        ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids, "<u4")
        at = (np.flatnonzero(self.begins[ids]) * 4).tolist()
        if len(at) != len(starts) + len(words):
            return [self._encode(start) for start in starts] + [self._encode(" " + word) for word in words]
        data, ends, n = ids.tobytes(), [*at[1:], 4 * len(ids)], len(starts)
        # The line break before a start is one token.
        return [data[i + 4 : j] for i, j in zip(at[:n], ends)] + [data[i:j] for i, j in zip(at[n:], ends[n:])]

    def _learn(self, starts: set[str], words: set[str]) -> dict[str, bytes]:
        """Ids of the words, each after a blank; those of the starts of lines are among the known then."""
        parted, learnt, new = {}, {}, {}
        for word in words:
            core = word.rstrip(PUNCTUATION)
            if core.isalpha() and (core.isascii() or max(core) < LATIN_END):
                parted[word] = core
                if core not in self.spaced:
                    new[core] = None
            elif word.split() == [word]:
                new[word] = None
            else:
                learnt[word] = self._encode(" " + word)
        begun = [start for start in starts if start.split() == [start]]
        found = self._apart(begun, list(new))
        if len(self.known) >= STARTS:
            self.known.clear()
        self.known.update(zip(begun, found))
        learnt.update(zip(new, found[len(begun) :], strict=True))
        for word, core in parted.items():
            if word not in learnt:
                ids = learnt[core] if core in learnt else self.spaced[core]
                learnt[word] = ids + self._plain(word[len(core) :])
        self._keep(learnt)
        return learnt

    def ids(self, text: str) -> bytes:
        if not self.by_word or TWO_BLANKS.search(text) or any(s in text for s in self.special):
            return self._encode(text)
        lines = [line.split(" ") for line in text.split("\n")]
        rest = [words[1:] for words in lines]
        get = self.spaced.get
        found = [list(map(get, words)) for words in rest]
        holes = [(ids, words) for ids, words in zip(found, rest, strict=True) if None in ids]
        starts = {words[0] for words in lines if words[0] and words[0] not in self.known}
        if holes or starts:
            learnt = self._learn(starts, {w for ids, words in holes for i, w in zip(ids, words, strict=True) if i is None})
            for ids, words in holes:
                ids[:] = [learnt[w] if i is None else i for i, w in zip(ids, words, strict=True)]
        newline, out = self._plain("\n"), []
        for n, (words, ids) in enumerate(zip(lines, found, strict=True)):
            if n:
                out.append(newline)
            if words[0]:
                out.append(self._plain(words[0]))
            out += ids
        return b"".join(out)


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> ChunkedTokenizer:
    return ChunkedTokenizer(path)


forgettable(_tokenizer.cache_clear)


class Piece:
    """A run of one document's tokens that may still be cut."""

    __slots__ = ("key", "start", "tokens", "loss")

    def __init__(self, key, start: int, tokens: int, loss: int):
        self.key, self.start, self.tokens, self.loss = key, start, tokens, loss

    def cut(self, tokens: int) -> tuple[Piece, Piece]:
        """Head of ``tokens`` tokens and the rest; the loss-bearing tokens are the last ones."""
        prompt = self.tokens - self.loss
        head_loss = max(0, tokens - prompt)
        return (
            Piece(self.key, self.start, tokens, head_loss),
            Piece(self.key, self.start + tokens, self.tokens - tokens, self.loss - head_loss),
        )


def pack(
    pieces: Iterable[Piece],
    capacity: int = 1024,
    max_segments: int = 256,
    max_loss: int | None = None,
    window: int = 1024,
    cut: bool = True,
) -> Iterator[list[Piece]]:
    """Sequences of pieces within all three limits: tokens, segments, loss-bearing tokens.

    Up to ``window`` pieces wait. A sequence is filled one piece at a time with
    the waiting piece that fits and whose demand vector has the largest dot
    product with what is left of the limits, each dimension weighted by the
    waiting pieces' mean demand. With ``cut``, the piece that comes next is
    divided where the tokens or the loss-bearing tokens run out, so that a
    sequence ends full unless its segments run out; without it, pieces stay
    whole (a piece over the limits is still divided, as nothing could hold it).
    """
    limit = np.array([capacity, max_segments, capacity if max_loss is None else max_loss], float)
    demand = np.zeros((window, 3))
    waiting: list[Piece] = []

    def put(piece: Piece) -> None:
        demand[len(waiting)] = piece.tokens, 1, piece.loss
        waiting.append(piece)

    def drop(i: int) -> Piece:
        piece, last = waiting[i], waiting.pop()
        if last is not piece:
            waiting[i] = last
            demand[i] = demand[len(waiting)]
        return piece

    def room(tokens, loss, left: np.ndarray):
        """The most tokens of a piece, or of several, that fit."""
        return np.minimum(np.minimum(tokens, left[0]), tokens - loss + left[2])

    def sequence() -> list[Piece]:
        left, chosen = limit.copy(), []
        weights = demand[: len(waiting)].mean(axis=0) / limit
        while waiting and left[0] > 0 and left[1] > 0:
            need = demand[: len(waiting)]
            fits = np.flatnonzero((need[:, 0] <= left[0]) & (need[:, 1] <= left[1]) & (need[:, 2] <= left[2]))
            if len(fits):
                piece = drop(int(fits[np.argmax(need[fits] @ (weights * left / limit / limit))]))
            elif cut:
                fitting = room(need[:, 0], need[:, 2], left)
                i = int(np.argmax(fitting))
                tokens = int(fitting[i])
                if tokens <= 0:
                    break
                piece, rest = drop(i).cut(tokens)
                put(rest)
            else:
                break
            chosen.append(piece)
            left -= (piece.tokens, 1, piece.loss)
        return chosen

    for piece in pieces:
        while (tokens := int(room(piece.tokens, piece.loss, limit))) < piece.tokens:
            if tokens <= 0:
                raise ValueError("a limit of 0 holds nothing")
            head, piece = piece.cut(tokens)
            yield [head]
        if piece.tokens:
            if len(waiting) == window:
                yield sequence()
            put(piece)
    while waiting:
        yield sequence()


def unpadded(sequence: list[Piece], capacity: int) -> Iterator[list[Piece]]:
    """A full sequence as it is; a shorter one in parts whose lengths are powers of two."""
    total = sum(p.tokens for p in sequence)
    if total == capacity:
        yield sequence
        return
    rest = list(reversed(sequence))
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            part, left = [], 1 << bit
            while left:
                piece = rest.pop()
                if piece.tokens > left:
                    piece, tail = piece.cut(left)
                    rest.append(tail)
                part.append(piece)
                left -= piece.tokens
            yield part


RESULT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)
_SCHEMA = pa.schema([(f.split()[0], pa.int64()) for f in RESULT.split(", ")])


def _pack_task(path: str, end_id: int, settings: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        end = np.array([end_id], "<u4").tobytes()
        task = TaskContext.get().partitionId()

        def pieces() -> Iterator[Piece]:
            for doc_id, text, prompt in arrow_rows(batches, "doc_id", "text", "prompt"):
                before = tokenizer.ids(prompt) if prompt else b""
                ids = before + tokenizer.ids(text) + end
                tokens = len(ids) // 4
                yield Piece((doc_id, ids, tokens), 0, tokens, tokens - len(before) // 4)

        def rows():
            number = 0
            for sequence in pack(pieces(), **settings):
                for part in unpadded(sequence, settings["capacity"]):
                    offset = 0
                    for p in part:
                        doc_id, ids, tokens = p.key
                        crc = zlib.crc32(ids[4 * p.start : 4 * (p.start + p.tokens)])
                        yield doc_id, p.start, p.tokens, crc, tokens, task << 40 | number, offset, p.loss
                        offset += p.tokens
                    number += 1

        yield from in_batches(rows(), _SCHEMA, 8192)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    prompt: str | None = None,
    capacity: int = 1024,
    max_segments: int = 256,
    max_loss: int | None = None,
    window: int = 1024,
    cut: bool = True,
) -> DataFrame:
    """Pieces of all documents and their places in sequences; see :data:`RESULT`.

    A document is the ids of its text and then ``end_id``. ``prompt`` names a
    column of text that comes first and bears no loss, for instruction data.
    Every task packs the documents it reads, with at most ``window`` of them
    waiting, so nothing shuffles and a sequence id is the task's number and a
    count. Sequences that cannot be filled are divided into lengths that are
    powers of two, which need no padding.

    A null text or prompt is empty: such a document is the end id alone. Null
    ids pass through; repeated rows are packed each. An empty table gives an
    empty result.
    """
    if prompt:
        rows = take(docs, "doc_id", "text", prompt).withColumnRenamed(prompt, "prompt")
    else:
        rows = take(docs, "doc_id", "text").withColumn("prompt", F.lit(""))
    texts = rows.select(F.col("doc_id").cast("long"), whole_text().alias("text"), whole_text("prompt").alias("prompt"))
    settings = {"capacity": capacity, "max_segments": max_segments, "max_loss": max_loss, "window": window, "cut": cut}
    return texts.mapInArrow(_pack_task(tokenizer_path, end_id, settings), RESULT)
