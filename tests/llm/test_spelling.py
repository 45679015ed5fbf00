"""Spelling variants against comparing all words with each other."""

import random
import re
import zlib
from collections import Counter

import pytest

from carelake.llm import spelling
from carelake.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n long, WORD string, word string, `a.b` int"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_all_pairs(rows, every=97, least=3):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            hashed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if hashed % every == 0:
                at = hashed % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= least}
    out = {}
    for word, n in count.items():
        found = sorted((-count[w], w) for w in count if near(word, w))
        form = found[0][1] if found and -found[0][0] >= 2 * n else None
        out[word] = (form, n, len(found), count[form] if form else None)

    def root(word):
        return root(out[word][0]) if out[word][0] else word

    return {w: (f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def result(df):
    rows = [(r["word"], (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_scan_of_sorted_words_finds_each_pair_that_shares_the_first_half():
    dice = random.Random(5)
    words = sorted({"".join(dice.choice("abé") for _ in range(dice.randint(1, 8))) for _ in range(800)})
    coded = [w.encode("latin-1") for w in words]
    queries = [words[0], "zzzzzz", "a", *words]
    mine, found = spelling.SortedWords(coded).one_edit([q.encode("latin-1") for q in queries])
    pairs = [(q, w) for q, w in zip(mine.tolist(), found.tolist(), strict=True)]
    assert len(pairs) == len(set(pairs))
    assert {(i, words[w]) for i, w in pairs} == {
        (i, w) for i, q in enumerate(queries) for w in words if w.startswith(q[: len(q) // 2 if len(q) > 2 else 0]) and near(q, w)
    }
    mine, found = spelling.SortedWords([]).one_edit([b"abcde"])
    assert len(mine) == len(found) == 0


def test_long_words_and_many_cells(monkeypatch):
    monkeypatch.setattr(spelling, "HELD_CELLS", 50)
    words = sorted([b"ab" * 20_000, b"ab" * 20_000 + b"c", b"abcde", b"abcdf", b"abxde"])
    mine, found = spelling.SortedWords(words).one_edit(words)
    pairs = {(words[a][-3:], words[b][-3:]) for a, b in zip(mine.tolist(), found.tolist(), strict=True)}
    assert pairs == {(b"bab", b"abc"), (b"abc", b"bab"), (b"cde", b"cdf"), (b"cdf", b"cde"), (b"cde", b"xde"), (b"xde", b"cde")}


@pytest.mark.parametrize("segment", [8192, 32])
def test_variants_equal_all_pairs(spark, segment):
    docs = table(spark, SF, "documents").select("doc_id", "text").where("doc_id < 70")
    expected = by_all_pairs(docs.collect())
    assert result(spelling.variants(docs, segment=segment)) == expected
    assert sum(f is not None for f, *_ in expected.values()) > 0


def test_chains_ties_and_a_short_alphabet(spark):
    dice = random.Random(3)
    rows = []
    for i in range(400):
        word = "".join(dice.choice("abÿ") for _ in range(dice.randint(4, 7)))
        rows.append((i, " ".join([word.upper() if i % 2 else word] * dice.randint(1, 40))))
    # Each word of the chain is one edit from the next, which occurs twice as often.
    rows += [(1000 + k, " ".join(["mmmmm"[: 5 - k] + "nnnnn"[:k]] * (5 << k))) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = by_all_pairs(rows)
    assert expected["mmmmm"][1] == "nnnnn"
    assert result(spelling.variants(docs, segment=16)) == expected


def test_odd_rows_and_empty_tables(spark):
    long = "word" * 50_000
    rows = [
        (None, "house house HOUSE mouse mouse mouse", 1, "x", "y", 1),
        (None, "house house HOUSE mouse mouse mouse", 1, "x", "y", 1),
        (1, None, 1, None, None, None),
        (2, "", None, None, None, None),
        (3, "été×÷ÿ été×÷ÿ été×÷ÿ Œuvre 12 é", 1, "x", "y", 1),
        (4, f"{long} {long} {long}", 1, "x", "y", 1),
        (4, "house " * 9, 1, "x", "y", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert result(spelling.variants(docs)) == by_all_pairs([r[:2] for r in rows])
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "- 1 2")], "doc_id long, text string")).count() == 0


def test_registered_query_reads_whole_texts(spark):
    from carelake.llm.queries import queries

    found = queries()["op11_spelling_variants"](spark, SF)
    assert found.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t for _, t in found.dtypes] == ["string", "string", "string", "bigint", "bigint", "bigint"]
