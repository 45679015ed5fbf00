"""SimHash components against comparing all fingerprints with each other."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from carelake.llm import pigeonhole
from carelake.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, bits long, N int, n int, key string, `a.b` int"


def plain_fingerprint(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashed = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def by_all_pairs(bits, radius=3):
    """The smallest number that reaches each fingerprint."""
    root = {b: b for b in bits}

    def find(b):
        while root[b] != b:
            b = root[b]
        return b

    values = list(root)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {b: find(b) for b in values}


def expected(rows):
    bits = [(doc_id, plain_fingerprint(text)) for doc_id, text in rows]
    root = by_all_pairs([b for _, b in bits])
    first = {}
    for doc_id, b in bits:
        if doc_id is not None:
            first[root[b]] = min(first.get(root[b], doc_id), doc_id)
    return sorted([(i, f"{b:016x}", first.get(root[b])) for i, b in bits], key=repr)


def result(df):
    return sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()], key=repr)


def test_a_run_hashes_as_the_engine_hashes_it(spark):
    text = "\x0bTwo  Wörds\t"
    hashed = spark.range(1).select(F.xxhash64(F.lit("two wörds"))).first()[0]
    assert pigeonhole.fingerprint(text) == hashed % (1 << 64) == plain_fingerprint(text)
    long = " ".join(random.Random(1).choice(["ab", "cd", "é", "X"]) for _ in range(70_000))
    assert pigeonhole.fingerprint(long) == plain_fingerprint(long)


def clustered(seed, count, bits=64):
    """Fingerprints in clusters, some bits nearly constant and some tied to others."""
    dice, out = random.Random(seed), set()
    while len(out) < count:
        centre = dice.getrandbits(bits) & ~0xFF | (0x0F if dice.random() < 0.9 else 0)
        centre = centre & ~(0xFFFF << 48) | (centre >> 16 & 0xFFFF) << 48
        for _ in range(dice.randint(1, 12)):
            out.add(centre ^ sum({1 << dice.randrange(64) for _ in range(dice.randint(0, 4))}))
    return sorted(out)


@pytest.mark.parametrize("layout", [*pigeonhole.LAYOUTS, (8,), (1,) * 8])
@pytest.mark.parametrize("radius", [0, 3])
def test_thresholds_reach_all_within_the_radius(layout, radius):
    values = np.array(clustered(2, 300), np.uint64)
    if layout == (8,):
        values = values[:3]
    joint = pigeonhole._joint(values)
    order = pigeonhole.lane_order(joint, len(values))
    assert sorted(order) == list(range(64))
    counts = pigeonhole._lane_counts(order)(values)
    model = pigeonhole.CostModel(order, counts, len(values), layout, radius, 5.0)
    thresholds, cost = model.thresholds(pigeonhole.in_lanes(values, order))
    assert (thresholds >= -1).all() and ((thresholds + 1).sum(axis=1) == radius + 1).all()
    listed, looked = {}, {}
    for key, bits, is_listed, looks in pigeonhole.entries(values, model):
        for k, b, x, y in zip(key.tolist(), bits.tolist(), is_listed, looks, strict=True):
            if x:
                listed.setdefault(k, set()).add(b)
            if y:
                looked.setdefault(b, set()).add(k)
    for a in values.tolist():
        met = set().union(*(listed.get(k, set()) for k in looked[a]))
        assert {b for b in values.tolist() if (a ^ b).bit_count() <= radius} <= met
    # No sharing out is cheaper than the one of the dynamic program.
    costs = model.costs(pigeonhole.in_lanes(values[:5], order))
    from itertools import product

    ways = [w for w in product(range(radius + 2), repeat=len(layout)) if sum(w) == radius + 1]
    for row, least in zip(costs, cost[:5], strict=True):
        assert least == pytest.approx(min(sum(row[i, t] for i, t in enumerate(w)) for w in ways))


@pytest.mark.parametrize("options", [{}, {"held": 3, "streamed": 2}, {"look_up": 0.001}, {"layouts": ((4, 4),), "held": 5}])
def test_links_connect_what_all_pairs_connect(spark, options):
    values = clustered(3, 600)
    # A dense group: everything within a few bits of one value.
    values = sorted({*values, *(0x1234567812345678 ^ 1 << a ^ 1 << b for a in range(24) for b in range(a))})
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = pigeonhole.links(spark.createDataFrame(rows, "bits long"), **options).collect()
    pairs = [(u % (1 << 64), v % (1 << 64)) for u, v in found]
    assert all(u != v and (u ^ v).bit_count() <= 3 for u, v in pairs)
    root = {v: v for v in values}

    def find(b):
        while root[b] != b:
            b = root[b]
        return b

    for u, v in pairs:
        root[max(find(u), find(v))] = min(find(u), find(v))
    assert {v: find(v) for v in values} == by_all_pairs(values)


def test_a_dense_group_gives_few_links():
    values = np.array([1 << a | 1 << b for a in range(24) for b in range(a)], np.uint64)
    assert len(list(pigeonhole._links(values, values, 3))) == 0 + len(values) - 1


def test_documents_equal_all_pairs(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    assert result(pigeonhole.near_components(docs)) == expected(docs.collect())


def test_odd_rows_and_empty_tables(spark):
    long = "word and another " * 30_000
    base = "one two three four five six seven eight nine ten " * 8
    rows = [
        (5, base, 1, 1, 1, "k", 1),
        (4, base.upper(), 1, 1, 1, "k", 1),
        (4, base.upper(), 1, 1, 1, "k", 1),
        (None, base + "eleven", None, None, None, None, None),
        (None, "alone é", None, None, None, None, None),
        (7, None, 1, 1, 1, "k", 1),
        (8, "", 1, 1, 1, "k", 1),
        (9, " \t\n\x0b\x0c\r", 1, 1, 1, "k", 1),
        (10, long, 1, 1, 1, "k", 1),
        (11, long + "end", 1, 1, 1, "k", 1),
        (12, "one", 1, 1, 1, "k", 1),
        (13, "one two", 1, 1, 1, "k", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert result(pigeonhole.near_components(docs)) == expected([r[:2] for r in rows])
    assert pigeonhole.near_components(docs.limit(0)).count() == 0
    only = pigeonhole.near_components(docs.where("text is null"))
    assert result(only) == [(7, "0" * 16, 7)]
