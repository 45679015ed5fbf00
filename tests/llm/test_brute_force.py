"""Operators beyond SQL against plain versions of themselves: votes, fits, scores and the whole pipeline."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from carelake.llm import lines, mixing, near, quality, simhash
from carelake.llm.common import shingles, table, word_hashes
from carelake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def scrambled(x):
    """The scrambling of 64-bit values, on plain integers."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def voted(text):
    """128 bits by counting the votes of each run of words one by one."""
    votes = [0.0] * 128
    for term, count in Counter(shingles(word_hashes(text)[0], 5).tolist()).items():
        hashed = scrambled(term).to_bytes(8, "little") + scrambled(term ^ 0x5851F42D4C957F2D).to_bytes(8, "little")
        for at, byte in enumerate(hashed):
            for bit in range(8):
                votes[8 * at + bit] += (1 + math.log(count)) * (1 if byte >> 7 - bit & 1 else -1)
    return bytes(sum(1 << 7 - b for b in range(8) if votes[8 * at + b] > 1e-9) for at in range(16)), votes


def test_simhash_is_the_vote_of_all_runs(spark):
    texts = [r.text or "" for r in table(spark, SF, "documents").select("text").limit(40).collect()]
    for text in [*texts, "", "one", "a b c d e f " * 50]:
        expected, votes = voted(text)
        found = simhash.fingerprint(text)
        differ = [b for b in range(128) if (expected[b // 8] ^ found[b // 8]) >> 7 - b % 8 & 1]
        # Only a vote that ends level, but for rounding, may come out either way.
        assert all(abs(votes[b]) < 1e-6 for b in differ)


def objective(rows, weights, cuts, ridge=0.3):
    """Mean negative log-likelihood of the ordinal model, with the penalty on hashed weights."""
    total = 0.0
    for grade, places, values in rows:
        score = sum(weights[p] * v for p, v in zip(places, values, strict=True))
        tails = [1.0, *(1 / (1 + math.exp(c - score)) for c in cuts), 0.0]
        total -= math.log(max(tails[grade] - tails[grade + 1], 1e-12))
    return (total + ridge / 2 * sum(w * w for w in weights[: quality.HASHED])) / len(rows)


def test_no_step_betters_the_ordinal_fit():
    dice = np.random.default_rng(6)
    used = np.array([3, 70, quality.HASHED, quality.HASHED + 1])
    rows = []
    for _ in range(400):
        values = dice.normal(size=4)
        score = 1.5 * values[0] - values[1] + 0.7 * values[2] + dice.logistic()
        rows.append((int(score > -0.5) + int(score > 1.0), used, values))
    model = quality.fit(rows, 3, steps=600)
    assert model.cuts[0] < model.cuts[1]
    best = objective(rows, model.weights, model.cuts)
    for step in (-0.3, -0.05, 0.05, 0.3):
        for place in used:
            weights = model.weights.copy()
            weights[place] += step
            assert objective(rows, weights, model.cuts) > best - 1e-4
        for k in range(2):
            cuts = model.cuts.copy()
            cuts[k] += step
            assert objective(rows, model.weights, cuts) > best - 1e-4


def test_scores_follow_features_weights_and_cuts(spark):
    dice = np.random.default_rng(8)
    model = quality.OrdinalModel(dice.normal(size=quality.HASHED + quality.SHAPES), np.array([-0.4, 0.6]))
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.classify(docs, table(spark, SF, "labels"), model=model).collect():
        places, values = quality.features(texts[r.doc_id] or "")
        score = float(model.weights[places] @ values)
        tails = [1 / (1 + math.exp(c - score)) for c in model.cuts]
        assert r.expected_grade == pytest.approx(sum(tails), abs=1e-9) and r.tail_probability == pytest.approx(tails[1], abs=1e-9)
        assert r.keep == (bool(quality.TOKEN.findall((texts[r.doc_id] or "").lower())) and r.tail_probability >= 0.5)


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The documents before each stage, and what the last stage returns."""
    root, found = tmp_path_factory.mktemp("stages"), [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], SF).write.parquet(str(root / name))
        found.append(spark.read.parquet(str(root / name)))
    return found


def counted(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_pipeline_keeps_what_the_classifier_accepts(spark, staged):
    judged = quality.classify(staged[0], table(spark, SF, "labels"))
    kept = {r.doc_id for r in judged.where("keep").collect()}
    assert counted(staged[1], *staged[0].columns) == counted(staged[0].where(F.col("doc_id").isin(kept)), *staged[0].columns)
    assert 0 < len(kept) < staged[0].count()


def test_pipeline_removes_the_matched_lines(spark, staged):
    removed = {r.doc_id: set(r.removed) for r in lines.dedup_lines(staged[1]).collect()}
    before = {r.doc_id: r.text for r in staged[1].collect()}
    after = {r.doc_id: r.text for r in staged[2].collect()}
    assert set(before) == set(after) and sum(map(len, removed.values())) > 0
    for doc_id, text in before.items():
        left = [line for i, line in enumerate(text.split("\n")) if i not in removed[doc_id]]
        assert after[doc_id] == "\n".join(left)


def test_pipeline_keeps_one_document_of_each_group(spark, staged):
    texts = {r.doc_id: r.text or "" for r in staged[2].collect()}
    items = {d: near.labelled_shingles(t) for d, t in texts.items()}
    sets = {d: word_hashes(t)[0].tobytes() for d, t in texts.items()}
    group = {d: d for d in texts}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] == sets[b] or near.alignment(items[a], items[b]) >= near.SIMILARITY:
                group[find(a)] = find(b)
    kept = [r.doc_id for r in staged[3].collect()]
    assert len(kept) == len({find(d) for d in ids}) == len({find(d) for d in kept})


def test_pipeline_repeats_documents_as_the_mix_says(spark, staged):
    copies = {r.doc_id: r.copies for r in mixing.mix(staged[3]).collect()}
    assert Counter(r.doc_id for r in staged[4].collect()) == Counter({d: n for d, n in copies.items() if n})


def test_pipeline_packs_every_token_once(spark, staged):
    encode = Tokenizer.from_file(tokenizer_path())
    want = sum(len(encode.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in staged[4].collect())
    pieces = staged[5].collect()
    assert sum(p.length for p in pieces) == want
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= 1024


def test_run_gives_the_rows_of_its_stages(spark, staged):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert counted(corpus_pipeline.run(spark, SF), *columns) == counted(staged[5], *columns)
