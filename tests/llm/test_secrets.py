"""Many secrets in one text, and what belongs together."""

import random
import time

from carelake.llm import secrets


def spans_of(row):
    return [(s["kind"], s["start"], s["end"]) for s in row["found"]]


def test_a_hundred_thousand_spans_in_one_text(spark):
    dice = random.Random(2)
    texts, expected, at = [], [], 0
    for _ in range(100_000):
        word = "".join(dice.choice("0123456789abcdef") for _ in range(16))
        gap = "-" * dice.randint(1, 3)
        expected.append((2, at + len(gap), at + len(gap) + 16))
        texts.append(gap + word)
        at += len(gap) + 16
    docs = spark.createDataFrame([(1, "".join(texts)), (2, "")], "doc_id long, text string")
    began = time.time()
    found = {r.doc_id: r for r in secrets.scan(docs).collect()}
    assert time.time() - began < 60
    assert found[1].n_hex == 100_000 and spans_of(found[1]) == expected


def test_links_are_the_nearest_parts(spark):
    dice = random.Random(7)
    pieces = ["password = 'abcdefghijkl'", "token: abc1234", "user=ann", "AKIA" + "B" * 16, "https://h/x", "0123456789abcdef", "\n" * 60, "é🙂 " * 25]
    docs = [(i, " ".join(dice.choice(pieces) for _ in range(40))) for i in range(40)] + [(100, None), (101, pieces[0]), (102, "user=ann token: abc1234")]
    rows = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    roles = [k[5] for k in secrets.KINDS]
    for doc_id, row in rows.items():
        assert doc_id < 100 or row["links"] == ("short:9:23>login:0:8>" if doc_id == 102 else "")
        for link in filter(None, row["links"].split(",")):
            secret, identifier, endpoint = link.split(">")
            kind, start, _ = secret.split(":")
            assert roles[[k[0] for k in secrets.KINDS].index(kind)] == "secret"
            # A reported part of the role that is nearer, or as near and earlier, does not exist.
            for other, role in ((identifier, "identifier"), (endpoint, "endpoint")):
                near = sorted((abs(s["start"] - int(start)), s["start"]) for s in row["found"] if roles[s["kind"]] == role)
                near = [x for x in near if x[0] <= secrets.SCOPE]
                if other:
                    at = int(other.split(":")[1])
                    assert not near or (abs(at - int(start)), at) <= near[0]
                else:
                    assert not near
