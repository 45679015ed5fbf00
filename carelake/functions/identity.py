"""Pseudonyms, node ids and numeric UIDs as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: root of the generated UIDs.
UID_ROOT = "1.2.826.0.1.3680043.10.543."


def pseudonym(value: Column, keep: int = 16) -> Column:
    """First ``keep`` hex digits of the SHA-256 of the value's text; null stays null."""
    return F.substring(F.sha2(value.cast("string"), 256), 1, keep)


def node_id(*parts: Column, keep: int = 32) -> Column:
    """Hash of several keys: the first ``keep`` hex digits, 128 bits by default.

    Every part goes in with its length before it, a missing part as ``-``, so
    that keys of varying length never run into each other.
    """
    texts = [p.cast("string") for p in parts]
    framed = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return pseudonym(F.concat(*framed), keep)


# 10^18 is 2^18 * 5^18. Both remainders fit 64-bit arithmetic, the whole does not.
TWOS, FIVES = 2**18, 5**18
FIVES_INVERSE = pow(FIVES, -1, TWOS)


def surrogate_uid(seed: Column, root: str = UID_ROOT) -> Column:
    """``root`` followed by the seed's SHA-256, read as one integer, modulo 10^18.

    The 64 hex digits, with a zero in front, are taken as thirteen 20-bit
    chunks. They are folded modulo 5^18; the last chunk alone gives the
    remainder modulo 2^18; the two remainders fix that modulo 10^18.
    """
    digest = F.concat(F.lit("0"), F.sha2(seed.cast("string"), 256))
    chunks = [F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("long") for i in range(13)]
    by_fives = chunks[0]
    for chunk in chunks[1:]:
        by_fives = (by_fives * F.lit(2**20) + chunk) % F.lit(FIVES)
    gap = F.pmod(chunks[-1] - by_fives, F.lit(TWOS))
    number = by_fives + F.lit(FIVES) * ((gap * F.lit(FIVES_INVERSE)) % F.lit(TWOS))
    return F.concat(F.lit(root), number.cast("string"))
