"""Equi joins that stay balanced when one key holds a large share of the rows of either side.

Hot keys are found by a sketch in two levels. In the join, the rows of a hot
key form a grid: the left side is cut into ``a`` parts, the right side into
``b``, and every part of one side meets every part of the other in a cell of
its own. A side is copied only as often as the other one is cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEFT_PART, RIGHT_PART = "__left_part", "__right_part"
DEFAULT_SHARE = 0.02
DEFAULT_SALTS = 32
# Below this many rows a hot key still fits one task easily.
MIN_HOT_ROWS = 1_000_000
# Most parts that one side of a key is cut into.
MOST_PARTS = 256
# Sketches that reach the last task, however many tasks there are.
SKETCH_GROUPS = 64


def sketched(df: DataFrame, column: str, items: int, *by: str) -> DataFrame:
    """``by``, rows ``n``, rows ``known`` (not null) and a mergeable sketch ``top`` of the column's values.

    The tasks' sketches are merged in :data:`SKETCH_GROUPS` groups, so that
    whoever merges those has a fixed number of them.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__group")
    return df.groupBy(*by, group).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(column).alias("known"),
        F.expr(f"approx_top_k_accumulate(`{column}`, {items})").alias("top"),
    ).drop("__group")


def merged(sketches: DataFrame, items: int, k: int, *by: str) -> DataFrame:
    """``by``, ``n`` and ``top``: the ``k`` most frequent values of each group with their estimated counts.

    Sketches without any value cannot be merged; they are left out, and a
    group that has no other is missing.
    """
    grouped = sketches.where("known > 0").groupBy(*(by or [F.lit(0).alias("all")])).agg(
        F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(top, {items})").alias("top")
    )
    return grouped.select(*by, "n", F.expr(f"approx_top_k_estimate(top, {k})").alias("top"))


def hot_parts(
    df: DataFrame, key: str, share: float = DEFAULT_SHARE, min_rows: int = MIN_HOT_ROWS
) -> dict[object, int]:
    """Values of ``key`` with more than ``share`` of the rows, and into how many parts to cut each; null may be one.

    A part has about ``share`` of the rows, or ``min_rows`` if that is more. At
    most ``1 / share`` values come back, however large the input is. The
    counts are estimates and steer only how a join is laid out.
    """
    k = max(1, int(1 / share))
    items = max(10_000, 10 * k)
    sketches = sketched(df.select(key), key, items).persist()
    try:
        total, known = sketches.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
        rows = merged(sketches, items, k).collect()
    finally:
        sketches.unpersist()
    floor = max(min_rows, share * total)
    counts = {t["item"]: t["count"] for row in rows for t in row["top"]} | {None: total - known}
    return {item: min(MOST_PARTS, -int(-n // floor)) for item, n in counts.items() if n > floor}


def hot_keys(
    df: DataFrame, key: str, share: float = DEFAULT_SHARE, min_rows: int = MIN_HOT_ROWS
) -> list:
    """Values of ``key`` that hold more than ``share`` of the rows; null may be one."""
    return list(hot_parts(df, key, share, min_rows))


def _is_hot(column: Column, hot: Sequence) -> Column:
    known = [value for value in hot if value is not None]
    return F.coalesce(column.isin(known), F.lit(None in hot))


def _parts(column: Column, parts: Mapping[object, int]) -> Column:
    """The number of parts of each key; 1 for all that are not listed."""
    out = F.lit(1)
    for n in sorted(set(parts.values()) - {1}):
        out = F.when(_is_hot(column, [k for k, m in parts.items() if m == n]), F.lit(n)).otherwise(out)
    return out


def _dealt(df: DataFrame, key: Column, own: Mapping[object, int], other: Mapping[object, int], names: Sequence[str]) -> DataFrame:
    """Each row with its own part, taken from the row itself, and a copy for every part of the other side."""
    mine, theirs = names
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), _parts(key, own)).cast("int")
    placed = df.withColumn(mine, part if set(own.values()) - {1} else F.lit(0))
    if not set(other.values()) - {1}:
        return placed.withColumn(theirs, F.lit(0))
    return placed.withColumn(theirs, F.explode(F.sequence(F.lit(0), _parts(key, other) - 1)))


def grid_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], cells: Mapping[object, tuple[int, int]], how: str = "inner"
) -> DataFrame:
    """Inner or left join on ``on``; ``cells`` tells for values of its first column how to cut either side.

    Other rows are joined as usual, so the result is exactly that of the plain
    join. A row's part comes from the row itself, so a retried task gives the
    same answer. Null keys match nothing, but their parts spread the left rows
    that a left join must keep. A left join may cut the left side alone: a copy
    of a left row could miss in one cell what it meets in another.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot cut a {how} join")
    if how == "left" and any(b > 1 for _, b in cells.values()):
        raise ValueError("cannot cut the right side of a left join")
    on = list(on)
    if not cells:
        return left.join(right, on, how)
    key = F.col(on[0])
    rows, columns = {k: a for k, (a, _) in cells.items()}, {k: b for k, (_, b) in cells.items()}
    names = (LEFT_PART, RIGHT_PART)
    placed = _dealt(left, key, rows, columns, names)
    others = _dealt(right.where(key.isNotNull()), key, columns, rows, names[::-1])
    return placed.join(others, [*on, *names], how).drop(*names)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    hot: Sequence,
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Join on ``on``; left rows whose first key is in ``hot`` are cut into ``salts`` parts."""
    return grid_join(left, right, on, {key: (salts, 1) for key in hot}, how)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    share: float = DEFAULT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join on one key, cutting the keys found hot on either side.

    Keys hot on the right do have a match, so in a left join their left rows
    are joined on their own, as an inner join.
    """
    rows = hot_parts(left, on, share, min_rows)
    columns = {k: n for k, n in hot_parts(right, on, share, min_rows).items() if k is not None}
    cells = {k: (rows.get(k, 1), columns.get(k, 1)) for k in {**rows, **columns}}
    if how == "inner" or not columns:
        return grid_join(left, right, [on], cells, how)
    matched = _is_hot(F.col(on), list(columns))
    rest = grid_join(left.where(~matched), right.where(~matched), [on], {k: c for k, c in cells.items() if k not in columns}, how)
    hot = grid_join(left.where(matched), right.where(matched), [on], {k: cells[k] for k in columns})
    return rest.unionByName(hot)
