"""Secret scans with multipart credential linking, in DataFrame expressions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import staged, take, whole_text

SCOPE = 200
# Kinds in their order, each with its pattern, the group whose
# length counts, the least and most characters of it and the part it plays.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (
    ("assign", ASSIGN, 2, 12, None, "secret"),
    ("access", r"AKIA[A-Z0-9]+", 0, 18, None, "identifier"),
    ("hex", r"[0-9a-f]{16,}", 0, 16, None, "secret"),
    ("short", ASSIGN, 2, 6, 11, "secret"),
    ("login", r"""(?i)\b(user|username|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 2, 3, None, "identifier"),
    ("endpoint", r"""(?:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqps?|ftp)://[^\x00-\x20"'<>]+|\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?\b""", 0, 7, None, "endpoint"),
)
BASE = 3
# Matches whose positions are summed up one by one; a text with more is cut into pieces of so many.
TOGETHER = 256
SPANS = "array<struct<start:long,end:long,kind:int>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda total, n: total + n)


def _width(piece: Column) -> Column:
    """Code points from the end of what comes before a piece to the end of its last match."""
    return _total(F.transform(piece, lambda one: (one["gap"] + one["width"]).cast("long")))


def _spans(kind: int) -> Column:
    """Spans of one kind in ``text``, in order.

    The texts between the matches, from a split at the same pattern, give
    where each match starts; both functions count code points. Positions are
    summed up piece by piece, so the work grows with the number of matches.
    """
    _, pattern, group, least, most, _ = KINDS[kind]
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else found
    gaps = F.slice(F.split("text", pattern, -1), 1, F.size(found))
    lengths = F.zip_with(
        F.arrays_zip(gaps.alias("gap"), found.alias("found")),
        value,
        lambda pair, v: F.struct(
            F.length(pair["gap"]).alias("gap"), F.length(pair["found"]).alias("width"), F.length(v).alias("value")
        ),
    )

    def step(state: Column, one: Column) -> Column:
        start = state["at"] + one["gap"]
        end = start + one["width"]
        fits = one["value"] >= least if most is None else one["value"].between(least, most)
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"))
        kept = F.when(fits, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    def piece_spans(piece: Column, at: Column) -> Column:
        begun = F.struct(at.alias("at"), F.expr(f"cast(array() as {SPANS})").alias("spans"))
        return F.aggregate(piece, begun, step, lambda state: state["spans"])

    def whole(ones: Column) -> Column:
        many = F.sequence(F.lit(0), F.floor((F.size(ones) - 1) / TOGETHER).cast("int"))
        pieces = F.transform(many, lambda i: F.slice(ones, i * TOGETHER + 1, F.lit(TOGETHER)))
        return _bound(pieces, lambda cut: _bound(F.transform(cut, _width), lambda widths: F.flatten(
            F.transform(cut, lambda piece, i: piece_spans(piece, _total(F.slice(widths, F.lit(1), i))))
        )))

    all_spans = _bound(lengths, whole)
    return F.when(F.col("text").rlike(pattern), all_spans).otherwise(F.expr(f"cast(array() as {SPANS})"))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _sorted(spans: Column) -> Column:
    """By start, then kind."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak spans (``row``, ``start``, ``end``, ``kind``) whose complementary parts are near.

    ``parts`` has the spans of all kinds. Near means starting at most ``scope``
    code points apart in one text. A weak secret needs an identifier or an
    endpoint, a weak identifier needs a secret, an endpoint needs both. The
    interval join goes by stretches of ``scope`` code points: what is in the
    same stretch is near, of the one before only the last start can matter, of
    the one after only the first. So per stretch and role one row joins, and
    no pairs arise however many parts a text has.
    """
    role = F.element_at(F.array(*[F.lit(k[5]) for k in KINDS]), F.col("kind") + 1)
    parts = parts.withColumn("role", role).withColumn("stretch", F.floor(F.col("start") / scope))
    known = parts.groupBy("row", "stretch", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    known = known.select("row", "stretch", F.col("role").alias("other"), "first", "last")
    weak = parts.where(F.col("kind") >= BASE).withColumn("step", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    weak = weak.withColumn("stretch", F.col("stretch") + F.col("step"))
    near = (
        (F.col("step") == 0)
        | ((F.col("step") < 0) & (F.col("last") >= F.col("start") - scope))
        | ((F.col("step") > 0) & (F.col("first") <= F.col("start") + scope))
    )
    met = weak.join(known, ["row", "stretch"]).where(near & (F.col("other") != F.col("role")))
    has = {r: F.max(F.col("other") == r) for r in ("secret", "identifier", "endpoint")}
    judged = met.groupBy("row", "start", "end", "kind", "role").agg(*[c.alias(r) for r, c in has.items()])
    enough = (
        ((F.col("role") == "secret") & (F.col("identifier") | F.col("endpoint")))
        | ((F.col("role") == "identifier") & F.col("secret"))
        | ((F.col("role") == "endpoint") & F.col("identifier") & F.col("secret"))
    )
    return judged.where(enough).select("row", "start", "end", "kind")


def links(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``row`` and ``links``: for each secret the nearest identifier and the nearest endpoint within the scope.

    A link is the text ``secret>identifier>endpoint``, each as
    ``kind:start:end``, empty where there is none; a secret without either has
    no link. Of equally near parts the earlier one counts, of parts with one
    start the first kind. Two running extremes per text find them, no pairs.
    """
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    role = F.element_at(F.array(*[F.lit(k[5]) for k in KINDS]), F.col("kind") + 1)
    said = F.concat_ws(":", F.element_at(names, F.col("kind") + 1), F.col("start").cast("string"), F.col("end").cast("string"))
    rows = parts.withColumn("role", role).withColumn("said", said)
    until = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    since = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def candidate(wanted: str, order: Column) -> Column:
        return F.when(F.col("role") == wanted, F.struct("start", order.alias("order"), "said"))

    others = ("identifier", "endpoint")
    rows = rows.withColumns({f"{o}_before": F.max(candidate(o, -F.col("kind"))).over(until) for o in others})
    rows = rows.withColumns({f"{o}_after": F.min(candidate(o, F.col("kind"))).over(since) for o in others})

    def nearest(other: str) -> Column:
        back = F.col("start") - F.col(f"{other}_before.start")
        ahead = F.col(f"{other}_after.start") - F.col("start")
        earlier = (back <= scope) & (back <= F.coalesce(ahead, back))
        return F.when(earlier, F.col(f"{other}_before.said")).when(ahead <= scope, F.col(f"{other}_after.said")).otherwise(F.lit(""))

    found = rows.where(F.col("role") == "secret").select("row", "start", "kind", "said", nearest(others[0]).alias("i"), nearest(others[1]).alias("e"))
    found = found.where((F.col("i") != "") | (F.col("e") != "")).withColumn("link", F.concat_ws(">", "said", "i", "e"))
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "link")))
    return found.groupBy("row").agg(F.array_join(F.transform(listed, lambda x: x["link"]), ",").alias("links"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Secrets of every document; one row per row of ``docs``.

    Columns: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``,
    ``spans`` (``kind:start:end``, by start and kind, comma-joined), ``links``
    (what belongs together, see :func:`links`, comma-joined) and ``found`` (the
    spans as structs). ``assign``, ``access`` and ``hex`` are
    always reported; ``short``, ``login`` and ``endpoint`` are weak and
    reported where :func:`linked` finds their complement.

    Texts are read once and nothing of them shuffles; only spans do. A null
    text is an empty one, null ids pass through, repeated rows are scanned
    each, an empty table gives an empty result.
    """
    texts = take(docs, "doc_id", "text").select("doc_id", whole_text().alias("text"))
    base = F.flatten(F.array(*[_spans(k) for k in range(BASE)]))
    weak = F.flatten(F.array(*[_spans(k) for k in range(BASE, len(KINDS))]))
    rows = staged(
        texts.select("doc_id", base.alias("base"), weak.alias("weak"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    parts = rows.where(F.size("weak") > 0).select("row", F.inline(F.concat("base", "weak")))
    added = linked(parts, scope).groupBy("row").agg(
        F.collect_list(F.struct("start", "end", "kind")).alias("linked")
    )
    several = rows.where(F.size("base") + F.size("weak") > 1).select("row", F.inline(F.concat("base", "weak")))
    together = links(several, scope)
    none = F.expr(f"cast(array() as {SPANS})")
    found = _sorted(F.concat("base", F.coalesce("linked", none)))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return rows.join(added, "row", "left").join(together, "row", "left").select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k][0]}") for k in range(BASE)],
        F.sha2(_listed(_sorted(F.col("base"))), 256).alias("base_sha256"),
        _listed(found).alias("spans"),
        F.coalesce("links", F.lit("")).alias("links"),
        found.alias("found"),
    )


def _any_case(pattern: str) -> str:
    """The pattern with each letter outside a class in both cases, for an engine that folds more than ASCII."""
    out, inside, escaped = [], False, False
    for c in pattern.removeprefix("(?i)"):
        if escaped or inside or not c.isalpha():
            out.append(c)
        else:
            out.append(f"[{c.upper()}{c.lower()}]")
        inside = (inside or c == "[") and c != "]" if not escaped else inside
        escaped = c == "\\" and not escaped
    return "".join(out)


def _oracle() -> str:
    parts = []
    for k, (_, pattern, group, least, most, _) in enumerate(KINDS):
        regex = (_any_case(pattern) if pattern.startswith("(?i)") else pattern).replace("'", "''")
        fits = f">= {least}" if most is None else f"BETWEEN {least} AND {most}"
        parts.append(f"""
  SELECT row, gap_end[i] + found_end[i] - length(found[i]) AS start, gap_end[i] + found_end[i] AS stop, {k} AS kind FROM (
    SELECT row, found, value, unnest(range(1, len(found) + 1)) AS i,
      list_transform(range(1, len(found) + 1), lambda n: list_sum(list_transform(gaps[1:n], lambda g: length(g)))) AS gap_end,
      list_transform(range(1, len(found) + 1), lambda n: list_sum(list_transform(found[1:n], lambda g: length(g)))) AS found_end
    FROM (SELECT row, regexp_extract_all(text, '{regex}') AS found, regexp_extract_all(text, '{regex}', {group}) AS value,
                 string_split_regex(text, '{regex}') AS gaps
          FROM texts WHERE regexp_matches(text, '{regex}')))
  WHERE length(value[i]) {fits}""")
    roles = " ".join(f"WHEN {k} THEN '{kind[5]}'" for k, kind in enumerate(KINDS))
    names = " ".join(f"WHEN {k} THEN '{kind[0]}'" for k, kind in enumerate(KINDS))
    nearest = (
        f"coalesce((SELECT o.name || ':' || o.start || ':' || o.stop FROM named o WHERE o.row = n.row AND abs(o.start - n.start) <= {SCOPE} "
        "AND o.role = '{}' ORDER BY abs(o.start - n.start), o.start, o.kind LIMIT 1), '')"
    )
    near = f"EXISTS (SELECT 1 FROM named o WHERE o.row = n.row AND abs(o.start - n.start) <= {SCOPE} AND o.role = "
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({" UNION ALL ".join(parts)}),
named AS (SELECT *, CASE kind {roles} END AS role, CASE kind {names} END AS name FROM parts),
judged AS (
  SELECT *, {near}'secret') AS s, {near}'identifier') AS a, {near}'endpoint') AS e FROM named n),
kept AS (
  SELECT row, start, kind, name || ':' || start || ':' || stop AS said FROM judged
  WHERE kind < {BASE} OR role = 'secret' AND (a OR e) OR role = 'identifier' AND s OR role = 'endpoint' AND a AND s),
listed AS (
  SELECT row, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
    string_agg(said, ',' ORDER BY start, kind) FILTER (kind < {BASE}) AS base,
    string_agg(said, ',' ORDER BY start, kind) AS spans
  FROM kept GROUP BY row),
met AS (
  SELECT row, start, kind, name || ':' || start || ':' || stop AS said,
    {nearest.format('identifier')} AS i, {nearest.format('endpoint')} AS e
  FROM named n WHERE role = 'secret'),
together AS (
  SELECT row, string_agg(said || '>' || i || '>' || e, ',' ORDER BY start, kind) AS links
  FROM met WHERE i <> '' OR e <> '' GROUP BY row)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(links, '') AS links
FROM texts LEFT JOIN listed USING (row) LEFT JOIN together USING (row)
"""


ORACLE = _oracle()
