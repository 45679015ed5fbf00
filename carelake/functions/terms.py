"""Graph terms: prefix:name form, full IRIs and N-Triples text."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

IRI, LITERAL, BLANK = "iri", "literal", "blank"
# What the name of a blank node starts with, as subject too.
BLANK_PREFIX = "_:"

# Public vocabularies and data types.
STANDARD_PREFIXES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "owl": "http://www.w3.org/2002/07/owl#",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "prov": "http://www.w3.org/ns/prov#",
    "dcat": "http://www.w3.org/ns/dcat#",
    "dct": "http://purl.org/dc/terms/",
}
RDF_TYPE = "rdf:type"
XSD_DATE, XSD_FLOAT = "xsd:date", "xsd:float"
XSD_INTEGER, XSD_DATETIME = "xsd:integer", "xsd:dateTime"
NUMERIC_TYPES = ("xsd:float", "xsd:double", "xsd:decimal", "xsd:integer", "xsd:int", "xsd:long")


@dataclass(frozen=True)
class Namespaces:
    """Prefixes of the graph. ``ont`` names classes and properties, ``res`` the nodes.

    Pass the IRIs of an existing deployment to get the very same graph text.
    """

    ontology: str = "http://example.org/health/ontology#"
    resource: str = "http://example.org/health/resource/"
    others: dict[str, str] = field(default_factory=lambda: dict(STANDARD_PREFIXES))

    @property
    def prefixes(self) -> dict[str, str]:
        return {"ont": self.ontology, "res": self.resource, **self.others}

    def expand(self, term: Column) -> Column:
        """Full IRI of a prefix:name term; any other text is an IRI already."""
        prefix = F.substring_index(term, ":", 1)
        known = F.create_map(*[F.lit(x) for kv in self.prefixes.items() for x in kv])
        base = known[prefix]
        local = F.substr(term, F.length(prefix) + F.lit(2))
        return F.when(base.isNotNull(), F.concat(base, local)).otherwise(term)

    def compact(self, iri: Column) -> Column:
        """prefix:name form of a full IRI, by the longest namespace that fits."""
        longest_first = sorted(self.prefixes.items(), key=lambda kv: -len(kv[1]))
        short = [
            F.when(
                iri.startswith(base),
                F.concat(F.lit(f"{prefix}:"), F.substr(iri, F.lit(len(base) + 1))),
            )
            for prefix, base in longest_first
        ]
        return F.coalesce(*short, iri)


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for raw, escaped in pairs:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def escape_literal(text: Column) -> Column:
    return _replaced(
        text, [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]
    )


# What an IRI may not hold.
ILLEGAL = '\\<>"{}|^` \n\r\t'


def escape_iri(text: Column) -> Column:
    """Write the characters an IRI may not hold as ``\\uXXXX``."""
    escaped = _replaced(text, [(c, f"\\u{ord(c):04X}") for c in ILLEGAL])
    return F.when(text.rlike(r'[\\<>"{}|^`\s]'), escaped).otherwise(text)


def _without_long(text: Column) -> Column:
    """``\\UXXXXXXXX`` as ``\\uXXXX`` or, beyond that, as the character; an impossible one stays."""

    def piece(x: Column) -> Column:
        digits = F.substr(x, F.lit(3), F.lit(8))
        point = F.conv(digits, 16, 10).cast("long")
        short = F.concat(F.lit("\\u"), F.substr(digits, F.lit(5)))
        long = F.decode(F.unhex(digits), "UTF-32")
        return (
            F.when(~x.startswith("\\U") | (F.length(x) != 10) | (point > 0x10FFFF), x)
            .when(point < 0x10000, short)
            .otherwise(long)
        )

    pieces = F.regexp_extract_all(text, F.lit(r"(?s)(\\U[0-9A-Fa-f]{8}|\\.|[^\\]+|\\)"), F.lit(1))
    return F.array_join(F.transform(pieces, piece), "")


def unescape(text: Column) -> Column:
    """Undo backslash escapes; null if one is not understood.

    The escapes of N-Triples text up to ``\\uXXXX`` are those of a JSON string;
    ``\\UXXXXXXXX`` becomes one of them, or the character itself. A bare quote
    ends such a string early, which makes the text unreadable too.
    """
    document = F.concat(F.lit('["'), F.when(F.contains(text, F.lit("\\U")), _without_long(text)).otherwise(text), F.lit('"]'))
    plain = F.from_json(document, "array<string>", {"allowUnescapedControlChars": "true"})
    bare = F.when(~F.contains(text, F.lit('"')), text)
    return F.when(F.contains(text, F.lit("\\")), F.get(plain, 0)).otherwise(bare)
