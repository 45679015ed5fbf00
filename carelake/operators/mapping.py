"""Mapping of the integrated tables to triples.

Rows meet once, by node: each node's distinct rows become its triples where
they are, and rows that disagree about a node are told apart there too. So the
many and wide triples need no shuffle, and nothing is counted beforehand.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.identity import node_id
from carelake.functions.standardize import blank_to_null, date_text, full_name, number, present
from carelake.functions.terms import IRI, XSD_DATE, XSD_FLOAT
from carelake.operators import vocabulary as v
from carelake.operators.integrate import Dictionaries, missing_entities
from carelake.operators.lookup import Dictionary, lookup
from carelake.session import concurrently

NODE, ROWS = "node", "rows"
# Which triples a mapping gives: all, those whose subject is the mapped node itself, or the others.
WHOLE, OWN, LINKS = "whole", "own", "links"
# Slices of the parts with the most rows; a divisor of the number of buckets, so that a bucket lies in one of them.
SLICES = 2
Field = Callable[[str], Column]
# A condition on the subject of a triple.
Only = Callable[[Column], Column]


def _patient(field: Field = F.col) -> Column:
    return v.node("patient", field("patient_id_pseudo"))


def _by_node(rows: DataFrame, part: str) -> DataFrame:
    """With :data:`OWN`, sorted where they lie, so that their triples come by subject: a node is one row, its triples many."""
    return rows.sortWithinPartitions(NODE) if part == OWN else rows


def _node_triples(
    df: DataFrame,
    kind: str,
    key: Column,
    columns: list[str],
    triples: Callable[[Field], list[Column]],
    staging: str | None = None,
    links: Callable[[Field], list[Column]] = lambda _: [],
    part: str = WHOLE,
    only: Only | None = None,
) -> DataFrame:
    """The set of triples of one kind of node, in one exchange.

    ``triples`` builds a row's triples from its fields, which are among
    ``columns``; the node is their subject, in ``links`` their object. Repeated
    rows go within each task, before the exchange by node. With :data:`OWN`
    the result lies where that exchange put it, sorted by subject; :data:`LINKS`
    gives the links of each row as they come. A node has several distinct rows
    only where its sources disagree; its triples are then made distinct as a
    list. That list is held in memory, so a key that stands for many things
    (say one id for all results) is an error to be cleaned before.

    ``only`` keeps the triples of some subjects. It goes before the exchange,
    so it needs a part whose subjects are known there, not :data:`WHOLE`.
    """
    # A generator, so that the conditions below do not work out the node's id again.
    rows = df.select(F.explode(F.array(v.node(kind, key))).alias(NODE), *columns).where(F.col(NODE).isNotNull())
    if only is not None and part == WHOLE:
        raise ValueError("the triples of a whole mapping have several subjects")
    if part == LINKS:
        made = links(F.col)
        if only is None:
            return v.emit(rows, *made)
        # Each link by its own subject, before ids are worked out for rows of other slices.
        return reduce(DataFrame.unionByName, [v.emit(rows.where(only(link["s"])), link) for link in made])
    if only is not None:
        rows = rows.where(only(F.col(NODE)))
    if not columns:
        return v.emit(_by_node(rows.distinct(), part), *triples(F.col))
    grouped = rows.groupBy(NODE).agg(F.collect_set(F.struct(*columns)).alias(ROWS))
    if staging is not None:
        path = f"{staging}/{kind}"
        grouped.write.mode("overwrite").parquet(path)
        grouped = df.sparkSession.read.schema(grouped.schema).parquet(path)
    grouped = _by_node(grouped, part)
    only = F.col(ROWS)[0]

    def wanted(field: Field) -> Column:
        return F.array(*triples(field), *(links(field) if part == WHOLE else []))

    one = wanted(lambda name: only[name])
    several = F.flatten(F.transform(ROWS, lambda row: wanted(lambda name: row[name])))
    found = grouped.select(F.inline(F.when(F.size(ROWS) == 1, one).otherwise(F.array_distinct(several))))
    return found.where(F.col("s").isNotNull() & F.col("o").isNotNull())


def map_patients(patients: DataFrame, staging: str | None = None, part: str = WHOLE) -> DataFrame:
    """Type and name of each patient."""
    name = full_name(F.col("first_name"), F.col("last_name"))
    p = F.col(NODE)
    return _node_triples(
        patients.withColumn("name", name),
        "patient",
        F.col("patient_id_pseudo"),
        ["name"],
        lambda field: [v.typed(p, "ont:Patient"), v.triple(p, "ont:label", field("name"))],
        staging,
        part=part,
    )


def map_imaging(
    images: DataFrame,
    patients: DataFrame | None = None,
    staging: str | None = None,
    part: str = WHOLE,
    only: Only | None = None,
) -> DataFrame:
    """Studies and instances, linked patient to study to instance to patient.

    Rows without pseudonym, study or instance are left out. An imaging patient
    is typed too, unless ``patients`` lists them already.
    """
    keys = ["patient_id_pseudo", "study_uid", "dicom_id"]
    complete = images.where(reduce(lambda a, b: a & b, [present(F.col(k)) for k in keys]))
    people = complete.select("patient_id_pseudo").distinct()
    if patients is not None:
        people = missing_entities(complete, patients, "patient_id_pseudo")
    node = F.col(NODE)
    studies = _node_triples(
        complete,
        "imagingstudy",
        F.col("study_uid"),
        ["study_uid", "study_date", "patient_id_pseudo"],
        lambda field: [
            v.typed(node, "ont:ImagingStudy"),
            v.triple(node, "ont:studyUID", field("study_uid")),
            v.triple(node, "ont:date", blank_to_null(date_text(field("study_date"))), dtype=XSD_DATE),
        ],
        staging,
        lambda field: [v.triple(_patient(field), "ont:hasImagingStudy", node, IRI)],
        part,
        only,
    )
    instances = _node_triples(
        complete,
        "dicom",
        F.col("dicom_id"),
        [*keys, "series_uid", "modality", "file_path"],
        lambda field: [
            v.typed(node, "ont:DicomInstance"),
            v.triple(node, "ont:hasPatient", _patient(field), IRI),
            v.triple(node, "ont:seriesUID", blank_to_null(field("series_uid"))),
            v.triple(node, "ont:sopUID", field("dicom_id")),
            v.triple(node, "ont:modality", blank_to_null(field("modality"))),
            v.triple(node, "ont:filePath", blank_to_null(field("file_path"))),
        ],
        staging,
        lambda field: [v.triple(v.node("imagingstudy", field("study_uid")), "ont:hasDicomInstance", node, IRI)],
        part,
        only,
    )
    if part == OWN:
        return studies.unionByName(instances)
    if only is not None:
        people = people.where(only(_patient()))
    typed = v.emit(people, v.typed(_patient(), "ont:Patient"))
    return typed.unionByName(studies).unionByName(instances)


def map_conditions(
    conditions: DataFrame, keep: int = 32, staging: str | None = None, part: str = WHOLE
) -> DataFrame:
    key = node_id(F.col("patient_id"), F.col("icd10_code"), keep=keep)
    node = F.col(NODE)
    return _node_triples(
        conditions,
        "condition",
        key,
        ["patient_id_pseudo", "icd10_code", "icd10_label"],
        lambda field: [
            v.typed(node, "ont:Condition"),
            v.triple(node, "ont:icd10Code", field("icd10_code")),
            v.triple(node, "ont:label", field("icd10_label")),
        ],
        staging,
        lambda field: [v.triple(_patient(field), "ont:hasCondition", node, IRI)],
        part,
    )


def map_allergies(
    allergies: DataFrame,
    allergy_families: Dictionary,
    keep: int = 32,
    staging: str | None = None,
    part: str = WHOLE,
) -> DataFrame:
    """Allergies, with an edge to the drug family where the allergy is known to rule one out."""
    key = node_id(F.col("patient_id"), F.col("allergy"), keep=keep)
    node = F.col(NODE)
    return _node_triples(
        lookup(allergies, allergy_families, {"allergy": "allergy"}, ["family"]),
        "allergy",
        key,
        ["patient_id_pseudo", "allergy", "family"],
        lambda field: [
            v.typed(node, "ont:Allergy"),
            v.triple(node, "ont:label", field("allergy")),
            v.triple(node, "ont:affectsFamily", v.node("drugfamily", field("family")), IRI),
        ],
        staging,
        lambda field: [v.triple(_patient(field), "ont:hasAllergy", node, IRI)],
        part,
    )


def map_prescriptions(
    prescriptions: DataFrame,
    keep: int = 32,
    staging: str | None = None,
    part: str = WHOLE,
    only: Only | None = None,
) -> DataFrame:
    """Drugs with their family, and prescriptions; an undated one has an id but no date."""
    key = node_id(F.col("patient_id"), F.col("drug"), F.col("date"), keep=keep)
    node = F.col(NODE)

    def drug(field: Field) -> Column:
        return F.replace(field("drug"), F.lit(" "), F.lit("_"))

    prescribed = _node_triples(
        prescriptions,
        "prescription",
        key,
        ["patient_id_pseudo", "drug", "date"],
        lambda field: [
            v.typed(node, "ont:Prescription"),
            v.triple(node, "ont:drug", v.node("drug", drug(field)), IRI),
            v.triple(node, "ont:date", blank_to_null(field("date").cast("string")), dtype=XSD_DATE),
        ],
        staging,
        lambda field: [v.triple(_patient(field), "ont:hasPrescription", node, IRI)],
        part,
        only,
    )
    if part == LINKS:
        return prescribed
    drugs = _node_triples(
        prescriptions,
        "drug",
        drug(F.col),
        ["drug", "drug_family"],
        lambda field: [
            v.typed(node, "ont:Drug"),
            v.triple(node, "ont:label", field("drug")),
            v.triple(node, "ont:belongsToFamily", v.node("drugfamily", field("drug_family")), IRI),
        ],
        staging,
        part=part,
        only=only,
    )
    return drugs.unionByName(prescribed)


def map_labs(labs: DataFrame, staging: str | None = None, part: str = WHOLE) -> DataFrame:
    """Laboratory results, all of them."""
    node = F.col(NODE)
    results = _node_triples(
        labs,
        "lab",
        F.col("lab_id"),
        ["patient_id_pseudo", "value", "unit", "date", "test_code_loinc", "test_name"],
        lambda field: [
            v.typed(node, "ont:LabResult"),
            v.triple(node, "ont:hasPatient", _patient(field), IRI),
            v.triple(node, "ont:value", F.nanvl(number(field("value")), F.lit(None).cast("double")), dtype=XSD_FLOAT),
            v.triple(node, "ont:unit", field("unit")),
            v.triple(node, "ont:date", field("date"), dtype=XSD_DATE),
            v.triple(node, "ont:loincCode", field("test_code_loinc")),
            v.triple(node, "ont:label", field("test_name")),
            v.triple(node, "ont:hasTest", v.node("loinc", field("test_code_loinc")), IRI),
        ],
        staging,
        part=part,
    )
    tests = _node_triples(labs, "loinc", F.col("test_code_loinc"), [], lambda _: [v.typed(node, "ont:Test")])
    return results.unionByName(tests)


def _mappings(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    dictionaries: Dictionaries,
    keep: int,
    title: str,
    staging: str | None = None,
) -> tuple[
    Callable[..., list[Callable[[], DataFrame]]],
    Callable[[str], list[Callable[[], DataFrame]]],
    Callable[[str], list[Callable[[], DataFrame]]],
    list[Callable[[], DataFrame]],
]:
    """What maps the two large tables, by part and subjects, the others with links and those without, by part, and what
    gives the fixed triples."""
    ruled_out = dictionaries.allergy_families

    def large(part: str, only: Only | None = None) -> list[Callable[[], DataFrame]]:
        return [
            lambda: map_imaging(tables["dicom_images"], tables["patients"], staging, part, only),
            lambda: map_prescriptions(tables["prescriptions"], keep, staging, part, only),
        ]

    def linked(part: str) -> list[Callable[[], DataFrame]]:
        return [
            lambda: map_conditions(tables["conditions"], keep, staging, part),
            lambda: map_allergies(tables["allergies"], ruled_out, keep, staging, part),
        ]

    def unlinked(part: str) -> list[Callable[[], DataFrame]]:
        return [
            lambda: map_labs(tables["lab_results"], staging, part),
            lambda: map_patients(tables["patients"], staging, part),
        ]

    fixed = [lambda: v.vocabulary(spark, title), lambda: v.concepts(spark, dictionaries)]
    return large, linked, unlinked, fixed


def graph_parts(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    dictionaries: Dictionaries,
    keep: int = 32,
    title: str = v.DEFAULT_TITLE,
) -> list[DataFrame]:
    """The graph of :func:`build_graph` in parts that share no triple, each dealt by its subjects; those of a kind are sorted.

    The triples of the mapped nodes stay where the rows met; only the links,
    which are few and narrow, take an exchange of their own. Written one after
    the other, a part needs room for its own exchanges alone; those with the
    most rows come first, while little else is written, and in :data:`SLICES`
    by their subjects, so that an exchange holds one slice of them. Slices are
    read and mapped again each time, but hold whole buckets, so no bucket gets
    more files by them.
    """
    large, linked, unlinked, fixed = _mappings(spark, tables, dictionaries, keep, title)

    def of_slice(i: int) -> Only:
        # The hash that deals rows to partitions and buckets.
        return lambda s: F.pmod(F.hash(s), F.lit(SLICES)) == i

    slices = [of_slice(i) for i in range(SLICES)]
    makes = [make for part in (OWN, LINKS) for only in slices for make in large(part, only)]
    found = concurrently(spark, [*makes, *linked(OWN), *unlinked(OWN), *linked(LINKS), *fixed])
    images, items, small = found[: len(makes) : 2], found[1 : len(makes) : 2], found[len(makes) :]

    def dealt(parts: list[DataFrame]) -> list[DataFrame]:
        return [df.repartition("s").dropDuplicates().sortWithinPartitions("s") for df in parts]

    nodes = [*items[:SLICES], *images[:SLICES]]
    links = [*dealt(items[SLICES:]), *dealt(images[SLICES:])]
    rest = reduce(DataFrame.unionByName, small[:4])
    # Links of two tables and the fixed triples each are no other's.
    others = reduce(DataFrame.unionByName, [*dealt(small[4:6]), *dealt([reduce(DataFrame.unionByName, small[6:])])])
    return [*nodes, *links, rest, others]


def build_graph(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    dictionaries: Dictionaries,
    keep: int = 32,
    title: str = v.DEFAULT_TITLE,
    staging: str | None = None,
    by_subject: bool = False,
) -> DataFrame:
    """The whole graph as a set of triples.

    Each part is a set and no two parts share a triple, since a triple names a
    node of its own kind; so the union is a set as it stands. With
    ``by_subject``, each part is dealt by its subjects, sorted by kind, so that
    :func:`carelake.sources.graphs.save_graph` need not move the triples
    again; given :func:`graph_parts` instead, it also needs less room.
    """
    if by_subject and staging is not None:
        raise ValueError("staged nodes do not lie by subject")
    if by_subject:
        return reduce(DataFrame.unionByName, graph_parts(spark, tables, dictionaries, keep, title))
    large, linked, unlinked, fixed = _mappings(spark, tables, dictionaries, keep, title, staging)
    return reduce(DataFrame.unionByName, concurrently(spark, [*large(WHOLE), *linked(WHOLE), *unlinked(WHOLE), *fixed]))


def graph_size(triples: DataFrame) -> DataFrame:
    return triples.agg(F.count(F.lit(1)).alias("triples"))
