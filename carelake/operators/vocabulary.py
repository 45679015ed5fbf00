"""Classes, properties, concept schemes and concepts of the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.functions.terms import IRI, LITERAL, RDF_TYPE
from carelake.operators.integrate import Dictionaries
from carelake.operators.lookup import local_table

# The declared classes and properties, and the scheme labels.
CLASSES = [
    "Patient",
    "LabResult",
    "Test",
    "Condition",
    "Drug",
    "DrugFamily",
    "Allergy",
    "Alert",
    "ImagingStudy",
    "DicomInstance",
]
OBJECT_PROPERTIES = [
    "hasPatient",
    "hasTest",
    "hasCondition",
    "hasAllergy",
    "hasPrescription",
    "hasImagingStudy",
    "hasDicomInstance",
    "drug",
    "belongsToFamily",
    "affectsFamily",
    "triggersAlert",
]
DATATYPE_PROPERTIES = [
    "value",
    "unit",
    "loincCode",
    "icd10Code",
    "label",
    "date",
    "modality",
    "studyUID",
    "seriesUID",
    "sopUID",
    "filePath",
]
SCHEME_LABELS = {"loinc": "LOINC mini scheme", "icd10": "ICD-10 mini scheme"}
FAMILY_ROOT = "Medicines"
DEFAULT_TITLE = "Health Mini Ontology"


def triple(s: Column, p: str, o: Column, kind: str = LITERAL, dtype: str | None = None) -> Column:
    """One triple as a struct; a null object means there is none."""
    none = F.lit(None).cast("string")
    return F.struct(
        s.alias("s"),
        F.lit(p).alias("p"),
        o.cast("string").alias("o"),
        F.lit(kind).alias("o_kind"),
        (F.lit(dtype) if dtype else none).alias("o_dtype"),
        none.alias("o_lang"),
    )


def typed(s: Column, cls: str) -> Column:
    return triple(s, RDF_TYPE, F.lit(cls), IRI)


def emit(df: DataFrame, *triples: Column) -> DataFrame:
    """All triples of each row, from one pass over ``df``; absent ones are left out."""
    rows = df.select(F.inline(F.array(*triples)))
    return rows.where(F.col("s").isNotNull() & F.col("o").isNotNull())


def node(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"res:{kind}/"), key.cast("string"))


def vocabulary(spark: SparkSession, title: str = DEFAULT_TITLE) -> DataFrame:
    """The declarations: ontology header, classes, properties and concept schemes."""
    iris = [("ont:", RDF_TYPE, "owl:Ontology")]
    iris += [(f"ont:{c}", RDF_TYPE, "owl:Class") for c in CLASSES]
    iris += [(f"ont:{p}", RDF_TYPE, "owl:ObjectProperty") for p in OBJECT_PROPERTIES]
    iris += [(f"ont:{p}", RDF_TYPE, "owl:DatatypeProperty") for p in DATATYPE_PROPERTIES]
    iris += [(f"res:scheme/{s}", RDF_TYPE, "skos:ConceptScheme") for s in SCHEME_LABELS]
    texts = [("ont:", "rdfs:label", title)]
    texts += [(f"res:scheme/{s}", "skos:prefLabel", label) for s, label in SCHEME_LABELS.items()]
    rows = [(*t, IRI, None, None) for t in iris] + [(*t, LITERAL, None, None) for t in texts]
    return local_table(spark, rows, schemas.TRIPLES)


def _coded_concepts(table: DataFrame, scheme: str, label: str) -> DataFrame:
    concept = node(scheme, F.col("code"))
    return emit(
        table,
        typed(concept, "skos:Concept"),
        triple(concept, "skos:inScheme", F.lit(f"res:scheme/{scheme}"), IRI),
        triple(concept, "skos:notation", F.col("code")),
        triple(concept, "skos:prefLabel", F.col(label)),
    )


def families(drug_families: DataFrame) -> DataFrame:
    """Distinct drug families, in order."""
    return drug_families.select("family").distinct().orderBy("family")


def _family_concepts(spark: SparkSession, drug_families: DataFrame) -> DataFrame:
    root = F.lit(f"res:drugfamily/{FAMILY_ROOT}")
    top = emit(
        spark.range(1),
        typed(root, "skos:Concept"),
        triple(root, "skos:prefLabel", F.lit(FAMILY_ROOT)),
    )
    family = node("drugfamily", F.col("family"))
    members = emit(
        drug_families.select("family").distinct(),
        typed(family, "skos:Concept"),
        triple(family, "skos:prefLabel", F.col("family")),
        triple(family, "skos:broader", root, IRI),
        triple(root, "skos:narrower", family, IRI),
    )
    return top.unionByName(members)


def concepts(spark: SparkSession, dictionaries: Dictionaries) -> DataFrame:
    """Concepts for test codes, condition codes and the drug family taxonomy."""
    tests = _coded_concepts(dictionaries.lab_tests.table, "loinc", "name")
    codes = _coded_concepts(dictionaries.condition_labels.table, "icd10", "label")
    families_of = _family_concepts(spark, dictionaries.drug_families.table)
    return tests.unionByName(codes).unionByName(families_of).dropDuplicates()
