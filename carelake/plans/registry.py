"""Every operator as a query over the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.functions import identity
from carelake.functions import standardize as std
from carelake.functions.terms import RDF_TYPE, Namespaces
from carelake.operators import harmonize, integrate, mapping, quality, vocabulary
from carelake.operators.match import Lit, match, register_views
from carelake.plans import bindings as b
from carelake.plans import graph_queries, zones
from carelake.session import scratch_path, tune
from carelake.sources import imaging, ntriples, resources
from carelake.sources import tables as io

Query = Callable[[SparkSession, str], DataFrame]
TEST = "click"
# Lines of one compressed text file.
LINES = 4_000_000
ALL_COLUMNS = "*"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------- standardisation


def pseudonymize(spark: SparkSession, sf: str) -> DataFrame:
    return integrate.pseudonymize(b.ehr_patients(spark, sf)).select(
        "patient_id", "patient_id_pseudo"
    )


def surrogate_uid(spark: SparkSession, sf: str) -> DataFrame:
    seed = F.concat_ws("-", F.lit("study"), "o_orderkey", "o_custkey")
    orders = b.table(spark, sf, "orders").select(seed.alias("seed"))
    return orders.withColumn("uid", identity.surrogate_uid(F.col("seed")))


def harmonized_labs(spark: SparkSession, sf: str) -> DataFrame:
    return harmonize.harmonize_units(b.labs(spark, sf), b.dictionaries(spark, sf).unit_rules)


def harmonize_units(spark: SparkSession, sf: str) -> DataFrame:
    return harmonized_labs(spark, sf).select("lab_id", "test_name", "value", "unit")


def flag_range(spark: SparkSession, sf: str) -> DataFrame:
    flagged = harmonize.flag_range(harmonized_labs(spark, sf), b.dictionaries(spark, sf).lab_tests)
    return flagged.select("lab_id", "value", "ref_low", "ref_high", "is_abnormal")


def normalize_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written in three ways, one per kind of order, and read back."""
    status = F.col("o_orderstatus")
    form = F.when(status == "F", F.date_format("o_orderdate", "yyyyMMdd"))
    form = form.when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
    raw = b.table(spark, sf, "orders").select(
        "o_orderkey", form.otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("raw")
    )
    return raw.select(
        "o_orderkey",
        "raw",
        std.to_date(F.col("raw"), ["dd/MM/yyyy"]).alias("date"),
        std.date_text(F.col("raw")).alias("text"),
    )


def repair_values(spark: SparkSession, sf: str) -> DataFrame:
    labs = b.integrated(spark, sf, "lab_results")
    repaired = harmonize.repair(
        labs,
        null_if={"value": "value > 2 * ref_high", "status": F.col("status") == "preliminary"},
        fill={"status": "unknown", "ref_low": 0.0},
        drop_if_null=["value"],
    )
    return repaired.select("lab_id", "value", "status", "ref_low", "ref_high")


def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    people = b.ehr_patients(spark, sf).join(b.clinical_patients(spark, sf), "patient_id", "left")
    complete, incomplete = harmonize.split_required(people, ["patient_id", "gender_fhir"])
    complete = complete.withColumn("missing_fields", F.lit(None).cast("string"))
    sides = [(complete, True), (incomplete, False)]
    return _union([df.select("patient_id", "missing_fields", F.lit(flag).alias("complete")) for df, flag in sides])


# ----------------------------------------------------------------- integration


def _integrated(name: str, *columns: str) -> Query:
    return lambda spark, sf: b.integrated(spark, sf, name).select(*columns)


def missing_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Patients with imaging that the clinical source does not list."""
    return integrate.missing_entities(
        b.imaging(spark, sf), b.clinical_patients(spark, sf), "patient_id"
    )


# --------------------------------------------------------------------- quality


def overview_counts(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ["patients", "lab_results", "prescriptions", "allergies", "dicom_images"]
    return quality.overview_counts({name: b.integrated(spark, sf, name) for name in wanted})


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.value_counts(b.labs(spark, sf), "test_name")


def distinct_entities(spark: SparkSession, sf: str) -> DataFrame:
    return quality.distinct_entities(b.imaging(spark, sf), "patient_id_pseudo")


def _integrated_labs(spark: SparkSession, sf: str) -> DataFrame:
    return b.integrated(spark, sf, "lab_results")


def completeness(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.completeness(_integrated_labs(spark, sf))
    return found.select(F.round("completeness_pct", 6).alias("completeness_pct"))


def missing_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_report(_integrated_labs(spark, sf))


def abnormal_rate(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.abnormal_rate(_integrated_labs(spark, sf))
    return found.select(F.round("abnormal_rate_pct", 6).alias("abnormal_rate_pct"))


def quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profile of the laboratory results, and what contradicts itself or the patients in silver and gold."""
    root, bound = b.stored_lake(spark, sf), b.dictionaries(spark, sf)
    found = [
        quality.quality_profile(_integrated_labs(spark, sf), "lab_results"),
        zones.contradictions("silver", b.silver_zone(spark, root), bound),
        zones.contradictions("gold", zones.read_gold(spark, root), bound),
    ]
    return _union(found).withColumn("value", F.round("value", 6))


# ----------------------------------------------------------------------- graph


def _mapped(name: str, mapper) -> Query:
    return lambda spark, sf: mapper(b.integrated(spark, sf, name))


def map_allergies(spark: SparkSession, sf: str) -> DataFrame:
    bound = b.dictionaries(spark, sf)
    return mapping.map_allergies(b.integrated(spark, sf, "allergies"), bound.allergy_families)


def vocab_concepts(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.concepts(spark, b.dictionaries(spark, sf))


def vocab_static(spark: SparkSession, sf: str) -> DataFrame:
    """Each declared class and property, and how often the graph uses it."""
    triples = b.stored_graph(spark, sf).triples
    declared = vocabulary.vocabulary(spark).where(F.col("p") == RDF_TYPE)
    declared = declared.where(F.col("o").isin("owl:Class", "owl:ObjectProperty", "owl:DatatypeProperty"))
    term = F.when(F.col("p") == RDF_TYPE, F.col("o")).otherwise(F.col("p"))
    used = triples.groupBy(term.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return declared.join(used, "s", "left").select(
        F.col("s").alias("term"), F.col("o").alias("kind"), F.coalesce("n", F.lit(0)).alias("uses")
    )


def graph_size(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.graph_size(b.stored_graph(spark, sf).triples)


def bgp_single(spark: SparkSession, sf: str) -> DataFrame:
    return match(b.stored_graph(spark, sf), [("?lab", "ont:label", Lit(TEST))])


STAR = [
    ("?lab", RDF_TYPE, "ont:LabResult"),
    ("?lab", "ont:hasPatient", "?patient"),
    ("?lab", "ont:label", "?test"),
    ("?lab", "ont:value", "?val"),
    ("?lab", "ont:date", "?date"),
]


def bgp_star(spark: SparkSession, sf: str) -> DataFrame:
    found = match(b.stored_graph(spark, sf), STAR)
    return found.withColumn("val", std.number(F.col("val")))


def bgp_path(spark: SparkSession, sf: str) -> DataFrame:
    return match(
        b.stored_graph(spark, sf),
        [
            ("?patient", "ont:hasImagingStudy", "?study"),
            ("?study", "ont:hasDicomInstance", "?inst"),
            ("?inst", "ont:modality", "?modality"),
        ],
    )


def sql_over_triples(spark: SparkSession, sf: str) -> DataFrame:
    used = ["ont:hasPatient", "ont:label", "ont:value", "ont:date"]
    register_views(b.stored_graph(spark, sf), "triples", used)
    return spark.sql(
        """
        SELECT t.s AS lab, hp.o AS patient, l.o AS test,
               try_cast(v.o AS double) AS val, d.o AS date
        FROM triples t
        JOIN hasPatient hp ON hp.s = t.s
        JOIN label l ON l.s = t.s
        JOIN value v ON v.s = t.s
        JOIN date d ON d.s = t.s
        WHERE t.p = 'rdf:type' AND t.o = 'ont:LabResult'
        """
    )


def _asked(question, **options) -> Query:
    return lambda spark, sf: question(b.stored_graph(spark, sf), **options)


# ------------------------------------------------------------ sources and sinks


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Patients written to files whose columns stand in two orders, and read back by name."""
    path = scratch_path(spark, "csv")
    patients = b.ehr_patients(spark, sf)
    even = F.pmod(F.xxhash64("patient_id"), F.lit(2)) == 0
    io.write_csv(patients.where(even), f"{path}/one")
    io.write_csv(patients.where(~even).select(*reversed(patients.columns)), f"{path}/other")
    return integrate.pseudonymize(io.read_csv(spark, f"{path}/*"))


def scan_json_array(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json-array")
    io.write_json_array(b.labs(spark, sf), path, rows_per_document=5_000)
    return io.read_json_array(spark, path)


def _resource_lines(spark: SparkSession, sf: str) -> DataFrame:
    shapes = {
        "patients": resources.patient_resources,
        "conditions": resources.condition_resources,
        "lab_results": resources.observation_resources,
        "allergies": resources.allergy_resources,
        "prescriptions": resources.prescription_resources,
    }
    return _union([shape(b.integrated(spark, sf, name)) for name, shape in shapes.items()])


def to_resources(spark: SparkSession, sf: str) -> DataFrame:
    return _resource_lines(spark, sf)


def route_resources(spark: SparkSession, sf: str) -> DataFrame:
    """All resources as lines in a file, read back and routed into their tables."""
    lines, landed = scratch_path(spark, "ndjson"), scratch_path(spark, "resources")
    _resource_lines(spark, sf).write.text(lines)
    io.write_ndjson_as_parquet(spark, lines, landed)
    read = spark.read.schema(schemas.CLINICAL_RESOURCE).parquet(landed)
    routed = resources.route_resources(read)
    none = F.lit(None).cast("string")

    def long(df: DataFrame, kind: str, value: str, date: Column = none) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), "patient_id", F.col(value).alias("value"), date.alias("date")
        )

    return _union(
        [
            long(routed.patients, "patient", "gender_fhir"),
            long(routed.conditions, "condition", "icd10_code"),
            long(routed.allergies, "allergy", "allergy"),
            long(routed.prescriptions, "prescription", "drug", F.col("date")),
        ]
    )


def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tables")
    io.write_tables({"lab_results": _integrated_labs(spark, sf)}, path)
    return io.table_or_empty(spark, path, "lab_results").unionByName(
        io.table_or_empty(spark, f"{path}/absent", "lab_results")
    )


def ntriples_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ntriples")
    # Ids are hex digits and most of a line is the same as in the one before; text takes several times the graph.
    ntriples.write_ntriples(b.stored_graph(spark, sf).triples, path, compression="gzip", lines=LINES)
    parsed = ntriples.parse_lines(spark.read.text(path))
    return parsed.select(*schemas.TRIPLES.names).withColumn("p", F.coalesce("p", F.lit("unreadable")))


def _write_files(files: DataFrame, root: str) -> None:
    """Write ``path, content`` rows as files below a folder all executors see."""
    if "://" in root:
        raise ValueError(f"needs a mounted folder, not {root}")

    def write(rows) -> None:
        for row in rows:
            target = os.path.join(root, row["path"])
            os.makedirs(os.path.dirname(target), exist_ok=True)
            partial = f"{target}.{os.getpid()}.tmp"
            with open(partial, "wb") as out:
                out.write(row["content"])
            os.replace(partial, target)

    files.foreachPartition(write)


def scan_imaging(spark: SparkSession, sf: str) -> DataFrame:
    """One image file per customer, written and read back; those in debt get a broken file."""
    root = scratch_path(spark, "imaging").removeprefix("file:")
    key = F.col("c_custkey").cast("string")
    uid = identity.surrogate_uid(F.concat(F.lit("sop-"), key))
    images = b.table(spark, sf, "customer").select(
        uid.alias("dicom_id"),
        key.alias("patient_id"),
        identity.surrogate_uid(F.concat(F.lit("study-"), key)).alias("study_uid"),
        identity.surrogate_uid(F.concat(F.lit("series-"), key)).alias("series_uid"),
        F.substring("c_mktsegment", 1, 2).alias("modality"),
        F.lit("20240131").alias("study_date"),
        F.concat(F.lit("study_"), F.col("c_nationkey"), F.lit("/"), key, F.lit(".dcm")).alias(
            "file_path"
        ),
        (F.col("c_nationkey") + 1).alias("rows"),
        F.lit(64).alias("cols"),
        "c_acctbal",
    )
    _write_files(b.spread(b.encode_headers(images, F.col("c_acctbal") >= 0), files=1), root)
    tasks = 4 * spark.sparkContext.defaultParallelism
    table, errors = imaging.scan_imaging(spark, root, mounted_tasks=tasks, staging=scratch_path(spark, "headers"))
    found = table.unionByName(errors, allowMissingColumns=True)
    name = F.substring_index("file_path", "/", -1)
    return found.withColumn("file_path", name).select(*schemas.IMAGING.names, "error")


def imaging_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Header bytes of all imaging instances, parsed."""
    table, _ = imaging.inventory(imaging.parse_headers(b.encode_headers(b.imaging(spark, sf))))
    return table.select(*schemas.IMAGING.names)


# ------------------------------------------------------------------------ zones


def zones_silver(spark: SparkSession, sf: str) -> DataFrame:
    root = b.stored_lake(spark, sf)
    labs = zones.read_silver(spark, f"{root}/silver", ["lab_results"])["lab_results"]
    return labs.select(
        "lab_id", "source_system", "date", "value", "unit", F.concat_ws(",", "tags").alias("tags")
    )


def _as_text(df: DataFrame) -> Column:
    """A row in a text form two engines agree on."""
    columns = [
        F.col(f.name).cast("decimal(18,6)") if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])


def zones_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of the six gold tables, its columns joined as text."""
    root = b.stored_lake(spark, sf)
    parts = []
    for name, df in zones.read_gold(spark, root).items():
        parts.append(df.select(F.lit(name).alias("table"), _as_text(df).alias("row")))
    return _union(parts)


def catalog_datasets(spark: SparkSession, sf: str) -> DataFrame:
    """Datasets of all zones, found by a graph pattern over the catalogue; only those with bytes on disk."""
    catalog = zones.read_catalog(spark, b.stored_lake(spark, sf))
    found = match(
        catalog,
        [
            ("?d", RDF_TYPE, "dcat:Dataset"),
            ("?d", "dcat:theme", "?zone"),
            ("?d", "dct:identifier", "?dataset"),
            ("?d", "dct:format", "?format"),
            ("?d", "dcat:accessURL", "?location"),
            ("?d", "dct:created", "?created"),
            ("?d", "dcat:byteSize", "?bytes"),
            ("?d", "ont:records", "?records"),
            ("?d", "ont:completeness", "?completeness"),
        ],
        numeric={"bytes": lambda v: v > 0},
    )
    return found.select(
        "dataset",
        "zone",
        "format",
        F.regexp_extract("location", "([^/]+)$", 1).alias("place"),
        (F.col("bytes").cast("long") > 0).alias("has_bytes"),
        F.to_timestamp("created").isNotNull().alias("has_time"),
        F.col("records").cast("long").alias("records"),
        F.round(F.col("completeness").cast("double"), 6).alias("completeness"),
    )


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    """What each silver and gold table was derived from, by which step, with its records, as its write noted them."""
    noted = spark.read.parquet(f"{b.stored_lake(spark, sf)}/lineage")
    names = Namespaces()

    def node(kind: str, column: str) -> Column:
        return names.expand(vocabulary.node(kind, F.col(column))).alias(column)

    return noted.select(node("dataset", "derived"), node("dataset", "source"), node("step", "step"), "records")


QUERIES: dict[str, Query] = {
    "pseudonymize": pseudonymize,
    "surrogate_uid": surrogate_uid,
    "harmonize_units": harmonize_units,
    "flag_range": flag_range,
    "normalize_dates": normalize_dates,
    "repair_values": repair_values,
    "required_fields": required_fields,
    "map_terms": _integrated("conditions", "patient_id", "icd10_code", "icd10_label"),
    "map_family": _integrated("prescriptions", "patient_id", "drug", "date", "drug_family"),
    "unify_entities": _integrated("patients", ALL_COLUMNS),
    "integrate_labs": _integrated("lab_results", ALL_COLUMNS),
    "missing_entities": missing_entities,
    "overview_counts": overview_counts,
    "value_counts": value_counts,
    "distinct_entities": distinct_entities,
    "completeness": completeness,
    "missing_report": missing_report,
    "abnormal_rate": abnormal_rate,
    "quality_profile": quality_profile,
    "vocab_static": vocab_static,
    "vocab_concepts": vocab_concepts,
    "map_patients": _mapped("patients", mapping.map_patients),
    "map_imaging": _mapped("dicom_images", mapping.map_imaging),
    "map_conditions": _mapped("conditions", mapping.map_conditions),
    "map_allergies": map_allergies,
    "map_prescriptions": _mapped("prescriptions", mapping.map_prescriptions),
    "map_labs": _mapped("lab_results", mapping.map_labs),
    "graph_size": graph_size,
    "bgp_single": bgp_single,
    "bgp_star": bgp_star,
    "bgp_path": bgp_path,
    "sql_over_triples": sql_over_triples,
    "q_count_entities": _asked(graph_queries.count_patients),
    "q_count_by_group": _asked(graph_queries.instances_per_modality),
    "q_abnormal_topk": _asked(graph_queries.abnormal_results, test=TEST),
    "q_imaging_lab": _asked(graph_queries.imaging_with_abnormal, test=TEST),
    "q_imaging_lab_bag": _asked(graph_queries.imaging_with_abnormal_bag, test=TEST),
    "q_contraindication": _asked(graph_queries.contraindications),
    "scan_csv": scan_csv,
    "scan_json_array": scan_json_array,
    "route_resources": route_resources,
    "to_resources": to_resources,
    "table_roundtrip": table_roundtrip,
    "ntriples_roundtrip": ntriples_roundtrip,
    "scan_imaging": scan_imaging,
    "imaging_headers": imaging_headers,
    "zones_silver": zones_silver,
    "zones_gold": zones_gold,
    "catalog_datasets": catalog_datasets,
    "lineage": lineage,
}


def tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {name: tuned(query) for name, query in QUERIES.items()}
