"""The data lake job: raw files, cleaned tables, unified tables, graph and catalogue."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake import schemas
from carelake.functions import standardize as std
from carelake.functions.terms import IRI, XSD_DATETIME, XSD_FLOAT, XSD_INTEGER, Namespaces
from carelake.operators import vocabulary as v
from carelake.operators.harmonize import flag_range, harmonize_units, repair
from carelake.operators.integrate import (
    Dictionaries,
    in_table_order,
    integrate_conditions,
    integrate_prescriptions,
    pseudonymize,
    unify_entities,
)
from carelake.operators.lookup import Dictionary, local_table, lookup
from carelake.operators.mapping import graph_parts
from carelake.operators.quality import Reference, consistency, quality_profile
from carelake.plans.graph_queries import predefined_queries
from carelake.plans.recording import Recorder, folder
from carelake.sources import tables as io
from carelake.sources import versions
from carelake.sources.graphs import load_graph, save_graph
from carelake.sources.imaging import HEADER, image_files, inventory, parse_headers
from carelake.sources.ntriples import write_ntriples
from carelake.sources.resources import route_resources

CATALOG = "dataset string, zone string, location string, format string"
SIGNATURES = "dataset string, signature string"
PROFILES = "dataset string, metric string, column string, value double"

# Tags of a silver laboratory row and the condition under which each applies.
LAB_TAGS = {
    "abnormal": "is_abnormal",
    "no_reference_range": "ref_low is null",
    "preliminary": "status = 'preliminary'",
    "missing_value": "value is null or isnan(value)",
}

SILVER_LABS = T.StructType(
    [f for f in schemas.LAB_RESULTS.fields if f.name != "date"]
    + [T.StructField("date", T.DateType()), T.StructField("tags", T.ArrayType(T.StringType()))]
)


def semantic_tags(df: DataFrame, rules: dict[str, str], into: str = "tags") -> DataFrame:
    """Add an array of the tags whose condition holds for the row."""
    tags = [F.when(F.expr(condition), F.lit(tag)) for tag, condition in rules.items()]
    return df.withColumn(into, F.array_compact(F.array(*tags)))


# ---------------------------------------------------------------------- silver


def silver_labs(labs: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """Pseudonymised, harmonised, flagged and tagged results with a proper date."""
    clean = repair(
        harmonize_units(pseudonymize(labs), dictionaries.unit_rules), drop_if_null=["lab_id"]
    )
    flagged = flag_range(clean, dictionaries.lab_tests)
    return semantic_tags(flagged, LAB_TAGS).withColumn("date", std.to_date(F.col("date")))


def silver_patients(patients: DataFrame) -> DataFrame:
    return pseudonymize(patients).withColumn("birthDate", std.to_date(F.col("birthDate")))


def silver_prescriptions(
    prescriptions: DataFrame, dictionaries: Dictionaries, drugs: DataFrame | None = None
) -> DataFrame:
    found = integrate_prescriptions(prescriptions, dictionaries, drugs)
    return found.withColumn("date", std.to_date(F.col("date")))


def write_labs(labs: DataFrame, path: str) -> None:
    """Silver results, partitioned by source system and date."""
    io.write_partitioned(labs, path, "source_system", "date")


def read_silver(spark: SparkSession, root: str, tables: list[str]) -> dict[str, DataFrame]:
    """Silver tables by name; the partitioned results are read with their schema."""
    found = {t: spark.read.parquet(f"{root}/{t}") for t in tables if t != "lab_results"}
    return found | {"lab_results": spark.read.schema(SILVER_LABS).parquet(f"{root}/lab_results")}


# ------------------------------------------------------------------------ gold


def as_text_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as ISO text, the form of the unified tables."""
    return df.withColumns({c: F.to_date(c).cast("string") for c in columns})


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six unified tables, from the silver ones."""
    patients = unify_entities(
        as_text_dates(silver["patients"], "birthDate"), silver["clinical_patients"]
    )
    unified = {
        "patients": patients,
        "lab_results": as_text_dates(silver["lab_results"], "date"),
        "conditions": silver["conditions"],
        "allergies": silver["allergies"],
        "prescriptions": as_text_dates(silver["prescriptions"], "date"),
        "dicom_images": silver["dicom_images"],
    }
    return {name: in_table_order(name, df) for name, df in unified.items()}


# ----------------------------------------------------------------- consistency

# What no row of a table may be. ``expected_unit`` is the unit of the test's reference range.
DENIALS = {
    "lab_results": {
        "other_unit": "unit <> expected_unit",
        "undated": "date IS NULL",
        "empty_range": "ref_low > ref_high",
        "flag_without_range": "is_abnormal AND ref_low IS NULL",
    },
    "prescriptions": {"undated": "date IS NULL"},
    "patients": {"unnamed": "first_name IS NULL AND last_name IS NULL"},
}
OF_PATIENTS = ["lab_results", "conditions", "allergies", "prescriptions", "dicom_images"]


def contradictions(zone: str, tables: dict[str, DataFrame], dictionaries: Dictionaries) -> DataFrame:
    """Consistency metrics of the tables of a zone: denied rows, and rows of patients that are not listed."""
    units = dictionaries.lab_tests
    expected = Dictionary(units.table.select("name", F.col("unit").alias("expected_unit")), units.keys, units.small)
    parts = []
    for name, df in tables.items():
        if name == "lab_results":
            df = lookup(df, expected, {"test_name": "name"}, ["expected_unit"])
        patient = Reference("patient_id", tables["patients"], "patient_id")
        references = {"patient": patient} if name in OF_PATIENTS else {}
        if name in DENIALS or references:
            parts.append(consistency(df, f"{zone}/{name}", DENIALS.get(name), references))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------- catalogue and lineage


Dataset = tuple[str, str, str, str]  # name, zone, location, format


def catalog_entries(spark: SparkSession, datasets: list[Dataset]) -> DataFrame:
    """One row per dataset: where it is, its format, size, files and age.

    All files are listed in one go and matched to the dataset whose folder
    they are in.
    """
    entries = local_table(spark, datasets, CATALOG)
    files = io.list_files(spark, [location for _, _, location, _ in datasets])
    folder_of = [
        F.when(F.contains("path", F.lit(f"{folder(location)}/")) | F.endswith("path", F.lit(folder(location))), F.lit(name))
        for name, _, location, _ in datasets
    ]
    file = F.concat_ws("|", "path", "length", F.unix_micros("modificationTime"))
    sizes = (
        files.select(F.coalesce(*folder_of).alias("dataset"), "length", "modificationTime", F.xxhash64(file).alias("h"))
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
            F.min("modificationTime").alias("created"),
            F.sum(F.col("h").cast("decimal(38,0)")).alias("h"),
        )
    )
    found = entries.join(sizes, "dataset", "left").na.fill(0, ["files", "bytes"])
    # Changes with any file's name, size or time.
    return found.withColumn("signature", F.concat_ws(":", "location", "files", "bytes", F.col("h").cast("string"))).drop("h")


def _dataset(name: Column) -> Column:
    return v.node("dataset", name)


def catalog_triples(entries: DataFrame) -> DataFrame:
    d = _dataset(F.col("dataset"))
    return v.emit(
        entries,
        v.typed(d, "dcat:Dataset"),
        v.triple(d, "dct:identifier", F.col("dataset")),
        v.triple(d, "dcat:theme", F.col("zone")),
        v.triple(d, "dcat:accessURL", F.col("location")),
        v.triple(d, "dct:format", F.col("format")),
        v.triple(d, "dcat:byteSize", F.col("bytes"), dtype=XSD_INTEGER),
        v.triple(
            d,
            "dct:created",
            F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss"),
            dtype=XSD_DATETIME,
        ),
    )


def quality_triples(profile: DataFrame) -> DataFrame:
    """Records and completeness of a dataset, as properties of its catalogue entry."""
    d = _dataset(F.col("dataset"))
    wanted = profile.where(F.col("metric").isin("records", "completeness_pct"))
    records = F.when(F.col("metric") == "records", F.col("value").cast("long"))
    share = F.when(F.col("metric") == "completeness_pct", F.col("value"))
    return v.emit(
        wanted,
        v.triple(d, "ont:records", records, dtype=XSD_INTEGER),
        v.triple(d, "ont:completeness", share, dtype=XSD_FLOAT),
    )


def lineage_triples(lineage: DataFrame) -> DataFrame:
    d = _dataset(F.col("derived"))
    return v.emit(
        lineage,
        v.triple(d, "prov:wasDerivedFrom", _dataset(F.col("source")), IRI),
        v.triple(d, "prov:wasGeneratedBy", v.node("step", F.col("step")), IRI),
    )


def refreshed_profiles(
    spark: SparkSession, root: str, entries: DataFrame, tables: dict[str, DataFrame]
) -> tuple[DataFrame, list[str]]:
    """Quality profiles of the tables, and which of them had to be worked out.

    A dataset whose files have the names, sizes and times of the last time
    keeps its profile; only the others are read. The profiles and what they
    were made of are committed together.
    """
    signed = {r.dataset: r.signature for r in entries.select("dataset", "signature").collect()}
    last = versions.current(spark, f"{root}/profiles")
    known = {}
    if last:
        known = {r.dataset: r.signature for r in spark.read.schema(SIGNATURES).parquet(f"{last.path}/signatures").collect()}
    changed = [name for name in tables if known.get(name) != signed.get(name)]
    if last and not changed:
        return spark.read.schema(PROFILES).parquet(f"{last.path}/profiles"), []
    kept = [name for name in tables if name not in changed]
    parts = [quality_profile(tables[name], name) for name in changed]
    if kept:
        parts.append(spark.read.schema(PROFILES).parquet(f"{last.path}/profiles").where(F.col("dataset").isin(kept)))
    path = versions.new_version(f"{root}/profiles")
    found = reduce(DataFrame.unionByName, parts)
    signatures = local_table(spark, [(name, signed.get(name)) for name in tables], SIGNATURES)
    io.write_tables({"profiles": found, "signatures": signatures}, path)
    versions.commit(spark, f"{root}/profiles", path)
    return spark.read.schema(PROFILES).parquet(f"{path}/profiles"), changed


def write_catalog(
    spark: SparkSession,
    root: str,
    datasets: list[Dataset],
    tables: dict[str, DataFrame],
    lineage: DataFrame,
) -> list[str]:
    """Describe datasets, the quality of the ``tables`` and the lineage as one small graph.

    Gives back which tables were read for it: those whose files have changed.
    """
    entries = catalog_entries(spark, datasets).persist()
    try:
        profiles, changed = refreshed_profiles(spark, root, entries, tables)
        parts = [catalog_triples(entries), quality_triples(profiles), lineage_triples(lineage)]
        reduce(DataFrame.unionByName, parts).dropDuplicates().write.mode("overwrite").parquet(f"{root}/catalog")
    finally:
        entries.unpersist()
    lineage.write.mode("overwrite").parquet(f"{root}/lineage")
    return changed


def read_catalog(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(schemas.TRIPLES).parquet(f"{root}/catalog")


# -------------------------------------------------------------------- pipeline

SILVER_TABLES = [
    "patients",
    "lab_results",
    "clinical_patients",
    "conditions",
    "allergies",
    "prescriptions",
    "dicom_images",
]
BRONZE_FORMATS = {"ehr": "csv", "lab": "json", "fhir": "ndjson", "dicom": "dicom"}


def zone_datasets(spark: SparkSession, root: str) -> list[Dataset]:
    """The silver tables and the committed gold ones under ``root``, as catalogue entries."""
    zones = {"silver": (f"{root}/silver", SILVER_TABLES), "gold": (_gold_path(spark, root), list(schemas.INTEGRATED_TABLES))}
    return [
        (f"{zone}/{name}", zone, f"{path}/{name}", "parquet")
        for zone, (path, names) in zones.items()
        for name in names
    ]


@dataclass(frozen=True)
class PipelineResult:
    gold: dict[str, DataFrame]
    queries: dict[str, DataFrame]
    catalog: DataFrame
    lineage: DataFrame
    image_errors: DataFrame


def write_gold(spark: SparkSession, root: str, record: Recorder) -> None:
    """The unified tables, from the silver ones that were written; readers see all six or those of before."""
    unified = gold_tables(read_silver(spark, f"{root}/silver", SILVER_TABLES))
    made = {name: (df, "unify" if name == "patients" else "curate") for name, df in unified.items()}
    path = versions.new_version(f"{root}/gold")
    record.write_all(path, "gold", made)
    versions.commit(spark, f"{root}/gold", path)


def _gold_path(spark: SparkSession, root: str) -> str:
    version = versions.current(spark, f"{root}/gold")
    return version.path if version else f"{root}/gold/none"


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The six unified tables as last committed; empty ones before the first time."""
    path = _gold_path(spark, root)
    return {name: io.table_or_empty(spark, path, name) for name in schemas.INTEGRATED_TABLES}


def write_silver(
    spark: SparkSession, in_dir: str, out_dir: str, dictionaries: Dictionaries, record: Recorder
) -> None:
    """Read the raw files, clean them and write the silver tables."""
    landed = record.stage(io.read_ndjson(spark, f"{in_dir}/fhir"), f"{out_dir}/staging/fhir")
    routed = route_resources(landed)
    headers = record.stage(parse_headers(image_files(spark, f"{in_dir}/dicom")), f"{out_dir}/staging/dicom")
    images, errors = inventory(headers)
    io.write_tables({"dicom_errors": errors}, f"{out_dir}/silver")
    labs = silver_labs(io.read_json_array(spark, f"{in_dir}/lab"), dictionaries)
    record.write_all(
        f"{out_dir}/silver",
        "silver",
        {
            "patients": (silver_patients(io.read_csv(spark, f"{in_dir}/ehr")), "pseudonymize"),
            "clinical_patients": (routed.patients, "route"),
            "conditions": (integrate_conditions(routed.conditions, dictionaries), "route"),
            "allergies": (pseudonymize(routed.allergies), "route"),
            "prescriptions": (silver_prescriptions(routed.prescriptions, dictionaries), "route"),
            "dicom_images": (images, "read_headers"),
            "lab_results": (labs, "harmonize"),
        },
        {"lab_results": write_labs},
    )


def run_pipeline(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    data: schemas.ReferenceData | None = None,
    names: Namespaces = Namespaces(),
) -> PipelineResult:
    """Raw files under ``in_dir`` to zones, graph, catalogue and answers under ``out_dir``.

    ``in_dir`` has one folder per domain: ``ehr``, ``lab``, ``fhir``, ``dicom``.
    Every stage is written before the next reads it, so a lost executor only
    repeats tasks of the stage at hand, and a run can be repeated as a whole.
    """
    dictionaries = Dictionaries.of(spark, data)
    datasets = [
        (f"bronze/{d}", "bronze", f"{in_dir}/{d}", form) for d, form in BRONZE_FORMATS.items()
    ]
    record = Recorder(spark, {location: name for name, _, location, _ in datasets})
    write_silver(spark, in_dir, out_dir, dictionaries, record)
    write_gold(spark, out_dir, record)
    silver = read_silver(spark, f"{out_dir}/silver", [*SILVER_TABLES, "dicom_errors"])
    gold = read_gold(spark, out_dir)

    parts = graph_parts(spark, gold, dictionaries)
    save_graph(parts, f"{out_dir}/graph", by_subject=True)
    graph = load_graph(spark, f"{out_dir}/graph")
    write_ntriples(graph.triples, f"{out_dir}/rdf", names)

    profiled = {f"gold/{name}": df for name, df in gold.items()}
    profiled |= {f"silver/{name}": silver[name] for name in SILVER_TABLES}
    write_catalog(spark, out_dir, datasets + zone_datasets(spark, out_dir), profiled, record.lineage())
    return PipelineResult(
        gold,
        predefined_queries(graph, names),
        read_catalog(spark, out_dir),
        spark.read.parquet(f"{out_dir}/lineage"),
        silver["dicom_errors"],
    )
