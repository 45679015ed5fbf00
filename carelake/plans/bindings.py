"""The given benchmark tables seen as health data.

Only the registered queries use this: customers stand in for patients, orders
for conditions and imaging studies, line items for prescriptions and imaging
instances, and events for laboratory results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.functions.identity import pseudonym
from carelake.operators import integrate as it
from carelake.operators.integrate import Dictionaries, Sources
from carelake.operators.mapping import graph_parts
from carelake.operators.match import Graph
from carelake.operators.skew import grid_join, hot_parts
from carelake.plans import zones
from carelake.plans.recording import Recorder
from carelake.session import scratch_path, tune
from carelake.sources import tables as io
from carelake.sources.graphs import buckets_for, load_graph, save_graph

LAB_TESTS = [
    ("c-click", "click", "mg/dL", 1.0, 140.0),
    ("c-view", "view", "mg/dL", 5.0, 100.0),
    ("c-error", "error", "mg/dL", 0.5, 15.0),
]
CONDITION_LABELS = [("1", "Urgent"), ("2", "High"), ("3", "Medium")]
ALLERGY_FAMILIES = [("AUTOMOBILE", "ECONOMY"), ("BUILDING", "PROMO")]
UNIT_RULES = [("click", "µmol/L", "mg/dL", 88.4, 3)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _day(column: str) -> Column:
    return F.to_date(column).cast("string")


# What is found out or written once per session and then shared by the queries.
_known: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, find):
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _known:
        _known[key] = find()
    return _known[key]


def dictionaries(spark: SparkSession, sf_dir: str) -> Dictionaries:
    drugs = table(spark, sf_dir, "part")
    data = schemas.ReferenceData(
        lab_tests=LAB_TESTS,
        condition_labels=CONDITION_LABELS,
        drug_families=drugs.select(
            _text("p_partkey").alias("drug"), F.col("p_type").alias("family")
        ),
        allergy_families=ALLERGY_FAMILIES,
        unit_rules=UNIT_RULES,
    )
    return _once(spark, sf_dir, "dictionaries", lambda: Dictionaries.of(spark, data))


def ehr_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("patient_id"),
        F.col("c_name").alias("first_name"),
        none.alias("last_name"),
        F.col("c_mktsegment").alias("gender"),
        none.alias("birthDate"),
        _text("c_nationkey").alias("country"),
    )


def clinical_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("user_id").isNotNull())
        .groupBy(_text("user_id").alias("patient_id"))
        .agg(F.max("event_type").alias("gender_fhir"))
    )


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    other_unit = (F.col("event_type") == "click") & (k % 4 == 0)
    return table(spark, sf_dir, "events").select(
        _text("event_id").alias("lab_id"),
        _text("user_id").alias("patient_id"),
        F.concat(F.lit("c-"), "event_type").alias("test_code_loinc"),
        F.col("event_type").alias("test_name"),
        "value",
        F.when(other_unit, F.lit("µmol/L")).otherwise(F.lit("mg/dL")).alias("unit"),
        _day("ts").alias("date"),
        F.when(k % 3 == 0, F.lit("preliminary")).otherwise(F.lit("final")).alias("status"),
        F.when(k % 2 == 0, F.lit("Lab_A")).otherwise(F.lit("Lab_B")).alias("source_system"),
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _text("o_custkey").alias("patient_id"),
        F.substring("o_orderpriority", 1, 1).alias("icd10_code"),
    )


def allergies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("allergy")
    )


def spread(df: DataFrame, files: int) -> DataFrame:
    """Deal rows out to all cores if they come from fewer files than there are cores.

    The given tables are one file with one row group each, hence one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if files >= cores else df.repartition(cores)


def _ordered_items(spark: SparkSession, sf_dir: str, items: list, orders: list) -> DataFrame:
    """Line items with columns of their order."""
    left = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), *items)
    right = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), *orders)
    hot = _once(spark, sf_dir, "hot orders", lambda: hot_parts(left, "key"))
    return grid_join(left, right, ["key"], {key: (parts, 1) for key, parts in hot.items()})


def prescriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _ordered_items(spark, sf_dir, ["l_partkey", "l_shipdate"], ["o_custkey"])
    return items.select(
        _text("o_custkey").alias("patient_id"),
        _text("l_partkey").alias("drug"),
        _day("l_shipdate").alias("date"),
    )


def prescribed_drugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drugs of all prescriptions, without the join that gives their patients."""
    return table(spark, sf_dir, "lineitem").select(_text("l_partkey").alias("drug"))


def imaging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Studies are orders; (order, line, flag) is an instance and occurs more than once."""
    items = _ordered_items(
        spark, sf_dir, ["l_linenumber", "l_returnflag"], ["o_custkey", "o_orderdate"]
    )
    instance = F.concat_ws(".", "key", "l_linenumber", "l_returnflag")
    patient = _text("o_custkey")
    return items.select(
        instance.alias("dicom_id"),
        patient.alias("patient_id"),
        pseudonym(patient).alias("patient_id_pseudo"),
        _text("key").alias("study_uid"),
        F.concat_ws(".", "key", "l_returnflag").alias("series_uid"),
        F.col("l_returnflag").alias("modality"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("study_date"),
        F.concat(F.lit("img/"), instance, F.lit(".dcm")).alias("file_path"),
        F.lit(64).alias("rows"),
        (F.col("l_linenumber") * 16).cast("int").alias("cols"),
    )


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        ehr_patients(spark, sf_dir),
        labs(spark, sf_dir),
        clinical_patients(spark, sf_dir),
        conditions(spark, sf_dir),
        allergies(spark, sf_dir),
        prescriptions(spark, sf_dir),
        imaging(spark, sf_dir),
    )


def integrated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One integrated table, without the work of the others."""
    if name == "patients":
        df = it.integrate_patients(ehr_patients(spark, sf_dir), clinical_patients(spark, sf_dir))
    elif name == "lab_results":
        df = it.integrate_labs(labs(spark, sf_dir), dictionaries(spark, sf_dir))
    elif name == "conditions":
        df = it.integrate_conditions(conditions(spark, sf_dir), dictionaries(spark, sf_dir))
    elif name == "allergies":
        df = it.pseudonymize(allergies(spark, sf_dir))
    elif name == "prescriptions":
        bound, drugs = dictionaries(spark, sf_dir), prescribed_drugs(spark, sf_dir)
        df = it.integrate_prescriptions(prescriptions(spark, sf_dir), bound, drugs)
    else:
        df = imaging(spark, sf_dir)
    return it.in_table_order(name, df)


def _written(spark: SparkSession, sf_dir: str, what: str, write) -> str:
    def find() -> str:
        path = scratch_path(spark, what)
        write(path)
        return path

    return _once(spark, sf_dir, what, find)


def _write_graph(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Map the written gold tables to triples and write those."""
    root = stored_lake(spark, sf_dir)
    gold = zones.read_gold(spark, root)
    bound = dictionaries(spark, sf_dir)
    # A row gives four to eight triples; counting reads file footers alone.
    rows = sum(df.count() for df in gold.values())
    parts = graph_parts(spark, gold, bound)
    save_graph(parts, path, buckets=buckets_for(6 * rows), by_subject=True)


def stored_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The bound graph, written once per session and read back."""
    tune(spark)
    path = _written(spark, sf_dir, "graph", lambda path: _write_graph(spark, sf_dir, path))
    return load_graph(spark, path)


# The given tables that the bound lake is made of.
GIVEN = ["customer", "events", "orders", "lineitem", "part"]


def _write_lake(spark: SparkSession, sf_dir: str, path: str) -> None:
    bound, raw = dictionaries(spark, sf_dir), sources(spark, sf_dir)
    datasets = [(f"bronze/{name}", "bronze", f"{sf_dir}/{name}.parquet", "parquet") for name in GIVEN]
    record = Recorder(spark, {location: name for name, _, location, _ in datasets})
    record.write_all(
        f"{path}/silver",
        "silver",
        {
            "patients": (zones.silver_patients(raw.ehr_patients), "pseudonymize"),
            "clinical_patients": (raw.clinical_patients, "route"),
            "conditions": (it.integrate_conditions(raw.conditions, bound), "route"),
            "allergies": (it.pseudonymize(raw.allergies), "route"),
            "prescriptions": (zones.silver_prescriptions(raw.prescriptions, bound, prescribed_drugs(spark, sf_dir)), "route"),
            "dicom_images": (raw.imaging, "read_headers"),
            "lab_results": (zones.silver_labs(raw.labs, bound), "harmonize"),
        },
        {"lab_results": zones.write_labs},
    )
    zones.write_gold(spark, path, record)
    written = {f"gold/{name}": df for name, df in zones.read_gold(spark, path).items()}
    written |= {f"silver/{name}": df for name, df in silver_zone(spark, path).items()}
    written |= {f"bronze/{name}": table(spark, sf_dir, name) for name in GIVEN}
    zones.write_catalog(spark, path, datasets + zones.zone_datasets(spark, path), written, record.lineage())


def silver_zone(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return zones.read_silver(spark, f"{root}/silver", zones.SILVER_TABLES)


def stored_lake(spark: SparkSession, sf_dir: str) -> str:
    """Root of the bound silver and gold tables, written once per session."""
    tune(spark)
    return _written(spark, sf_dir, "lake", lambda path: _write_lake(spark, sf_dir, path))


# --------------------------------------------------------- image files as bytes


def _element(tag: str, kind: str, text: Column) -> Column:
    """One explicit little-endian header element; ``text`` is shorter than 255 bytes."""
    raw = text.cast("binary")
    odd = F.octet_length(raw) % 2 == 1
    padded = F.when(odd, F.concat(raw, F.lit(b" "))).otherwise(raw)
    size = F.unhex(F.concat(F.lpad(F.hex(F.octet_length(padded)), 2, "0"), F.lit("00")))
    return F.concat(F.lit(bytes.fromhex(tag)), F.lit(kind.encode()), size, padded)


def _number(tag: str, number: Column) -> Column:
    value = F.unhex(F.concat(F.lpad(F.hex(number.cast("int")), 2, "0"), F.lit("00")))
    return F.concat(F.lit(bytes.fromhex(tag)), F.lit(b"US\x02\x00"), value)


def encode_headers(images: DataFrame, valid: Column | None = None) -> DataFrame:
    """``path, content`` of small image files for rows of the imaging table."""
    start = F.when(F.lit(True) if valid is None else valid, F.lit(bytes(128) + b"DICM")).otherwise(
        F.lit(b"not an image ")
    )
    content = F.concat(
        start,
        _element("02001000", "UI", F.lit("1.2.840.10008.1.2.1")),
        _element("08001800", "UI", F.col("dicom_id")),
        _element("08002000", "DA", F.col("study_date")),
        _element("08006000", "CS", F.col("modality")),
        _element("10002000", "LO", F.col("patient_id")),
        _element("20000D00", "UI", F.col("study_uid")),
        _element("20000E00", "UI", F.col("series_uid")),
        _number("28001000", F.col("rows")),
        _number("28001100", F.col("cols")),
    )
    return images.select(F.col("file_path").alias("path"), content.alias("content"))
