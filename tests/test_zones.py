import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.functions import standardize as std
from carelake.operators.integrate import Dictionaries
from carelake.operators.match import match
from carelake.plans import zones
from carelake.plans.recording import Recorder
from carelake.sources.graphs import load_graph
from carelake.sources.ntriples import read_ntriples
from test_imaging import TEXT, image

EHR = """patient_id,first_name,last_name,gender,birthDate,country
P0001,Leila,El Amrani,female,1970-05-01,MA
P0002,Jean,Petit,male,unknown,FR
P0003,Ana,,female,1980-01-01,ES
"""
LABS = [
    ("L1", "P0001", "2345-7", "Glucose", 180.0, "mg/dL", "2024-01-31", "final", "Lab_A"),
    ("L2", "P0001", "2160-0", "Creatinine", 132.6, "µmol/L", "2024-02-01", "preliminary", "Lab_B"),
    ("L3", "P0002", "2345-7", "Glucose", 150.0, "mg/dL", "2024-02-01", "final", "Lab_A"),
    ("L4", "P0404", "1-1", "Rare", 7.0, "mg/dL", "2024-02-02", "final", "Lab_A"),
]
LAB_NAMES = "lab_id patient_id test_code_loinc test_name value unit date status source_system".split()
FHIR = [
    {"resourceType": "Patient", "id": "P0002", "gender": "other"},
    {"resourceType": "Condition", "subject": {"reference": "Patient/P0001"}, "code": {"coding": [{"code": "E11"}]}},
    {"resourceType": "AllergyIntolerance", "patient": {"reference": "Patient/P0001"}, "code": {"text": "Penicillin"}},
    {"resourceType": "MedicationRequest", "subject": {"reference": "Patient/P0001"},
     "medicationCodeableConcept": {"text": "Amoxicillin"}, "authoredOn": "2024-03-01"},
    {"resourceType": "MedicationRequest", "subject": {"reference": "Patient/P0001"},
     "medicationCodeableConcept": {"text": "Aspirin"}},
]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    for folder in ("ehr", "lab", "fhir", "dicom/patient_P0001/study_1"):
        (raw / folder).mkdir(parents=True)
    (raw / "ehr" / "patients.csv").write_text(EHR)
    labs = [dict(zip(LAB_NAMES, r, strict=True)) for r in LABS]
    (raw / "lab" / "labs.json").write_text(json.dumps(labs, indent=2, ensure_ascii=False))
    (raw / "fhir" / "bundle.ndjson").write_text("\n".join(json.dumps(r) for r in FHIR))
    (raw / "dicom" / "patient_P0001" / "study_1" / "a.dcm").write_bytes(image(text=TEXT))
    (raw / "dicom" / "broken.dcm").write_bytes(b"broken")
    out = str(root / "out")
    zones.run_pipeline(spark, str(raw), out)
    return out, zones.run_pipeline(spark, str(raw), out)  # a second run replaces the first


def test_gold_tables(lake):
    _, result = lake
    people = {r.patient_id: r for r in result.gold["patients"].collect()}
    assert {k: v.gender_unified for k, v in people.items()} == {
        "P0001": "female", "P0002": "other", "P0003": "female",
    }
    assert people["P0001"].birthDate == "1970-05-01" and people["P0002"].birthDate is None
    labs = {r.lab_id: r for r in result.gold["lab_results"].collect()}
    assert (labs["L2"].value, labs["L2"].unit, labs["L2"].date) == (1.5, "mg/dL", "2024-02-01")
    assert [labs[k].is_abnormal for k in ("L1", "L2", "L3", "L4")] == [True, False, True, False]
    assert result.gold["dicom_images"].count() == 1
    assert result.image_errors.count() == 1
    assert result.gold["prescriptions"].where("date is null").first().drug_family == "NSAIDs"


def test_silver_is_partitioned_and_tagged(spark, lake):
    out, _ = lake
    labs = zones.read_silver(spark, f"{out}/silver", ["lab_results"])["lab_results"]
    assert {r.lab_id: r.tags for r in labs.collect()} == {
        "L1": ["abnormal"], "L2": ["preliminary"], "L3": ["abnormal"], "L4": ["no_reference_range"],
    }
    plan = labs.where("source_system = 'Lab_B'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_system" in plan


def test_answers(lake):
    _, result = lake
    answers = {name: df.collect() for name, df in result.queries.items()}
    assert answers["count_patients"][0][0] == 3
    assert [r.val for r in answers["abnormal_results"]] == [180.0, 150.0]
    assert [(r.allergyLabel, r.drugLabel) for r in answers["contraindications"]] == [
        ("Penicillin", "Amoxicillin")
    ]
    assert [r.val for r in answers["imaging_with_abnormal"]] == [180.0]
    assert [r.modality for r in answers["imaging_with_abnormal_bag"]] == ["CT"]


def test_graph_text_holds_the_same_triples(spark, lake, rows):
    out, _ = lake
    triples, unreadable = read_ntriples(spark, f"{out}/rdf")
    stored = load_graph(spark, f"{out}/graph").triples
    assert rows(triples) == rows(stored.select(*triples.columns))
    assert unreadable.count() == 0


def test_catalogue_and_lineage(lake, rows):
    _, result = lake
    found = match(
        result.catalog,
        [("?d", "rdf:type", "dcat:Dataset"), ("?d", "dct:identifier", "?name"), ("?d", "dcat:byteSize", "?n")],
        numeric={"n": lambda n: n > 0},
    )
    assert {r.name for r in found.collect()} == {
        "bronze/ehr", "bronze/lab", "bronze/fhir", "bronze/dicom",
        *[f"silver/{t}" for t in zones.SILVER_TABLES],
        *[f"gold/{t}" for t in result.gold],
    }
    origins = match(
        result.catalog,
        [("?d", "prov:wasDerivedFrom", "?s"), ("?s", "prov:wasDerivedFrom", "?raw")],
    ).where("d = 'res:dataset/gold/patients'")
    assert {r.raw for r in origins.collect()} == {"res:dataset/bronze/ehr", "res:dataset/bronze/fhir"}
    assert result.lineage.count() == 14


def test_lineage_follows_what_the_plans_read(spark, tmp_path, rows):
    """Without the second input, its edge is gone; what is staged stands for its sources."""
    for name in ("a", "b"):
        spark.range(3).withColumn("x", F.lit(name)).write.parquet(str(tmp_path / name))
    record = Recorder(spark, {str(tmp_path / "a"): "bronze/a", f"file:{tmp_path}/b": "bronze/b"})
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
    staged = record.stage(b.where("id > 0"), str(tmp_path / "staged"))
    both = a.join(staged, "id").select("id")
    record.write("silver/both", both, str(tmp_path / "both"), "join")
    record.write("silver/one", a.select("id"), str(tmp_path / "one"), "copy")
    record.write("gold/all", spark.read.parquet(str(tmp_path / "both"), str(tmp_path / "one")), str(tmp_path / "all"), "union")
    record.write("gold/none", spark.range(2), str(tmp_path / "none"), "make")
    assert rows(record.lineage()) == [
        ("gold/all", "silver/both", "union", 5),
        ("gold/all", "silver/one", "union", 5),
        ("silver/both", "bronze/a", "join", 2),
        ("silver/both", "bronze/b", "join", 2),
        ("silver/one", "bronze/a", "copy", 3),
    ]


def test_only_changed_datasets_are_profiled_again(spark, tmp_path):
    root = str(tmp_path / "lake")
    datasets = [(f"silver/{n}", "silver", f"{root}/silver/{n}", "parquet") for n in ("a", "b")]

    def refresh():
        tables = {name: spark.read.parquet(location) for name, _, location, _ in datasets}
        return zones.write_catalog(spark, root, datasets, tables, Recorder(spark, {}).lineage())

    def records():
        found = match(zones.read_catalog(spark, root), [("?d", "ont:records", "?n")])
        return {r.d.rpartition("/")[2]: int(r.n) for r in found.collect()}

    for name, n in (("a", 3), ("b", 4)):
        spark.range(n).write.parquet(f"{root}/silver/{name}")
    assert refresh() == ["silver/a", "silver/b"] and records() == {"a": 3, "b": 4}
    assert refresh() == [] and records() == {"a": 3, "b": 4}
    spark.range(2).write.mode("append").parquet(f"{root}/silver/b")
    assert refresh() == ["silver/b"] and records() == {"a": 3, "b": 6}


def test_contradictions_of_the_lake(spark, lake):
    out, result = lake
    found = zones.contradictions("gold", result.gold, Dictionaries.of(spark))
    values = {(r.dataset, r.metric, r.column): r.value for r in found.collect()}
    assert values["gold/lab_results", "orphan_rows", "patient"] == 1.0
    assert values["gold/lab_results", "violations", "other_unit"] == 0.0
    assert values["gold/prescriptions", "violations", "undated"] == 1.0
    assert values["gold/prescriptions", "consistent_pct", None] == 50.0


def test_gold_tables_are_replaced_together_or_not_at_all(spark, tmp_path, rows):
    root = str(tmp_path)
    silver = {t: schemas.INTEGRATED_TABLES[t] for t in ("conditions", "allergies", "dicom_images")}
    for name, schema in silver.items():
        spark.createDataFrame([], schema).write.parquet(f"{root}/silver/{name}")
    spark.createDataFrame([("P1", "male")], "patient_id string, gender_fhir string").write.parquet(f"{root}/silver/clinical_patients")
    spark.createDataFrame([], zones.SILVER_LABS).write.parquet(f"{root}/silver/lab_results")
    drugs = "patient_id string, drug string, date date, patient_id_pseudo string, drug_family string"
    spark.createDataFrame([], drugs).write.parquet(f"{root}/silver/prescriptions")
    people = "patient_id string, first_name string, last_name string, gender string, birthDate date, country string, patient_id_pseudo string"

    def with_patients(*names):
        made = [(f"P{i}", n, None, None, None, None, f"h{i}") for i, n in enumerate(names)]
        spark.createDataFrame(made, people).write.mode("overwrite").parquet(f"{root}/silver/patients")
        return [r.first_name for r in zones.read_gold(spark, root)["patients"].orderBy("first_name").collect()]

    assert with_patients("Ann") == []
    zones.write_gold(spark, root, Recorder(spark, {}))
    assert with_patients("Bo", "Cy") == ["Ann"]

    class Broken(Recorder):
        def write(self, dataset, *rest):
            super().write(dataset, *rest)
            if dataset == "gold/patients":
                raise RuntimeError("lost its driver")

    with pytest.raises(RuntimeError, match="lost"):
        zones.write_gold(spark, root, Broken(spark, {}))
    assert with_patients("Bo", "Cy") == ["Ann"]
    zones.write_gold(spark, root, Recorder(spark, {}))
    assert with_patients("Di") == ["Bo", "Cy"]


def test_dates_become_text_and_text_dates_without_the_formatter(spark, rows):
    days = spark.sql("SELECT explode(array(date'0001-01-01', date'2024-02-29', date'9999-12-31', null)) AS day")
    text = zones.as_text_dates(days, "day")
    assert [r[0] for r in text.collect()] == ["0001-01-01", "2024-02-29", "9999-12-31", None]
    assert "date_format" not in text._jdf.queryExecution().analyzed().toString().lower()
    back = text.select(std.to_date(F.col("day")).alias("day"))
    assert rows(back) == rows(days)
    assert "rlike" in back._jdf.queryExecution().analyzed().toString().lower()


def test_image_ids_of_the_lake_are_stored_as_what_differs_from_the_one_before(spark, tmp_path, rows):
    ids = ["dicom_id", "study_uid", "series_uid", "file_path"]
    images = spark.range(2_000).select(
        *[F.concat(F.lit("1.2."), (F.col("id") / 4).cast("int").cast("string")).alias(c) for c in ids], F.lit("CT").alias("modality")
    )
    Recorder(spark, {}).write_all(str(tmp_path), "silver", {"dicom_images": (images, "route")})
    files = list((tmp_path / "dicom_images").glob("*.parquet"))
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        found = {c.path_in_schema: c for c in (group.column(i) for i in range(group.num_columns))}
        assert all("DELTA_BYTE_ARRAY" in found[c].encodings and not found[c].has_dictionary_page for c in ids)
        assert found["modality"].has_dictionary_page
    assert files and rows(spark.read.parquet(str(tmp_path / "dicom_images"))) == rows(images)
