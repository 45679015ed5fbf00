import hashlib
from itertools import groupby

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from carelake import schemas
from carelake.operators import mapping, vocabulary
from carelake.operators.integrate import Dictionaries, integrate_prescriptions, pseudonymize
from carelake.operators.lookup import local_table
from carelake.sources import graphs
from carelake.sources.graphs import load_graph, save_graph
from carelake.sources.tables import write_tables


@pytest.fixture(scope="module")
def dictionaries(spark):
    return Dictionaries.of(spark)


def h(text, keep=16):
    return hashlib.sha256(text.encode()).hexdigest()[:keep]


def objects(triples):
    return sorted((r.s, r.p, r.o) for r in triples.collect())


def test_static_vocabulary_has_80_triples(spark, dictionaries):
    declared = vocabulary.vocabulary(spark)
    assert declared.count() == 38
    concepts = vocabulary.concepts(spark, dictionaries)
    assert concepts.count() == 42 == concepts.distinct().count()
    assert declared.unionByName(concepts).distinct().count() == 80
    assert [r[0] for r in vocabulary.families(dictionaries.drug_families.table).collect()] == [
        "Analgesics",
        "NSAIDs",
        "Penicillins",
    ]
    narrower = concepts.where("p = 'skos:narrower'").collect()
    assert {r.s for r in narrower} == {"res:drugfamily/Medicines"} and len(narrower) == 3


def patients(spark, *rows):
    return spark.createDataFrame(
        [(*r, h(r[0])) for r in rows],
        "patient_id string, first_name string, last_name string, patient_id_pseudo string",
    )


def test_patients(spark):
    found = mapping.map_patients(patients(spark, ("P1", "Leila", "El Amrani"), ("P1", "Leila", "El Amrani")))
    p = f"res:patient/{h('P1')}"
    assert objects(found) == [
        (p, "ont:label", "Leila El Amrani"),
        (p, "rdf:type", "ont:Patient"),
    ]


def test_a_patient_with_two_names_is_typed_once(spark):
    found = mapping.map_patients(patients(spark, ("P1", "A", "B"), ("P1", "C", "D")))
    assert sorted(r.p for r in found.collect()) == ["ont:label", "ont:label", "rdf:type"]


IMAGE = dict(
    dicom_id="1.1", patient_id="P1", patient_id_pseudo=h("P1"), study_uid="9", series_uid="9.1",
    modality="CT", study_date="20240131", file_path="a.dcm", rows=1, cols=1,
)


def images(spark, *changes):
    rows = [{**IMAGE, **c} for c in changes]
    return local_table(spark, [tuple(r[n] for n in schemas.IMAGING.names) for r in rows], schemas.IMAGING)


def test_imaging_links_both_ways(spark):
    p, study, inst = f"res:patient/{h('P1')}", "res:imagingstudy/9", "res:dicom/1.1"
    assert objects(mapping.map_imaging(images(spark, {}, {}))) == sorted(
        [
            (p, "rdf:type", "ont:Patient"),
            (study, "rdf:type", "ont:ImagingStudy"),
            (study, "ont:studyUID", "9"),
            (study, "ont:date", "2024-01-31"),
            (p, "ont:hasImagingStudy", study),
            (inst, "rdf:type", "ont:DicomInstance"),
            (inst, "ont:hasPatient", p),
            (inst, "ont:seriesUID", "9.1"),
            (inst, "ont:sopUID", "1.1"),
            (inst, "ont:modality", "CT"),
            (inst, "ont:filePath", "a.dcm"),
            (study, "ont:hasDicomInstance", inst),
        ]
    )


def test_incomplete_images_are_left_out(spark):
    bad = [{"dicom_id": None}, {"study_uid": ""}, {"patient_id_pseudo": None}]
    assert mapping.map_imaging(images(spark, *bad)).count() == 0


def test_absent_image_attributes_give_no_triple(spark):
    found = mapping.map_imaging(
        images(spark, {"series_uid": None, "modality": "", "study_date": None, "file_path": ""})
    )
    assert {r.p for r in found.collect()} == {
        "rdf:type", "ont:studyUID", "ont:hasImagingStudy", "ont:hasPatient", "ont:sopUID",
        "ont:hasDicomInstance",
    }


def test_shared_nodes_stay_a_set(spark):
    """One study of two patients, one instance seen with two modalities."""
    found = mapping.map_imaging(
        images(spark, {}, {"modality": "MR"}, {"patient_id_pseudo": "other", "dicom_id": "1.2"})
    )
    assert found.count() == found.distinct().count() == 22


def test_prescription_edges(spark, dictionaries):
    raw = spark.createDataFrame(
        [("P1", "Penicillin V", None), ("P1", "New Drug", "2024-01-31"), ("P1", "New Drug", "2024-01-31")],
        "patient_id string, drug string, date string",
    )
    found = mapping.map_prescriptions(integrate_prescriptions(raw, dictionaries))
    p = f"res:patient/{h('P1')}"
    undated = f"res:prescription/{h('2:P112:Penicillin V-', 32)}"
    dated = f"res:prescription/{h('2:P18:New Drug10:2024-01-31', 32)}"
    assert objects(found) == sorted(
        [
            ("res:drug/Penicillin_V", "rdf:type", "ont:Drug"),
            ("res:drug/Penicillin_V", "ont:label", "Penicillin V"),
            ("res:drug/Penicillin_V", "ont:belongsToFamily", "res:drugfamily/Penicillins"),
            ("res:drug/New_Drug", "rdf:type", "ont:Drug"),
            ("res:drug/New_Drug", "ont:label", "New Drug"),
            ("res:drug/New_Drug", "ont:belongsToFamily", "res:drugfamily/UnknownFamily"),
            (undated, "rdf:type", "ont:Prescription"),
            (undated, "ont:drug", "res:drug/Penicillin_V"),
            (p, "ont:hasPrescription", undated),
            (dated, "rdf:type", "ont:Prescription"),
            (dated, "ont:drug", "res:drug/New_Drug"),
            (dated, "ont:date", "2024-01-31"),
            (p, "ont:hasPrescription", dated),
        ]
    )


def test_allergies_know_the_families_they_rule_out(spark, dictionaries):
    raw = spark.createDataFrame([("P1", "Penicillin"), ("P1", "Pollen")], "patient_id string, allergy string")
    found = mapping.map_allergies(pseudonymize(raw), dictionaries.allergy_families)
    assert [(r.s, r.o) for r in found.where("p = 'ont:affectsFamily'").collect()] == [
        (f"res:allergy/{h('2:P110:Penicillin', 32)}", "res:drugfamily/Penicillins")
    ]
    assert found.where("p = 'ont:hasAllergy'").count() == 2


def labs(spark, n=3):
    rows = [
        (f"L{i}", "P1", "2345-7", "Glucose", 140.0 + i, "mg/dL", "2024-01-31", "final", "A", h("P1"), 70.0, 140.0, i > 0)
        for i in range(n)
    ]
    return local_table(spark, rows, schemas.LAB_RESULTS)


def test_labs(spark):
    found = mapping.map_labs(labs(spark))
    assert found.count() == 3 * 8 + 1
    assert {r.s for r in found.collect()} == {"res:lab/L0", "res:lab/L1", "res:lab/L2", "res:loinc/2345-7"}
    value = found.where("s = 'res:lab/L1' and p = 'ont:value'").first()
    assert (value.o, value.o_kind, value.o_dtype) == ("141.0", "literal", "xsd:float")


def test_staging_changes_nothing(spark, tmp_path, rows):
    plain = rows(mapping.map_imaging(images(spark, {}, {"dicom_id": "1.2"})))
    staged = mapping.map_imaging(images(spark, {}, {"dicom_id": "1.2"}), staging=str(tmp_path / "s"))
    assert rows(staged) == plain


def tables(spark, dictionaries):
    drugs = spark.createDataFrame(
        [("P1", "Aspirin", "2024-01-31")], "patient_id string, drug string, date string"
    )
    allergies = spark.createDataFrame([("P1", "Aspirin")], "patient_id string, allergy string")
    conditions = spark.createDataFrame(
        [("P9", "I10", h("P9"), "x")],
        "patient_id string, icd10_code string, patient_id_pseudo string, icd10_label string",
    )
    return {
        "patients": patients(spark, ("P1", "A", "B")),
        "lab_results": labs(spark),
        "conditions": conditions,
        "allergies": pseudonymize(allergies),
        "prescriptions": integrate_prescriptions(drugs, dictionaries),
        "dicom_images": images(spark, {}, {"dicom_id": "1.2", "patient_id_pseudo": "unlisted"}),
    }


def test_graph_is_a_set_and_repeating_rows_change_nothing(spark, dictionaries, rows):
    once = tables(spark, dictionaries)
    graph = mapping.build_graph(spark, once, dictionaries)
    twice = {name: df.unionByName(df) for name, df in once.items()}
    again = mapping.build_graph(spark, twice, dictionaries)
    assert rows(graph) == rows(graph.distinct()) == rows(again)
    assert mapping.graph_size(graph).first()[0] == len(rows(graph))


def test_only_imaging_types_unlisted_patients(spark, dictionaries):
    graph = mapping.build_graph(spark, tables(spark, dictionaries), dictionaries)
    typed = {r.s for r in graph.where("p = 'rdf:type' and o = 'ont:Patient'").collect()}
    assert typed == {f"res:patient/{h('P1')}", "res:patient/unlisted"}
    assert graph.where(f"p = 'ont:hasCondition' and s = 'res:patient/{h('P9')}'").count() == 1


def test_graph_by_subject_is_the_same_set_and_needs_no_exchange_of_the_triples(spark, dictionaries, rows, tmp_path):
    twice = {name: df.unionByName(df) for name, df in tables(spark, dictionaries).items()}
    graph = mapping.build_graph(spark, twice, dictionaries)
    by_subject = mapping.build_graph(spark, twice, dictionaries, by_subject=True)
    assert rows(by_subject) == rows(by_subject.distinct()) == rows(graph)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    save_graph(by_subject, str(tmp_path / "graph"), buckets=3, by_subject=True)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    found = load_graph(spark, str(tmp_path / "graph")).triples
    assert rows(found) == rows(graph)
    files = found.select("p", "s", F.regexp_extract(F.input_file_name(), r"_(\d+)\.c", 1).cast("int").alias("bucket"))
    assert files.where("bucket <> pmod(hash(s), 3)").count() == 0
    # A kind of node or link has one file for each predicate and bucket: its rows lie in one task.
    names = found.select("p", F.element_at(F.split("s", "/"), 1).alias("kind"), F.expr("pmod(hash(s), 3)").alias("bucket"), F.input_file_name().alias("file"))
    per_kind = names.where("p not in ('rdf:type', 'skos:prefLabel')").groupBy("p", "kind", "bucket").agg(F.count_distinct("file").alias("n"))
    assert per_kind.where("n > 1").where("kind = 'res:patient'").count() == 0


def test_written_tables_take_the_denser_codec(spark, tmp_path):
    write_tables({"one": spark.range(3)}, str(tmp_path))
    assert all(".zstd." in f.name for f in (tmp_path / "one").glob("part-*"))


def test_parts_written_in_turn_are_the_same_graph_and_leave_no_shuffle_files(spark, dictionaries, rows, tmp_path, shuffle_files, monkeypatch):
    twice = {name: df.unionByName(df) for name, df in tables(spark, dictionaries).items()}
    parts = mapping.graph_parts(spark, twice, dictionaries)
    before, left = shuffle_files(), []
    survey = graphs.surveyed
    monkeypatch.setattr(graphs, "surveyed", lambda written: left.append(shuffle_files(since=before)) or survey(written))
    save_graph(parts, str(tmp_path / "graph"), buckets=3, by_subject=True)
    assert len(parts) > 1 and left == [set()]
    found = load_graph(spark, str(tmp_path / "graph")).triples
    assert rows(found) == rows(mapping.build_graph(spark, twice, dictionaries))
    files = found.select("s", F.regexp_extract(F.input_file_name(), r"_(\d+)\.c", 1).cast("int").alias("bucket"))
    assert files.where("bucket <> pmod(hash(s), 3)").count() == 0


def test_subjects_of_a_graph_are_stored_as_what_differs_from_the_one_before(spark, tmp_path):
    made = spark.range(20_000).select(
        F.concat(F.lit("res:x/"), F.sha2(F.col("id").cast("string"), 256)).alias("s"), F.lit("ont:label").alias("p"),
        F.col("id").cast("string").alias("o"), F.lit("literal").alias("o_kind"),
        F.lit(None).cast("string").alias("o_dtype"), F.lit(None).cast("string").alias("o_lang"),
    )
    save_graph(made, str(tmp_path / "graph"), buckets=1)
    files = list((tmp_path / "graph").rglob("triples/**/*.parquet"))
    columns = [pq.ParquetFile(f).metadata.row_group(0).column(0) for f in files]
    assert columns and all(c.path_in_schema == "s" and "DELTA_BYTE_ARRAY" in c.encodings for c in columns)
    assert load_graph(spark, str(tmp_path / "graph")).triples.exceptAll(made.select(schemas.TRIPLES.names)).count() == 0


def test_large_parts_come_in_slices_of_whole_buckets(spark, dictionaries, rows, tmp_path):
    """The exchange of a part holds some of its subjects alone, and a bucket gets no more files by that."""
    key = F.col("id").cast("string")
    many = spark.range(60)
    given = tables(spark, dictionaries) | {
        "prescriptions": many.select(
            key.alias("patient_id"), F.sha2(key, 256).alias("patient_id_pseudo"), F.lit("Ibuprofen").alias("drug"),
            F.lit("2024-01-01").alias("date"), F.lit("NSAIDs").alias("drug_family"),
        ),
        "dicom_images": many.select(
            *[key.alias(c) for c in ("dicom_id", "patient_id_pseudo", "study_uid", "series_uid", "modality", "file_path")],
            F.lit("20240101").alias("study_date"),
        ),
    }
    parts = mapping.graph_parts(spark, given, dictionaries)
    of_slice = F.pmod(F.hash("s"), F.lit(mapping.SLICES))
    held = [{r[0] for r in part.select(of_slice).distinct().collect()} for part in parts[: 4 * mapping.SLICES]]
    assert mapping.SLICES > 1 and held == 4 * [{i} for i in range(mapping.SLICES)]
    text = parts[0]._jdf.queryExecution().executedPlan().toString()
    assert "pmod(hash(" in text.partition("Exchange")[2]
    save_graph(parts, str(tmp_path / "graph"), buckets=2 * mapping.SLICES, by_subject=True)
    found = load_graph(spark, str(tmp_path / "graph")).triples
    assert rows(found) == rows(mapping.build_graph(spark, given, dictionaries))
    files = found.select("p", F.expr(f"pmod(hash(s), {2 * mapping.SLICES})").alias("bucket"), F.input_file_name().alias("file"))
    for p in ("ont:drug", "ont:hasPrescription", "ont:sopUID", "ont:studyUID"):
        assert files.where(F.col("p") == p).groupBy("bucket").agg(F.count_distinct("file").alias("n")).where("n > 1").count() == 0, p


def test_repeated_subjects_of_a_graph_have_no_dictionary(spark, tmp_path):
    made = spark.range(20_000).select(
        F.concat(F.lit("res:x/"), (F.col("id") / 4).cast("int").cast("string")).alias("s"), F.lit("ont:hasPatient").alias("p"),
        F.concat(F.lit("res:y/"), F.col("id").cast("string")).alias("o"), F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("o_dtype"), F.lit(None).cast("string").alias("o_lang"),
    )
    save_graph(made, str(tmp_path / "graph"), buckets=1)
    columns = [pq.ParquetFile(f).metadata.row_group(0).column(0) for f in (tmp_path / "graph").rglob("triples/**/*.parquet")]
    assert columns and all(c.path_in_schema == "s" and not c.has_dictionary_page and "DELTA_BYTE_ARRAY" in c.encodings for c in columns)
    assert load_graph(spark, str(tmp_path / "graph")).triples.exceptAll(made.select(schemas.TRIPLES.names)).count() == 0


def test_parts_come_sorted_by_kind_and_subject_and_work_out_an_id_once(spark, dictionaries, tmp_path):
    key = F.col("id").cast("string")
    given = tables(spark, dictionaries) | {
        "prescriptions": spark.range(300).select(
            key.alias("patient_id"), F.concat(F.lit("p"), key).alias("patient_id_pseudo"), F.lit("Ibuprofen").alias("drug"),
            F.lit("2024-01-01").alias("date"), F.lit("NSAIDs").alias("drug_family"),
        ),
    }
    parts = mapping.graph_parts(spark, given, dictionaries)
    text = parts[0]._jdf.queryExecution().executedPlan().toString()
    assert text.count("sha2(") == 1
    save_graph(parts, str(tmp_path / "graph"), buckets=4, by_subject=True)
    files = [pq.ParquetFile(f).read(["s"])["s"].to_pylist() for f in (tmp_path / "graph").rglob("triples/**/*.parquet")]
    for subjects in files:
        runs = [(kind, list(run)) for kind, run in groupby(subjects, lambda s: s.partition("/")[0])]
        assert len(runs) == len(dict(runs)) and all(run == sorted(run) for _, run in runs)
    assert max(map(len, files)) > 50
    # Nothing but the parts' own plans sorted them.
    for part in parts:
        text = part._jdf.queryExecution().executedPlan().toString()
        assert "Sort [node#" in text or "Sort [s#" in text
