import json

import pytest
from pyspark.sql import types as T

from carelake import schemas
from carelake.sources import resources
from carelake.sources import tables as io


def test_csv_keeps_text_as_it_is(spark, tmp_path, rows):
    path = tmp_path / "p.csv"
    path.write_text(
        "patient_id,first_name,last_name,gender,birthDate,country\n"
        "P0001,Leila,El Amrani,female,1970-05-01,NA\n"
        'P0002,"A, B",,,not a date,FR\n'
    )
    assert rows(io.read_csv(spark, str(path))) == [
        ("P0001", "Leila", "El Amrani", "female", "1970-05-01", "NA"),
        ("P0002", "A, B", None, None, "not a date", "FR"),
    ]


LABS = [
    (f"LAB{i}", f"P{i % 3}", "2345-7", "Glucose", float(i), "µmol/L", "2024-01-31", "final", "Lab_A")
    for i in range(25)
]


def test_json_array_documents_round_trip(spark, tmp_path, rows):
    labs = spark.createDataFrame(LABS, schemas.LAB_DOCUMENT).coalesce(1)
    io.write_json_array(labs, str(tmp_path / "labs"), rows_per_document=10)
    files = list((tmp_path / "labs").glob("part-*"))
    assert sorted(len(json.loads(f.read_text())) for f in files) == [5, 10, 10]
    assert rows(io.read_json_array(spark, str(tmp_path / "labs"))) == sorted(LABS, key=repr)


def test_indented_array_document(spark, tmp_path):
    names = schemas.LAB_DOCUMENT.names
    text = json.dumps([dict(zip(names, r, strict=True)) for r in LABS], indent=2, ensure_ascii=False)
    (tmp_path / "labs.json").write_text(text, encoding="utf-8")
    assert io.read_json_array(spark, str(tmp_path / "labs.json")).count() == 25


def test_broken_array_document_fails(spark, tmp_path):
    (tmp_path / "labs.json").write_text('[{"lab_id": "L1"}, {"lab_id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_json_array(spark, str(tmp_path / "labs.json")).collect()


LINES = [
    '{"resourceType":"Patient","id":"P1","gender":"male"}',
    '{"resourceType":"Patient","id":"P1"}',
    "",
    "   ",
    '{"resourceType":"Condition","subject":{"reference":"Patient/P1"},"code":{"coding":[{"system":"ICD-10","code":"I10"},{"code":"E11"}]}}',
    '{"resourceType":"AllergyIntolerance","patient":{"reference":"P2"},"code":{"text":"Penicillin"}}',
    '{"resourceType":"MedicationRequest","subject":{"reference":"Patient/P1"},"medicationCodeableConcept":{"text":"Penicillin V"}}',
    '{"resourceType":"Encounter","id":"E1"}',
]


def ndjson(spark, tmp_path, *more):
    (tmp_path / "b.ndjson").write_text("\n".join([*LINES, *more]) + "\n", encoding="utf-8")
    return io.read_ndjson(spark, str(tmp_path / "b.ndjson"))


def test_resources_are_routed(spark, tmp_path, rows):
    routed = resources.route_resources(ndjson(spark, tmp_path))
    assert rows(routed.patients) == [("P1", "male"), ("P1", None)]
    assert rows(routed.conditions) == [("P1", "I10")]
    assert rows(routed.allergies) == [("P2", "Penicillin")]
    assert rows(routed.prescriptions) == [("P1", "Penicillin V", None)]


EMPTY_CODING = '{"resourceType":"Condition","subject":{"reference":"Patient/P9"},"code":{"coding":[]}}'


def test_missing_required_field_fails(spark, tmp_path):
    routed = resources.route_resources(ndjson(spark, tmp_path, EMPTY_CODING))
    with pytest.raises(Exception, match="icd10_code"):
        routed.conditions.collect()


def test_missing_required_field_can_be_set_aside(spark, tmp_path, rows):
    routed = resources.route_resources(ndjson(spark, tmp_path, EMPTY_CODING), quarantine=True)
    assert rows(routed.conditions) == [("P1", "I10")]
    assert rows(routed.quarantine) == [("Condition", "P9", "icd10_code")]


def test_malformed_line_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed"):
        ndjson(spark, tmp_path, '{"resourceType": "Patient", "id"').collect()


def test_resources_shape_back(spark, tmp_path, rows):
    conditions = spark.createDataFrame([("P1", "I10")], "patient_id string, icd10_code string")
    drugs = spark.createDataFrame(
        [("P1", "Aspirin", "2024-01-31"), ("P2", "Aspirin", None)],
        "patient_id string, drug string, date string",
    )
    lines = resources.condition_resources(conditions).unionByName(
        resources.prescription_resources(drugs)
    )
    lines.write.text(str(tmp_path / "r"))
    routed = resources.route_resources(io.read_ndjson(spark, str(tmp_path / "r")))
    assert rows(routed.conditions) == rows(conditions)
    assert rows(routed.prescriptions) == rows(drugs)


def test_tables_replace_and_absent_ones_are_empty(spark, tmp_path, rows):
    root = str(tmp_path / "gold")
    schema = schemas.INTEGRATED_TABLES["allergies"]
    for allergy in ("Aspirin", "Penicillin"):
        io.write_tables({"allergies": spark.createDataFrame([("P1", allergy, "h")], schema)}, root)
    assert rows(io.table_or_empty(spark, root, "allergies")) == [("P1", "Penicillin", "h")]
    assert io.table_exists(spark, root, "allergies")
    absent = io.table_or_empty(spark, root, "patients")
    assert not io.table_exists(spark, root, "patients")
    assert absent.count() == 0 and absent.schema.names == schemas.PATIENTS.names


def test_partitioned_write_keeps_all_rows(spark, tmp_path, rows):
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 40)) AS k")
    io.write_partitioned(df, str(tmp_path / "t"), "k")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert rows(back.select("id", "k")) == rows(df)


def test_files_are_counted_and_heads_shown(spark, tmp_path):
    for name in ("a/x.dcm", "a/b/y.dcm", "a/z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("line 1\nline 2\nline 3\n")
    assert io.count_files(spark, str(tmp_path)) == 2
    assert io.count_files(spark, str(tmp_path / "absent")) == 0
    head = io.text_head(spark, str(tmp_path / "a" / "z.txt"), 2)
    assert [r.value for r in head.collect()] == ["line 1", "line 2"]


def test_xml_rows(spark, tmp_path, rows):
    (tmp_path / "p.xml").write_text("<all><p><id>P1</id><g>male</g></p><p><id>P2</id></p></all>")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("g", T.StringType())])
    assert rows(io.read_xml(spark, str(tmp_path / "p.xml"), "p", schema)) == [("P1", "male"), ("P2", None)]


def test_csv_export(spark, tmp_path, rows):
    df = spark.createDataFrame([("P1", "x,y"), ("P2", None)], "a string, b string")
    io.export_csv({"t": df}, str(tmp_path))
    assert rows(io.read_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)


def test_csv_columns_go_by_name_and_quotes_are_undone(spark, tmp_path, rows):
    (tmp_path / "p.csv").write_text(
        'patient_id,last_name,first_name,birthDate,gender,country\nP1,El Amrani,"Al ""Bo"" X",1970-05-01,male,FR\nP2,"a, b",,,,NA\n'
    )
    found = io.read_csv(spark, str(tmp_path / "p.csv")).select("patient_id", "first_name", "last_name", "country")
    assert rows(found) == [("P1", 'Al "Bo" X', "El Amrani", "FR"), ("P2", None, "a, b", "NA")]


def test_csv_round_trip_of_awkward_text(spark, tmp_path, rows):
    texts = [("1", 'say "so"'), ("2", " a, b "), ("3", "two\nlines"), ("4", None)]
    df = spark.createDataFrame(texts, "id string, text string")
    io.write_csv(df, str(tmp_path / "t"))
    assert rows(io.read_csv(spark, str(tmp_path / "t"), df.schema, multi_line=True)) == sorted(texts, key=repr)


TWO_FILES = {
    "a.csv": "patient_id,first_name,last_name,gender,birthDate,country\nP1,Ann,Lee,female,1970-05-01,FR\n",
    "b.csv": "country,last_name,patient_id,first_name,note,gender,birthDate\nDE,Weiß,P2,Bo,x,male,1980-01-02\n",
    "empty.csv": "",
    "c d.csv": "\ufeffpatient_id,first_name,last_name,gender,birthDate,country\nP3,Cy,Poe,,,NA\n",
}


def csv_folder(tmp_path, **more):
    for name, text in {**TWO_FILES, **more}.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


GOOD = [
    ("P1", "Ann", "Lee", "female", "1970-05-01", "FR"),
    ("P2", "Bo", "Weiß", "male", "1980-01-02", "DE"),
    ("P3", "Cy", "Poe", None, None, "NA"),
]


def test_each_csv_file_is_read_by_its_own_header(spark, tmp_path, rows):
    found = io.read_csv(spark, csv_folder(tmp_path))
    assert rows(found) == GOOD and found.schema.names == schemas.EHR_PATIENTS.names
    headers = io.csv_headers(spark, str(tmp_path))
    assert sorted(len(files) for _, files in headers) == [1, 2]


BAD = {"bad.csv": TWO_FILES["b.csv"] + "DE,Short,P4\nFR,Right,P5,Di,,female,1990-01-01\nFR,Long,P6,Ed,,,1,2,3\n"}


def test_short_and_long_csv_rows_fail(spark, tmp_path):
    found = io.read_csv(spark, csv_folder(tmp_path, **BAD))
    with pytest.raises(Exception, match="(?i)malformed"):
        found.collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        found.select("patient_id").collect()


def test_short_and_long_csv_rows_can_be_set_aside(spark, tmp_path, rows):
    parsed = io.read_csv_set_aside(spark, csv_folder(tmp_path, **BAD))
    assert rows(parsed.table) == sorted([*GOOD, GOOD[1], ("P5", "Di", "Right", "female", "1990-01-01", "FR")], key=repr)
    assert sorted(r.record for r in parsed.quarantine.collect()) == ["DE,Short,P4", "FR,Long,P6,Ed,,,1,2,3"]
    assert [(r.file.rpartition("/")[2], r.n_rejected) for r in parsed.counts().collect()] == [("bad.csv", 2)]


def test_a_csv_file_without_a_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="country in .*d.csv"):
        io.read_csv(spark, csv_folder(tmp_path, **{"d.csv": "patient_id,first_name,last_name,gender,birthDate\n"}))


def test_csv_of_nothing(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert io.read_csv(spark, str(tmp_path)).count() == 0
    parsed = io.read_csv_set_aside(spark, str(tmp_path))
    assert parsed.table.count() == parsed.quarantine.count() == 0


def test_typed_csv_columns(spark, tmp_path, rows):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("a.b", T.StringType())])
    (tmp_path / "t.csv").write_text("a.b,n,n\nx,1,9\ny,one,9\n")
    parsed = io.read_csv_set_aside(spark, str(tmp_path), schema)
    assert rows(parsed.table) == [(1, "x")] and parsed.quarantine.first().record == "y,one,9"


def test_broken_ndjson_lines_can_be_set_aside(spark, tmp_path, rows):
    (tmp_path / "b.ndjson").write_text("\n".join([*LINES, '{"resourceType": "Patient", "id"', "[1"]) + "\n", encoding="utf-8")
    parsed = io.read_ndjson_set_aside(spark, str(tmp_path))
    whole = resources.route_resources(parsed.table)
    assert rows(whole.conditions) == [("P1", "I10")] and rows(whole.patients) == [("P1", "male"), ("P1", None)]
    assert sorted(r.record for r in parsed.quarantine.collect()) == ["[1", '{"resourceType": "Patient", "id"']
