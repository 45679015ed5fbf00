import math

import pytest

from carelake import schemas
from carelake.operators import harmonize, integrate
from carelake.operators.integrate import Dictionaries


@pytest.fixture(scope="module")
def dictionaries(spark):
    return Dictionaries.of(spark)


LABS = [
    # id, test, value, unit -> value, unit, abnormal
    ("L1", "Creatinine", 132.6, "µmol/L", 1.5, "mg/dL", False),
    ("L2", "Creatinine", 176.8, "μmol/L", 2.0, "mg/dL", True),
    ("L3", "Creatinine", 100.0, "µmol/L", 1.131, "mg/dL", False),
    ("L4", "Creatinine", 0.4, "mg/dL", 0.4, "mg/dL", True),
    ("L5", "Glucose", 141.0, "µmol/L", 141.0, "µmol/L", True),
    ("L6", "Glucose", 140.0, "mg/dL", 140.0, "mg/dL", False),
    ("L7", "Ferritin", 1e6, "ng/mL", 1e6, "ng/mL", False),
    ("L8", "Glucose", None, "mg/dL", None, "mg/dL", False),
    ("L9", None, 5.0, None, 5.0, None, False),
]


def labs(spark):
    rows = [(i, "P1", "code", t, v, u, "2024-01-31", "final", "Lab_A") for i, t, v, u, *_ in LABS]
    rows.append(("L0", "P1", "code", "Glucose", math.nan, "mg/dL", "2024-01-31", "final", "Lab_A"))
    return spark.createDataFrame(rows, schemas.LAB_DOCUMENT)


def test_labs_are_harmonised_then_flagged(spark, dictionaries):
    found = {r.lab_id: r for r in integrate.integrate_labs(labs(spark), dictionaries).collect()}
    for lab_id, _, _, _, value, unit, abnormal in LABS:
        assert (found[lab_id].value, found[lab_id].unit) == (value, unit)
        assert found[lab_id].is_abnormal is abnormal
    assert found["L0"].is_abnormal is False and math.isnan(found["L0"].value)
    assert (found["L6"].ref_low, found["L7"].ref_low) == (70.0, None)


def test_unify_prefers_the_clinical_gender(spark, rows):
    ehr = spark.createDataFrame(
        [("P1", "male"), ("P2", None), ("P3", "male"), ("P4", "female"), (None, "male"), (None, "male")],
        "patient_id string, gender string",
    )
    clinical = spark.createDataFrame(
        [("P1", "female"), ("P2", "male"), ("P3", None), ("P5", "male"), ("P4", "a"), ("P4", "b"), (None, "x")],
        "patient_id string, gender_fhir string",
    )
    expected = sorted(
        [
            ("P1", "male", "female"),
            ("P2", None, "male"),
            ("P3", "male", "male"),
            ("P4", "female", "a"),
            ("P4", "female", "b"),
            (None, "male", "male"),
            (None, "male", "male"),
        ],
        key=repr,
    )
    assert rows(integrate.unify_entities(ehr, clinical)) == expected
    assert rows(integrate.unify_entities(ehr, clinical, min_rows=0, share=0.01)) == expected
    empty = clinical.where("false")
    assert {r[2] for r in rows(integrate.unify_entities(ehr, empty))} == {"male", "female", None}


def test_terms_and_families_have_defaults(spark, dictionaries, rows):
    conditions = spark.createDataFrame(
        [("P1", "I10"), ("P1", "Z99"), ("P2", None)], "patient_id string, icd10_code string"
    )
    found = integrate.integrate_conditions(conditions, dictionaries)
    assert {(r.icd10_code, r.icd10_label) for r in found.collect()} == {
        ("I10", "Hypertension essentielle"),
        ("Z99", "Unknown ICD-10"),
        (None, "Unknown ICD-10"),
    }
    drugs = spark.createDataFrame(
        [("P1", "Penicillin V", None), ("P1", "Other", "2024-01-31")],
        "patient_id string, drug string, date string",
    )
    found = integrate.integrate_prescriptions(drugs, dictionaries)
    assert {(r.drug, r.drug_family) for r in found.collect()} == {
        ("Penicillin V", "Penicillins"),
        ("Other", "UnknownFamily"),
    }


def test_missing_entities(spark, rows):
    some = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("b",), ("c",)], "k string")
    assert rows(integrate.missing_entities(some, known, "k")) == [("a",)]


def test_required_fields_fail_or_split(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None), (None, None)], "k string, n int")
    good, bad = harmonize.split_required(df, ["k", "n"])
    assert rows(good) == [("a", 1)]
    assert rows(bad) == sorted([(None, 2, "k"), ("c", None, "n"), (None, None, "k,n")], key=repr)
    assert rows(harmonize.assert_required(good, ["k", "n"])) == [("a", 1)]
    with pytest.raises(Exception, match="required field missing: (k|n)"):
        harmonize.assert_required(df, ["k", "n"]).collect()
    for part in (harmonize.assert_required(df, ["k", "n"]), harmonize.assert_required(df, ["k"]).select("n")):
        with pytest.raises(Exception, match="required field missing"):
            part.count()


def test_repair_rules_apply_in_order(spark, rows):
    df = spark.createDataFrame(
        [("a", 5.0, None), ("b", -1.0, "x"), ("c", None, "y"), (None, 1.0, "z")],
        "k string, v double, u string",
    )
    found = harmonize.repair(df, ["k", "v"], fill={"u": "?"}, null_if={"v": "v < 0"})
    assert rows(found) == [("a", 5.0, "?")]
