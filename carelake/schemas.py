"""Table schemas and the small reference dictionaries.

Every reader takes an explicit schema, so no job spends a pass on inference
and a country code such as ``NA`` stays text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------- sources

EHR_PATIENTS = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("birthDate", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

LAB_DOCUMENT = T.StructType(
    [
        T.StructField("lab_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("test_code_loinc", T.StringType()),
        T.StructField("test_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source_system", T.StringType()),
    ]
)

_REFERENCE = T.StructType([T.StructField("reference", T.StringType())])
_TEXT = T.StructType([T.StructField("text", T.StringType())])
_CODING = T.StructType(
    [T.StructField("system", T.StringType()), T.StructField("code", T.StringType())]
)

# One nullable union of the four resource shapes; ``resourceType`` tells them apart.
CLINICAL_RESOURCE = T.StructType(
    [
        T.StructField("resourceType", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("subject", _REFERENCE),
        T.StructField("patient", _REFERENCE),
        T.StructField(
            "code",
            T.StructType(
                [
                    T.StructField("coding", T.ArrayType(_CODING)),
                    T.StructField("text", T.StringType()),
                ]
            ),
        ),
        T.StructField("medicationCodeableConcept", _TEXT),
        T.StructField("authoredOn", T.StringType()),
    ]
)

IMAGING = T.StructType(
    [
        T.StructField("dicom_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("patient_id_pseudo", T.StringType()),
        T.StructField("study_uid", T.StringType()),
        T.StructField("series_uid", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("study_date", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("rows", T.IntegerType()),
        T.StructField("cols", T.IntegerType()),
    ]
)

# ----------------------------------------------------------- integrated tables

PATIENTS = T.StructType(
    EHR_PATIENTS.fields
    + [
        T.StructField("patient_id_pseudo", T.StringType()),
        T.StructField("gender_unified", T.StringType()),
    ]
)

LAB_RESULTS = T.StructType(
    LAB_DOCUMENT.fields
    + [
        T.StructField("patient_id_pseudo", T.StringType()),
        T.StructField("ref_low", T.DoubleType()),
        T.StructField("ref_high", T.DoubleType()),
        T.StructField("is_abnormal", T.BooleanType()),
    ]
)

CONDITIONS = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("icd10_code", T.StringType()),
        T.StructField("patient_id_pseudo", T.StringType()),
        T.StructField("icd10_label", T.StringType()),
    ]
)

ALLERGIES = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("allergy", T.StringType()),
        T.StructField("patient_id_pseudo", T.StringType()),
    ]
)

PRESCRIPTIONS = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("drug", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("patient_id_pseudo", T.StringType()),
        T.StructField("drug_family", T.StringType()),
    ]
)

INTEGRATED_TABLES = {
    "patients": PATIENTS,
    "lab_results": LAB_RESULTS,
    "conditions": CONDITIONS,
    "allergies": ALLERGIES,
    "prescriptions": PRESCRIPTIONS,
    "dicom_images": IMAGING,
}

# A graph is a duplicate-free set of these rows. ``s``, ``p`` and IRI objects
# are held in prefix:name form and expanded at the text boundary.
TRIPLES = T.StructType(
    [
        T.StructField("s", T.StringType()),
        T.StructField("p", T.StringType()),
        T.StructField("o", T.StringType()),
        T.StructField("o_kind", T.StringType()),
        T.StructField("o_dtype", T.StringType()),
        T.StructField("o_lang", T.StringType()),
    ]
)

# ------------------------------------------------------ reference dictionaries

LAB_TEST_FIELDS = "code string, name string, unit string, low double, high double"
CODE_LABEL_FIELDS = "code string, label string"
DRUG_FAMILY_FIELDS = "drug string, family string"
ALLERGY_FAMILY_FIELDS = "allergy string, family string"
UNIT_RULE_FIELDS = "test string, from_unit string, to_unit string, divisor double, digits int"

# Laboratory tests with their reference ranges.
LAB_TESTS = [
    ("718-7", "Hemoglobin", "g/dL", 12.0, 17.0),
    ("2160-0", "Creatinine", "mg/dL", 0.5, 1.5),
    ("2345-7", "Glucose", "mg/dL", 70.0, 140.0),
    ("6690-2", "WBC", "10^3/uL", 4.0, 11.0),
]

# Condition codes and labels, and the label of any other code.
CONDITION_LABELS = [
    ("I10", "Hypertension essentielle"),
    ("E11", "Diabète de type 2"),
    ("J45", "Asthme"),
]
UNKNOWN_CONDITION = "Unknown ICD-10"

# Drugs and their families, and the family of any other drug.
DRUG_FAMILIES = [
    ("Amoxicillin", "Penicillins"),
    ("Penicillin V", "Penicillins"),
    ("Ibuprofen", "NSAIDs"),
    ("Aspirin", "NSAIDs"),
    ("Paracetamol", "Analgesics"),
]
UNKNOWN_FAMILY = "UnknownFamily"

# The drug family an allergy rules out.
ALLERGY_FAMILIES = [("Penicillin", "Penicillins"), ("Aspirin", "NSAIDs")]

# 1 mg/dL of creatinine is 88.4 µmol/L. The unit is written with
# either of two look-alike letters, U+00B5 (micro) and U+03BC (Greek mu).
UNIT_RULES = [
    ("Creatinine", "µmol/L", "mg/dL", 88.4, 3),
    ("Creatinine", "μmol/L", "mg/dL", 88.4, 3),
]


@dataclass(frozen=True)
class ReferenceData:
    """The dictionaries a pipeline needs; each may be a list of tuples or a DataFrame."""

    lab_tests: object = None
    condition_labels: object = None
    drug_families: object = None
    allergy_families: object = None
    unit_rules: object = None

    @staticmethod
    def default() -> "ReferenceData":
        return ReferenceData(
            lab_tests=LAB_TESTS,
            condition_labels=CONDITION_LABELS,
            drug_families=DRUG_FAMILIES,
            allergy_families=ALLERGY_FAMILIES,
            unit_rules=UNIT_RULES,
        )
