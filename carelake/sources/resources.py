"""Routing of clinical resources by type, and shaping tables back into resources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.standardize import first_code, reference_id
from carelake.operators.harmonize import assert_required, split_required


@dataclass(frozen=True)
class Routed:
    """The four tables of a resource file, and the rows set aside, if that was asked for."""

    patients: DataFrame
    conditions: DataFrame
    allergies: DataFrame
    prescriptions: DataFrame
    quarantine: DataFrame | None = None


def _shape(resources: DataFrame, kind: str, **columns: Column) -> DataFrame:
    return resources.where(F.col("resourceType") == kind).select(
        *[c.alias(name) for name, c in columns.items()]
    )


def route_resources(resources: DataFrame, quarantine: bool = False) -> Routed:
    """Split resources into patients, conditions, allergies and prescriptions.

    Other types are ignored. A resource without a required field fails the
    job, or goes to ``quarantine`` as ``resourceType, patient_id,
    missing_fields``. The input is read once per table: land or cache it when
    several are used.
    """
    subject = reference_id(F.col("subject.reference"))
    shaped = {
        "Patient": (
            _shape(
                resources, "Patient", patient_id=F.col("id"), gender_fhir=F.col("gender")
            ),
            ["patient_id"],
        ),
        "Condition": (
            _shape(
                resources,
                "Condition",
                patient_id=subject,
                icd10_code=first_code(F.col("code.coding")),
            ),
            ["patient_id", "icd10_code"],
        ),
        "AllergyIntolerance": (
            _shape(
                resources,
                "AllergyIntolerance",
                patient_id=reference_id(F.col("patient.reference")),
                allergy=F.col("code.text"),
            ),
            ["patient_id", "allergy"],
        ),
        "MedicationRequest": (
            _shape(
                resources,
                "MedicationRequest",
                patient_id=subject,
                drug=F.col("medicationCodeableConcept.text"),
                date=F.col("authoredOn"),
            ),
            ["patient_id", "drug"],
        ),
    }
    if not quarantine:
        return Routed(*[assert_required(df, required) for df, required in shaped.values()])
    good, bad = [], None
    for kind, (df, required) in shaped.items():
        complete, incomplete = split_required(df, required)
        good.append(complete)
        incomplete = incomplete.select(
            F.lit(kind).alias("resourceType"), "patient_id", "missing_fields"
        )
        bad = incomplete if bad is None else bad.unionByName(incomplete)
    return Routed(*good, quarantine=bad)


def _reference(patient_id: Column) -> Column:
    return F.struct(F.concat(F.lit("Patient/"), patient_id).alias("reference"))


def _coding(system: str, code: Column) -> Column:
    return F.array(F.struct(F.lit(system).alias("system"), code.alias("code"))).alias("coding")


def patient_resources(patients: DataFrame) -> DataFrame:
    """One JSON ``Patient`` resource per row, in column ``resource``."""
    return patients.select(
        F.to_json(
            F.struct(
                F.lit("Patient").alias("resourceType"),
                F.col("patient_id").alias("id"),
                F.col("gender_unified").alias("gender"),
            )
        ).alias("resource")
    )


def condition_resources(conditions: DataFrame) -> DataFrame:
    return conditions.select(
        F.to_json(
            F.struct(
                F.lit("Condition").alias("resourceType"),
                _reference(F.col("patient_id")).alias("subject"),
                F.struct(_coding("ICD-10", F.col("icd10_code"))).alias("code"),
            )
        ).alias("resource")
    )


def observation_resources(labs: DataFrame) -> DataFrame:
    quantity = F.struct(F.col("value"), F.col("unit"))
    return labs.select(
        F.to_json(
            F.struct(
                F.lit("Observation").alias("resourceType"),
                F.col("lab_id").alias("id"),
                F.col("status"),
                _reference(F.col("patient_id")).alias("subject"),
                F.struct(
                    _coding("LOINC", F.col("test_code_loinc")), F.col("test_name").alias("text")
                ).alias("code"),
                quantity.alias("valueQuantity"),
                F.col("date").alias("effectiveDateTime"),
            )
        ).alias("resource")
    )


def allergy_resources(allergies: DataFrame) -> DataFrame:
    return allergies.select(
        F.to_json(
            F.struct(
                F.lit("AllergyIntolerance").alias("resourceType"),
                _reference(F.col("patient_id")).alias("patient"),
                F.struct(F.col("allergy").alias("text")).alias("code"),
            )
        ).alias("resource")
    )


def prescription_resources(prescriptions: DataFrame) -> DataFrame:
    return prescriptions.select(
        F.to_json(
            F.struct(
                F.lit("MedicationRequest").alias("resourceType"),
                _reference(F.col("patient_id")).alias("subject"),
                F.struct(F.col("drug").alias("text")).alias("medicationCodeableConcept"),
                F.col("date").alias("authoredOn"),
            )
        ).alias("resource")
    )
