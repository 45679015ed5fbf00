"""Cleaning and joining the sources into the six integrated tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake import schemas
from carelake.functions.identity import pseudonym
from carelake.operators.harmonize import flag_range, harmonize_units
from carelake.operators.lookup import MAX_BROADCAST_ROWS, Dictionary, translate
from carelake.operators.skew import skew_join


@dataclass(frozen=True)
class Dictionaries:
    """The checked dictionaries of a pipeline, ready to join."""

    lab_tests: Dictionary
    condition_labels: Dictionary
    drug_families: Dictionary
    allergy_families: Dictionary
    unit_rules: Dictionary

    @staticmethod
    def of(
        spark: SparkSession,
        data: schemas.ReferenceData | None = None,
        max_rows: int = MAX_BROADCAST_ROWS,
    ) -> "Dictionaries":
        data = data or schemas.ReferenceData.default()

        def checked(rows, fields: str, *keys: str) -> Dictionary:
            return Dictionary.of(spark, rows, fields, keys, max_rows)

        return Dictionaries(
            checked(data.lab_tests, schemas.LAB_TEST_FIELDS, "name"),
            checked(data.condition_labels, schemas.CODE_LABEL_FIELDS, "code"),
            checked(data.drug_families, schemas.DRUG_FAMILY_FIELDS, "drug"),
            checked(data.allergy_families, schemas.ALLERGY_FAMILY_FIELDS, "allergy"),
            checked(data.unit_rules, schemas.UNIT_RULE_FIELDS, "test", "from_unit"),
        )


@dataclass(frozen=True)
class Sources:
    """The inputs of :func:`integrate`, as read."""

    ehr_patients: DataFrame
    labs: DataFrame
    clinical_patients: DataFrame
    conditions: DataFrame
    allergies: DataFrame
    prescriptions: DataFrame
    imaging: DataFrame


def pseudonymize(df: DataFrame, column: str = "patient_id", keep: int = 16) -> DataFrame:
    """Add ``<column>_pseudo``; the raw id stays."""
    return df.withColumn(f"{column}_pseudo", pseudonym(F.col(column), keep))


def unify_entities(ehr: DataFrame, clinical: DataFrame, **skew) -> DataFrame:
    """EHR patients with ``gender_unified``: the clinical gender where there is one.

    Every EHR row is kept; people known only to the clinical source are not
    added. A patient listed twice in the clinical source gives two rows.
    """
    joined = skew_join(ehr, clinical.select("patient_id", "gender_fhir"), "patient_id", "left", **skew)
    unified = joined.withColumn("gender_unified", F.coalesce("gender_fhir", "gender"))
    return unified.drop("gender_fhir").select(*ehr.columns, "gender_unified")


def missing_entities(df: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` in ``df`` that ``known`` does not list.

    Both sides shrink to distinct values within each task before they shuffle.
    """
    return (
        df.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .join(known.select(column).distinct(), column, "left_anti")
    )


def integrate_labs(labs: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """Pseudonym, common units, reference range and abnormal flag for each result."""
    harmonized = harmonize_units(pseudonymize(labs), dictionaries.unit_rules)
    return flag_range(harmonized, dictionaries.lab_tests)


def integrate_patients(ehr: DataFrame, clinical: DataFrame) -> DataFrame:
    return unify_entities(pseudonymize(ehr), clinical)


def integrate_conditions(conditions: DataFrame, dictionaries: Dictionaries) -> DataFrame:
    """Pseudonym and label of each condition."""
    return translate(
        pseudonymize(conditions),
        "icd10_code",
        dictionaries.condition_labels,
        "label",
        "icd10_label",
        schemas.UNKNOWN_CONDITION,
    )


def integrate_prescriptions(
    prescriptions: DataFrame, dictionaries: Dictionaries, drugs: DataFrame | None = None
) -> DataFrame:
    """Pseudonym and drug family of each prescription; hot keys are looked for in ``drugs`` if given."""
    return translate(
        pseudonymize(prescriptions),
        "drug",
        dictionaries.drug_families,
        "family",
        "drug_family",
        schemas.UNKNOWN_FAMILY,
        drugs,
    )


def in_table_order(name: str, df: DataFrame) -> DataFrame:
    """The columns of an integrated table, in its order."""
    return df.select(*schemas.INTEGRATED_TABLES[name].names)


def integrate(sources: Sources, dictionaries: Dictionaries) -> dict[str, DataFrame]:
    """The six integrated tables, each one lazy plan."""
    tables = {
        "patients": integrate_patients(sources.ehr_patients, sources.clinical_patients),
        "lab_results": integrate_labs(sources.labs, dictionaries),
        "conditions": integrate_conditions(sources.conditions, dictionaries),
        "allergies": pseudonymize(sources.allergies),
        "prescriptions": integrate_prescriptions(sources.prescriptions, dictionaries),
        "dicom_images": sources.imaging,
    }
    return {name: in_table_order(name, df) for name, df in tables.items()}
