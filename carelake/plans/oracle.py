"""The registered queries as SQL over the given tables, for checking."""

from __future__ import annotations

from carelake.functions.terms import Namespaces
from carelake.operators import vocabulary as v

NAMES = Namespaces()
RES = NAMES.resource


def pseudo(value: str) -> str:
    return f"substr(sha256(cast({value} as varchar)), 1, 16)"


def node_key(*parts: str) -> str:
    framed = " || ".join(f"coalesce(length(cast({p} as varchar)) || ':' || cast({p} as varchar), '-')" for p in parts)
    return f"substr(sha256({framed}), 1, 32)"


def full(term: str) -> str:
    return f"'{RES}' || substr({term}, 5)"


# ---------------------------------------------------------------- bound tables

K = r"cast(regexp_extract(props, '[0-9]+') as int)"
RAW_LABS = f"""
select cast(event_id as varchar) lab_id, cast(user_id as varchar) patient_id,
  'c-' || event_type test_code_loinc, event_type test_name, value,
  case when event_type = 'click' and {K} % 4 = 0 then 'µmol/L' else 'mg/dL' end unit,
  strftime(ts, '%Y-%m-%d') "date",
  case when {K} % 3 = 0 then 'preliminary' else 'final' end status,
  case when {K} % 2 = 0 then 'Lab_A' else 'Lab_B' end source_system
from events"""
RANGES = "(values ('click', 1.0, 140.0), ('view', 5.0, 100.0), ('error', 0.5, 15.0)) r(name, low, high)"
LABS = f"""
select h.*, {pseudo('patient_id')} patient_id_pseudo,
  cast(low as double) ref_low, cast(high as double) ref_high,
  coalesce(value < low or value > high, false) is_abnormal
from (select lab_id, patient_id, test_code_loinc, test_name,
        case when unit = 'µmol/L' then round(value / 88.4, 3) else value end as value,
        'mg/dL' unit, "date", status, source_system
      from ({RAW_LABS})) h
left join {RANGES} on test_name = name"""
CLINICAL = """
select cast(user_id as varchar) patient_id, max(event_type) gender_fhir
from events where user_id is not null group by 1"""
PATIENTS = f"""
select cast(c_custkey as varchar) patient_id, c_name first_name, cast(null as varchar) last_name,
  c_mktsegment gender, cast(null as varchar) "birthDate", cast(c_nationkey as varchar) country,
  {pseudo('c_custkey')} patient_id_pseudo, coalesce(gender_fhir, c_mktsegment) gender_unified
from customer left join ({CLINICAL}) c on c.patient_id = cast(c_custkey as varchar)"""
LABELS = "(values ('1', 'Urgent'), ('2', 'High'), ('3', 'Medium')) d(code, label)"
CONDITIONS = f"""
select cast(o_custkey as varchar) patient_id, substr(o_orderpriority, 1, 1) icd10_code,
  {pseudo('o_custkey')} patient_id_pseudo, coalesce(label, 'Unknown ICD-10') icd10_label
from orders left join {LABELS} on code = substr(o_orderpriority, 1, 1)"""
ALLERGIES = f"""
select cast(c_custkey as varchar) patient_id, c_mktsegment allergy,
  {pseudo('c_custkey')} patient_id_pseudo from customer"""
RULED_OUT = "(values ('AUTOMOBILE', 'ECONOMY'), ('BUILDING', 'PROMO')) m(allergy, family)"
PRESCRIPTIONS = f"""
select cast(o_custkey as varchar) patient_id, cast(l_partkey as varchar) drug,
  strftime(l_shipdate, '%Y-%m-%d') "date", {pseudo('o_custkey')} patient_id_pseudo,
  coalesce(p_type, 'UnknownFamily') drug_family
from lineitem join orders on l_orderkey = o_orderkey left join part on p_partkey = l_partkey"""
INSTANCE = "concat_ws('.', l_orderkey, l_linenumber, l_returnflag)"
IMAGES = f"""
select {INSTANCE} dicom_id, cast(o_custkey as varchar) patient_id,
  {pseudo('o_custkey')} patient_id_pseudo, cast(l_orderkey as varchar) study_uid,
  concat_ws('.', l_orderkey, l_returnflag) series_uid, l_returnflag modality,
  strftime(o_orderdate, '%Y%m%d') study_date, 'img/' || {INSTANCE} || '.dcm' file_path,
  64 "rows", cast(l_linenumber * 16 as int) cols
from lineitem join orders on l_orderkey = o_orderkey"""
TABLES = {
    "patients": PATIENTS,
    "lab_results": LABS,
    "conditions": CONDITIONS,
    "allergies": ALLERGIES,
    "prescriptions": PRESCRIPTIONS,
    "dicom_images": IMAGES,
}


# ------------------------------------------------------------- expected triples


def triples(source: str, *rows: tuple) -> str:
    """Distinct triples; each row is (subject, predicate, object, kind, data type)."""
    selects = []
    for s, p, o, *rest in rows:
        kind = rest[0] if rest else "iri"
        dtype = f"'{rest[1]}'" if len(rest) > 1 else "cast(null as varchar)"
        selects.append(
            f"select {s} s, '{p}' p, cast({o} as varchar) o, '{kind}' o_kind, {dtype} o_dtype "
            f"from src where ({o}) is not null"
        )
    return f"with src as ({source}) " + " union ".join(selects)


PATIENT = "'res:patient/' || patient_id_pseudo"
STUDY, DICOM = "'res:imagingstudy/' || study_uid", "'res:dicom/' || dicom_id"
CONDITION = "'res:condition/' || " + node_key("patient_id", "icd10_code")
ALLERGY = "'res:allergy/' || " + node_key("patient_id", "allergy")
DRUG = "'res:drug/' || drug"
RX = "'res:prescription/' || " + node_key("patient_id", "drug", '"date"')
LAB, LOINC = "'res:lab/' || lab_id", "'res:loinc/' || test_code_loinc"

MAPPED = {
    "patients": triples(
        PATIENTS,
        (PATIENT, "rdf:type", "'ont:Patient'"),
        (PATIENT, "ont:label", "first_name", "literal"),
    ),
    "dicom_images": triples(
        IMAGES,
        (PATIENT, "rdf:type", "'ont:Patient'"),
        (STUDY, "rdf:type", "'ont:ImagingStudy'"),
        (STUDY, "ont:studyUID", "study_uid", "literal"),
        (
            STUDY,
            "ont:date",
            "substr(study_date,1,4)||'-'||substr(study_date,5,2)||'-'||substr(study_date,7,2)",
            "literal",
            "xsd:date",
        ),
        (PATIENT, "ont:hasImagingStudy", STUDY),
        (DICOM, "rdf:type", "'ont:DicomInstance'"),
        (DICOM, "ont:hasPatient", PATIENT),
        (DICOM, "ont:seriesUID", "series_uid", "literal"),
        (DICOM, "ont:sopUID", "dicom_id", "literal"),
        (DICOM, "ont:modality", "modality", "literal"),
        (DICOM, "ont:filePath", "file_path", "literal"),
        (STUDY, "ont:hasDicomInstance", DICOM),
    ),
    "conditions": triples(
        CONDITIONS,
        (CONDITION, "rdf:type", "'ont:Condition'"),
        (CONDITION, "ont:icd10Code", "icd10_code", "literal"),
        (CONDITION, "ont:label", "icd10_label", "literal"),
        (PATIENT, "ont:hasCondition", CONDITION),
    ),
    "allergies": triples(
        f"select a.*, family from ({ALLERGIES}) a left join {RULED_OUT} on m.allergy = a.allergy",
        (ALLERGY, "rdf:type", "'ont:Allergy'"),
        (ALLERGY, "ont:label", "allergy", "literal"),
        (PATIENT, "ont:hasAllergy", ALLERGY),
        (ALLERGY, "ont:affectsFamily", "'res:drugfamily/' || family"),
    ),
    "prescriptions": triples(
        PRESCRIPTIONS,
        (DRUG, "rdf:type", "'ont:Drug'"),
        (DRUG, "ont:label", "drug", "literal"),
        (DRUG, "ont:belongsToFamily", "'res:drugfamily/' || drug_family"),
        (RX, "rdf:type", "'ont:Prescription'"),
        (RX, "ont:drug", DRUG),
        (RX, "ont:date", '"date"', "literal", "xsd:date"),
        (PATIENT, "ont:hasPrescription", RX),
    ),
    "lab_results": triples(
        LABS,
        (LAB, "rdf:type", "'ont:LabResult'"),
        (LAB, "ont:hasPatient", PATIENT),
        (LAB, "ont:value", "value", "literal", "xsd:float"),
        (LAB, "ont:unit", "unit", "literal"),
        (LAB, "ont:date", '"date"', "literal", "xsd:date"),
        (LAB, "ont:loincCode", "test_code_loinc", "literal"),
        (LAB, "ont:label", "test_name", "literal"),
        (LOINC, "rdf:type", "'ont:Test'"),
        (LAB, "ont:hasTest", LOINC),
    ),
}
CODED = """
select 'loinc' scheme, code, name as label
from (values ('c-click', 'click'), ('c-view', 'view'), ('c-error', 'error')) t(code, name)
union all select 'icd10', code, label from (values ('1', 'Urgent'), ('2', 'High'), ('3', 'Medium')) d(code, label)"""
CODE_NODE, FAMILY_NODE = "'res:' || scheme || '/' || code", "'res:drugfamily/' || family"
FAMILIES = "select distinct p_type family from part where p_type is not null"
ROOT = "'res:drugfamily/Medicines'"
CONCEPTS = " union ".join(
    f"(select * from ({part}))"
    for part in (
        triples(
            CODED,
            (CODE_NODE, "rdf:type", "'skos:Concept'"),
            (CODE_NODE, "skos:inScheme", "'res:scheme/' || scheme"),
            (CODE_NODE, "skos:notation", "code", "literal"),
            (CODE_NODE, "skos:prefLabel", "label", "literal"),
        ),
        triples(
            "select 1 x",
            (ROOT, "rdf:type", "'skos:Concept'"),
            (ROOT, "skos:prefLabel", "'Medicines'", "literal"),
        ),
        triples(
            FAMILIES,
            (FAMILY_NODE, "rdf:type", "'skos:Concept'"),
            (FAMILY_NODE, "skos:prefLabel", "family", "literal"),
            (FAMILY_NODE, "skos:broader", ROOT),
            (ROOT, "skos:narrower", FAMILY_NODE),
        ),
    )
)
DECLARED = (
    [(f"ont:{c}", "owl:Class") for c in v.CLASSES]
    + [(f"ont:{p}", "owl:ObjectProperty") for p in v.OBJECT_PROPERTIES]
    + [(f"ont:{p}", "owl:DatatypeProperty") for p in v.DATATYPE_PROPERTIES]
)


def _static() -> str:
    iris = [("ont:", "owl:Ontology"), *DECLARED]
    iris += [(f"res:scheme/{s}", "skos:ConceptScheme") for s in v.SCHEME_LABELS]
    rows = [f"('{s}', 'rdf:type', '{o}', 'iri', null)" for s, o in iris]
    rows.append(f"('ont:', 'rdfs:label', '{v.DEFAULT_TITLE}', 'literal', null)")
    rows += [
        f"('res:scheme/{s}', 'skos:prefLabel', '{label}', 'literal', null)"
        for s, label in v.SCHEME_LABELS.items()
    ]
    return f"select * from (values {', '.join(rows)}) st(s, p, o, o_kind, o_dtype)"


STATIC = _static()
GRAPH = " union ".join(f"(select * from ({part}))" for part in [STATIC, CONCEPTS, *MAPPED.values()])


def triple_rows(source: str) -> str:
    return f"select s, p, o, o_kind, o_dtype, cast(null as varchar) as o_lang from ({source}) g"


# --------------------------------------------------------------------- answers

B52, M18 = 2**52, 10**18


def _uid(seed: str) -> str:
    digest = f"'0' || sha256({seed})"
    number = "cast(0 as hugeint)"
    for i in range(5):
        chunk = f"cast('0x' || substr({digest}, {1 + 13 * i}, 13) as hugeint)"
        number = f"(({number} * {B52} + {chunk}) % {M18})"
    return f"'1.2.826.0.1.3680043.10.543.' || cast({number} as varchar)"


LAB_COLUMNS = [
    "lab_id",
    "patient_id",
    "test_code_loinc",
    "test_name",
    "value",
    "unit",
    "date",
    "status",
    "source_system",
    "patient_id_pseudo",
    "ref_low",
    "ref_high",
    "is_abnormal",
]


def _nulls(column: str) -> str:
    return f"count(*) - count(\"{column}\")"


FILLED = " + ".join(f'count("{c}")' for c in LAB_COLUMNS)
COMPLETENESS = f"round(({FILLED}) * 100.0 / (count(*) * {len(LAB_COLUMNS)}), 6)"
RATE = "round(avg(cast(is_abnormal as int)) * 100, 6)"


def _described(zone: str, name: str, place: str, columns: list[str], source: str) -> str:
    filled = " + ".join(f'count("{c}")' for c in columns)
    return (
        f"select '{zone}/{name}' as dataset, '{zone}' as zone, 'parquet' as format, '{place}' as place, "
        f"true as has_bytes, true as has_time, count(*) as records, "
        f"round(({filled}) * 100.0 / (count(*) * {len(columns)}), 6) as completeness from ({source})"
    )


TABLE_COLUMNS = {
    "patients": ["patient_id", "first_name", "last_name", "gender", "birthDate", "country", "patient_id_pseudo", "gender_unified"],
    "lab_results": LAB_COLUMNS,
    "conditions": ["patient_id", "icd10_code", "patient_id_pseudo", "icd10_label"],
    "allergies": ["patient_id", "allergy", "patient_id_pseudo"],
    "prescriptions": ["patient_id", "drug", "date", "patient_id_pseudo", "drug_family"],
    "dicom_images": ["dicom_id", "patient_id", "patient_id_pseudo", "study_uid", "series_uid", "modality", "study_date", "file_path", "rows", "cols"],
}


GIVEN_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
}
# Silver patients have no unified gender yet, silver results have tags.
SILVER_COLUMNS = {
    "patients": [c for c in TABLE_COLUMNS["patients"] if c != "gender_unified"],
    "clinical_patients": ["patient_id", "gender_fhir"],
    "lab_results": [*LAB_COLUMNS, "tags"],
}
SILVER = TABLES | {"clinical_patients": CLINICAL, "lab_results": f"select l.*, 1 as tags from ({LABS}) l"}


def _gold(name: str) -> str:
    doubles = {"value", "ref_low", "ref_high"}
    columns = [
        f'cast("{c}" as decimal(18,6))' if c in doubles else f'"{c}"' for c in TABLE_COLUMNS[name]
    ]
    text = ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in columns)
    return f"select '{name}' as \"table\", concat_ws('|', {text}) as \"row\" from ({TABLES[name]})"


def _lineage() -> str:
    edges = [
        ("gold/patients", "silver/patients", "unify"),
        ("gold/patients", "silver/clinical_patients", "unify"),
        *[(f"gold/{t}", f"silver/{t}", "curate") for t in TABLES if t != "patients"],
        ("silver/patients", "bronze/customer", "pseudonymize"),
        ("silver/clinical_patients", "bronze/events", "route"),
        ("silver/lab_results", "bronze/events", "harmonize"),
        ("silver/conditions", "bronze/orders", "route"),
        ("silver/allergies", "bronze/customer", "route"),
        ("silver/prescriptions", "bronze/lineitem", "route"),
        ("silver/prescriptions", "bronze/orders", "route"),
        ("silver/prescriptions", "bronze/part", "route"),
        ("silver/dicom_images", "bronze/lineitem", "read_headers"),
        ("silver/dicom_images", "bronze/orders", "read_headers"),
    ]
    rows = TABLES | {"clinical_patients": CLINICAL}
    return " union all ".join(
        f"select '{RES}dataset/{d}' as derived, '{RES}dataset/{s}' as source, "
        f"'{RES}step/{step}' as step, count(*) as records from ({rows[d.split('/')[1]]})"
        for d, s, step in edges
    )


# Conditions that no row may meet, per table.
DENIED = {
    "lab_results": {
        "other_unit": "unit <> expected_unit",
        "undated": '"date" is null',
        "empty_range": "ref_low > ref_high",
        "flag_without_range": "is_abnormal and ref_low is null",
    },
    "prescriptions": {"undated": '"date" is null'},
    "patients": {"unnamed": "first_name is null and last_name is null"},
}


def _contradictions(zone: str) -> list[str]:
    parts = []
    for name, source in TABLES.items():
        if name == "lab_results":
            source = f"""select l.*, u.unit as expected_unit from ({source}) l
              left join (values ('click', 'mg/dL'), ('view', 'mg/dL'), ('error', 'mg/dL')) u(name, unit) on u.name = l.test_name"""
        head = f"select '{zone}/{name}' as dataset"
        denied = DENIED.get(name, {})
        clean = " and ".join(f"not coalesce({c}, false)" for c in denied.values()) or "true"
        if denied or name != "patients":
            parts.append(
                f"""{head}, 'consistent_pct' as metric, cast(null as varchar) as "column",
                  round(count(*) filter (where {clean}) * 100.0 / nullif(count(*), 0), 6) as "value" from ({source})"""
            )
        parts += [
            f"{head}, 'violations' as metric, '{rule}' as \"column\", cast(count(*) filter (where {c}) as double) as \"value\" from ({source})"
            for rule, c in denied.items()
        ]
        if name != "patients":
            lost = f"from ({source}) where patient_id is not null and patient_id not in (select patient_id from ({PATIENTS}) where patient_id is not null)"
            parts.append(f"{head}, 'orphan_rows' as metric, 'patient' as \"column\", cast(count(*) as double) as \"value\" {lost}")
            parts.append(f"{head}, 'orphan_keys' as metric, 'patient' as \"column\", cast(count(distinct patient_id) as double) as \"value\" {lost}")
    return parts


def _missing(names: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(f"case when {n} is null then '{n}' end" for n in names) + ")"


TAGS = """concat_ws(',', case when is_abnormal then 'abnormal' end,
  case when ref_low is null then 'no_reference_range' end,
  case when status = 'preliminary' then 'preliminary' end,
  case when value is null then 'missing_value' end)"""
TYPED_PATIENTS = "(select c_custkey as k from customer union select o_custkey from orders join lineitem on l_orderkey = o_orderkey)"
ABNORMAL = f"(select distinct * from ({LABS}) where test_name = 'click' and value > 140)"
STUDIES = f"(select distinct patient_id_pseudo, study_uid from ({IMAGES}))"
INSTANCES = f"(select distinct patient_id_pseudo, dicom_id, modality from ({IMAGES}))"

RESOURCES = f"""
select '{{"resourceType":"Patient","id":"' || patient_id || '","gender":"' || gender_unified || '"}}' as resource from ({PATIENTS})
union all
select '{{"resourceType":"Condition","subject":{{"reference":"Patient/' || patient_id
  || '"}},"code":{{"coding":[{{"system":"ICD-10","code":"' || icd10_code || '"}}]}}}}' from ({CONDITIONS})
union all
select '{{"resourceType":"Observation","id":"' || lab_id || '","status":"' || status
  || '","subject":{{"reference":"Patient/' || patient_id
  || '"}},"code":{{"coding":[{{"system":"LOINC","code":"' || test_code_loinc || '"}}],"text":"' || test_name
  || '"}},"valueQuantity":{{"value":' || cast(value as varchar) || ',"unit":"' || unit
  || '"}},"effectiveDateTime":"' || "date" || '"}}' from ({LABS})
union all
select '{{"resourceType":"AllergyIntolerance","patient":{{"reference":"Patient/' || patient_id
  || '"}},"code":{{"text":"' || allergy || '"}}}}' from ({ALLERGIES})
union all
select '{{"resourceType":"MedicationRequest","subject":{{"reference":"Patient/' || patient_id
  || '"}},"medicationCodeableConcept":{{"text":"' || drug || '"}},"authoredOn":"' || "date" || '"}}' from ({PRESCRIPTIONS})"""
ROUTED = f"""
select 'patient' as kind, patient_id, gender_unified as value, cast(null as varchar) as "date" from ({PATIENTS})
union all select 'condition', patient_id, icd10_code, null from ({CONDITIONS})
union all select 'allergy', patient_id, allergy, null from ({ALLERGIES})
union all select 'prescription', patient_id, drug, "date" from ({PRESCRIPTIONS})"""
STAR = f"""
select distinct {LAB} as lab, {PATIENT} as patient, test_name as test,
  value as val, "date" from ({LABS})"""
IMAGE_OK = "c_acctbal >= 0"


def _if_ok(value: str, kind: str = "varchar") -> str:
    return f"case when {IMAGE_OK} then {value} else cast(null as {kind}) end"


SCANNED = f"""
select {_if_ok(_uid("'sop-' || c_custkey"))} as dicom_id, {_if_ok('cast(c_custkey as varchar)')} as patient_id,
  {_if_ok(pseudo('c_custkey'))} as patient_id_pseudo, {_if_ok(_uid("'study-' || c_custkey"))} as study_uid,
  {_if_ok(_uid("'series-' || c_custkey"))} as series_uid, {_if_ok('substr(c_mktsegment, 1, 2)')} as modality,
  {_if_ok("'20240131'")} as study_date, c_custkey || '.dcm' as file_path,
  {_if_ok('cast(c_nationkey + 1 as int)', 'int')} as "rows", {_if_ok('64', 'int')} as cols,
  case when {IMAGE_OK} then null else 'no DICM marker' end as error
from customer"""

ORACLE = {
    "pseudonymize": f"select patient_id, patient_id_pseudo from ({PATIENTS})",
    "surrogate_uid": f"select seed, {_uid('seed')} as uid from (select 'study-' || o_orderkey || '-' || o_custkey as seed from orders)",
    "harmonize_units": f"select lab_id, test_name, value, unit from ({LABS})",
    "flag_range": f"select lab_id, value, ref_low, ref_high, is_abnormal from ({LABS})",
    "normalize_dates": """
        select o_orderkey, case o_orderstatus when 'F' then strftime(o_orderdate, '%Y%m%d')
            when 'O' then strftime(o_orderdate, '%Y-%m-%d') else strftime(o_orderdate, '%d/%m/%Y') end as raw,
          cast(o_orderdate as date) as "date",
          case when o_orderstatus in ('F', 'O') then strftime(o_orderdate, '%Y-%m-%d')
            else strftime(o_orderdate, '%d/%m/%Y') end as text
        from orders""",
    "repair_values": f"""
        select lab_id, value, case when status = 'preliminary' then 'unknown' else status end as status,
          coalesce(ref_low, 0.0) as ref_low, ref_high
        from ({LABS}) where value is not null and not coalesce(value > 2 * ref_high, false)""",
    "required_fields": f"""
        select p.patient_id, case when gender_fhir is null then 'gender_fhir' end as missing_fields,
          gender_fhir is not null as complete
        from ({PATIENTS}) p left join ({CLINICAL}) c on c.patient_id = p.patient_id""",
    "map_terms": f"select patient_id, icd10_code, icd10_label from ({CONDITIONS})",
    "map_family": f'select patient_id, drug, "date", drug_family from ({PRESCRIPTIONS})',
    "unify_entities": PATIENTS,
    "integrate_labs": LABS,
    "missing_entities": f"select distinct patient_id from ({IMAGES}) where patient_id not in (select patient_id from ({CLINICAL}))",
    "overview_counts": " union all ".join(
        f"select '{t}' as \"table\", count(*) as \"rows\" from ({TABLES[t]})"
        for t in ["patients", "lab_results", "prescriptions", "allergies", "dicom_images"]
    ),
    "value_counts": 'select test_name as "value", count(*) as "count" from (%s) where test_name is not null group by 1' % RAW_LABS,
    "distinct_entities": f"select count(distinct patient_id_pseudo) as distinct_entities from ({IMAGES})",
    "completeness": f"select {COMPLETENESS} as completeness_pct from ({LABS})",
    "missing_report": " union all ".join(
        f"select '{c}' as \"column\", {_nulls(c)} as n_missing from ({LABS}) having {_nulls(c)} > 0"
        for c in LAB_COLUMNS
    ),
    "abnormal_rate": f"select {RATE} as abnormal_rate_pct from ({LABS})",
    "quality_profile": " union all ".join(
        [
            f"select 'lab_results' as dataset, '{metric}' as metric, {column} as \"column\", cast({value} as double) as \"value\" from ({LABS})"
            for metric, column, value in [
                ("records", "cast(null as varchar)", "count(*)"),
                ("completeness_pct", "cast(null as varchar)", COMPLETENESS),
                ("abnormal_rate_pct", "cast(null as varchar)", RATE),
                *[("missing", f"'{c}'", _nulls(c)) for c in LAB_COLUMNS],
            ]
        ]
        + _contradictions("silver")
        + _contradictions("gold")
    ),
    "vocab_static": f"""
        select d.term, d.kind, coalesce(n, 0) as uses
        from (values {', '.join(f"('{t}', '{k}')" for t, k in DECLARED)}) d(term, kind)
        left join (select case when p = 'rdf:type' then o else p end as term, count(*) as n
                   from ({GRAPH}) g group by 1) u on u.term = d.term""",
    "vocab_concepts": triple_rows(CONCEPTS),
    "map_patients": triple_rows(MAPPED["patients"]),
    "map_imaging": triple_rows(MAPPED["dicom_images"]),
    "map_conditions": triple_rows(MAPPED["conditions"]),
    "map_allergies": triple_rows(MAPPED["allergies"]),
    "map_prescriptions": triple_rows(MAPPED["prescriptions"]),
    "map_labs": triple_rows(MAPPED["lab_results"]),
    "graph_size": f"select count(*) as triples from ({GRAPH}) g",
    "bgp_single": f"select distinct {LAB} as lab from ({LABS}) where test_name = 'click'",
    "bgp_star": STAR,
    "bgp_path": f"select distinct {PATIENT} as patient, {STUDY} as study, {DICOM} as inst, modality from ({IMAGES})",
    "sql_over_triples": STAR,
    "q_count_entities": f'select count(*) as "count" from {TYPED_PATIENTS}',
    "q_count_by_group": f'select modality, count(*) as "count" from {INSTANCES} group by 1',
    "q_abnormal_topk": f"""
        select {full(PATIENT)} as patient, value as val, "date" from {ABNORMAL}
        order by value desc, {LAB} limit 10""",
    "q_imaging_lab": f"""
        select distinct {full("'res:patient/' || s.patient_id_pseudo")} as patient, value as val, {full(STUDY)} as study
        from {STUDIES} s join {ABNORMAL} l on l.patient_id_pseudo = s.patient_id_pseudo""",
    "q_imaging_lab_bag": f"""
        select {full("'res:patient/' || i.patient_id_pseudo")} as patient, modality, value as val, "date"
        from {INSTANCES} i join {ABNORMAL} l on l.patient_id_pseudo = i.patient_id_pseudo""",
    "q_contraindication": f"""
        select {full("'res:patient/' || a.patient_id_pseudo")} as patient, a.allergy as "allergyLabel",
          x.drug as "drugLabel", {full("'res:drugfamily/' || m.family")} as family
        from (select distinct * from ({ALLERGIES})) a join {RULED_OUT} on m.allergy = a.allergy
        join (select distinct * from ({PRESCRIPTIONS})) x
          on x.patient_id_pseudo = a.patient_id_pseudo and x.drug_family = m.family""",
    "scan_csv": f'select patient_id, first_name, last_name, gender, "birthDate", country, patient_id_pseudo from ({PATIENTS})',
    "scan_json_array": RAW_LABS,
    "route_resources": ROUTED,
    "to_resources": RESOURCES,
    "table_roundtrip": LABS,
    "ntriples_roundtrip": triple_rows(GRAPH),
    "scan_imaging": SCANNED,
    "imaging_headers": f"select {', '.join(f'\"{c}\"' for c in TABLE_COLUMNS['dicom_images'])} from ({IMAGES})",
    "zones_silver": f"""
        select lab_id, source_system, cast("date" as date) as "date", value, unit, {TAGS} as tags from ({LABS})""",
    "zones_gold": " union all ".join(_gold(name) for name in TABLES),
    "catalog_datasets": " union all ".join(
        [_described("bronze", t, f"{t}.parquet", columns, t) for t, columns in GIVEN_COLUMNS.items()]
        + [_described("silver", t, t, SILVER_COLUMNS.get(t, TABLE_COLUMNS.get(t)), source) for t, source in SILVER.items()]
        + [_described("gold", t, t, TABLE_COLUMNS[t], source) for t, source in TABLES.items()]
    ),
    "lineage": _lineage(),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
