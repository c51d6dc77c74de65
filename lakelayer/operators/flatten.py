"""Flatten nested clinical resources (FHIR R4 subset) into typed columns.

Each flattener is one ``select`` over the ``resource`` struct, so it runs inside
whole-stage codegen; missing parts give NULL, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.functions.nested import first_elem, join_words, last_match, or_else, strip_ref

# ── schemas (only the fields that are read) ───────────────────────────────────
CODING = T.StructType([T.StructField("code", T.StringType()), T.StructField("display", T.StringType())])
CONCEPT = T.StructType([T.StructField("coding", T.ArrayType(CODING))])
REFERENCE = T.StructType([T.StructField("reference", T.StringType())])
QUANTITY = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType())])
START = T.StructType([T.StructField("start", T.StringType())])


def _f(name, dt):
    return T.StructField(name, dt)


RESOURCE = T.StructType([
    _f("resourceType", T.StringType()), _f("id", T.StringType()),
    _f("meta", T.StructType([_f("lastUpdated", T.StringType())])),
    _f("status", T.StringType()), _f("subject", REFERENCE), _f("encounter", REFERENCE),
    _f("category", T.ArrayType(CONCEPT)), _f("code", CONCEPT),
    # Patient
    _f("name", T.ArrayType(T.StructType([_f("family", T.StringType()),
                                         _f("given", T.ArrayType(T.StringType()))]))),
    _f("gender", T.StringType()), _f("birthDate", T.StringType()),
    _f("address", T.ArrayType(T.StructType([_f("city", T.StringType()), _f("state", T.StringType()),
                                            _f("country", T.StringType()), _f("postalCode", T.StringType())]))),
    _f("telecom", T.ArrayType(T.StructType([_f("system", T.StringType()), _f("value", T.StringType())]))),
    _f("communication", T.ArrayType(T.StructType([_f("language", CONCEPT)]))),
    _f("active", T.BooleanType()),
    # Encounter
    _f("class", CODING), _f("type", T.ArrayType(CONCEPT)),
    _f("period", T.StructType([_f("start", T.StringType()), _f("end", T.StringType())])),
    _f("reasonCode", T.ArrayType(CONCEPT)),
    _f("serviceProvider", T.StructType([_f("display", T.StringType())])),
    # Observation
    _f("effectiveDateTime", T.StringType()), _f("effectivePeriod", START), _f("issued", T.StringType()),
    _f("valueQuantity", QUANTITY), _f("valueString", T.StringType()), _f("valueCodeableConcept", CONCEPT),
    _f("component", T.ArrayType(T.StructType([_f("code", CONCEPT), _f("valueQuantity", QUANTITY)]))),
    # Condition
    _f("clinicalStatus", CONCEPT), _f("verificationStatus", CONCEPT), _f("severity", CONCEPT),
    _f("onsetDateTime", T.StringType()), _f("onsetPeriod", START),
    _f("abatementDateTime", T.StringType()), _f("recordedDate", T.StringType()),
])

BUNDLE = T.StructType([
    _f("resourceType", T.StringType()),
    _f("total", T.LongType()),
    _f("link", T.ArrayType(T.StructType([_f("relation", T.StringType()), _f("url", T.StringType())]))),
    _f("entry", T.ArrayType(T.StructType([_f("resource", RESOURCE)]))),
])

# Fields each resource type reads (the rest of RESOURCE is never touched for it).
_COMMON = ("resourceType", "id", "meta")
READS = {
    "Patient": _COMMON + ("name", "gender", "birthDate", "address", "telecom", "communication", "active"),
    "Encounter": _COMMON + ("status", "class", "type", "subject", "period", "reasonCode", "serviceProvider"),
    "Observation": _COMMON + ("status", "category", "code", "subject", "encounter", "effectiveDateTime",
                              "effectivePeriod", "issued", "valueQuantity", "valueString",
                              "valueCodeableConcept", "component"),
    "Condition": _COMMON + ("clinicalStatus", "verificationStatus", "category", "code", "subject", "encounter",
                            "onsetDateTime", "onsetPeriod", "abatementDateTime", "recordedDate", "severity"),
}


def bundle_schema(resource: str | None = None) -> T.StructType:
    """Bundle schema; with a resource type, its entries carry only the fields that type reads."""
    if resource is None:
        return BUNDLE
    res = T.StructType([f for f in RESOURCE.fields if f.name in READS[resource]])
    return T.StructType([f if f.name != "entry" else
                         _f("entry", T.ArrayType(T.StructType([_f("resource", res)]))) for f in BUNDLE.fields])


# Resource names and their id columns.
RESOURCES = ("Patient", "Encounter", "Observation", "Condition")
ID_COLUMN = {"Patient": "patient_id", "Encounter": "encounter_id",
             "Observation": "observation_id", "Condition": "condition_id"}


def _code(concept: Column, field: str = "code") -> Column:
    return first_elem(concept["coding"])[field]


def _first_code(concepts: Column, field: str = "code") -> Column:
    return first_elem(first_elem(concepts)["coding"])[field]


def patient_columns(r: Column) -> list[Column]:
    name, addr = first_elem(r["name"]), first_elem(r["address"])
    return [
        r["id"].alias("patient_id"),
        name["family"].alias("family_name"),
        join_words(name["given"]).alias("given_name"),
        r["gender"].alias("gender"),
        r["birthDate"].alias("birth_date"),
        addr["city"].alias("city"), addr["state"].alias("state"),
        addr["country"].alias("country"), addr["postalCode"].alias("postal_code"),
        last_match(r["telecom"], "system", "phone")["value"].alias("phone"),
        last_match(r["telecom"], "system", "email")["value"].alias("email"),
        _code(first_elem(r["communication"])["language"]).alias("language"),
        r["active"].alias("active"),
        r["meta"]["lastUpdated"].alias("last_updated"),
    ]


def encounter_columns(r: Column) -> list[Column]:
    return [
        r["id"].alias("encounter_id"),
        r["status"].alias("status"),
        r["class"]["code"].alias("class_code"),
        r["class"]["display"].alias("class_display"),
        _first_code(r["type"]).alias("type_code"),
        _first_code(r["type"], "display").alias("type_display"),
        strip_ref(r["subject"]["reference"], "Patient/").alias("patient_id"),
        r["period"]["start"].alias("period_start"),
        r["period"]["end"].alias("period_end"),
        _first_code(r["reasonCode"]).alias("reason_code"),
        _first_code(r["reasonCode"], "display").alias("reason_display"),
        r["serviceProvider"]["display"].alias("service_provider"),
        r["meta"]["lastUpdated"].alias("last_updated"),
    ]


def observation_columns(r: Column) -> list[Column]:
    comp = first_elem(r["component"])
    return [
        r["id"].alias("observation_id"),
        r["status"].alias("status"),
        _first_code(r["category"]).alias("category"),
        _code(r["code"]).alias("code"),
        _code(r["code"], "display").alias("code_display"),
        strip_ref(r["subject"]["reference"], "Patient/").alias("patient_id"),
        strip_ref(r["encounter"]["reference"], "Encounter/").alias("encounter_id"),
        or_else(r["effectiveDateTime"], r["effectivePeriod"]["start"]).alias("effective_datetime"),
        r["issued"].alias("issued"),
        r["valueQuantity"]["value"].alias("value_quantity"),
        r["valueQuantity"]["unit"].alias("value_unit"),
        r["valueString"].alias("value_string"),
        _code(r["valueCodeableConcept"]).alias("value_code"),
        _code(comp["code"]).alias("component_code"),
        comp["valueQuantity"]["value"].alias("component_value"),
        comp["valueQuantity"]["unit"].alias("component_unit"),
        r["meta"]["lastUpdated"].alias("last_updated"),
    ]


def condition_columns(r: Column) -> list[Column]:
    return [
        r["id"].alias("condition_id"),
        _code(r["clinicalStatus"]).alias("clinical_status"),
        _code(r["verificationStatus"]).alias("verification_status"),
        _first_code(r["category"]).alias("category"),
        _code(r["code"]).alias("code"),
        _code(r["code"], "display").alias("code_display"),
        strip_ref(r["subject"]["reference"], "Patient/").alias("patient_id"),
        strip_ref(r["encounter"]["reference"], "Encounter/").alias("encounter_id"),
        or_else(r["onsetDateTime"], r["onsetPeriod"]["start"]).alias("onset_datetime"),
        r["abatementDateTime"].alias("abatement_datetime"),
        r["recordedDate"].alias("recorded_date"),
        _code(r["severity"]).alias("severity"),
        r["meta"]["lastUpdated"].alias("last_updated"),
    ]


FLATTENERS = {"Patient": patient_columns, "Encounter": encounter_columns,
              "Observation": observation_columns, "Condition": condition_columns}


def flatten(entries: DataFrame, resource: str, resource_col: str = "resource",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of one resource type, flattened; other types are skipped."""
    r = F.col(resource_col)
    return (entries.filter(r["resourceType"] == F.lit(resource))
            .select(*FLATTENERS[resource](r), *[F.col(k) for k in keep]))
