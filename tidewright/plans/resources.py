"""Clinical resources (FHIR R4 JSON) to typed tables, with profile overlays.

A resource table has common columns, and typed columns that are JSON paths with a type; choice types are separate columns. A profile adds
columns to a base and falls back to it; the chain is resolved while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.scalars import first_match

# Shapes of clinical data types, as DDL.
CODING = "STRUCT<system: STRING, version: STRING, code: STRING, display: STRING>"
CONCEPT = f"STRUCT<coding: ARRAY<{CODING}>, text: STRING>"
PERIOD = "STRUCT<start: STRING, end: STRING>"
REFERENCE = "STRUCT<reference: STRING, type: STRING, display: STRING>"
QUANTITY = "STRUCT<value: DOUBLE, comparator: STRING, unit: STRING, system: STRING, code: STRING>"
IDENTIFIER = f"STRUCT<use: STRING, type: {CONCEPT}, system: STRING, value: STRING, period: {PERIOD}>"
NAME = f"STRUCT<use: STRING, text: STRING, family: STRING, given: ARRAY<STRING>, prefix: ARRAY<STRING>, suffix: ARRAY<STRING>, period: {PERIOD}>"
ADDRESS = "STRUCT<use: STRING, type: STRING, text: STRING, line: ARRAY<STRING>, city: STRING, district: STRING, state: STRING, postalCode: STRING, country: STRING>"
CONTACT = "STRUCT<system: STRING, value: STRING, use: STRING, rank: INT>"
NOTE = "STRUCT<authorString: STRING, time: STRING, text: STRING>"
DOSAGE = f"STRUCT<sequence: INT, text: STRING, route: {CONCEPT}, asNeededBoolean: BOOLEAN>"
RANGE = f"STRUCT<low: {QUANTITY}, high: {QUANTITY}>"
ATTACHMENT = "STRUCT<contentType: STRING, language: STRING, url: STRING, size: BIGINT, hash: STRING, title: STRING, creation: STRING>"
PARTS = {
    "Participant": f"STRUCT<type: ARRAY<{CONCEPT}>, period: {PERIOD}, individual: {REFERENCE}>",
    "Diagnosis": f"STRUCT<condition: {REFERENCE}, use: {CONCEPT}, rank: INT>",
    "Hospitalization": f"STRUCT<origin: {REFERENCE}, admitSource: {CONCEPT}, destination: {REFERENCE}, dischargeDisposition: {CONCEPT}>",
    "Stay": f"STRUCT<location: {REFERENCE}, status: STRING, physicalType: {CONCEPT}, period: {PERIOD}>",
    "Component": f"STRUCT<code: {CONCEPT}, valueQuantity: {QUANTITY}, valueCodeableConcept: {CONCEPT}, valueString: STRING, valueBoolean: BOOLEAN, valueInteger: INT, valueDateTime: STRING, dataAbsentReason: {CONCEPT}, interpretation: ARRAY<{CONCEPT}>>",
    "ReferenceRange": f"STRUCT<low: {QUANTITY}, high: {QUANTITY}, type: {CONCEPT}, appliesTo: ARRAY<{CONCEPT}>, age: {RANGE}, text: STRING>",
    "Performer": f"STRUCT<function: {CONCEPT}, actor: {REFERENCE}, onBehalfOf: {REFERENCE}>",
    "VaccineReaction": f"STRUCT<date: STRING, detail: {REFERENCE}, reported: BOOLEAN>",
    "Protocol": f"STRUCT<series: STRING, authority: {REFERENCE}, targetDisease: ARRAY<{CONCEPT}>, doseNumberPositiveInt: INT, seriesDosesPositiveInt: INT>",
    "AllergyReaction": f"STRUCT<substance: {CONCEPT}, manifestation: ARRAY<{CONCEPT}>, description: STRING, onset: STRING, severity: STRING, exposureRoute: {CONCEPT}>",
    "Dispense": f"STRUCT<validityPeriod: {PERIOD}, numberOfRepeatsAllowed: INT, quantity: {QUANTITY}, performer: {REFERENCE}>",
    "Substitution": f"STRUCT<allowedBoolean: BOOLEAN, allowedCodeableConcept: {CONCEPT}, reason: {CONCEPT}>",
    "Attachment": ATTACHMENT,
    "Content": f"STRUCT<attachment: {ATTACHMENT}, format: {CODING}>",
    "Context": f"STRUCT<encounter: ARRAY<{REFERENCE}>, event: ARRAY<{CONCEPT}>, period: {PERIOD}, facilityType: {CONCEPT}, practiceSetting: {CONCEPT}, sourcePatientInfo: {REFERENCE}, related: ARRAY<{REFERENCE}>>",
    "Relation": f"STRUCT<code: STRING, target: {REFERENCE}>",
    "CoverageClass": f"STRUCT<type: {CONCEPT}, value: STRING, name: STRING>",
    "Cost": f"STRUCT<type: {CONCEPT}, valueQuantity: {QUANTITY}>",
    "Activity": f"STRUCT<reference: {REFERENCE}, outcomeCodeableConcept: ARRAY<{CONCEPT}>, progress: ARRAY<{NOTE}>>",
    "Target": f"STRUCT<measure: {CONCEPT}, detailQuantity: {QUANTITY}, detailCodeableConcept: {CONCEPT}, detailString: STRING, dueDate: STRING>",
    "Udi": "STRUCT<deviceIdentifier: STRING, issuer: STRING, jurisdiction: STRING, carrierHRF: STRING, entryType: STRING>",
    "DeviceName": "STRUCT<name: STRING, type: STRING>",
    "DeviceVersion": f"STRUCT<type: {CONCEPT}, value: STRING>",
    "Stage": f"STRUCT<summary: {CONCEPT}, type: {CONCEPT}, assessment: ARRAY<{REFERENCE}>>",
    "Evidence": f"STRUCT<code: ARRAY<{CONCEPT}>, detail: ARRAY<{REFERENCE}>>",
    "PersonContact": f"STRUCT<relationship: ARRAY<{CONCEPT}>, name: {NAME}, telecom: ARRAY<{CONTACT}>, gender: STRING, organization: {REFERENCE}>",
    "Communication": f"STRUCT<language: {CONCEPT}, preferred: BOOLEAN>",
}
TYPES = PARTS | {"Range": RANGE, "Coding": CODING, "Concept": CONCEPT, "Period": PERIOD, "Reference": REFERENCE, "Quantity": QUANTITY, "Identifier": IDENTIFIER, "Name": NAME, "Address": ADDRESS, "Contact": CONTACT, "Note": NOTE, "Dosage": DOSAGE, "string": "STRING", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INT", "time": "TIME", "date": "DATE"}

# Elements of each resource of the R4 standard by type; ``*`` marks repeating ones.
RESOURCES: dict[str, dict[str, str]] = {
    "Patient": {"Identifier": "identifier*", "Name": "name*", "Contact": "telecom*", "Address": "address*", "string": "gender deceasedDateTime", "boolean": "active deceasedBoolean multipleBirthBoolean", "date": "birthDate", "Concept": "maritalStatus", "Reference": "generalPractitioner* managingOrganization", "PersonContact": "contact*", "Communication": "communication*"},
    "Observation": {"Identifier": "identifier*", "string": "status valueString valueDateTime", "Concept": "category* code valueCodeableConcept interpretation* bodySite method dataAbsentReason", "Reference": "subject encounter performer* hasMember* derivedFrom* specimen device basedOn*", "time": "effectiveDateTime issued", "Quantity": "valueQuantity", "boolean": "valueBoolean", "int": "valueInteger", "Note": "note*", "Period": "effectivePeriod", "Component": "component*", "ReferenceRange": "referenceRange*"},
    "Condition": {"Identifier": "identifier*", "Concept": "clinicalStatus verificationStatus category* severity code bodySite*", "Reference": "subject encounter recorder asserter", "time": "onsetDateTime abatementDateTime recordedDate", "string": "onsetString abatementString", "Note": "note*", "Period": "onsetPeriod", "Stage": "stage*", "Evidence": "evidence*"},
    "Encounter": {"Identifier": "identifier*", "string": "status", "Coding": "class", "Concept": "type* serviceType priority reasonCode*", "Reference": "subject serviceProvider partOf reasonReference* episodeOfCare*", "Period": "period", "Participant": "participant*", "Diagnosis": "diagnosis*", "Hospitalization": "hospitalization", "Stay": "location*"},
    "Procedure": {"Identifier": "identifier*", "string": "status performedString", "Concept": "category code reasonCode* bodySite* outcome complication*", "Reference": "subject encounter location report* reasonReference* recorder asserter", "time": "performedDateTime", "Period": "performedPeriod", "Note": "note*", "Performer": "performer*"},
    "MedicationRequest": {"Identifier": "identifier*", "string": "status intent priority", "Concept": "category* medicationCodeableConcept reasonCode* statusReason", "Reference": "medicationReference subject encounter requester reasonReference* recorder", "time": "authoredOn", "Dosage": "dosageInstruction*", "Note": "note*", "Dispense": "dispenseRequest", "Substitution": "substitution", "boolean": "doNotPerform"},
    "DiagnosticReport": {"Identifier": "identifier*", "string": "status conclusion", "Concept": "category* code conclusionCode*", "Reference": "subject encounter performer* result* specimen* resultsInterpreter* imagingStudy*", "time": "effectiveDateTime issued", "Period": "effectivePeriod", "Attachment": "presentedForm*"},
    "AllergyIntolerance": {"Identifier": "identifier*", "string": "type criticality category*", "Concept": "clinicalStatus verificationStatus code", "Reference": "patient encounter recorder", "time": "onsetDateTime recordedDate lastOccurrence", "Note": "note*", "AllergyReaction": "reaction*"},
    "Immunization": {"Identifier": "identifier*", "string": "status lotNumber occurrenceString", "Concept": "statusReason vaccineCode site route reasonCode* programEligibility* fundingSource", "Reference": "patient encounter location manufacturer reasonReference*", "time": "occurrenceDateTime recorded", "date": "expirationDate", "Quantity": "doseQuantity", "boolean": "primarySource isSubpotent", "Performer": "performer*", "VaccineReaction": "reaction*", "Protocol": "protocolApplied*", "Note": "note*"},
    "Coverage": {"Identifier": "identifier*", "string": "status subscriberId dependent network", "Concept": "type relationship", "Reference": "policyHolder subscriber beneficiary payor*", "Period": "period", "int": "order", "CoverageClass": "class*", "Cost": "costToBeneficiary*"},
    "CarePlan": {"Identifier": "identifier*", "string": "status intent title description", "Concept": "category*", "Reference": "subject encounter author goal* careTeam* addresses*", "Period": "period", "time": "created", "Note": "note*", "Activity": "activity*"},
    "Goal": {"Identifier": "identifier*", "string": "lifecycleStatus statusReason", "Concept": "achievementStatus category* priority description startCodeableConcept outcomeCode*", "Reference": "subject expressedBy addresses*", "date": "startDate statusDate", "Note": "note*", "Target": "target*"},
    "Device": {"Identifier": "identifier*", "string": "status manufacturer lotNumber serialNumber modelNumber distinctIdentifier partNumber", "Concept": "type statusReason* safety*", "time": "manufactureDate expirationDate", "Reference": "patient owner location", "Note": "note*", "Udi": "udiCarrier*", "DeviceName": "deviceName*", "DeviceVersion": "version*"},
    "DocumentReference": {"Identifier": "identifier*", "string": "status docStatus description", "Concept": "type category* securityLabel*", "Reference": "subject author* authenticator custodian", "time": "date", "Content": "content*", "Context": "context", "Relation": "relatesTo*"},
}

#: Profiles: name to (base profile or None, {resource: {column: Column of the resource text}}).
_profiles: dict[str, tuple[str | None, dict[str, dict[str, Column]]]] = {"base": (None, {})}


def bundle_entries(df: DataFrame, bundle: str) -> DataFrame:
    """Resources of bundles, one JSON text a row; text that is no bundle gives none."""
    ok = F.get_json_object(bundle, "$.resourceType") == "Bundle"
    entries = F.from_json(bundle, "entry array<struct<resource string>>")["entry"]
    only = F.filter(F.transform(entries, lambda x: x["resource"]), lambda x: x.isNotNull())
    return df.where(ok).select(*[c for c in df.columns if c != bundle], F.explode(only).alias("raw_json"))


def rejected_bundles(df: DataFrame, bundle: str) -> DataFrame:
    return df.where(~F.coalesce(F.get_json_object(bundle, "$.resourceType") == "Bundle", F.lit(False)))


def _fields(resource: str) -> dict[str, tuple[str, bool]]:
    return {n.rstrip("*"): (kind, n.endswith("*")) for kind, names in RESOURCES[resource].items() for n in names.split()}


def _ddl(kind: str, many: bool) -> str:
    t = TYPES[kind] if kind not in ("time", "date") else "STRING"
    return f"ARRAY<{t}>" if many else t


def extension_value(raw: str, url: str, path: str) -> Column:
    """Text at ``path`` of the first extension with this address."""
    ext = F.from_json(F.get_json_object(raw, "$.extension"), "array<string>")
    return first_match(ext, lambda x: F.get_json_object(x, "$.url") == url, lambda x: F.get_json_object(x, "$." + path))


def register_profile(name: str, base: str | None, columns: dict[str, dict[str, Column]]) -> None:
    """A profile that adds columns to resources of its base; columns are expressions over ``raw_json``."""
    if base is not None and base not in _profiles:
        raise ValueError(f"unknown profile {base}")
    _profiles[name] = (base, columns)


def profile_columns(profile: str, resource: str) -> dict[str, Column]:
    base, own = _profiles[profile]
    return (profile_columns(base, resource) if base else {}) | own.get(resource, {})


def resource_table(df: DataFrame, resource: str, raw: str = "raw_json", profile: str = "base") -> DataFrame:
    """``id``, ``resourceType``, ``lastUpdated``, typed columns, profile columns, ``extension`` and ``raw_json``."""
    fields = _fields(resource)
    shape = ", ".join(["id STRING", "resourceType STRING", "meta STRUCT<lastUpdated: STRING>", *(f"`{n}` {_ddl(*k)}" for n, k in fields.items())])
    own = df.where(F.get_json_object(raw, "$.resourceType") == resource).withColumn("__r", F.from_json(raw, shape))

    def column(n: str) -> Column:
        c, kind = F.col(f"__r.`{n}`"), fields[n][0]
        return (c.try_cast("timestamp") if kind == "time" else c.try_cast("date") if kind == "date" else c).alias(n)

    extra = [c.alias(k) for k, c in profile_columns(profile, resource).items()]
    return own.select(F.col("__r.id").alias("id"), F.col("__r.resourceType").alias("resourceType"), F.col("__r.meta.lastUpdated").try_cast("timestamp").alias("lastUpdated"), *(column(n) for n in fields), *extra, F.get_json_object(raw, "$.extension").alias("extension"), F.col(raw).alias("raw_json"))


def _uk(name: str) -> str:
    return f"https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-{name}"


def register_uk_core() -> None:
    """A national overlay of Patient: NHS number, ethnicity, birth sex, death status, interpreter, residence."""
    ids = F.from_json(F.get_json_object("raw_json", "$.identifier"), "array<struct<system string, value string>>")
    coded = lambda n: extension_value("raw_json", _uk(n), "valueCodeableConcept.coding[0].code")
    register_profile("uk_core", "base", {"Patient": {
        "nhs_number": first_match(ids, lambda x: x["system"] == "https://fhir.nhs.uk/Id/nhs-number", lambda x: x["value"]),
        "ethnicity": coded("EthnicCategory"),
        "birth_sex": coded("BirthSex"),
        "death_status": coded("DeathNotificationStatus"),
        "interpreter_required": extension_value("raw_json", _uk("NHSCommunication"), "extension[0].valueBoolean").try_cast("boolean"),
        "residential_status": coded("ResidentialStatus"),
    }})
