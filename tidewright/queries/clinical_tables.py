"""One query for each segment and resource table that ``clinical`` has none for.

Each customer gives one message or resource, ``{k}`` being its key. A sample states fields by position (or JSON), then for each result
column where to find it in the table and what DuckDB says it must be.
"""

from pyspark.sql import functions as F

from tidewright.plans import messages, resources
from tidewright.queries._tables import Registry, load

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

Columns = dict[str, tuple[str, str]]

SEGMENT_SAMPLES: dict[str, tuple[dict[int, str], Columns]] = {
    "EVN": ({1: "A01", 2: "20240102030405", 5: "d{k}^Lee~e{k}^Kim", 7: "ward^1.2^ISO"}, {"kind": ("evn_1", "'A01'"), "at": ("evn_2", "'2024-01-02T03:04:05Z'"), "second": ("evn_5[1].id", "'e' || c_custkey"), "place": ("evn_7.universal_id", "'1.2'")}),
    "PD1": ({3: "Clinic {k}^L^77", 4: "d{k}^Lee^Ann", 13: "20240301"}, {"clinic": ("pd1_3[0].name", "'Clinic ' || c_custkey"), "doctor": ("pd1_4[0].given_name", "'Ann'"), "at": ("pd1_13", "'2024-03-01T00:00:00Z'")}),
    "PV1": ({1: "1", 2: "I^Inpatient", 3: "W1^R{k}^B2^HOSP", 7: "d{k}^Lee", 19: "v{k}^^^HOSP", 44: "202401020304", 47: "12.5"}, {"class": ("pv1_2.text", "'Inpatient'"), "room": ("pv1_3.room", "'R' || c_custkey"), "doctor": ("pv1_7[0].id", "'d' || c_custkey"), "visit": ("pv1_19.id", "'v' || c_custkey"), "at": ("pv1_44", "'2024-01-02T03:04:00Z'"), "charges": ("pv1_47", "'12.5'")}),
    "PV2": ({3: "R{k}^reason", 8: "20240105", 10: "3", 23: "Clinic^L^c{k}"}, {"reason": ("pv2_3.code", "'R' || c_custkey"), "at": ("pv2_8", "'2024-01-05T00:00:00Z'"), "days": ("pv2_10", "3::INTEGER"), "clinic": ("pv2_23[0].id", "'c' || c_custkey")}),
    "NK1": ({1: "2", 2: "Lee^Kin{k}", 3: "MTH^Mother", 4: "1 Road^^Town^^P{k}", 5: "555{k}"}, {"set_id": ("set_id", "2::INTEGER"), "name": ("nk1_2[0].given_name", "'Kin' || c_custkey"), "kind": ("nk1_3.text", "'Mother'"), "post": ("nk1_4[0].postal_code", "'P' || c_custkey"), "phone": ("nk1_5[0].number", "'555' || c_custkey")}),
    "MRG": ({1: "old{k}^^^A~older{k}", 7: "Lee^Old"}, {"first": ("mrg_1[0].id", "'old' || c_custkey"), "second": ("mrg_1[1].id", "'older' || c_custkey"), "name": ("mrg_7[0].given_name", "'Old'")}),
    "AL1": ({1: "1", 2: "DA^Drug", 3: "A{k}^Aspirin^L", 5: "rash", 6: "20231231"}, {"kind": ("al1_2.code", "'DA'"), "what": ("al1_3.code", "'A' || c_custkey"), "system": ("al1_3.system", "'L'"), "reaction": ("al1_5[0].code", "'rash'"), "at": ("al1_6", "'2023-12-31T00:00:00Z'")}),
    "IAM": ({1: "0", 3: "A{k}^Nuts", 6: "A^Add", 7: "u{k}^ns", 11: "2024"}, {"set_id": ("set_id", "0::INTEGER"), "what": ("iam_3.text", "'Nuts'"), "action": ("iam_6.code", "'A'"), "id": ("iam_7.id", "'u' || c_custkey"), "at": ("iam_11", "'2024-01-01T00:00:00Z'")}),
    "DG1": ({1: "1", 3: "J45.{k}^Asthma^I10", 5: "20240203", 6: "F", 15: "1", 16: "d{k}^Lee"}, {"code": ("dg1_3.code", "'J45.' || c_custkey"), "at": ("dg1_5", "'2024-02-03T00:00:00Z'"), "kind": ("dg1_6.code", "'F'"), "priority": ("dg1_15", "1::INTEGER"), "doctor": ("dg1_16[0].family_name", "'Lee'")}),
    "PR1": ({1: "1", 3: "P{k}^Bypass", 5: "20240203", 7: "90", 11: "s{k}^Cut", 19: "p{k}^ns"}, {"code": ("pr1_3.code", "'P' || c_custkey"), "at": ("pr1_5", "'2024-02-03T00:00:00Z'"), "minutes": ("pr1_7", "90::INTEGER"), "surgeon": ("pr1_11[0].id", "'s' || c_custkey"), "id": ("pr1_19.id", "'p' || c_custkey")}),
    "ORC": ({1: "NW", 2: "o{k}^app", 3: "f{k}", 7: "1^Q1H", 9: "20240203040506", 12: "d{k}^Lee"}, {"control": ("orc_1", "'NW'"), "placer": ("orc_2.namespace", "'app'"), "filler": ("orc_3.id", "'f' || c_custkey"), "every": ("orc_7[0].interval", "'Q1H'"), "at": ("orc_9", "'2024-02-03T04:05:06Z'"), "doctor": ("orc_12[0].id", "'d' || c_custkey")}),
    "NTE": ({1: "3", 2: "L", 3: "note {k} \\T\\ more", 4: "RE^Remark"}, {"set_id": ("set_id", "3::INTEGER"), "source": ("nte_2", "'L'"), "note": ("nte_3[0]", "'note ' || c_custkey || ' & more'"), "kind": ("nte_4.text", "'Remark'")}),
    "SPM": ({1: "1", 2: "s{k}&ns^f{k}", 4: "BLD^Blood", 12: "5^ml", 17: "20240203", 26: "2"}, {"filler": ("spm_2.filler", "'f' || c_custkey"), "kind": ("spm_4.text", "'Blood'"), "units": ("spm_12.units", "'ml'"), "at": ("spm_17.start", "'2024-02-03T00:00:00Z'"), "containers": ("spm_26", "2::INTEGER")}),
    "IN1": ({1: "1", 2: "PL{k}^Plan", 3: "c{k}", 4: "Insurer", 12: "20240101", 13: "20241231", 16: "Lee^Ann"}, {"plan": ("in1_2.code", "'PL' || c_custkey"), "company": ("in1_3[0].id", "'c' || c_custkey"), "name": ("in1_4[0].name", "'Insurer'"), "from": ("in1_12", "'2024-01-01T00:00:00Z'"), "to": ("in1_13", "'2024-12-31T00:00:00Z'"), "insured": ("in1_16[0].given_name", "'Ann'")}),
    "GT1": ({1: "1", 2: "g{k}", 3: "Lee^Gus", 5: "1 Road^^Town", 8: "19700304", 11: "SEL^Self"}, {"number": ("gt1_2[0].id", "'g' || c_custkey"), "name": ("gt1_3[0].given_name", "'Gus'"), "city": ("gt1_5[0].city", "'Town'"), "born": ("gt1_8", "'1970-03-04T00:00:00Z'"), "kind": ("gt1_11.code", "'SEL'")}),
    "FT1": ({1: "1", 4: "20240203", 6: "CG", 7: "T{k}^Test", 10: "2", 20: "d{k}^Lee", 23: "f{k}"}, {"at": ("ft1_4.start", "'2024-02-03T00:00:00Z'"), "kind": ("ft1_6.code", "'CG'"), "code": ("ft1_7.code", "'T' || c_custkey"), "quantity": ("ft1_10", "2::INTEGER"), "doctor": ("ft1_20[0].id", "'d' || c_custkey"), "filler": ("ft1_23.id", "'f' || c_custkey")}),
    "RXA": ({1: "0", 2: "1", 3: "20240203", 5: "V{k}^Vaccine^CVX", 6: "0.5", 15: "lot{k}", 17: "Maker"}, {"at": ("rxa_3", "'2024-02-03T00:00:00Z'"), "code": ("rxa_5.code", "'V' || c_custkey"), "amount": ("rxa_6", "'0.5'"), "lot": ("rxa_15[0]", "'lot' || c_custkey"), "maker": ("rxa_17[0].code", "'Maker'")}),
    "SCH": ({1: "p{k}^app", 2: "f{k}", 7: "CHK^Checkup", 9: "30", 11: "^^^20240203^20240204", 16: "c{k}^Lee"}, {"placer": ("sch_1.id", "'p' || c_custkey"), "filler": ("sch_2.id", "'f' || c_custkey"), "reason": ("sch_7.text", "'Checkup'"), "minutes": ("sch_9", "30::INTEGER"), "start": ("sch_11[0].start", "'20240203'"), "contact": ("sch_16[0].id", "'c' || c_custkey")}),
    "TXA": ({1: "1", 2: "DS", 4: "20240203", 8: "20240204~20240205", 9: "d{k}^Lee", 12: "t{k}^ns", 17: "AU"}, {"kind": ("txa_2.code", "'DS'"), "at": ("txa_4", "'2024-02-03T00:00:00Z'"), "edited": ("txa_8[1]", "'2024-02-05T00:00:00Z'"), "author": ("txa_9[0].id", "'d' || c_custkey"), "id": ("txa_12.id", "'t' || c_custkey"), "done": ("txa_17", "'AU'")}),
}

#: The last field of each segment holds a key too: what it is rendered as, and the column that gives it back.
_LAST = {"CWE": ("Z{k}^last", ".code"), "XPN": ("Z{k}^last", ".family_name"), "EI": ("Z{k}^last", ".id"), "EIP": ("Z{k}&last^x", ".placer"), "XON": ("Z{k}^last", ".name"), "XTN": ("Z{k}^last", ".number"), "HD": ("Z{k}^last", ".namespace"), "CX": ("Z{k}^last", ".id"), "DTM": ("20240506", "")}
for _segment, (_fields, _columns) in SEGMENT_SAMPLES.items():
    _count, _kinds = messages.SEGMENTS[_segment]
    _found = {p.strip("*"): (k, p.endswith("*")) for k, places in _kinds.items() for p in places.split()}.get(str(_count), ("ST", False))
    if _count not in _fields:
        _text, _part = _LAST.get(_found[0], ("Z{k}", ""))
        _fields[_count] = _text
        _columns["last"] = (f"{_segment.lower()}_{_count}{'[0]' if _found[1] else ''}{_part}", "'2024-05-06T00:00:00Z'" if _found[0] == "DTM" else "'Z' || c_custkey")

RESOURCE_SAMPLES: dict[str, tuple[str, Columns]] = {
    "Condition": ('"clinicalStatus":{"coding":[{"code":"active"}]},"code":{"text":"c{k}"},"subject":{"reference":"Patient/p{k}"},"onsetDateTime":"2024-02-03T04:05:06Z","note":[{"text":"n"}]', {"status": ("clinicalStatus.coding[0].code", "'active'"), "code": ("code.text", "'c' || c_custkey"), "subject": ("subject.reference", "'Patient/p' || c_custkey"), "onset": ("cast(onsetDateTime as timestamp_ntz)", "TIMESTAMP '2024-02-03 04:05:06'"), "note": ("note[0].text", "'n'")}),
    "Encounter": ('"status":"finished","class":{"code":"AMB"},"type":[{"text":"t{k}"}],"period":{"start":"2024-02-03","end":"2024-02-04"}', {"status": ("status", "'finished'"), "class": ("`class`.code", "'AMB'"), "type": ("type[0].text", "'t' || c_custkey"), "until": ("period.end", "'2024-02-04'")}),
    "Procedure": ('"status":"completed","code":{"coding":[{"code":"{k}"}]},"performedPeriod":{"start":"2024"},"bodySite":[{"text":"arm"}]', {"status": ("status", "'completed'"), "code": ("code.coding[0].code", "c_custkey::VARCHAR"), "since": ("performedPeriod.start", "'2024'"), "site": ("bodySite[0].text", "'arm'")}),
    "MedicationRequest": ('"status":"active","intent":"order","medicationCodeableConcept":{"text":"m{k}"},"authoredOn":"2024-02-03T00:00:00Z","dosageInstruction":[{"sequence":1,"text":"daily","asNeededBoolean":false}]', {"intent": ("intent", "'order'"), "what": ("medicationCodeableConcept.text", "'m' || c_custkey"), "at": ("cast(authoredOn as timestamp_ntz)", "TIMESTAMP '2024-02-03 00:00:00'"), "dose": ("dosageInstruction[0].text", "'daily'"), "if_needed": ("dosageInstruction[0].asNeededBoolean", "false")}),
    "DiagnosticReport": ('"status":"final","code":{"text":"r{k}"},"result":[{"reference":"Observation/1"},{"reference":"Observation/{k}"}],"conclusion":"fine","issued":"2024-02-03T00:00:00Z"', {"code": ("code.text", "'r' || c_custkey"), "second": ("result[1].reference", "'Observation/' || c_custkey"), "conclusion": ("conclusion", "'fine'"), "at": ("cast(issued as timestamp_ntz)", "TIMESTAMP '2024-02-03 00:00:00'")}),
    "AllergyIntolerance": ('"type":"allergy","criticality":"high","category":["food","{k}"],"code":{"text":"nuts"},"patient":{"reference":"Patient/p{k}"}', {"type": ("type", "'allergy'"), "criticality": ("criticality", "'high'"), "second": ("category[1]", "c_custkey::VARCHAR"), "code": ("code.text", "'nuts'"), "patient": ("patient.reference", "'Patient/p' || c_custkey")}),
    "Immunization": ('"status":"completed","lotNumber":"lot{k}","expirationDate":"2025-06-07","doseQuantity":{"value":0.5,"unit":"ml"},"primarySource":true', {"lot": ("lotNumber", "'lot' || c_custkey"), "expires": ("expirationDate", "DATE '2025-06-07'"), "dose": ("doseQuantity.value", "0.5::DOUBLE"), "primary_source": ("primarySource", "true")}),
    "Coverage": ('"status":"active","subscriberId":"s{k}","payor":[{"display":"Insurer"}],"order":2,"period":{"start":"2024-01-01"}', {"subscriber": ("subscriberId", "'s' || c_custkey"), "payor": ("payor[0].display", "'Insurer'"), "place": ("`order`", "2::INTEGER"), "since": ("period.start", "'2024-01-01'")}),
    "CarePlan": ('"status":"active","title":"plan {k}","goal":[{"reference":"Goal/{k}"}],"created":"2024-02-03T00:00:00Z"', {"title": ("title", "'plan ' || c_custkey"), "goal": ("goal[0].reference", "'Goal/' || c_custkey"), "at": ("cast(created as timestamp_ntz)", "TIMESTAMP '2024-02-03 00:00:00'")}),
    "Goal": ('"lifecycleStatus":"active","description":{"text":"g{k}"},"startDate":"2024-02-03","statusDate":"none"', {"status": ("lifecycleStatus", "'active'"), "text": ("description.text", "'g' || c_custkey"), "since": ("startDate", "DATE '2024-02-03'"), "no_date": ("statusDate", "NULL::DATE")}),
    "Device": ('"status":"active","serialNumber":"sn{k}","type":{"text":"pump"},"manufactureDate":"2024-02-03T00:00:00Z"', {"serial": ("serialNumber", "'sn' || c_custkey"), "type": ("type.text", "'pump'"), "made": ("cast(manufactureDate as timestamp_ntz)", "TIMESTAMP '2024-02-03 00:00:00'")}),
    "DocumentReference": ('"status":"current","type":{"coding":[{"system":"s","code":"{k}"}]},"author":[{"display":"Lee"}],"date":"2024-02-03T04:05:06Z"', {"status": ("status", "'current'"), "code": ("type.coding[0].code", "c_custkey::VARCHAR"), "author": ("author[0].display", "'Lee'"), "at": ("cast(date as timestamp_ntz)", "TIMESTAMP '2024-02-03 04:05:06'")}),
}


def _filled(template: str):
    return F.replace(F.lit(template), F.lit("{k}"), F.col("c_custkey").cast("string"))


def _twin(key: str, columns: Columns) -> str:
    return f"SELECT {key}, " + ", ".join(f'{sql} AS "{name}"' for name, (_, sql) in columns.items()) + " FROM customer"


def _segment_query(name: str) -> None:
    fields, columns = SEGMENT_SAMPLES[name]
    line = "|".join([name, *(fields.get(i, "") for i in range(1, max(fields) + 1))])

    def query(spark, d):
        text = _filled(f"MSH|^~\\&|app||||||ADT|M{{k}}||2.5\r{line}")
        t = messages.segment_table(load(spark, d, "customer").select(text.alias("message")), name)
        return t.select("message_id", *(F.expr(found).alias(c) for c, (found, _) in columns.items()))

    query.__name__ = f"hl7_{name.lower()}"
    R.query(_twin("'M' || c_custkey AS message_id", columns))(query)


def _resource_query(name: str) -> None:
    body, columns = RESOURCE_SAMPLES[name]

    def query(spark, d):
        text = _filled(f'{{"resourceType":"Bundle","entry":[{{"resource":{{"resourceType":"{name}","id":"r{{k}}",{body}}}}},{{"fullUrl":"x"}}]}}')
        t = resources.resource_table(resources.bundle_entries(load(spark, d, "customer").select(text.alias("bundle")), "bundle"), name)
        return t.select("id", *(F.expr(found).alias(c) for c, (found, _) in columns.items()))

    query.__name__ = f"fhir_{''.join('_' + c.lower() if c.isupper() else c for c in name).lstrip('_')}"
    R.query(_twin("'r' || c_custkey AS id", columns))(query)


for _name in SEGMENT_SAMPLES:
    _segment_query(_name)
for _name in RESOURCE_SAMPLES:
    _resource_query(_name)
