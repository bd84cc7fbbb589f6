"""Pipe-delimited clinical messages (HL7 v2) to typed segment tables, all as Spark expressions.

Separators are read from each message's own header. Columns are named by segment and field position (``pid_5``);
composite fields are structs, repeating ones arrays of structs, ranges of times (``DR``) structs of two. Which fields are composite is a table by data type, and
further kinds and segments can be registered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.scalars import hl7_ts

# Components of the composite data types of the HL7 v2 standard, in order; ``/`` parts the names of subcomponents.
COMPOSITES: dict[str, str] = {
    "AUI": "authorization_number date source",
    "CP": "price/currency price_type from_value to_value range_units/range_units_text/range_units_system range_type",
    "CQ": "quantity units",
    "CWE": "code text system alternate_code alternate_text alternate_system system_version alternate_system_version original_text",
    "CX": "id check_digit check_digit_scheme assigning_authority/assigning_authority_universal_id/assigning_authority_universal_id_type type_code assigning_facility/assigning_facility_universal_id/assigning_facility_universal_id_type effective_date expiration_date assigning_jurisdiction assigning_agency security_check security_check_scheme",
    "DLD": "location effective_date",
    "DLN": "number issuing_authority expiration_date",
    "EI": "id namespace universal_id universal_id_type",
    "EIP": "placer/placer_namespace/placer_universal_id/placer_universal_id_type filler/filler_namespace/filler_universal_id/filler_universal_id_type",
    "FC": "class/text/system/alternate_code/alternate_text/alternate_system/system_version/alternate_system_version/original_text effective_date",
    "HD": "namespace universal_id universal_id_type",
    "JCC": "code/text/system class/class_text/class_system description",
    "MO": "quantity denomination",
    "MOC": "amount/amount_currency charge_code/charge_code_text/charge_code_system",
    "MSG": "code trigger structure",
    "NDL": "id/family_name/given_name/middle_name/suffix/prefix/degree start end point_of_care room bed facility location_status patient_location_type building floor",
    "OG": "original_sub_id group sequence identifier",
    "PL": "point_of_care room bed facility location_status person_location_type building floor description comprehensive_id assigning_authority",
    "PRL": "observation_identifier/text/system observation_sub_id observation_value_descriptor",
    "PT": "processing_id processing_mode",
    "SPS": "code/code_text additives text body_site site_modifier collection_modifier role",
    "TQ": "quantity/quantity_units interval/interval_explicit_time duration start end priority condition text conjunction sequencing occurrence_duration total_occurrences",
    "VID": "version internationalization_code/internationalization_text/internationalization_system internal_version/internal_version_text/internal_version_system",
    "XAD": "street other city state postal_code country type other_geographic county/county_text/county_system census_tract/census_tract_text/census_tract_system representation_code validity_range effective_date expiration_date expiration_reason/expiration_reason_text/expiration_reason_system temporary_indicator bad_address_indicator usage addressee comment preference_order protection_code/protection_code_text/protection_code_system identifier",
    "XCN": "id family_name given_name middle_name suffix prefix degree source_table assigning_authority/assigning_authority_universal_id/assigning_authority_universal_id_type name_type_code check_digit check_digit_scheme identifier_type_code assigning_facility/assigning_facility_universal_id/assigning_facility_universal_id_type name_representation_code name_context name_validity_range name_assembly_order effective_date expiration_date professional_suffix",
    "XON": "name type_code id check_digit check_digit_scheme assigning_authority/assigning_authority_universal_id/assigning_authority_universal_id_type id_type assigning_facility/assigning_facility_universal_id/assigning_facility_universal_id_type name_representation organization_id",
    "XPN": "family_name given_name middle_name suffix prefix degree name_type_code name_representation_code name_context name_validity_range name_assembly_order name_effective_date name_expiration_date professional_suffix called_by",
    "XTN": "number use equipment email country area local extension text extension_prefix speed_dial_code unformatted_number effective_date expiration_date expiration_reason protection_code shared_telecom_id preference_order",
}

# Fields of each segment, and the positions of those that are not plain text; ``*`` marks repeating ones.
SEGMENTS: dict[str, tuple[int, dict[str, str]]] = {
    "MSH": (28, {"HD": "3 4 5 6 24 25", "DTM": "7", "MSG": "9", "PT": "11", "VID": "12", "INT": "13", "ST": "18*", "CWE": "19 26 27* 28*", "EI": "21*", "XON": "22 23"}),
    "EVN": (7, {"DTM": "2 3 6", "CWE": "4", "XCN": "5*", "HD": "7"}),
    "PID": (40, {"SI": "1", "CX": "2 3* 4 18 21*", "XPN": "5* 6*", "DTM": "7 29 33", "CWE": "8 10* 15 16 17 22* 26* 27 28 32* 35 36 38 39*", "XAD": "11*", "XTN": "13* 14* 40*", "DLN": "20", "INT": "25", "HD": "34"}),
    "PD1": (23, {"CWE": "1* 2 5 6 7 8 11 15* 16 19 20 21", "XON": "3* 14*", "XCN": "4*", "CX": "10*", "DTM": "13 17 18 22 23"}),
    "PV1": (54, {"SI": "1", "CWE": "2 4 10 12 13 14 15* 16 18 21 22 23 24* 28 29 31 34 36 38 39 40 41 51", "PL": "3 6 11 42 43", "CX": "5 19 50* 54", "XCN": "7* 8* 9* 17* 52*", "FC": "20*", "ST": "26* 27*", "DTM": "25* 30 35 44 45", "DLD": "37"}),
    "PV2": (50, {"PL": "1", "CWE": "2 3 4 7* 16 18 21 24 25 27 30 31 38 39* 40 41* 42 43 44 45* 49*", "ST": "5*", "DTM": "8 9 14 17 26 28 29 33 46 47 48 50", "INT": "10 11 20", "XCN": "13*", "XON": "23*"}),
    "NK1": (41, {"SI": "1", "XPN": "2* 26* 30*", "CWE": "3 7 14 15 17* 18* 19* 20 21 22 24 25 27 28* 29* 34 35* 36 39", "XAD": "4* 32*", "XTN": "5* 6* 31* 40 41", "DTM": "8 9 16", "JCC": "11", "CX": "12 33*", "XON": "13*"}),
    "MRG": (7, {"CX": "1* 2* 3 4 5 6", "XPN": "7*"}),
    "AL1": (6, {"SI": "1", "CWE": "2 3 4 5*", "DTM": "6"}),
    "IAM": (30, {"SI": "1", "CWE": "2 3 4 5* 6 9 10 15 16 17 27", "EI": "7", "DTM": "11 13 20 22 24 26", "XCN": "14 18 21 23 25", "XON": "19 28 29 30"}),
    "DG1": (26, {"SI": "1", "CWE": "3 6 7 8 10 11 17 23 25 26", "DTM": "5 19", "INT": "12 15", "CP": "13", "XCN": "16*", "EI": "20 22"}),
    "PR1": (25, {"SI": "1", "CWE": "3 6 9 13 15 16* 17 18* 21 22", "DTM": "5", "INT": "7 10", "XCN": "8* 11* 12*", "EI": "19 25", "PL": "23*"}),
    "ORC": (38, {"EI": "2 3 4 38", "TQ": "7*", "EIP": "8*", "DTM": "9 15 27 32 37", "XCN": "10* 11* 12* 19*", "PL": "13", "XTN": "14* 23*", "CWE": "16 17 18 20 25 26 28 29 30 31 34*", "XON": "21*", "XAD": "22* 24*", "CX": "33*", "DR": "36"}),
    "OBR": (55, {"SI": "1", "EI": "2 3 51 52", "CWE": "4 12 13* 31* 38* 39* 40 43* 44 45* 46* 47* 48 49 50", "DTM": "6 7 8 14 22 36", "CQ": "9", "XCN": "10* 16* 28*", "SPS": "15", "XTN": "17*", "MOC": "23", "PRL": "26", "TQ": "27*", "EIP": "29 54*", "NDL": "32 33* 34* 35*", "INT": "37", "CX": "53*"}),
    "OBX": (33, {"SI": "1", "CWE": "3 6 8* 15 17* 20* 22 27 28* 32*", "OG": "4", "ST": "5* 10*", "DTM": "12 14 19", "XCN": "16* 25", "EI": "18* 21", "XON": "23", "XAD": "24", "EIP": "33*"}),
    "NTE": (9, {"SI": "1", "ST": "3*", "CWE": "4 9*", "XCN": "5", "DTM": "6 7 8"}),
    "SPM": (35, {"SI": "1", "EIP": "2 3*", "CWE": "4 5* 6* 7 8 9* 10 11* 15* 16* 21* 22 23 24* 27 28 29", "CQ": "12 25", "INT": "13 26", "ST": "14*", "DR": "17", "DTM": "18 19 33 34", "CX": "30* 31*", "EI": "32"}),
    "IN1": (55, {"SI": "1", "CWE": "2 15 17 20 21 27 31 32 35 42 43 46 47 48 50 53 54*", "CX": "3* 10* 49*", "XON": "4* 9* 11*", "XAD": "5* 19* 44*", "XPN": "6* 16*", "XTN": "7*", "DTM": "12 13 18 24 26 29 51", "AUI": "14", "XCN": "30*", "INT": "33 34 39", "CP": "37 38 40 41"}),
    "GT1": (57, {"SI": "1", "CX": "2* 19* 29*", "XPN": "3* 4* 16* 42* 45*", "XAD": "5* 17*", "XTN": "6* 7* 18* 46*", "DTM": "8 13 14 24 31 32", "CWE": "9 10 11 20 23 26 30 33 34* 35* 36 37 38 40 41 43 44* 47 48 52 53 55* 57", "INT": "15 28", "XON": "21* 51*", "CP": "27", "JCC": "50", "FC": "54"}),
    "FT1": (56, {"SI": "1", "CX": "2 30 38 39", "DR": "4", "DTM": "5", "CWE": "6 7 13 14 17 18 19* 25 26* 27 28 29 34 36* 37 40 41 45 53 55* 56", "INT": "10", "CP": "11 12 15 22", "PL": "16", "XCN": "20* 21* 24*", "EI": "23", "ST": "31*", "XON": "32* 33", "CQ": "43", "MO": "51 52"}),
    "RXA": (29, {"INT": "1 2", "DTM": "3 4 16* 22", "CWE": "5 7 8 9* 14 17* 18* 19* 24 25", "XCN": "10*", "ST": "15*", "PL": "27", "XAD": "28", "EI": "29*"}),
    "SCH": (28, {"EI": "1 2 4 23 24 26* 27*", "INT": "3 9", "TQ": "11*", "CWE": "5 6 7 8 10 25", "XCN": "12* 16* 20*", "XTN": "13 17 21*", "XAD": "14* 18*", "PL": "15 19 22", "EIP": "28"}),
    "TXA": (28, {"SI": "1", "CWE": "2 24* 28", "DTM": "4 6 7 8* 26", "XCN": "5* 9* 10* 11* 22* 23*", "EI": "12 13 14* 15", "ST": "25*", "HD": "27"}),
}
GENERIC_FIELDS = 25
REPEATING = {s for s, (_, kinds) in SEGMENTS.items() if kinds.get("SI") == "1"}

_plain: dict[str, Callable[[Column], Column]] = {
    "ST": lambda c: c,
    "SI": lambda c: c.try_cast("int"),
    "INT": lambda c: c.try_cast("int"),
    "NM": lambda c: c.try_cast("double"),
    "DTM": hl7_ts,
}


def register_kind(name: str, components: str | None = None, convert: Callable[[Column], Column] | None = None) -> None:
    """A further composite (component names) or plain kind (a function from Column to Column)."""
    if components:
        COMPOSITES[name] = components
    else:
        _plain[name] = convert or (lambda c: c)


def register_segment(name: str, fields: int, kinds: dict[str, str]) -> None:
    SEGMENTS[name] = (fields, kinds)


def split_batches(files: DataFrame, text: str = "value") -> DataFrame:
    """Messages of batch files, one row each: line ends made equal, envelope lines (FHS BHS BTS FTS) dropped, cut before MSH."""
    lines = F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), r"(?m)^(FHS|BHS|BTS|FTS).*$\n?", "")
    parts = F.split(lines, r"(?m)(?=^MSH)")
    kept = F.filter(F.transform(parts, F.trim), lambda m: m.startswith("MSH"))
    return files.select(*[c for c in files.columns if c != text], F.posexplode(kept).alias("message_index", "message"))


SEPARATORS = {"field": 4, "component": 5, "repetition": 6, "escape": 7, "subcomponent": 8}
_LETTERS = {"field": "F", "component": "S", "repetition": "R", "escape": "E", "subcomponent": "T"}
#: Each message's separators are rewritten to the first five characters, so that all splits have a constant pattern, and its
#: escaped ones to the other five, which stand for the same separators as text.
_SPLIT = dict(zip(SEPARATORS, "\x01\x02\x03\x04\x05", strict=True))
_TEXT = dict(zip(SEPARATORS, "\x0e\x0f\x10\x11\x12", strict=True))


def unescape(text: Column) -> Column:
    r"""``\F\ \S\ \T\ \R\ \H\ \N\`` and then ``\E\`` of a message whose separators are rewritten."""
    e, out = _SPLIT["escape"], text
    for k in ("field", "component", "subcomponent", "repetition"):
        out = F.replace(out, F.lit(f"{e}{_LETTERS[k]}{e}"), F.lit(_TEXT[k]))
    out = F.replace(F.replace(out, F.lit(f"{e}H{e}")), F.lit(f"{e}N{e}"))
    return F.when(text.rlike(f"{e}[A-Z.]"), F.replace(out, F.lit(f"{e}E{e}"), F.lit(_TEXT["escape"]))).otherwise(text)


def plain(c: Column) -> Column:
    """A value as text again, the message's own separators put back; empty is null."""
    return F.call_function("translate", F.nullif(c, F.lit("")), F.lit("".join([*_SPLIT.values(), *_TEXT.values()])), F.concat(F.col("separators"), F.col("separators")))


def _inner(c: Column) -> Column:
    """A line, or its name, with the message's separators rewritten and escaped ones told apart."""
    return unescape(F.call_function("translate", c, F.col("separators"), F.lit("".join(_SPLIT.values()))))


def _name(line: Column) -> Column:
    """The segment name of a raw line; only what lies before the first field separator is rewritten."""
    return F.substring_index(_inner(F.call_function("substring_index", line, F.left("separators", F.lit(1)), F.lit(1))), _SPLIT["field"], 1)


def _lines(messages: DataFrame, message: str) -> DataFrame:
    """Each message with its metadata, its separators and ``__lines``, its segments as they came; null where it does not begin with MSH.

    Lines are rewritten after they have become rows, so that a message's are rewritten once each and only those that are asked for. A filter on
    the message would render it twice where it is made by an expression.
    """
    default = {"field": "|", "component": "^", "repetition": "~", "escape": "\\", "subcomponent": "&"}
    own = F.concat(*(F.coalesce(F.nullif(F.substring(message, i, 1), F.lit("")), F.lit(default[k])) for k, i in SEPARATORS.items()))
    m = messages.withColumn("separators", own)
    m = m.withColumn("__lines", F.when(F.col(message).startswith("MSH"), F.filter(F.split(message, "[\r\n]+"), lambda x: x != "")))
    head = F.split(_inner(F.get("__lines", F.lit(0))), _SPLIT["field"])
    first = lambda n: F.nullif(F.get(head, F.lit(n - 1)), F.lit(""))
    m = m.withColumns({"message_id": plain(first(10)), "message_timestamp": hl7_ts(first(7)), "hl7_version": F.nullif(F.split_part(first(12), F.lit(_SPLIT["component"]), F.lit(1)), F.lit(""))})
    return m.drop(message)


def _fields(rows: DataFrame) -> DataFrame:
    """``raw_segment``, ``segment`` and ``fields`` from the raw line ``__s``; MSH fields count from the separator, so they are shifted by one."""
    parts = F.split(_inner(F.col("__s")), _SPLIT["field"])
    rows = rows.withColumns({"raw_segment": F.col("__s"), "segment": _name(F.col("__s")), "__parts": parts}).drop("__s")
    shifted = F.concat(F.array(F.lit("MSH"), F.lit(_SPLIT["field"])), F.slice("__parts", 2, F.greatest(F.size("__parts") - 1, F.lit(0))))
    return rows.withColumn("fields", F.when(F.col("segment") == "MSH", shifted).otherwise(F.col("__parts"))).drop("__parts")


def segments(messages: DataFrame, message: str = "message") -> DataFrame:
    """One row for each segment with its ordinal, ``segment`` name, ``fields`` and the metadata of its message.

    A message without MSH is dropped. MSH fields count from the separator, so they are shifted by one. Field zero is the name.
    """
    m = _lines(messages, message)
    return _fields(m.select(*[c for c in m.columns if c != "__lines"], F.posexplode("__lines").alias("ordinal", "__s")))


def field(n: int) -> Column:
    """Field ``n`` of a segment row, from 1, separators rewritten; empty is null."""
    return F.nullif(F.get("fields", F.lit(n)), F.lit(""))


def repetitions(c: Column) -> Column:
    return F.split(c, _SPLIT["repetition"])


def component(c: Column, n: int) -> Column:
    """Component ``n`` of a field value as text; empty is null."""
    return plain(F.get(F.split(c, _SPLIT["component"]), F.lit(n - 1)))


def subcomponent(c: Column, n: int) -> Column:
    """Subcomponent ``n`` of a component whose separators are rewritten."""
    return plain(F.get(F.split(c, _SPLIT["subcomponent"]), F.lit(n - 1)))


def typed_field(n: int, kind: str, repeating: bool) -> Column:
    """Field ``n`` as its kind: a struct of components, an array of them, or a plain value.

    Components are taken inside ``transform``, which splits a value once and keeps generated code small however many
    fields a segment has.
    """
    if kind == "DR":  # a range of times
        return F.when(field(n).isNotNull(), F.struct(hl7_ts(component(field(n), 1)).alias("start"), hl7_ts(component(field(n), 2)).alias("end")))
    value = f"nullif(get(fields, {n}), '')"
    repeated = f"split({value}, '{_SPLIT['repetition']}')"
    if kind in COMPOSITES:
        parts = ", ".join(f"'{name}', {_plain_sql(value)}" for name, value in _components(kind))
        made = f"transform(transform({repeated}, r -> split(r, '{_SPLIT['component']}')), p -> named_struct({parts}))"
        return F.expr(made if repeating else f"get({made}, 0)")
    if repeating:
        return F.transform(F.expr(f"transform({repeated}, r -> {_plain_sql('r')})"), _plain[kind])
    return _plain[kind](F.expr(_plain_sql(value)))


def _components(kind: str) -> list[tuple[str, str]]:
    """Names of a composite's components and subcomponents, each with its place in the split value ``p``."""
    out = []
    for i, name in enumerate(COMPOSITES[kind].split()):
        names = name.split("/")
        out += [(name, f"get(p, {i})")] if len(names) == 1 else [(n, f"get(split(get(p, {i}), '{_SPLIT['subcomponent']}'), {k})") for k, n in enumerate(names)]
    return out


def _plain_sql(c: str) -> str:
    """``plain`` as SQL text: one expression instead of many calls for segments with hundreds of components."""
    return f"translate(nullif({c}, ''), '{''.join([*_SPLIT.values(), *_TEXT.values()])}', concat(separators, separators))"


METADATA = ("message_id", "message_timestamp", "hl7_version")


def segment_table(messages: DataFrame, segment: str, carry: tuple[str, ...] = (), message: str = "message", names: dict[str, str] | None = None) -> DataFrame:
    """The typed table of one segment: message metadata, ``set_id``, columns ``<segment>_<position>``, ``raw_segment``.

    Unknown segments, those starting with Z among them, have ``field_1`` to ``field_25`` as text. ``set_id`` is the segment's own or else its
    position among its message's segments of the name; zero is kept. A message's segments of the name are picked and numbered in its own
    array before rows are made, so messages are told apart whatever their ids, and nothing is shuffled.

    ``names`` gives columns names of the user's own by place: ``{"pid_7": "date_of_birth", "pid_3": "patient_id"}`` for fields, and
    ``{"msh_3.namespace": "sending_application"}`` for a component as a column, right after the field's own.
    """
    made = _segment_table(messages, segment, carry, message)
    names = names or {}
    unknown = [p for p in names if p.split(".")[0] not in made.columns]
    if unknown:
        raise ValueError(f"{segment} has no {', '.join(unknown)}")
    out = []
    for c in made.columns:
        out.append(F.col(f"`{c}`").alias(names.get(c, c)))
        out += [F.col(p).alias(n) for p, n in names.items() if p.startswith(f"{c}.")]
    return made.select(*out)


def _segment_table(messages: DataFrame, segment: str, carry: tuple[str, ...], message: str) -> DataFrame:
    """``segment_table`` with columns named by position.
    """
    m = _lines(messages, message)
    mine = F.filter("__lines", lambda x: _name(x) == segment)
    own = _fields(m.select(*carry, *METADATA, "separators", F.posexplode(mine).alias("__n", "__s")))
    if segment in SEGMENTS:
        count, kinds = SEGMENTS[segment]
        by = {int(p.strip("*")): (k, p.endswith("*")) for k, places in kinds.items() for p in places.split()}
        columns = [typed_field(n, *by.get(n, ("ST", False))).alias(f"{segment.lower()}_{n}") for n in range(1, count + 1)]
    else:
        columns = [F.expr(_plain_sql(f"get(fields, {n})")).alias(f"field_{n}") for n in range(1, GENERIC_FIELDS + 1)]
    given = field(1).try_cast("int") if segment in REPEATING else F.lit(None).cast("int")
    return own.select(*carry, *METADATA, F.coalesce(given, F.col("__n") + 1).alias("set_id"), *columns, "raw_segment")
