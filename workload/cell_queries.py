"""Names, cells and redaction: N1 to N8, T1 to T20, R1 to R9."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.functions import cells, masking, names
from loomsync.operators import catalog
from loomsync.spec import ColumnSpec, TableSpec
from workload.base import Registry
from workload.inputs import Inputs

registry = Registry()
query = registry.add

# --- names -----------------------------------------------------------------

# Fixed values in this file: patterns of numbers, dates, statements and identifiers, prefixes, suffixes, mask texts.
_WORDS = ", ".join(f"'{w}'" for w in sorted(names.RESERVED_WORDS))
IDENTIFIER = f"""
WITH a AS (SELECT {{key}} AS k, upper(regexp_replace(regexp_replace({{name}}, '[^A-Za-z0-9_]+', '_', 'g'),
                  '^_+|_+$', '', 'g')) AS s FROM {{source}}),
b AS (SELECT k, CASE WHEN regexp_matches(s, '^[0-9]') THEN 'C_' || s ELSE s END AS s FROM a),
c AS (SELECT k, CASE WHEN s IN ({_WORDS}) THEN 'SF_' || s ELSE s END AS s FROM b),
d AS (SELECT k, CASE WHEN length(s) > 128 THEN regexp_replace(substr(s, 1, 128), '_+$', '') ELSE s END AS s FROM c)
"""


@query(
    "N1_canonical_identifier",
    IDENTIFIER.format(key="name", name="name", source="names")
    + " SELECT k AS name, nullif(s, '') AS identifier FROM d",
    "names",
)
def identifiers(t: Inputs) -> DataFrame:
    return t["names"].select("name", names.canonical_identifier(F.col("name")).alias("identifier"))


@query(
    "N2_cross_system_name",
    "SELECT name_id, CASE WHEN source_system = target_system THEN name"
    " WHEN source_system = 'salesforce' THEN CASE WHEN lower(name) LIKE 'ora\\_%' ESCAPE '\\'"
    " THEN regexp_replace(substr(name, 5), '(?i)__c$', '') ELSE 'SF_' || name END"
    " WHEN upper(name) LIKE 'SF\\_%' ESCAPE '\\' THEN substr(name, 4) ELSE 'ora_' || lower(name) || '__c' END"
    " AS target_name FROM table_names",
    "table_names",
)
def cross_names(t: Inputs) -> DataFrame:
    made = names.cross_system_name(F.col("name"), F.col("source_system"), F.col("target_system"))
    return t["table_names"].select("name_id", made.alias("target_name"))


@query(
    "N3_managed_table",
    "SELECT name_id, CASE WHEN source_system = 'salesforce' THEN regexp_matches(lower(name), '^ora_.*__c$')"
    " ELSE upper(name) LIKE 'SF\\_%' ESCAPE '\\' END AS is_managed FROM table_names",
    "table_names",
)
def managed(t: Inputs) -> DataFrame:
    return t["table_names"].select(
        "name_id", names.is_managed_table(F.col("name"), F.col("source_system")).alias("is_managed")
    )


@query(
    "N4_statement_object",
    "SELECT statement_id, nullif(regexp_extract(regexp_replace(statement, '\\(.*?\\)', '', 'g'),"
    " '(?i)\\bFROM\\s+([a-zA-Z0-9_]+)', 1), '') AS object_name FROM statements",
    "statements",
)
def statement_objects(t: Inputs) -> DataFrame:
    return t["statements"].select("statement_id", names.statement_object(F.col("statement")).alias("object_name"))


@query(
    "N5_digits_only",
    "SELECT doc_id, regexp_replace(ssn, '\\D', '', 'g') AS digits FROM sensitive",
    "sensitive",
)
def digits(t: Inputs) -> DataFrame:
    return t["sensitive"].select("doc_id", names.digits_only(F.col("ssn")).alias("digits"))


@query("N6_nul_strip", "SELECT row_id, replace(note, chr(0), '') AS note FROM cells", "cells")
def nul_strip(t: Inputs) -> DataFrame:
    return t["cells"].select("row_id", names.strip_nul(F.col("note")).alias("note"))


@query(
    "N7_iso8601_escaped",
    "SELECT event_id, replace(replace(strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00', ':', '%3A'), '+', '%2B') AS stamp"
    " FROM events",
)
def escaped_stamps(t: Inputs) -> DataFrame:
    return t["events"].select("event_id", names.iso8601_escaped(F.col("ts")).alias("stamp"))


@query("N8_initial", "SELECT member_id, substr(middle_name, 1, 1) AS middle_initial FROM members", "members")
def initials(t: Inputs) -> DataFrame:
    return t["members"].select("member_id", names.initial(F.col("middle_name")).alias("middle_initial"))


# --- text to typed ---------------------------------------------------------

_BOOL = "lower(nullif(flag, '')) = 'true'"
_INT = "CASE WHEN regexp_matches({c}, '^\\s*[+-]?[0-9]+\\s*$') THEN try_cast(trim({c}) AS BIGINT) END"
_REAL = "CASE WHEN regexp_matches(real_text, '^[+-]?[0-9.]+([eE][+-]?[0-9]+)?$') THEN try_cast(real_text AS DOUBLE) END"
_PLAIN = "try_cast(trim(nullif(money, '')) AS DECIMAL(38,10))"
_DAY = "CASE WHEN regexp_matches(day, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN try_cast(day AS DATE) END"
_OFFSET = "([+-])([0-9]{2}):?([0-9]{2})$"
_STAMP = (
    f"CASE WHEN regexp_matches(stamp, '{_OFFSET}') THEN try_cast(regexp_replace(stamp, '{_OFFSET}', '') AS TIMESTAMP)"
    f" - to_minutes(CASE WHEN regexp_extract(stamp, '{_OFFSET}', 1) = '-' THEN -1 ELSE 1 END"
    f" * (60 * try_cast(regexp_extract(stamp, '{_OFFSET}', 2) AS INTEGER)"
    f" + try_cast(regexp_extract(stamp, '{_OFFSET}', 3) AS INTEGER))) ELSE try_cast(nullif(stamp, '') AS TIMESTAMP) END"
)
_CLOCK = (
    "CASE WHEN regexp_matches(rtrim(clock, 'Z'), '^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\\.[0-9]+)?)?$')"
    " THEN rtrim(clock, 'Z') END"
)
_TYPES = {
    "flag": "boolean", "whole": "int", "real_text": "double", "money": "currency", "day": "date",
    "stamp": "datetime", "clock": "time", "yn": "string",
}
_BAD = " + ".join(
    f"CASE WHEN nullif({c}, '') IS NOT NULL AND ({e}) IS NULL THEN 1 ELSE 0 END"
    for c, e in {
        "whole": _INT.format(c="whole"), "real_text": _REAL, "money": _PLAIN, "day": _DAY,
        "stamp": _STAMP, "clock": _CLOCK,
    }.items()
)


@query(
    "T1_cast_text_frame",
    f"SELECT row_id, {_BOOL} AS flag, {_INT.format(c='whole')} AS whole, {_REAL} AS real_text, {_PLAIN} AS money,"
    f" {_DAY} AS day, {_STAMP} AS stamp, {_CLOCK} AS clock, nullif(yn, '') AS yn, {_BAD} AS n_rejects FROM cells",
    "cells",
)
def cast_text(t: Inputs) -> DataFrame:
    typed = cells.cast_text_frame(t["cells"].drop("note"), _TYPES)
    return typed.select(
        "row_id", "flag", "whole", "real_text", "money", "day", F.col("stamp").cast("timestamp_ntz").alias("stamp"),
        "clock", "yn", F.size(cells.REJECTS).alias("n_rejects"),
    )


def _one(name: str, sql: str, column: str, make) -> None:
    query(name, f"SELECT row_id, {sql} AS value FROM cells", "cells")(
        lambda t: t["cells"].select("row_id", make(F.col(column)).alias("value"))
    )


_one("T2_to_bool", _BOOL, "flag", cells.to_bool)
_one("T3_to_int", _INT.format(c="whole"), "whole", cells.to_int)
_one("T3_to_double", _REAL, "real_text", cells.to_double)
_one("T4_to_decimal_plain", _PLAIN, "money", cells.to_decimal_plain)
_one("T5_to_date_iso", _DAY, "day", cells.to_date_iso)
_one("T6_to_datetime_iso", _STAMP, "stamp", lambda c: cells.to_datetime_iso(c).cast("timestamp_ntz"))
_one("T7_to_time", _CLOCK, "clock", cells.to_time)


@query(
    "T8_to_text",
    "SELECT event_id, CASE WHEN value > 50 THEN 'true' WHEN value <= 50 THEN 'false' ELSE '' END AS flag,"
    " CASE WHEN date_part('microseconds', ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    " ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS stamp, strftime(ts, '%Y-%m-%d') AS day,"
    " CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS who, CAST(value AS VARCHAR) AS amount,"
    " '[\"' || event_type || '\"]' AS tags FROM events",
)
def to_text(t: Inputs) -> DataFrame:
    who = F.when(F.col("event_id") % 4 != 0, F.col("user_id"))
    return t["events"].select(
        "event_id",
        cells.to_text(F.col("value") > 50, "boolean").alias("flag"),
        cells.to_text(F.col("ts"), "timestamp_ntz").alias("stamp"),
        cells.to_text(F.col("ts").cast("date"), "date").alias("day"),
        cells.to_text(who, "bigint").alias("who"),
        cells.to_text(F.col("value"), "double").alias("amount"),
        cells.to_text(F.array("event_type"), "array").alias("tags"),
    )


@query(
    "T9_omit_nulls",
    "SELECT member_id, '{' || array_to_string(list_filter(["
    " '\"first_name\":\"' || first_name || '\"',"
    " CASE WHEN member_id % 5 = 0 THEN '\"email_addr\":null' ELSE '\"email_addr\":\"' || email_addr || '\"' END,"
    " '\"dt_of_death\":\"' || CAST(dt_of_death AS VARCHAR) || '\"'], lambda x: x IS NOT NULL), ',') || '}' AS body"
    " FROM members",
    "members",
)
def omit_nulls(t: Inputs) -> DataFrame:
    clear = F.when(F.col("member_id") % 5 == 0, F.array(F.lit("email_addr")))
    fields = {c: F.col(c) for c in ("first_name", "email_addr", "dt_of_death")}
    return t["members"].select("member_id", cells.omit_nulls(fields, clear).alias("body"))


@query(
    "T9_typed_fields",
    "SELECT event_id, '{' || array_to_string(list_filter(["
    " CASE WHEN event_id % 3 > 0 THEN '\"flag\":\"' || CASE WHEN value > 50 THEN 'true' ELSE 'false' END || '\"' END,"
    " '\"stamp\":\"' || CASE WHEN date_part('microseconds', ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    " ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '\"', '\"day\":\"' || strftime(ts, '%Y-%m-%d') || '\"',"
    " CASE WHEN event_id % 4 > 0 THEN '\"who\":\"' || CAST(user_id AS VARCHAR) || '\"' END, '\"amount\":\"' || CAST(value AS VARCHAR) || '\"'"
    "], lambda x: x IS NOT NULL), ',') || '}' AS body FROM events",
)
def typed_fields(t: Inputs) -> DataFrame:
    """Fields that are no text are sent as a CRM wants them."""
    at = F.col("event_id")
    fields = {
        "flag": F.when(at % 3 > 0, F.col("value") > 50), "stamp": F.col("ts"), "day": F.col("ts").cast("date"),
        "who": F.when(at % 4 > 0, F.col("user_id")), "amount": F.col("value"),
    }
    kinds = {"flag": "boolean", "stamp": "timestamp_ntz", "day": "date", "who": "bigint", "amount": "double"}
    return t["events"].select("event_id", cells.omit_nulls(fields, kinds=kinds).alias("body"))


# --- typed to target -------------------------------------------------------

_NUL_FREE = "replace({c}, chr(0), '')"
_BLANK = f"CASE WHEN regexp_matches({_NUL_FREE}, '\\S') THEN {_NUL_FREE} END"
_NUMBER = "try_cast(replace(trim(money), ',', '') AS DECIMAL(38,10))"
_HEAD = "substr(trim(day), 1, 10)"
_NDATE = f"CASE WHEN regexp_matches({_HEAD}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') THEN try_cast({_HEAD} AS DATE) END"
_BARE = "regexp_replace(stamp, '[+-][0-9]{2}:[0-9]{2}$', '')"
_NSTAMP = (
    f"CASE WHEN regexp_matches({_BARE}, '^[0-9-]+(T[0-9:]+(\\.[0-9]{{1,6}})?| [0-9:]+)$')"
    f" THEN try_cast({_BARE} AS TIMESTAMP) END"
)
_TRIMMED = f"nullif(regexp_replace({_NUL_FREE}, '^\\s+|\\s+$', '', 'g'), '')"
_YN = "CASE WHEN length(flag) > 0 THEN 'Y' WHEN length(flag) = 0 THEN 'N' END"

_TARGET = TableSpec(
    "CELLS",
    columns=(
        ColumnSpec("row_id", "NUMBER", "integer"),
        ColumnSpec("flag", "VARCHAR2", "boolean"),
        ColumnSpec("money", "NUMBER", "float"),
        ColumnSpec("day", "DATE", "date"),
        ColumnSpec("stamp", "TIMESTAMP", "datetime"),
        ColumnSpec("yn", "CLOB"),
        ColumnSpec("note", "VARCHAR2", max_length=40),
    ),
)


@query(
    "T10_normalize_frame",
    f"SELECT CAST(row_id AS DECIMAL(38,10)) AS row_id, {_YN} AS flag, {_NUMBER} AS money, {_NDATE} AS day,"
    f" {_NSTAMP} AS stamp, {_BLANK.format(c='yn')} AS yn, {_TRIMMED.format(c='note')} AS note,"
    f" CASE WHEN {_BLANK.format(c='day')} IS NOT NULL AND {_NDATE} IS NULL THEN 1 ELSE 0 END"
    f" + CASE WHEN {_BLANK.format(c='stamp')} IS NOT NULL AND {_NSTAMP} IS NULL THEN 1 ELSE 0 END AS n_rejects FROM cells",
    "cells",
)
def normalize(t: Inputs) -> DataFrame:
    rows = t["cells"].select("row_id", "flag", "money", "day", "stamp", "yn", "note")
    done = cells.normalize_frame(rows, _TARGET)
    lower = [F.col(c).alias(c.lower()) for c in done.columns if c != cells.REJECTS]
    return done.select(*lower, F.size(cells.REJECTS).alias("n_rejects"))


query(
    "T11_norm_bool_yn",
    f"SELECT row_id, {_YN} AS from_text, CASE WHEN {_BOOL} THEN 'Y' WHEN NOT {_BOOL} THEN 'N' END AS from_flag FROM cells",
    "cells",
)(
    lambda t: t["cells"].select(
        "row_id",
        cells.norm_bool_yn(F.col("flag"), True).alias("from_text"),
        cells.norm_bool_yn(cells.to_bool(F.col("flag")), False).alias("from_flag"),
    )
)
_one("T12_yn_to_bool", "upper(trim(yn)) = 'Y'", "yn", cells.yn_to_bool)
_one("T13_norm_blank_null", _BLANK.format(c="note"), "note", cells.norm_blank_null)
_one("T14_norm_number", _NUMBER, "money", cells.norm_number)
_one("T15_norm_date", _NDATE, "day", cells.norm_date)
_one("T16_norm_timestamp", _NSTAMP, "stamp", cells.norm_timestamp)
_one("T17_norm_text", _TRIMMED.format(c="note"), "note", cells.norm_text)


_RECORD = {
    "mq_id": "n", "pid": "s", "first_name": "s", "middle_name": "s", "last_name": "s", "name_suffix_id": "n",
    "birthdate": "s", "dt_of_death": "s", "email_addr": "s", "gender_id": "n", "phone": "s", "phone_type_id": "n",
    "city": "s", "mq_status": "n",
}
_QUOTED = {"n": "CAST({c} AS VARCHAR)", "s": "'\"' || CAST({c} AS VARCHAR) || '\"'"}
_LINES = " || ',' || chr(10) || ".join(
    f"'  \"{c}\" : ' || coalesce({_QUOTED[kind].format(c=c)}, 'null')" for c, kind in _RECORD.items()
)


@query(
    "T18_record_json",
    f"SELECT mq_id, '{{' || chr(10) || {_LINES} || chr(10) || '}}' AS json_record FROM inbound",
    "inbound",
)
def record_json(t: Inputs) -> DataFrame:
    return t["inbound"].select("mq_id", cells.record_json(list(_RECORD)).alias("json_record"))


query(
    "T19_status_class",
    "SELECT event_id, CAST(200 + event_id % 300 AS BIGINT) AS code,"
    " CAST((200 + event_id % 300) // 100 * 100 AS INTEGER) AS code_class FROM events",
)(
    lambda t: t["events"]
    .select("event_id", (F.lit(200) + F.col("event_id") % 300).alias("code"))
    .withColumn("code_class", cells.status_class(F.col("code")))
)


@query(
    "T20_default_on_null",
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 202 ELSE 304 END AS mq_status, 'loader' AS created_by,"
    " CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE ts END AS created_at FROM events",
)
def defaults(t: Inputs) -> DataFrame:
    rows = t["events"].select(
        "event_id",
        F.when(F.col("event_id") % 3 != 0, 304).alias("mq_status"),
        F.when(F.col("event_id") % 2 != 0, F.col("ts")).alias("created_at"),
    )
    fixed = {
        "mq_status": F.lit(202),
        "created_by": F.lit("loader"),
        "created_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
    }
    return cells.default_on_null(rows, fixed)


# --- redaction -------------------------------------------------------------

SECRET = b"unit-test-key"
_PATTERN = "\\b[0-9]{3}[-\\s]?[0-9]{2}[-\\s]?[0-9]{4}\\b"


def _blob(mask: int) -> str:
    return "'" + "".join(f"\\x{b ^ mask:02X}" for b in SECRET.ljust(64, b"\0")) + "'::BLOB"


def _token(text: str) -> str:
    inner = f"unhex(sha256({_blob(0x36)} || encode(regexp_replace({text}, '\\D', '', 'g'))))"
    return f"'SSN:' || substr(sha256({_blob(0x5C)} || {inner}), 1, 12)"


_PART = (
    "'***-**-' || CASE WHEN length(regexp_replace(ssn, '\\D', '', 'g')) >= 4"
    " THEN right(regexp_replace(ssn, '\\D', '', 'g'), 4) ELSE '****' END"
)


def _field(name: str, sql: str, strategy) -> None:
    query(name, f"SELECT doc_id, CASE WHEN trim(ssn) <> '' THEN {sql} ELSE ssn END AS ssn FROM sensitive", "sensitive")(
        lambda t: t["sensitive"].select("doc_id", masking.redact_field(F.col("ssn"), strategy).alias("ssn"))
    )


def _scan(name: str, sql: str, strategy) -> None:
    query(name, f"SELECT doc_id, {sql} AS text FROM sensitive", "sensitive")(
        lambda t: t["sensitive"].select("doc_id", masking.redact_scan(F.col("text"), strategy).alias("text"))
    )


_hash = masking.hash_mask
_field("R1_redact_field_full", "'***-**-****'", masking.strategy_for("full-mask"))
_field("R2_redact_field_part", _PART, masking.strategy_for("part_mask"))


@query(
    "R3_redact_field_hash",
    f"SELECT doc_id, CASE WHEN trim(ssn) <> '' THEN {_token('ssn')} ELSE ssn END AS ssn FROM sensitive",
    "sensitive",
)
def redact_hash(t: Inputs) -> DataFrame:
    return t["sensitive"].select("doc_id", masking.redact_field(F.col("ssn"), _hash(SECRET)).alias("ssn"))


_scan("R4_redact_scan_full", f"regexp_replace(text, '{_PATTERN}', '***-**-****', 'g')", masking.strategy_for("full_mask"))
_scan(
    "R5_redact_scan_part",
    "regexp_replace(text, '\\b[0-9]{3}[-\\s]?[0-9]{2}[-\\s]?([0-9]{4})\\b', '***-**-\\1', 'g')",
    masking.strategy_for("part_mask"),
)


@query(
    "R6_redact_scan_hash",
    f"WITH cut AS (SELECT doc_id, string_split_regex(text, '{_PATTERN}') AS parts,"
    f" regexp_extract_all(text, '{_PATTERN}') AS hits FROM sensitive)"
    " SELECT doc_id, array_to_string(list_transform(range(1, len(parts) + 1),"
    f" lambda i: parts[i] || coalesce({_token('hits[i]')}, '')), '') AS text FROM cut",
    "sensitive",
)
def redact_scan_hash(t: Inputs) -> DataFrame:
    return t["sensitive"].select("doc_id", masking.redact_scan(F.col("text"), _hash(SECRET)).alias("text"))


_scan("R7_redact_none", "text", masking.strategy_for("none"))


@query(
    "R8_redact_plan",
    f"SELECT doc_id AS \"Id\", source AS \"Subject\", regexp_replace(text, '{_PATTERN}', '***-**-****', 'g')"
    " AS \"Description\" FROM sensitive",
    "sensitive",
)
def redact_plan(t: Inputs) -> DataFrame:
    case = t["sensitive"].select(
        F.col("doc_id").alias("Id"), F.col("source").alias("Subject"), F.col("text").alias("Description")
    )
    plan = catalog.redaction_plan("salesforce", "Case", case.columns)
    return masking.apply_plan(case, plan, masking.strategy_for("full_mask"))




def _count(column: str) -> str:
    return f"len(regexp_extract_all({column}, '{_PATTERN}'))"


@query(
    "R9_pii_discovery",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'ssn' AS pattern_name, count(*) FILTER ({_count(c)} > 0) AS matching_rows,"
        f" CAST(sum(coalesce({_count(c)}, 0)) AS BIGINT) AS matches FROM sensitive"
        for c in ("text", "ssn", "source")
    ),
    "sensitive",
)
def pii_discovery(t: Inputs) -> DataFrame:
    return masking.discover(t["sensitive"], ["text", "ssn", "source"])
