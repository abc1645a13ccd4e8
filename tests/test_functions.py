"""Literal cases for names, cells, types and redaction."""

import datetime as dt
import hashlib
import hmac
import json
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loomsync.functions import cells, masking, names
from loomsync.functions.fingerprints import differs, fingerprint
from loomsync.operators import catalog
from loomsync.plans import migrate
from loomsync.spec import ColumnSpec, TableSpec, spec_of


def apply(spark, values, make, kind="string"):
    """Values of one column through a Column function, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


IDENTIFIERS = {
    "LastName": "LASTNAME", "AccountId": "ACCOUNTID", "Id": "ID", "already_snake": "ALREADY_SNAKE",
    "LAST_NAME": "LAST_NAME", "Org_PensionIdentification__c": "ORG_PENSIONIDENTIFICATION__C",
    "Select": "SF_SELECT", "123abc": "C_123ABC", " a--b! ": "A_B", "Index": "SF_INDEX",
    "x" * 127 + "_y": "X" * 127,
}


def test_identifiers(spark):
    assert apply(spark, IDENTIFIERS, names.canonical_identifier) == list(IDENTIFIERS.values())
    assert [cells.canonical_name(n) for n in IDENTIFIERS] == list(IDENTIFIERS.values())
    assert apply(spark, ["***", None], names.canonical_identifier) == [None, None]
    suffixed = apply(spark, ["Date"], lambda c: names.canonical_identifier(c, force_suffix=True))
    prefixed = apply(spark, ["9x"], lambda c: names.canonical_identifier(c, force_prefix=True, prefix="ZZ_"))
    assert suffixed == ["DATE_COL"] and prefixed == ["ZZ_9X"]
    with pytest.raises(Exception, match="no identifier"):
        apply(spark, ["!"], lambda c: names.canonical_identifier(c, strict=True))
    with pytest.raises(ValueError):
        cells.canonical_name(" - ")


def test_cross_system_names(spark):
    to_oracle = {"Contact": "SF_Contact", "ora_account__c": "account", "ORA_Thing": "Thing"}
    to_crm = {"SF_CONTACT": "CONTACT", "ACCOUNT": "ora_account__c"}
    one = lambda s, t: lambda c: names.cross_system_name(c, s, t)
    assert apply(spark, to_oracle, one("salesforce", "oracle")) == list(to_oracle.values())
    assert apply(spark, to_crm, one("oracle", "salesforce")) == list(to_crm.values())
    assert apply(spark, ["Foo"], one("oracle", "oracle")) == ["Foo"]
    for name, want in to_oracle.items():
        assert migrate.target_name(name, "salesforce", "oracle") == want
    for name, want in to_crm.items():
        assert migrate.target_name(name, "oracle", "salesforce") == want


def test_statement_object(spark):
    cases = {"SELECT Id FROM Account": "Account", "select x,(select y from Kids) from  Top_1 where a": "Top_1", "x": None}
    assert apply(spark, cases, names.statement_object) == list(cases.values())


def test_text_to_typed(spark):
    assert apply(spark, ["true", "TRUE", "false", "yes", "", None], cells.to_bool) == [True, True, False, False, None, None]
    assert apply(spark, ["42", " 7 ", "+1", "1_000", "3.14", "x"], cells.to_int) == [42, 7, 1, 1000, None, None]
    assert apply(spark, ["3.14", "1e3", ".5", "1d", "abc"], cells.to_double) == [3.14, 1000.0, 0.5, None, None]
    assert apply(spark, ["100.50", "1,2"], cells.to_decimal_plain) == [Decimal("100.5000000000"), None]
    assert apply(spark, ["2020-01-01", "20200101", "2020-13-01", "2020-1-1"], cells.to_date_iso) == [
        dt.date(2020, 1, 1), dt.date(2020, 1, 1), None, None,
    ]
    stamps = ["2024-06-15T12:00:00.000+0000", "2024-06-15T12:00:00Z", "2024-06-15T12:00:00+02:00", "2024-06-15", "no"]
    got = apply(spark, stamps, lambda c: cells.to_datetime_iso(c).cast("string"))
    assert got == ["2024-06-15 12:00:00", "2024-06-15 12:00:00", "2024-06-15 10:00:00", "2024-06-15 00:00:00", None]
    assert apply(spark, ["12:30:00.000Z", "25:00"], cells.to_time) == ["12:30:00.000", None]


def test_record_cast_keeps_bad_text(spark):
    rows = spark.createDataFrame([("001", "30", "true", "x"), ("002", "old", "no", "")], "Id string, Age string, Active string, Other string")
    out = cells.cast_text_frame(rows, {"Id": "id", "Age": "int", "Active": "boolean"}).orderBy("Id").collect()
    assert tuple(out[0])[:4] == ("001", 30, True, "x") and out[0]["_rejects"] == []
    assert out[1]["Age"] is None and [tuple(r) for r in out[1]["_rejects"]] == [("Age", "old")]


def test_typed_to_text(spark):
    assert apply(spark, [True, False, None], lambda c: cells.to_text(c, "boolean"), "boolean") == ["true", "false", ""]
    numbers = [42.0, 3.14, 1e7, 123456789.125, 1e16, 1.5e20, 0.0001, 1e-5, 0.00025, -2.5, 0.0]
    assert apply(spark, numbers, lambda c: cells.to_text(c, "double"), "double") == [str(n) for n in numbers]
    stamp = dt.datetime(2024, 6, 15, 12, 0, 0, 5000)
    assert apply(spark, [stamp, None], lambda c: cells.to_text(c, "timestamp_ntz"), "timestamp_ntz") == [stamp.isoformat(), ""]
    body = apply(spark, [{"a": 1}], lambda c: cells.to_text(c, "map"), "map<string,int>")
    assert json.loads(body[0]) == {"a": 1}


def test_omit_nulls(spark):
    rows = spark.createDataFrame([("x", None, ["b"]), (None, "y", None)], "a string, b string, gone array<string>")
    made = rows.select(cells.omit_nulls({"a": F.col("a"), "b": F.col("b")}, F.col("gone")).alias("j")).collect()
    assert [json.loads(r["j"]) for r in made] == [{"a": "x", "b": None}, {"b": "y"}]


def test_target_cells(spark):
    assert apply(spark, ["   ", "\x00 ", "a\x00b", None], cells.norm_blank_null) == [None, None, "ab", None]
    assert apply(spark, ["3.14", " 1,234 ", "x"], cells.norm_number) == [Decimal("3.1400000000"), Decimal("1234.0000000000"), None]
    assert apply(spark, ["2020-01-01T10:00", "soon"], cells.norm_date) == [dt.date(2020, 1, 1), None]
    stamps = ["2024-06-15T12:00:00", "2024-06-15T12:00:00+05:00", "2024-06-15 12:00:00", "2024-06-15T12:00:00Z", "2024-06-15T12:00:00.5"]
    noon = dt.datetime(2024, 6, 15, 12)
    assert apply(spark, stamps, cells.norm_timestamp) == [noon, noon, noon, None, noon.replace(microsecond=500000)]
    assert apply(spark, [" hello\t"], cells.norm_text) == ["hello"]
    assert apply(spark, ["false", "", None], lambda c: cells.norm_bool_yn(c, True)) == ["Y", "N", None]
    assert apply(spark, [True, False, None], lambda c: cells.norm_bool_yn(c, False), "boolean") == ["Y", "N", None]
    assert apply(spark, [" y ", "N", None], cells.yn_to_bool) == [True, False, None]


def test_normalize_frame_refuses_unknown_columns(spark):
    spec = TableSpec("T", columns=(ColumnSpec("LastName"),))
    rows = spark.createDataFrame([(" Lee ", "1")], "LastName string, Orphan string")
    with pytest.raises(KeyError):
        cells.normalize_frame(rows, spec)
    assert cells.normalize_frame(rows.drop("Orphan"), spec).first()["LASTNAME"] == "Lee"


def test_numbers_are_kept_or_rejected(spark):
    columns = (
        ColumnSpec("big", "NUMBER", "float"), ColumnSpec("wide", "NUMBER", "integer", precision=32, scale=0),
        ColumnSpec("tight", "NUMBER", "float", precision=6, scale=2), ColumnSpec("typed", "NUMBER", "float"), ColumnSpec("n", "NUMBER", "integer"),
    )
    wide, low = Decimal("9" * 32), Decimal("-" + "9" * 32)
    rows = [
        (1, 1e30, wide, 12.25, "1,234.50", 5), (2, 1e-11, low, 0.001, "0.00000000001", None),
        (3, 0.1, None, 12345.0, "1" + "0" * 29, 6), (4, None, None, float("nan"), "x", 7), (5, -2.5, None, -0.0, " 1e-3 ", 8),
        (6, None, None, None, "1e99999999999", 9), (7, None, None, None, "", 9),
    ]
    df = spark.createDataFrame(rows, "i int, big double, wide decimal(32,0), tight double, typed string, n int")
    spec = TableSpec("T", columns=(ColumnSpec("i", "NUMBER", "integer"), *columns))
    got = {r[0]: tuple(r)[1:] for r in cells.normalize_frame(df, spec).collect()}
    rejects = {i: [tuple(x) for x in r[-1]] for i, r in got.items()}
    assert [got[i][0] for i in range(1, 6)] == [1e30, 1e-11, 0.1, None, -2.5]
    assert [got[i][1] for i in (1, 2, 3)] == [wide, low, None]
    assert [got[i][2] for i in range(1, 6)] == [Decimal("12.25"), None, None, None, Decimal("0.00")]
    assert [got[i][3] for i in range(1, 6)] == [Decimal("1234.5"), None, None, None, Decimal("0.001")]
    assert rejects[1] == rejects[5] == rejects[7] == [] and [r[4] for r in got.values()] == [5, None, 6, 7, 8, 9, 9]
    assert rejects[2] == [("TIGHT", "0.001"), ("TYPED", "0.00000000001")]
    assert rejects[3] == [("TIGHT", "12345.0"), ("TYPED", "1" + "0" * 29)]
    assert rejects[4] == [("TIGHT", "NaN")] and rejects[6] == [("TYPED", "1e99999999999")]


def test_currency_text_is_not_rounded(spark):
    rows = spark.createDataFrame([("0.1234567890", ), ("0.12345678901", ), ("1e-11", )], "c string")
    got = [tuple(r) for r in cells.cast_text_frame(rows, {"c": "currency"}).collect()]
    assert [r[0] for r in got] == [Decimal("0.1234567890"), None, None]
    assert [[x["raw"] for x in r[1]] for r in got] == [[], ["0.12345678901"], ["1e-11"]]


def test_record_json(spark):
    rows = spark.createDataFrame([(1, None)], "mq_id int, pid string")
    text = rows.select(cells.record_json(["mq_id", "pid"]).alias("j")).first()["j"]
    assert json.loads(text) == {"mq_id": 1, "pid": None} and list(json.loads(text)) == ["mq_id", "pid"] and "\n" in text


SSN = re.compile(r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b")
TEXTS = [
    "pt SSN 123-45-6789, call back", "spaced 123 45 6789 here", "bare 123456789 nine", "no ssn here", "", None,
    "123-45-6789", "a 123-45-6789 b 987-65-4321", "é123-45-6789", "1234567890", "x123-45-6789", "(123-45-6789)(123456789)",
]


def token(secret, matched):
    return "SSN:" + hmac.new(secret, re.sub(r"\D", "", matched).encode(), hashlib.sha256).hexdigest()[:12]


def test_scan_equals_plain_regex(spark):
    secret = b"unit-test-key"
    for mode, want in {
        "full-mask": lambda m: "***-**-****",
        "part_mask": lambda m: "***-**-" + re.sub(r"\D", "", m.group())[-4:],
        "hash_mask": lambda m: token(secret, m.group()),
    }.items():
        got = apply(spark, TEXTS, lambda c: masking.redact_scan(c, masking.strategy_for(mode, secret)))
        assert got == [None if t is None else SSN.sub(want, t) for t in TEXTS], mode


def test_field_redaction(spark):
    values = ["123-45-6789", "123456789", "   ", None, "12"]
    field = lambda mode: lambda c: masking.redact_field(c, masking.strategy_for(mode, b"k" * 80))
    assert apply(spark, values, field("full_mask")) == ["***-**-****", "***-**-****", "   ", None, "***-**-****"]
    assert apply(spark, values, field("part_mask")) == ["***-**-6789", "***-**-6789", "   ", None, "***-**-****"]
    hashed = apply(spark, values, field("hash_mask"))
    assert hashed[0] == hashed[1] == token(b"k" * 80, "123456789") and hashed[2:4] == ["   ", None]
    assert apply(spark, values, field("none")) == values


def test_modes(monkeypatch):
    monkeypatch.delenv(masking.SECRET_VARIABLE, raising=False)
    assert masking.normalize_mode("  Full-Mask  ") == "full_mask"
    with pytest.raises(ValueError):
        masking.normalize_mode("scramble")
    with pytest.raises(RuntimeError):
        masking.strategy_for("hash-mask")


def test_redaction_plan(spark):
    plan = catalog.redaction_plan("salesforce", "Contact", ["SSN__c", "Name"])
    assert plan == {"SSN__c": "field"}
    rows = spark.createDataFrame([("123-45-6789", "re 222-33-4444", "hi")], "SSN__c string, Description string, Subject string")
    strategy = masking.strategy_for("full_mask")
    out = masking.apply_plan(rows, {"SSN__c": "field", "Description": "scan", "Absent": "field"}, strategy).first()
    assert tuple(out) == ("***-**-****", "re ***-**-****", "hi")


def test_fingerprint_rules(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("", "x"), (None, "x")], "a string, b string")
    got = [r["f"] for r in rows.select(fingerprint([F.col("a"), F.col("b")]).alias("f")).collect()]
    assert got[0] == got[1] == hashlib.md5(b"abc").hexdigest().upper()
    assert got[2] == got[3] == hashlib.md5(b"|x").hexdigest().upper()
    pairs = spark.createDataFrame([(None, None), (None, "|"), ("a", None), ("a", "a")], "a string, b string")
    assert [r["d"] for r in pairs.select(differs(F.col("a"), F.col("b")).alias("d")).collect()] == [False, False, True, False]


def test_type_maps(spark):
    crm = {"id": "string", "int": "integer", "currency": "float", "boolean": "boolean", "datetime": "datetime",
           "time": "time", "base64": "byte", "location": "json", "Mystery": "string"}
    assert apply(spark, crm, catalog.crm_canonical) == list(crm.values())
    definition = {"Text(255)": "string", "Number(18, 0)": "float", "Date/Time": "datetime", "Multi-Select Picklist": "string"}
    assert apply(spark, definition, catalog.definition_canonical) == list(definition.values())
    assert apply(spark, ["NUMBER"], lambda c: catalog.relational_canonical(c, F.lit(0))) == ["integer"]
    assert apply(spark, ["NUMBER"], lambda c: catalog.relational_canonical(c, F.lit(None).cast("int"))) == ["float"]
    assert apply(spark, ["TIMESTAMP(6)", "RAW", "ROWID"], lambda c: catalog.relational_canonical(c, F.lit(None).cast("int"))) == [
        "datetime", "byte", "string",
    ]


def test_target_types(spark):
    cases = [
        ("string", 80, None, None, "VARCHAR2(80 CHAR)"), ("string", None, None, None, "CLOB"), ("string", 5000, None, None, "CLOB"),
        ("integer", None, None, None, "NUMBER"), ("float", None, 18, 2, "NUMBER(18, 2)"), ("float", None, None, None, "NUMBER"),
        ("boolean", None, None, None, "VARCHAR2(1 CHAR)"), ("time", None, None, None, "VARCHAR2(15 CHAR)"),
        ("byte", None, None, None, "BLOB"), ("json", None, None, None, "JSON"), ("bytearray", None, None, None, "VARCHAR2(255 CHAR)"),
    ]
    rows = spark.createDataFrame(cases, "c string, l int, p int, s int, want string")
    made = rows.select(catalog.target_type(F.col("c"), F.col("l"), F.col("p"), F.col("s")).alias("got"), "want").collect()
    assert [r["got"] for r in made] == [r["want"] for r in made]


def test_spec_of_keeps_metadata(spark):
    rows = spark.createDataFrame([(1, "x", Decimal("1.5"))], "ID long, LABEL string, SCORE decimal(18,4)")
    spec = spec_of(rows, "T", key=("ID",))
    assert spec.primary_key == ["ID"]
    assert [c.canonical for c in spec.columns] == ["integer", "string", "float"]
    assert spec.schema()["ID"].metadata["primary_key"] is True
