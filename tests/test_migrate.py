"""Migrations into targets that are there already: reconciled, adapted, partly updated."""

import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loomsync.operators import catalog, guard, loads
from loomsync.plans import migrate
from loomsync.spec import ColumnSpec, TableSpec

SPEC = TableSpec("Contact", "salesforce", columns=(ColumnSpec("Id", max_length=10, is_primary_key=True, is_indexed=True), ColumnSpec("Note", max_length=5, is_nullable=False)))
FIELDS = "Id string, Note string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def load(spark, root, rows, spec=SPEC, **settings):
    return migrate.load_table(spark.createDataFrame(rows, FIELDS), spec, str(root), migrate.Settings(**settings))


def columns_of(spark, root):
    return {c.name: c for c in migrate.description(spark, str(root), "SF_Contact").columns}


def test_columns_follow_the_rows(spark, tmp_path):
    first = load(spark, tmp_path, [("1", "short")])
    assert first.changes == () and (first.processed, first.rejected) == (1, 0)
    wide = load(spark, tmp_path, [("2", "x" * 30), ("3", None)])
    assert wide.changes == (("NOTE", "RELAX", None), ("NOTE", "WIDEN", "80"))
    long = load(spark, tmp_path, [("4", "x" * 5000)])
    assert ("NOTE", "PROMOTE", "CLOB") in long.changes
    note = columns_of(spark, tmp_path)["NOTE"]
    assert (note.raw_type, note.max_length, note.is_nullable) == ("CLOB", None, True)
    assert long.table.count() == 4


def test_a_key_is_never_made_a_lob(spark, tmp_path):
    load(spark, tmp_path, [("1", "a")])
    with pytest.raises(ValueError, match="too long for a key"):
        load(spark, tmp_path, [("2", "b"), ("k" * 4001, "c")])
    assert rows_of(loads.VersionedTable(spark, f"{tmp_path}/SF_Contact").read()) == [("1", "a")]
    assert columns_of(spark, tmp_path)["ID"].max_length == 10


def test_full_load_starts_the_description_anew(spark, tmp_path):
    load(spark, tmp_path, [("1", "x" * 60)])
    assert columns_of(spark, tmp_path)["NOTE"].max_length == 110
    load(spark, tmp_path, [("1", "y")], action="full_load")
    assert columns_of(spark, tmp_path)["NOTE"].max_length == 5


def test_last_row_of_a_key_wins_without_an_order(spark, tmp_path):
    rows = [(str(i % 7), str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, FIELDS).coalesce(1)
    got = migrate.migrate_table(df, SPEC, str(tmp_path), migrate.Settings(action="upsert", buckets=4))
    assert rows_of(got) == sorted((str(k), str(max(i for i in range(50) if i % 7 == k))) for k in range(7))


def test_first_update_makes_an_empty_table(spark, tmp_path):
    done = load(spark, tmp_path, [("1", "a")], action="update")
    assert done.table.count() == 0 and done.table.columns == ["ID", "NOTE"] and done.processed == 1
    with pytest.raises(ValueError, match="needs a key"):
        load(spark, tmp_path / "other", [("1", "a")], spec=SPEC.with_columns(replace(c, is_primary_key=False) for c in SPEC.columns), action="upsert")


def test_stored_values_that_do_not_convert_stop_the_load(spark, tmp_path):
    load(spark, tmp_path, [("1", "a")])
    numeric = SPEC.with_columns([SPEC.columns[0], ColumnSpec("Note", "NUMBER", "integer")])
    with pytest.raises(ValueError, match="do not convert"):
        load(spark, tmp_path, [("2", "7")], spec=numeric)
    load(spark, tmp_path, [("1", "5")], action="reset")
    done = load(spark, tmp_path, [("2", "7")], spec=numeric)
    assert ("NOTE", "MODIFY TYPE", "NUMBER") in done.changes
    assert [(r[0], int(r[1])) for r in rows_of(done.table)] == [("1", 5), ("2", 7)]


def test_decimals_widen_to_hold_both(spark, tmp_path):
    spec = TableSpec("Sum", "salesforce", columns=(ColumnSpec("Id", is_primary_key=True), ColumnSpec("N", "NUMBER", "float", precision=6, scale=4)))
    one = spark.createDataFrame([("1", "1.2345")], "Id string, N string")
    migrate.migrate_table(one, spec, str(tmp_path))
    other = replace(spec, columns=(spec.columns[0], replace(spec.columns[1], precision=9, scale=1)))
    done = migrate.migrate_table(spark.createDataFrame([("2", "12345678.5")], "Id string, N string"), other, str(tmp_path))
    assert dict(done.dtypes)["N"] == "decimal(12,4)"
    assert [str(r["N"]) for r in done.orderBy("ID").collect()] == ["1.2345", "12345678.5000"]


def _files(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def test_a_load_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path / "t")
    table = loads.KeyedTable(spark, root, ["id"], buckets=8)
    table.write(spark.createDataFrame([(i, f"n{i}") for i in range(200)] + [(None, "no key")], "id bigint, name string"))
    every = table.upsert(spark.createDataFrame([(i, "first", 1) for i in range(200)], "id bigint, name string, at int"), "at")
    assert every.count() == 201
    before, folders = _files(root), set(table.folders())
    done = table.upsert(spark.createDataFrame([(5, "new", 2), (5, "older", 1)], "id bigint, name string, at int"), "at")
    after = _files(root)
    assert {p: after[p] for p in before} == before
    assert len(folders - set(table.folders())) == 1 and len(set(table.folders()) - folders) == 1
    assert done.filter("name = 'first'").count() == 199 and rows_of(done.filter("id = 5")) == [(5, "new")]
    assert table.update(spark.createDataFrame([(900, "x"), (None, "y")], "id bigint, name string")).count() == 201
    again = table.upsert(spark.createDataFrame([(None, "loose", 1), (901, "added", 1)], "id bigint, name string, at int"), "at", tag="once")
    assert again.count() == 203 and table.upsert(spark.createDataFrame([(902, "z", 1)], "id bigint, name string, at int"), "at", tag="once").count() == 203


def test_the_number_of_buckets_stays(spark, tmp_path):
    first = loads.KeyedTable(spark, str(tmp_path), ["id"], buckets=3)
    first.write(spark.createDataFrame([(i, "a") for i in range(9)], "id bigint, name string"))
    first.upsert(spark.createDataFrame([(1, "b", 1)], "id bigint, name string, at int"), "at")
    later = loads.KeyedTable(spark, str(tmp_path), ["id"])
    before = set(later.folders())
    assert later.upsert(spark.createDataFrame([(2, "c", 1)], "id bigint, name string, at int"), "at").count() == 9
    assert later.buckets == 3 and len(before & set(later.folders())) == len(before) - 1


def test_no_rows_at_all_keep_their_columns(spark, tmp_path):
    table = loads.KeyedTable(spark, str(tmp_path), ["id"], buckets=4)
    empty = spark.createDataFrame([], "id bigint, name string")
    table.write(empty)
    assert table.update(empty).columns == ["id", "name"]
    assert table.upsert(spark.createDataFrame([(1, "a", 1)], "id bigint, name string, at int"), "at").count() == 1


CRM = TableSpec(
    "Account",
    "salesforce",
    columns=(
        ColumnSpec("Id", "id", is_read_only=True), ColumnSpec("Key__c", "string", is_external_id=True), ColumnSpec("Active__c", "boolean", "boolean"),
        ColumnSpec("Born__c", "date", "date"), ColumnSpec("Amount__c", "double", "float"), ColumnSpec("Sum__c", "double", "float", is_computed=True),
    ),
)


def test_partial_update_of_a_crm_object(spark, tmp_path):
    fields = "KEY__C string, ACTIVE__C boolean, BORN__C string, AMOUNT__C double, SUM__C double, at int"
    settings = migrate.Settings(source_system="oracle", target_system="salesforce", action="upsert", clear_marker="#N/A", buckets=4)
    spec = TableSpec("SF_Account", "oracle")

    def upsert(rows, **more):
        return migrate.load_table(spark.createDataFrame(rows, fields), spec, str(tmp_path), replace(settings, **more), order="at", target=CRM)

    upsert([("a", True, "2020-01-02", 1.5, 9.0, 1), ("b", False, None, None, 9.0, 1)])
    upsert([("a", None, "#N/A", None, None, 2), ("a", False, None, None, None, 3), ("b", None, "2021-05-06", 1e-7, None, 1), (None, True, None, 2.0, None, 1)])
    stored = loads.VersionedTable(spark, f"{tmp_path}/Account").read()
    got = rows_of(stored.select("Key__c", "Active__c", F.col("Born__c").cast("string"), "Amount__c", "Sum__c"))
    assert got == [("a", False, None, 1.5, None), ("b", False, "2021-05-06", 1e-7, None), (None, True, None, 2.0, None)]
    assert dict(stored.dtypes)["Born__c"] == "date"
    with pytest.raises(ValueError, match="do not fit"):
        upsert([("a", None, "soon", None, None, 9)])
    with pytest.raises(ValueError, match="no column for the key"):
        upsert([("a", None, None, None, None, 9)], action="update")
    kept = upsert([("a", None, "soon", 3.0, None, 9)], keep_rejects=True)
    assert (kept.processed, kept.rejected) == (1, 1)
    with pytest.raises(guard.GuardRefused):
        upsert([("z", True, None, None, None, 1)], action="reset")
    assert upsert([("z", True, None, None, None, 1)], action="reset", destructive="yes").table.count() == 1


def test_owners_tell_tables_of_one_name_apart(spark):
    desired = spark.createDataFrame([("A", "T", "C", "VARCHAR2", "string", 10, True), ("B", "T", "C", "VARCHAR2", "string", 10, True)],
        "owner string, table_name string, column_name string, raw_type string, canonical string, max_length int, is_nullable boolean")
    actual = spark.createDataFrame([("A", "T", "C", "VARCHAR2", 10, 10, "Y"), ("B", "T", "C", "VARCHAR2", 3, 3, "Y")],
        "owner string, table_name string, column_name string, data_type string, char_length int, data_length int, nullable string")
    assert rows_of(catalog.schema_drift(desired, actual)) == [("B", "T", "C", "WIDEN", "60")]
    names = "owner string, table_name string, column_name string, ordinal int"
    source = spark.createDataFrame([("A", "T", "my col", 1), ("B", "T", "my col", 1)], names)
    target = spark.createDataFrame([("A", "T", "MY_COL", 1), ("B", "T", "My-Col", 2)], names)
    assert rows_of(catalog.rename_map(source, target)) == [("A", "T", "my col", "MY_COL"), ("B", "T", "my col", "My-Col")]
