"""Loads, guard, catalog, numbering, skew-proof joins and files."""

import pytest
from pyspark.sql import functions as F

from loomsync.operators import catalog, guard, joins, loads, numbering
from loomsync.plans import migrate
from loomsync.session import configure
from loomsync.sources import tables, text_files
from loomsync.spec import ColumnSpec, TableSpec


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_last_wins_and_null_overwrites(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "keep", 2), (None, "loose", 3)], "id int, v string, n int")
    source = spark.createDataFrame(
        [(1, "a", 10, 1), (1, None, 11, 2), (3, "new", 12, 3), (None, "x", 13, 4), (None, "y", 14, 5)],
        "id int, v string, n int, o int",
    )
    once = loads.upsert(target, source, ["id"], "o")
    got = {(r["id"], r["v"], r["n"]) for r in once.collect()}
    assert got == {(1, None, 11), (2, "keep", 2), (3, "new", 12), (None, "loose", 3), (None, "x", 13), (None, "y", 14)}
    keyed = source.filter("id IS NOT NULL")
    twice = loads.upsert(loads.upsert(target, keyed, ["id"], "o"), keyed, ["id"], "o")
    assert twice.exceptAll(loads.upsert(target, keyed, ["id"], "o")).isEmpty()
    with pytest.raises(ValueError):
        loads.upsert(target, source, [], "o")


def test_update_ignores_new_and_overlay_keeps(spark):
    target = spark.createDataFrame([("1", "a", "b"), ("2", "c", "d")], "Id string, x string, y string")
    source = spark.createDataFrame([("1", "n", None, 1), ("1", None, "m", 2), ("9", "z", "z", 3)], "Id string, x string, y string, o int")
    assert rows_of(loads.update(target, source, ["Id"], "o").select("Id", F.coalesce("x", F.lit("-")), "y")) == [("1", "-", "m"), ("2", "c", "d")]
    assert rows_of(loads.overlay(target, source, "Id", "o", ["x", "y"])) == [("1", "n", "m"), ("2", "c", "d"), ("9", "z", "z")]
    kept = loads.overlay(target, source, "Id", "o", ["x"], insert_new=False)
    assert rows_of(kept) == [("1", "n", "b"), ("2", "c", "d")]


def test_delete_takes_only_ids(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, v string")
    assert rows_of(loads.delete(target, spark.createDataFrame([(1,), (None,)], "id int"), "Id")) == [(2, "b")]
    with pytest.raises(ValueError):
        loads.delete(target, target, "Id")


def test_versioned_table_rewrites_itself(spark, tmp_path):
    table = loads.VersionedTable(spark, f"{tmp_path}/t")
    table.write(spark.range(3))
    table.append(spark.range(3, 5), "more")
    table.append(spark.range(3, 5), "more")
    assert table.read().count() == 5
    table.write(table.read().filter("id > 1"), "cut")
    assert table.read().count() == 3 and table.read_before("cut").count() == 5
    with pytest.raises(FileNotFoundError):
        loads.VersionedTable(spark, f"{tmp_path}/none").read()


def test_queue_moves_rows_once(spark, tmp_path):
    queue = loads.StatusQueue(spark, f"{tmp_path}/q", 202)
    queue.stage(spark.createDataFrame([(1, 202), (2, 202), (3, 202)], "mq_id int, mq_status int"), "s")
    done = spark.createDataFrame([(1, 200), (3, 304)], "mq_id int, mq_status int")
    for _ in range(2):
        queue.settle("mq_id", done, "run")
    assert rows_of(queue.settled.read()) == [(1, 200), (3, 304)] and rows_of(queue.waiting.read()) == [(2, 202)]
    queue.settle("mq_id", done.limit(0), "idle")
    assert queue.rows().count() == 3


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_unique_cuts_hot_keys(spark, how):
    """Nothing runs while the plan is built; a key that fills a partition is cut while it runs."""
    left = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 501).alias("k"), "id", F.md5(F.col("id").cast("string")).alias("wide")
    )
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    configure(spark)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
        joined = joins.join_unique(left, right, ["k"], how)
        assert spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() == jobs
        counted = joined.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v"), F.max("wide").alias("wide"))
        got = {tuple(r) for r in counted.collect()}
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    want = left.join(F.broadcast(right), ["k"], how).groupBy("k").agg(F.count("*"), F.sum("v"), F.max("wide"))
    assert got == {tuple(r) for r in want.collect()}
    with pytest.raises(ValueError):
        joins.join_unique(left, right, ["k"], "full")


def test_left_join_many(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    many = spark.createDataFrame([(1, i) for i in range(50)] + [(3, 0)], "k int, w int")
    got = joins.left_join_many(one, many, ["k"]).select("k", "v", "w")
    want = one.join(many, "k", "left").select("k", "v", "w")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_latest_per_key_does_not_window(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "z")], "k string, o int, v string")
    latest = joins.latest_per_key(rows, ["k"], "o")
    assert {tuple(r) for r in latest.collect()} == {("a", 3, None), ("b", 2, "z")}
    assert "Window" not in latest._jdf.queryExecution().executedPlan().toString()


def test_numbering_is_gap_free_for_ties(spark):
    rows = spark.range(1000).select(F.lit(1).alias("same"), "id")
    numbered = numbering.number_rows(rows.repartition(7), ["same", "id"], "n", 100)
    assert [r["n"] - r["id"] for r in numbered.collect()] == [100] * 1000
    chunks = numbering.chunk_by_count(rows, ["id"], 300).groupBy("chunk").count()
    assert rows_of(chunks) == [(0, 300), (1, 300), (2, 300), (3, 100)]


def test_nth_smallest(spark):
    ids = [5, 9, 1000000, 7, 12345678, 8, 8]
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    for n in range(1, 9):
        assert numbering.nth_smallest(rows, "id", n, buckets=4) == sorted(ids)[min(n, 7) - 1]
    assert numbering.nth_smallest(rows.limit(0), "id", 1) is None


def test_guard_table(spark):
    def reasons(op, mode, env_class, managed, glass=False):
        row = [(op, mode, "e", env_class, "SF_X", managed, glass)]
        schema = "op string, mode string, environment string, env_class string, table_name string, is_managed boolean, break_glass boolean"
        return list(guard.evaluate(spark.createDataFrame(row, schema)).first()["reasons"])

    for op in ("drop", "truncate", "alter"):
        assert reasons(op, "no", "dev", True)
    assert not reasons("drop", "restricted", "dev", True) and reasons("drop", "restricted", "dev", False)
    assert not reasons("drop", " Dev-Only ", "qa", False) and len(reasons("drop", "dev_only", "unknown", False)) == 2
    assert len(reasons("drop", "yes", "prod", True)) == 1 and not reasons("alter", "yes", "prod", False)
    assert not reasons("drop", "yes", "prod", True, True)
    assert len(reasons("truncate", "no", "prod", True)) == 2
    with pytest.raises(ValueError):
        guard.normalize_mode("maybe")


def test_overflow_cases(spark):
    data = spark.createDataFrame([(1, "s", "p"), (2, "X" * 9000, None)], "ID long, BODY string, LABEL string")
    declared = spark.createDataFrame(
        [("ID", "NUMBER", None, False, True, True), ("BODY", "VARCHAR2", 100, True, False, False), ("LABEL", "VARCHAR2", 100, False, False, False)],
        "column_name string, raw_type string, max_length int, is_nullable boolean, is_key boolean, is_indexed boolean",
    )
    plan = {r["column_name"]: (r["size_action"], r["new_length"], r["relax_null"]) for r in catalog.overflow_plan(catalog.profile(data), declared).collect()}
    assert plan == {"ID": ("NONE", None, False), "BODY": ("PROMOTE", None, False), "LABEL": ("NONE", None, True)}
    keyed = declared.withColumn("is_key", F.lit(True))
    assert catalog.overflow_plan(catalog.profile(data), keyed).filter("column_name = 'BODY'").first()["size_action"] == "REFUSED"


def test_describe_and_filter_objects(spark):
    field = (
        "name string, label string, type string, length int, precision int, scale int, nillable boolean, `unique` boolean,"
        " updateable boolean, calculated boolean, idLookup boolean, externalId boolean, referenceTo array<string>,"
        " picklistValues array<struct<value:string,active:boolean>>"
    )
    f = lambda n, k, **m: {"name": n, "type": k, **m}
    fields = [
        f("Id", "id", length=18, nillable=False, idLookup=True), f("MailingAddress", "address"),
        f("AccountId", "reference", length=18, referenceTo=["Account"]),
        f("LeadSource", "picklist", length=40, picklistValues=[{"value": "Web", "active": True}, {"value": "Retired", "active": False}]),
        f("CreatedDate", "datetime", updateable=False, length=0),
    ]
    inner = ", ".join(part.strip().replace(" ", ":", 1) for part in field.split(", "))
    describes = spark.createDataFrame([{"name": "Contact", "fields": fields}], f"name string, fields array<struct<{inner}>>")
    out = {r["column_name"]: r for r in catalog.describe_columns(describes).collect()}
    assert list(out) == ["Id", "AccountId", "LeadSource", "CreatedDate"] and out["AccountId"]["ordinal"] == 2
    assert out["Id"]["is_primary_key"] and out["Id"]["is_indexed"] and not out["Id"]["is_nullable"]
    assert out["AccountId"]["foreign_key_mapping"] == {"Account": "Id"} and out["LeadSource"]["enum_values"] == ["Web"]
    assert out["CreatedDate"]["is_read_only"] and out["CreatedDate"]["max_length"] is None

    names = ["Contact", "Account", "ConnectedApplication", "AccountHistory", "X__ChangeEvent", "AcceptedEventRelation"]
    objects = spark.createDataFrame(
        [(n, True, True, n != "AcceptedEventRelation", False) for n in names],
        "name string, queryable boolean, retrieveable boolean, layoutable boolean, searchable boolean",
    )
    assert [r["name"] for r in catalog.object_filter(objects).collect()] == ["Account", "ConnectedApplication", "Contact"]


def test_csv_and_json_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'say "hi", you'), (2, "two\nlines"), (3, None), (4, " padded ")], "i int, t string")
    for name in text_files.DELIMITERS:
        path = f"{tmp_path}/{name}"
        text_files.write_csv(rows, path, name, "CRLF" if name == "TAB" else "LF")
        back = {int(r["i"]): r["t"] for r in text_files.read_csv(spark, path, name).collect()}
        assert back == {1: 'say "hi", you', 2: "two\nlines", 3: None, 4: " padded "}
    with pytest.raises(ValueError, match="missing"):
        text_files.typed_csv(spark, f"{tmp_path}/COMMA", {"i": "NUMBER", "absent": "DATE"})
    (tmp_path / "page.json").write_text('{"totalSize": 1, "done": true,\n "records": [{"attributes": {"type": "A"}, "Id": "1"}]}')
    assert rows_of(text_files.json_pages(spark, f"{tmp_path}/page.json")) == [("1",)]
    (tmp_path / "f.bin").write_bytes(b"\x00\x01" * 60)
    import base64

    assert tables.binary_files(spark, str(tmp_path), "*.bin").first()["body"] == base64.b64encode(b"\x00\x01" * 60).decode()


def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_path):
    """Line ends, quotes and separators in fields, wherever the splits fall."""
    cells = ["plain", 'a "quoted" word', "two\nlines", "x,y", "", None, "\n\n", '"', "long " * 40 + "\n" + "z" * 90, "crlf\r\ninside", "é\u0000ü"]
    rows = [(str(i), cells[i % len(cells)], cells[(i * 7) % len(cells)]) for i in range(700)]
    df = spark.createDataFrame(rows, "id string, a string, b string")
    for ending in ("LF", "CRLF"):
        path = f"{tmp_path}/{ending}"
        text_files.write_csv(df.coalesce(1), path, "COMMA", ending)
        want = sorted(map(str, text_files.read_csv(spark, path, whole_files=True).collect()))
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        for size in ("4m", "3000", "257"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            try:
                got = text_files.read_csv(spark, path)
                assert sorted(map(str, got.collect())) == want
                if size == "257":
                    assert text_files.csv_records(spark, path).select(F.spark_partition_id()).distinct().count() > 20
                with pytest.raises(Exception, match="the header of a CSV file is id,a,b"):
                    text_files.read_csv(spark, path, columns=["a", "id", "b"]).collect()
            finally:
                spark.conf.set("spark.sql.files.maxPartitionBytes", before)
                spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_bytes_are_those_of_the_file(spark, tmp_path):
    cells = ["plain", 'a "quoted" word', "two\nlines", "x,y", "", None, '"', "é", " padded "]
    rows = spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate((a, b) for a in cells for b in cells)], "id string, a string, b string")
    text_files.write_csv(rows.coalesce(1), str(tmp_path / "t"))
    (file,) = (tmp_path / "t").glob("*.csv")
    counted = rows.agg(F.sum(text_files.csv_bytes(rows))).first()[0]
    assert file.stat().st_size == len("id,a,b\n") + counted


def test_chunks_respect_both_limits(spark):
    rows = spark.range(500).select("id", F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")).alias("t"))
    chunks = text_files.chunk_by_bytes(rows, ["id"], 30, 400)
    stats = chunks.groupBy("chunk").agg(F.count("*").alias("n"), F.sum("_bytes").alias("b")).collect()
    assert sum(r["n"] for r in stats) == 500 and all(r["n"] <= 30 and r["b"] <= 400 for r in stats)


def test_migration_actions(spark, tmp_path):
    spec = TableSpec("Contact", "salesforce", columns=(ColumnSpec("Id", is_primary_key=True), ColumnSpec("LastName"), ColumnSpec("SSN__c")))
    first = spark.createDataFrame([("1", " Lee ", "123-45-6789")], "Id string, LastName string, SSN__c string")
    hide = migrate.Settings(action="insert", redaction="part-mask")
    assert rows_of(migrate.migrate_table(first, spec, str(tmp_path), hide)) == [("1", "Lee", "***-**-6789")]
    assert migrate.migrate_table(first, spec, str(tmp_path), hide).count() == 2
    fewer = TableSpec("Contact", "salesforce", columns=spec.columns[:2])
    reset = migrate.migrate_table(first.drop("SSN__c"), fewer, str(tmp_path), migrate.Settings(action="reset"))
    assert rows_of(reset) == [("1", "Lee", None)]
    full = migrate.migrate_table(first.drop("SSN__c"), fewer, str(tmp_path), migrate.Settings(action="full_load"))
    assert full.columns == ["ID", "LASTNAME"]
    more = spark.createDataFrame([("1", "Ray", "x"), ("2", "Kim", "y")], "Id string, LastName string, SSN__c string")
    grown = migrate.migrate_table(more, spec, str(tmp_path), migrate.Settings(action="upsert"))
    assert rows_of(grown) == [("1", "Ray", "x"), ("2", "Kim", "y")]
    with pytest.raises(guard.GuardRefused):
        migrate.migrate_table(more, spec, str(tmp_path), migrate.Settings(action="reset", env_class="prod"))
    with pytest.raises(ValueError, match="unknown load action"):
        migrate.migrate_table(more, spec, str(tmp_path), migrate.Settings(action="merge"))


def test_bad_cells_stop_or_stay_beside(spark, tmp_path):
    spec = TableSpec("Event", "salesforce", columns=(ColumnSpec("Id"), ColumnSpec("Day", "DATE", "date")))
    rows = spark.createDataFrame([("1", "2024-01-02"), ("2", "soon")], "Id string, Day string")
    with pytest.raises(ValueError, match="do not fit"):
        migrate.migrate_table(rows, spec, str(tmp_path))
    kept = migrate.migrate_table(rows, spec, str(tmp_path), migrate.Settings(keep_rejects=True))
    assert kept.filter("DAY IS NULL").count() == 1
    assert loads.VersionedTable(spark, f"{tmp_path}/SF_Event_rejects").read().count() == 1


def test_sparse_left_join_deals_rows_without_a_key(spark):
    left = spark.createDataFrame([(i, None if i % 4 else f"k{i % 8}", None if i % 7 == 0 else 1) for i in range(400)], "id long, k string, at int")
    right = spark.createDataFrame([("k0", 1, "a"), ("k0", 1, "b"), (None, 1, "c"), ("k4", None, "d"), (None, None, "e")], "k string, at int, v string")
    joined = joins.left_join_sparse(left, right, ["k", "at"], ["id"])
    assert joined.columns == left.join(right, ["k", "at"], "left").columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, left.join(right, ["k", "at"], "left").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joins.left_join_sparse(left, right, ["k", "at"], ["id"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(r["count"] for r in sizes) < 220  # 314 rows lack a key


def test_rename_map_leaves_names_without_an_identifier(spark):
    source = spark.createDataFrame([("T", "***"), ("T", None), ("T", "a b"), (None, "a b"), ("T", "9x")], "table_name string, column_name string")
    target = spark.createDataFrame([("T", "!!", 1), ("T", None, 2), ("T", "A_B", 3), ("T", "A__B", 4), (None, "A_B", 5), ("T", "C_9X", 6)], "table_name string, column_name string, ordinal long")
    assert rows_of(catalog.rename_map(source, target)) == [("T", "9x", "C_9X"), ("T", "a b", "A_B")]


def test_catalog_columns_are_the_same_rows(spark):
    from workload import inputs

    lines = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1), (5, None), (5, None), (None, None), (12, 4)], "l_orderkey long, l_linenumber int")
    made = [sorted(map(str, spark.sql(text["cat_columns"], lineitem=lines).collect())) for text in (inputs.DERIVED, inputs.SPARK_FORM)]
    assert made[0] == made[1] and len(made[0]) == 6
