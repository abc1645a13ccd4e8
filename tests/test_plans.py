"""Plans keep what large runs depend on: pushed filters, pruned columns, combining before a shuffle."""

from pyspark.sql import functions as F

from loomsync.functions import cells, masking
from loomsync.operators import catalog, joins
from loomsync.plans import sync
from loomsync.sources import tables, text_files
from loomsync.spec import ColumnSpec, TableSpec
from workload.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushes_filter_and_prunes(spark):
    text = plan(tables.scan(spark.read.parquet(f"{FOLDER}/lineitem.parquet"), ["l_orderkey"], {"l_returnflag": "A"}))
    assert "EqualTo(l_returnflag,A)" in text and "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_text_work_stays_in_the_jvm(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = plan(docs.select(masking.redact_scan(F.col("text"), masking.hash_mask(b"k"))))
    assert "Python" not in text and "Exchange" not in text


def test_profile_reads_once(spark):
    text = plan(catalog.profile(spark.read.parquet(f"{FOLDER}/documents.parquet")))
    assert text.count("FileScan") == 1 and "partial" in text


def test_windows_limit_before_the_shuffle(spark):
    t = Inputs(spark, FOLDER)
    rows = sync.reject_reasons(sync.with_hashes(t["inbound"]), {}).withColumn("window_no", F.lit(0))
    text = plan(sync._steps(rows))
    assert "WindowGroupLimit" in text and "Partial" in text and "CartesianProduct" not in text


def test_latest_combines_before_the_shuffle(spark):
    rows = spark.read.parquet(f"{FOLDER}/events.parquet").select("user_id", "event_id", "value")
    text = plan(joins.latest_per_key(rows, ["user_id"], "event_id"))
    assert "partial_max_by" in text


def test_sync_lookups_start_no_job(spark):
    t = Inputs(spark, FOLDER)
    state, inbound = sync.State(t["members"], t["addresses"], t["phones"]), t["inbound"]
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()
    found = sync.change_flags(sync.hydrate(inbound, state))
    assert spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs() == jobs
    assert "CartesianProduct" not in plan(found) and "Python" not in plan(found)


def test_current_state_works_members_out_once(spark):
    t = Inputs(spark, FOLDER)
    state = sync.State(t["members"], t["addresses"], t["phones"])
    lov, empty = t["lov"], spark.createDataFrame
    view = sync.current_state(
        state, lov, empty([], "name_prefix_id bigint, name_prefix string"), empty([], "name_suffix_id bigint, name_suffix string"),
        empty([], "phone_type_id bigint, phone_type string"),
    )
    text = view._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("AS demogr_hash") == 1


def test_numbers_need_few_patterns(spark):
    """A cell's text is worked out in few places; only exponents have their digits moved, apart from the rest."""
    rows = spark.createDataFrame([("1.5", 2)], "a string, b bigint")
    spec = TableSpec("T", columns=(ColumnSpec("a", "NUMBER", "float"), ColumnSpec("b", "NUMBER", "integer", precision=9, scale=0)))
    text = cells.normalize_frame(rows, spec)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("(?U)^") <= 6 and text.count("transform") == 1


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_identifiers_are_worked_out_once_per_side(spark):
    t = Inputs(spark, FOLDER)
    named = t["cat_columns"].select("table_name", "column_name", F.col("column_id").alias("ordinal"))
    text = optimized(catalog.rename_map(named.drop("ordinal"), named))
    assert text.count("regexp_replace") == 2 and "ACCESS|ADD" not in text


def test_catalog_columns_are_made_distinct_by_their_keys(spark):
    assert optimized(Inputs(spark, FOLDER)["cat_columns"]).count("Aggregate [l_orderkey") == 1


def test_drift_steps_are_columns_before_the_array(spark):
    t = Inputs(spark, FOLDER)
    text = optimized(catalog.schema_drift(t["desired_columns"], t["cat_columns"]))
    assert "array(_step0" in text


def test_small_windows_are_shuffled_once(spark):
    t = Inputs(spark, FOLDER)
    rows = sync.reject_reasons(sync.with_hashes(t["inbound"]), {}).withColumn("window_no", F.col("mq_id") % 40)
    dealt = sync._steps(sync._in_blocks(rows, 8), ["pid", "_block"])
    before, after = plan(dealt).split("REPARTITION_BY_COL")
    assert before.count("Exchange") == 1 and "Exchange hashpartitioning(pid" in before and "Window" in before
    assert sorted(dealt.drop("_block").collect(), key=str) == sorted(sync._steps(rows).collect(), key=str)


def test_chunks_by_bytes_move_only_what_is_wanted(spark):
    rows = spark.createDataFrame([(i, "x" * (i % 7) + '"') for i in range(200)], "id long, text string").repartition(3)
    whole = text_files.chunk_by_bytes(rows, ["id"], 30, 400)
    narrow = text_files.chunk_by_bytes(rows, ["id"], 30, 400, columns=["id"])
    assert narrow.columns == ["id", "_bytes", "chunk"] and whole.columns == ["id", "text", "_bytes", "chunk"]
    assert sorted(narrow.collect()) == sorted(whole.drop("text").collect())
    assert "MapInArrow" in plan(narrow) and "text#" not in plan(narrow).split("MapInArrow")[1].split("Exchange")[0]
