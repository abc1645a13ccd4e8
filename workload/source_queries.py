"""Scans, files and relational shapes: S1 to S17, Q1 to Q23."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.functions.fingerprints import differs
from loomsync.operators import catalog, joins, numbering
from loomsync.plans import sync
from loomsync.session import shared_dir
from loomsync.sources import tables, text_files
from workload.base import Registry
from workload.inputs import Inputs

registry = Registry()
query = registry.add


def _folder(t: Inputs, label: str) -> str:
    return f"{shared_dir(t.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


query("S1_scan_project", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")(
    lambda t: tables.scan(t["orders"], ["o_orderkey", "o_orderstatus", "o_totalprice"])
)
query(
    "S2_scan_bind_filter",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'",
)(
    lambda t: tables.scan(
        t["lineitem"], ["l_orderkey", "l_partkey", "l_quantity"], {"l_returnflag": "A", "l_linestatus": "F"}
    )
)
query("S2_null_bind", "SELECT o_orderkey FROM orders WHERE o_orderstatus = NULL")(
    lambda t: tables.scan(t["orders"], ["o_orderkey"], {"o_orderstatus": None})
)
query(
    "S3_sql_query",
    "SELECT c_mktsegment, count(*) AS n_customers FROM customer WHERE c_acctbal > 1000 AND c_nationkey <> 3"
    " GROUP BY c_mktsegment",
)(
    lambda t: tables.sql_query(
        t.spark,
        "SELECT c_mktsegment, count(*) AS n_customers FROM {customer} WHERE c_acctbal > :low AND c_nationkey <> :skip"
        " GROUP BY c_mktsegment",
        {"customer": t["customer"]},
        {"low": 1000, "skip": 3},
    )
)

_CONTACTS = {
    "Index": "NUMBER(10)", "Customer Id": "VARCHAR2(50 CHAR)", "Full Name": "VARCHAR2(100 CHAR)",
    "Company": "VARCHAR2(200 CHAR)", "Subscription Date": "DATE",
}


def contacts_csv(t: Inputs) -> str:
    path = _folder(t, "contacts")
    text_files.write_csv(t["contacts"].toDF(*_CONTACTS), path)
    return path


CONTACTS_SQL = (
    "SELECT try_cast(idx AS BIGINT) AS \"SF_INDEX\", customer_id AS \"CUSTOMER_ID\", full_name AS \"FULL_NAME\","
    " company AS \"COMPANY\", try_cast(subscribed AS DATE) AS \"SUBSCRIPTION_DATE\" FROM contacts"
)


@query("S4_csv_typed_read", CONTACTS_SQL, "contacts")
def csv_typed(t: Inputs) -> DataFrame:
    return text_files.typed_csv(t.spark, contacts_csv(t), _CONTACTS)


@query(
    "S5_csv_dialect_io",
    "SELECT row_id, d AS dialect, nullif(replace(note, chr(0), ''), '') AS note, money FROM (SELECT row_id, note,"
    " nullif(money, '') AS money, unnest(['BACKQUOTE', 'CARET', 'COMMA', 'PIPE', 'SEMICOLON', 'TAB']) AS d FROM cells)",
    "cells",
)
def csv_dialects(t: Inputs) -> DataFrame:
    rows = t["cells"].select("row_id", "note", "money")
    read = []
    for at, name in enumerate(text_files.DELIMITERS):
        path = _folder(t, name.lower())
        text_files.write_csv(rows, path, name, "CRLF" if at % 2 else "LF")
        back = text_files.read_csv(t.spark, path, name, rows.columns)
        read.append(
            back.select(
                F.col("row_id").cast("bigint").alias("row_id"),
                F.lit(name).alias("dialect"),
                F.nullif(F.col("note"), F.lit("")).alias("note"),
                "money",
            )
        )
    return text_files.union_header(read)


@query(
    "S6_csv_union_header",
    "SELECT CAST(member_id AS VARCHAR) AS member_id, phone, NULL AS city FROM phones UNION ALL"
    " SELECT CAST(member_id AS VARCHAR), NULL, city FROM addresses",
    "phones", "addresses",
)
def union_header(t: Inputs) -> DataFrame:
    rows = text_files.union_header(
        [t["phones"].select("member_id", "phone"), t["addresses"].select("member_id", "city")]
    )
    path = _folder(t, "union")
    text_files.write_csv(rows, path)
    return text_files.read_csv(t.spark, path, columns=rows.columns)


@query("S7_json_pages_flatten", "SELECT 'A' || CAST(c_custkey AS VARCHAR) AS \"Id\", c_name AS \"Name\" FROM customer")
def json_pages(t: Inputs) -> DataFrame:
    record = F.struct(
        F.struct(F.lit("Account").alias("type"), F.concat(F.lit("/a/"), "c_custkey").alias("url")).alias("attributes"),
        F.concat(F.lit("A"), "c_custkey").alias("Id"),
        F.col("c_name").alias("Name"),
    )
    pages = (
        t["customer"]
        .groupBy(F.expr("c_custkey div 50").alias("page"))
        .agg(F.count("*").alias("totalSize"), F.collect_list(record).alias("records"))
        .select("totalSize", F.lit(False).alias("done"), "records")
    )
    path = _folder(t, "pages")
    pages.select(F.to_json(F.struct("*"))).write.text(path)
    schema = "records array<struct<attributes:struct<type:string,url:string>,Id:string,Name:string>>"
    return text_files.json_page_lines(t.spark, path, schema)


@query("S8_parquet_export", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def parquet_export(t: Inputs) -> DataFrame:
    path = _folder(t, "export")
    tables.parquet_export(t["orders"].select("o_orderkey", "o_custkey", "o_orderdate"), path, 5000)
    return t.spark.read.parquet(path)


@query("S9_arrow_batches", "SELECT c_custkey, upper(c_name) AS c_name FROM customer")
def arrow_batches(t: Inputs) -> DataFrame:
    def upper(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.utf8_upper(batch.column(1))], names=["c_custkey", "c_name"])

    return tables.arrow_batches(t["customer"].select("c_custkey", "c_name"), upper, "c_custkey long, c_name string")


query(
    "S10_chunk_by_count",
    "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk FROM orders",
)(lambda t: numbering.chunk_by_count(t["orders"].select("o_orderkey"), ["o_orderkey"], 1000))


@query("S11_chunk_by_bytes", "SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS broken_chunks FROM documents")
def chunk_by_bytes(t: Inputs) -> DataFrame:
    chunks = text_files.chunk_by_bytes(t["documents"], ["doc_id"], 40, 200_000, columns=["doc_id"])
    per_chunk = chunks.groupBy("chunk").agg(F.count("*").alias("n"), F.sum("_bytes").alias("b"))
    broken = (F.col("n") > 40) | ((F.col("b") > 200_000) & (F.col("n") > 1))
    return per_chunk.agg(F.sum("n").alias("total_rows"), F.count_if(broken).alias("broken_chunks"))


def _line_bytes(columns: list[str]) -> str:
    """Bytes of a row as a CSV line, in SQL."""
    cells = []
    for c in columns:
        text = f"CAST({c} AS VARCHAR)"
        quoted = " OR ".join(f"contains({text}, {mark})" for mark in ("','", "'\"'", "chr(10)", "chr(13)"))
        quotes = f"length({text}) - length(replace({text}, '\"', ''))"
        cells.append(f"coalesce(strlen({text}) + CASE WHEN {quoted} THEN 2 + {quotes} ELSE 0 END, 0)")
    return " + ".join([*cells, str(len(columns))])


_DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@query("S11_line_bytes", f"SELECT doc_id, CAST({_line_bytes(_DOCUMENT)} AS BIGINT) AS line_bytes, TRUE AS fits FROM documents")
def line_bytes(t: Inputs) -> DataFrame:
    """Size of every line, and whether the file of its chunk is within the limit."""
    limit = 60_000
    chunks = text_files.chunk_by_bytes(t["documents"].select(*_DOCUMENT), ["doc_id"], 40, limit, columns=["doc_id"])
    header = len(",".join(_DOCUMENT)) + 1
    sizes = chunks.groupBy("chunk").agg(((F.sum("_bytes") + header <= limit) | (F.count("*") == 1)).alias("fits"))
    return chunks.join(sizes, "chunk").select("doc_id", F.col("_bytes").alias("line_bytes"), "fits")


query("S12_row_count", "SELECT count(*) AS \"rows\" FROM lineitem")(lambda t: tables.row_count(t["lineitem"]))

_MEMBER = ["member_id", "middle_name", "name_suffix_id", "dt_of_death", "email_addr", "ssn"]
query(
    "S13_null_count",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM members" for c in _MEMBER),
    "members",
)(lambda t: tables.null_counts(t["members"].select(*_MEMBER)))
query("S14_soft_delete_read", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")(
    lambda t: tables.live_rows(
        t["orders"].withColumn("is_deleted", F.col("o_orderstatus") == "F"), "is_deleted"
    ).select("o_orderkey")
)
query(
    "S15_changed_between",
    "SELECT event_id, event_type = 'error' AS is_deleted FROM events"
    " WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'",
)(
    lambda t: tables.changed_between(t["events"], "ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00").select(
        "event_id", (F.col("event_type") == "error").alias("is_deleted")
    )
)
query("S16_get_by_key", "SELECT c_custkey, c_name FROM customer WHERE c_name = 'Customer#000000042'")(
    lambda t: tables.get_by_key(t["customer"], "c_name", "Customer#000000042").select("c_custkey", "c_name")
)


@query("S17_binary_base64", "SELECT doc_id, base64(encode(text)) AS body, text AS back FROM documents")
def base64_body(t: Inputs) -> DataFrame:
    coded = tables.to_base64(t["documents"], "text", "body")
    return tables.from_base64(coded, "body", "raw").select("doc_id", "body", F.decode("raw", "UTF-8").alias("back"))


# --- relational shapes -----------------------------------------------------

_STATE = "SELECT pid, member_id, last_name FROM members WHERE status_id = '37' AND pid <> 'N/A'"


def _active(t: Inputs) -> DataFrame:
    return sync.active_members(t["members"]).select("pid", "member_id", F.col("last_name").alias("state_name"))


query(
    "Q1_inner_equi_join",
    f"SELECT i.mq_id, s.member_id FROM inbound i JOIN ({_STATE}) s ON s.pid = i.pid",
    "inbound", "members",
)(lambda t: joins.join_unique(t["inbound"], _active(t), ["pid"], "inner").select("mq_id", "member_id"))
query(
    "Q2_left_lookup_join",
    "SELECT m.member_id, p.name_prefix, s.name_suffix FROM members m LEFT JOIN prefixes p"
    " ON p.name_prefix_id = m.name_prefix_id LEFT JOIN suffixes s ON s.name_suffix_id = m.name_suffix_id",
    "members", "prefixes", "suffixes",
)(
    lambda t: t["members"].join(t["prefixes"], "name_prefix_id", "left").join(t["suffixes"], "name_suffix_id", "left")
    .select("member_id", "name_prefix", "name_suffix")
)


@query(
    "Q3_left_join_typed_lookup",
    "SELECT m.member_id, g.lov_desc AS gender, s.lov_desc AS mar_status FROM members m"
    " LEFT JOIN lov g ON g.lov_id = m.gender_id AND g.lov_type = 'CSM_SEX'"
    " LEFT JOIN lov s ON s.lov_id = m.mar_status_id AND s.lov_type = 'CSM_MARITAL_ST'",
    "members", "lov",
)
def typed_lookup(t: Inputs) -> DataFrame:
    names = {"id_col": "lov_id", "type_col": "lov_type", "text_col": "lov_desc"}
    rows = joins.typed_lookup(t["members"], t["lov"], "gender_id", "CSM_SEX", "gender", **names)
    rows = joins.typed_lookup(rows, t["lov"], "mar_status_id", "CSM_MARITAL_ST", "mar_status", **names)
    return rows.select("member_id", "gender", "mar_status")


query(
    "Q4_left_join_pinned",
    "SELECT m.member_id, p.phone FROM members m LEFT JOIN phones p ON p.member_id = m.member_id AND p.phone_type_id = 1",
    "members", "phones",
)(
    lambda t: joins.left_join_many(
        t["members"].select("member_id"), t["phones"].filter("phone_type_id = 1"), ["member_id"]
    ).select("member_id", "phone")
)
query(
    "Q5_left_join_missing",
    f"SELECT i.mq_id, CASE WHEN s.pid IS NULL THEN 404 ELSE 200 END AS found FROM inbound i LEFT JOIN ({_STATE}) s"
    " ON s.pid = i.pid",
    "inbound", "members",
)(
    lambda t: joins.join_unique(t["inbound"].select("mq_id", "pid"), _active(t), ["pid"])
    .select("mq_id", F.when(F.col("member_id").isNull(), 404).otherwise(200).alias("found"))
)
query(
    "Q6_anti_join_orphans",
    "SELECT mq_id, name_suffix_id FROM inbound WHERE name_suffix_id IS NOT NULL"
    " AND name_suffix_id NOT IN (SELECT name_suffix_id FROM suffixes)",
    "inbound", "suffixes",
)(
    lambda t: joins.orphans(t["inbound"], t["suffixes"], "name_suffix_id", "name_suffix_id")
    .select("mq_id", "name_suffix_id")
)
query(
    "Q7_semi_filter",
    "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)(
    lambda t: t["customer"].select("c_custkey").join(
        t["orders"].filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct(),
        "c_custkey", "left_semi",
    )
)


@query(
    "Q8_scalar_lookup",
    "WITH s AS (SELECT m.pid, count(*) AS n, max(m.member_id) AS member_id FROM members m LEFT JOIN addresses a"
    " ON a.member_id = m.member_id GROUP BY m.pid) SELECT i.mq_id, CASE WHEN s.n = 1 THEN s.member_id END AS member_id,"
    " coalesce(s.n > 1, FALSE) AS is_ambiguous FROM inbound i LEFT JOIN s ON s.pid = i.pid",
    "inbound", "members", "addresses",
)
def scalar_lookup(t: Inputs) -> DataFrame:
    counts = t["addresses"].groupBy("member_id").agg(F.count("*").alias("n"))
    one = t["members"].join(counts, "member_id", "left").groupBy("pid").agg(
        F.sum(F.coalesce("n", F.lit(1))).alias("n"), F.max("member_id").alias("member_id")
    )
    rows = joins.join_unique(t["inbound"].select("mq_id", "pid"), one, ["pid"])
    return rows.select(
        "mq_id",
        F.when(F.col("n") == 1, F.col("member_id")).alias("member_id"),
        F.coalesce(F.col("n") > 1, F.lit(False)).alias("is_ambiguous"),
    )


query("Q9_range_filter", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")(
    lambda t: t["lineitem"].filter(F.col("l_quantity").between(10, 20)).select("l_orderkey", "l_quantity")
)
query(
    "Q10_null_safe_diff",
    "SELECT mq_id, coalesce(middle_name, '|') <> coalesce(email_addr, '|') AS differs FROM inbound",
    "inbound",
)(lambda t: t["inbound"].select("mq_id", differs(F.col("middle_name"), F.col("email_addr")).alias("differs")))
query("Q11_count_agg", "SELECT count(*) AS n_rows, count(email_addr) AS n_emails FROM members", "members")(
    lambda t: t["members"].agg(F.count("*").alias("n_rows"), F.count("email_addr").alias("n_emails"))
)


@query(
    "Q12_group_having",
    "SELECT m.pid FROM members m LEFT JOIN addresses a ON a.member_id = m.member_id GROUP BY m.pid HAVING count(*) = 1",
    "members", "addresses",
)
def group_having(t: Inputs) -> DataFrame:
    counts = t["addresses"].groupBy("member_id").agg(F.count("*").alias("n"))
    rows = t["members"].join(counts, "member_id", "left").groupBy("pid").agg(F.sum(F.coalesce("n", F.lit(1))).alias("n"))
    return rows.filter("n = 1").select("pid")


query("Q13_max_agg", "SELECT max(o_orderkey) AS high FROM orders WHERE o_orderstatus = 'O'")(
    lambda t: t["orders"].filter("o_orderstatus = 'O'").agg(F.max("o_orderkey").alias("high"))
)
query(
    "Q14_ordered_string_agg",
    "SELECT owner, constraint_name, string_agg(column_name, ' ' ORDER BY position) AS column_names"
    " FROM cat_cons_columns GROUP BY owner, constraint_name",
    "cat_cons_columns",
)(
    lambda t: t["cat_cons_columns"].groupBy("owner", "constraint_name").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("position", "column_name"))), lambda e: e["column_name"]),
            " ",
        ).alias("column_names")
    )
)


@query(
    "Q15_window_count",
    "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders",
)
def window_count(t: Inputs) -> DataFrame:
    # Counted first and joined back: a hot key is combined on the map side instead of filling one window.
    counts = t["orders"].groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return joins.join_unique(t["orders"].select("o_orderkey", "o_custkey"), counts, ["o_custkey"], "inner").select(
        "o_orderkey", "n_orders"
    )


_LATEST = "SELECT pid, mq_id, last_name FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY mq_id DESC) AS rn FROM inbound) WHERE rn = 1"
query("Q16_dedupe_latest", _LATEST, "inbound")(
    lambda t: joins.latest_per_key(t["inbound"].select("pid", "mq_id", "last_name"), ["pid"], "mq_id")
)
query(
    "Q17_latest_for_key",
    "SELECT mq_id, pid FROM inbound WHERE pid = '000000121' ORDER BY mq_id DESC LIMIT 1",
    "inbound",
)(
    lambda t: tables.get_by_key(t["inbound"].select("mq_id", "pid"), "pid", "000000121").orderBy(F.desc("mq_id")).limit(1)
)
query("Q18_top_n_ordered", "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 100")(
    lambda t: t["events"].select("event_id", "user_id").orderBy("event_id").limit(100)
)
query("Q19_sort_by", "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey")(
    lambda t: t["part"].select("p_partkey", "p_name").orderBy("p_name", "p_partkey")
)
query(
    "Q20_union_all",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)(
    lambda t: t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    .unionByName(t["supplier"].select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))
)
_SNAPSHOT = ["pid", "first_name", "last_name", "email_addr", "mar_status_id", "gender_id"]
query(
    "Q21_minus_delta",
    f"SELECT {', '.join(_SNAPSHOT)} FROM members WHERE status_id = '37' AND pid <> 'N/A' EXCEPT"
    f" SELECT {', '.join(_SNAPSHOT)} FROM census",
    "members", "census",
)(lambda t: sync.active_members(t["members"]).select(*_SNAPSHOT).subtract(t["census"].select(*_SNAPSHOT)))
query("Q22_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")(
    lambda t: catalog.distinct_names(t["lineitem"], "l_returnflag", "l_linestatus")
)
query(
    "Q23_case_expr",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN'"
    " ELSE 'UNKNOWN (' || o_orderstatus || ')' END AS status_text FROM orders",
)(
    lambda t: t["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "FINISHED")
        .when(F.col("o_orderstatus") == "O", "OPEN")
        .otherwise(F.concat(F.lit("UNKNOWN ("), "o_orderstatus", F.lit(")")))
        .alias("status_text"),
    )
)
