"""Load actions, the catalog and whole migrations: L1 to L12, C1 to C16, P1 to P3, U1 to U3."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsync.functions import masking
from loomsync.operators import catalog, guard, loads
from loomsync.operators.numbering import chunk_by_count
from loomsync.plans import migrate
from loomsync.session import shared_dir
from loomsync.spec import ColumnSpec, TableSpec
from workload import cell_queries, source_queries
from workload.base import Registry
from workload.inputs import Inputs

registry = Registry()
query = registry.add

_COLS = "order_id, line_no, quantity, flag, supplier_id"
_KEYS = ["order_id", "line_no"]
_LATEST = (
    "latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_no ORDER BY ordinal DESC) AS rn"
    " FROM upsert_source WHERE order_id IS NOT NULL) x WHERE rn = 1)"
)
_PAIR = ("upsert_target", "upsert_source")


def _folder(t: Inputs, label: str) -> str:
    return f"{shared_dir(t.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _written(t: Inputs, label: str, df: DataFrame) -> loads.VersionedTable:
    table = loads.VersionedTable(t.spark, _folder(t, label))
    table.write(df)
    return table


def _keyed(t: Inputs, label: str, df: DataFrame, keys: list[str]) -> loads.KeyedTable:
    table = loads.KeyedTable(t.spark, _folder(t, label), keys, buckets=16)
    table.write(df)
    return table


# --- loads -----------------------------------------------------------------


@query("L1_load_insert", f"SELECT {_COLS} FROM upsert_target UNION ALL SELECT {_COLS} FROM upsert_source", *_PAIR)
def load_insert(t: Inputs) -> DataFrame:
    table = _written(t, "insert", t["upsert_target"])
    return table.append(loads.fit(t["upsert_source"].drop("ordinal"), t["upsert_target"]))


@query(
    "L1_insert_without_key",
    "SELECT id, name, segment, nation_id, created_by FROM accounts UNION ALL"
    " SELECT NULL, name, segment, nation_id, created_by FROM account_changes",
    "accounts", "account_changes",
)
def insert_without_key(t: Inputs) -> DataFrame:
    return loads.insert(t["accounts"], t["account_changes"].drop("ordinal"), drop_key="id")


@query("L2_load_reset", "SELECT order_id, line_no, NULL AS quantity, flag, NULL AS supplier_id FROM upsert_source", *_PAIR)
def load_reset(t: Inputs) -> DataFrame:
    table = _written(t, "reset", t["upsert_target"])
    return table.write(loads.reset(table.read(), t["upsert_source"].select("order_id", "line_no", "flag")))


@query("L3_load_full", "SELECT order_id, line_no, flag FROM upsert_source", *_PAIR)
def load_full(t: Inputs) -> DataFrame:
    table = _written(t, "full", t["upsert_target"])
    return table.write(loads.full_load(t["upsert_source"].select("order_id", "line_no", "flag")))


@query(
    "L4_load_upsert_full",
    f"WITH {_LATEST} SELECT {_COLS} FROM latest"
    f" UNION ALL SELECT {_COLS} FROM upsert_target t WHERE NOT EXISTS"
    " (SELECT 1 FROM latest l WHERE l.order_id = t.order_id AND l.line_no = t.line_no)"
    f" UNION ALL SELECT {_COLS} FROM upsert_source WHERE order_id IS NULL",
    *_PAIR,
)
def load_upsert(t: Inputs) -> DataFrame:
    return loads.upsert(t["upsert_target"], t["upsert_source"], _KEYS, "ordinal")


@query(
    "L5_load_update",
    f"WITH {_LATEST} SELECT t.order_id, t.line_no,"
    + ", ".join(f"CASE WHEN l.rn = 1 THEN l.{c} ELSE t.{c} END AS {c}" for c in ("quantity", "flag", "supplier_id"))
    + " FROM upsert_target t LEFT JOIN latest l ON l.order_id = t.order_id AND l.line_no = t.line_no",
    *_PAIR,
)
def load_update(t: Inputs) -> DataFrame:
    return loads.update(t["upsert_target"], t["upsert_source"], _KEYS, "ordinal")


_ACCOUNT = TableSpec(
    "Account",
    system="salesforce",
    columns=(
        ColumnSpec("id", is_read_only=True, is_external_id=True), ColumnSpec("name"), ColumnSpec("segment"),
        ColumnSpec("nation_id", "NUMBER", "integer"), ColumnSpec("created_by", is_read_only=True),
    ),
)
_LAST = ", ".join(f"arg_max({c}, ordinal) FILTER ({c} IS NOT NULL) AS {c}" for c in ("name", "segment", "nation_id"))


@query(
    "L6_load_upsert_overlay",
    f"WITH last AS (SELECT id, {_LAST} FROM account_changes WHERE id IS NOT NULL GROUP BY id)"
    " SELECT coalesce(a.id, l.id) AS id, coalesce(l.name, a.name) AS name, coalesce(l.segment, a.segment) AS segment,"
    " coalesce(l.nation_id, a.nation_id) AS nation_id, a.created_by FROM accounts a FULL JOIN last l ON l.id = a.id"
    " UNION ALL SELECT NULL, name, segment, nation_id, NULL FROM account_changes WHERE id IS NULL",
    "accounts", "account_changes",
)
def load_overlay(t: Inputs) -> DataFrame:
    return loads.overlay(t["accounts"], t["account_changes"], loads.external_key(_ACCOUNT), "ordinal", _ACCOUNT.writable)


# The same loads into stored tables, of which only the buckets that hold a key of the source are written.
@query("L4_keyed_upsert", registry.oracle["L4_load_upsert_full"])
def keyed_upsert(t: Inputs) -> DataFrame:
    return _keyed(t, "upsert", t["upsert_target"], _KEYS).upsert(t["upsert_source"], "ordinal")


@query("L5_keyed_update", registry.oracle["L5_load_update"])
def keyed_update(t: Inputs) -> DataFrame:
    return _keyed(t, "update", t["upsert_target"], _KEYS).update(t["upsert_source"], "ordinal")


@query("L6_keyed_overlay", registry.oracle["L6_load_upsert_overlay"])
def keyed_overlay(t: Inputs) -> DataFrame:
    key = loads.external_key(_ACCOUNT)
    return _keyed(t, "overlay", t["accounts"], [key]).overlay(t["account_changes"], "ordinal", _ACCOUNT.writable)


@query(
    "L7_load_delete",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id * 11 FROM events WHERE event_type = 'error')",
)
def load_delete(t: Inputs) -> DataFrame:
    ids = t["events"].filter("event_type = 'error'").select((F.col("user_id") * 11).alias("c_custkey"))
    return loads.delete(t["customer"].select("c_custkey", "c_name"), ids, "c_custkey")


@query(
    "L8_load_report",
    "WITH c AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 2000 AS chunk, o_orderstatus = 'P' AS bad FROM orders)"
    " SELECT chunk, count(*) FILTER (NOT bad) AS processed, count(*) FILTER (bad) AS failed, count(*) AS total"
    " FROM c GROUP BY GROUPING SETS ((chunk), ())",
)
def load_report(t: Inputs) -> DataFrame:
    rows = chunk_by_count(t["orders"].select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 2000)
    return loads.load_report(rows, "chunk", F.col("o_orderstatus") == "P")


@query(
    "L9_split_results",
    "SELECT CASE o_orderstatus WHEN 'F' THEN 'successful' WHEN 'P' THEN 'failed' ELSE 'unprocessed' END AS part,"
    " count(*) AS n_rows FROM orders GROUP BY 1",
)
def split_results(t: Inputs) -> DataFrame:
    state = F.when(F.col("o_orderstatus") == "F", "successful").when(F.col("o_orderstatus") == "P", "failed")
    parts = loads.split_results(t["orders"].select("o_orderkey", state.alias("state")), "state")
    counts = [df.agg(F.lit(name).alias("part"), F.count("*").alias("n_rows")) for name, df in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "L10_assign_sequence",
    "SELECT o_orderkey AS event_no, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey"
    " ELSE 999 + row_number() OVER (PARTITION BY o_orderkey % 3 = 0 ORDER BY o_orderkey) END AS log_id FROM orders",
)
def assign_sequence(t: Inputs) -> DataFrame:
    key = F.col("o_orderkey")
    rows = t["orders"].select(key.alias("event_no"), F.when(key % 3 == 0, key).alias("log_id"))
    return loads.assign_sequence(rows, "log_id", ["event_no"], 1000)


@query(
    "L11_status_partitioned_queue",
    "SELECT event_id AS mq_id, CASE WHEN event_type = 'view' THEN 304 WHEN event_type = 'click' THEN 202 ELSE 200 END"
    " AS mq_status, event_type <> 'click' AS is_settled FROM events",
)
def status_queue(t: Inputs) -> DataFrame:
    queue = loads.StatusQueue(t.spark, _folder(t, "queue"), 202)
    queue.stage(t["events"].select(F.col("event_id").alias("mq_id"), "event_type", F.lit(202).alias("mq_status")), "load")
    waiting = queue.waiting.read()
    status = F.when(F.col("event_type") == "view", 304).otherwise(200)
    done = waiting.filter("event_type <> 'click'").select("mq_id", status.alias("mq_status"))
    queue.settle("mq_id", done, "run-1")
    queue.settle("mq_id", done, "run-1")
    settled = queue.settled.read().select("mq_id", "mq_status", F.lit(True).alias("is_settled"))
    return settled.unionByName(queue.waiting.read().select("mq_id", "mq_status", F.lit(False).alias("is_settled")))


_PROD = "env_class NOT IN ('dev', 'qa')"


@query(
    "L12_guarded_write",
    "WITH r AS (SELECT write_id, CASE WHEN mode = 'no' THEN 'all destructive operations are disabled'"
    " WHEN mode = 'restricted' AND NOT is_managed THEN 'only managed tables may be changed; not managed: ' || table_name"
    f" WHEN mode = 'dev-only' AND {_PROD} THEN 'not allowed outside dev: ' || environment || ' is ' || env_class END AS a,"
    f" CASE WHEN op IN ('drop', 'truncate') AND {_PROD} AND NOT break_glass"
    " THEN 'data loss in production needs break-glass: ' || environment END AS b FROM write_plan)"
    " SELECT write_id, concat_ws(' | ', a, b) AS reasons, a IS NULL AND b IS NULL AS permitted FROM r",
    "write_plan",
)
def guarded_write(t: Inputs) -> DataFrame:
    judged = guard.evaluate(t["write_plan"])
    return judged.select(
        "write_id", F.array_join("reasons", " | ").alias("reasons"), (F.size("reasons") == 0).alias("permitted")
    )


# --- catalog ---------------------------------------------------------------

_SUFFIX = " OR ".join(f"ends_with(name, '{s}')" for s in catalog.SKIP_SUFFIXES)
_SKIP = ", ".join(f"'{n}'" for n in catalog.SKIP_NAMES)


@query(
    "C1_object_filter",
    f"SELECT name, object_no FROM objects WHERE queryable AND retrieveable AND (layoutable OR searchable)"
    f" AND name NOT IN ({_SKIP}) AND NOT ({_SUFFIX})",
    "objects",
)
def object_filter(t: Inputs) -> DataFrame:
    return catalog.object_filter(t["objects"]).select("name", "object_no")


_CRM = "CASE column_id % 8 WHEN 0 THEN 'string' WHEN 1 THEN 'id' WHEN 2 THEN 'int' WHEN 3 THEN 'picklist' WHEN 4 THEN 'address' WHEN 5 THEN 'currency' WHEN 6 THEN 'datetime' ELSE 'newtype' END"


@query(
    "C2_describe_columns",
    f"WITH f AS (SELECT table_name, column_id, column_name, {_CRM} AS kind, coalesce(char_length, 0) AS len, nullable,"
    " row_number() OVER (PARTITION BY table_name ORDER BY column_id) - 1 AS ordinal FROM cat_columns)"
    " SELECT table_name, ordinal, column_name, kind AS raw_type, CASE kind WHEN 'int' THEN 'integer' WHEN 'currency'"
    " THEN 'float' WHEN 'datetime' THEN 'datetime' ELSE 'string' END AS canonical, nullif(len, 0) AS max_length,"
    " nullable = 'Y' AS is_nullable, column_id % 2 = 0 AS is_read_only, column_id % 3 = 0 AS is_indexed,"
    " CASE WHEN kind = 'picklist' THEN 'Web,Phone' ELSE '' END AS enum_text,"
    " CASE WHEN kind = 'id' THEN 'Account' ELSE '' END AS references_text FROM f WHERE kind <> 'address'",
    "cat_columns",
)
def describe_columns(t: Inputs) -> DataFrame:
    kind = F.expr(_CRM)
    value = T.ArrayType(T.StructType([T.StructField("value", T.StringType()), T.StructField("active", T.BooleanType())]))
    choices = F.from_json(
        F.lit('[{"value":"Web","active":true},{"value":"Old","active":false},{"value":"Phone","active":true}]'), value
    )
    one = F.struct(
        "column_id",
        F.col("column_name").alias("name"),
        F.lower("column_name").alias("label"),
        kind.alias("type"),
        F.coalesce("char_length", F.lit(0)).alias("length"),
        F.lit(0).alias("precision"),
        F.lit(0).alias("scale"),
        (F.col("nullable") == "Y").alias("nillable"),
        F.lit(False).alias("unique"),
        (F.col("column_id") % 2 != 0).alias("updateable"),
        F.lit(False).alias("calculated"),
        (F.col("column_id") % 3 == 0).alias("idLookup"),
        F.lit(False).alias("externalId"),
        F.when(kind == "picklist", choices).alias("picklistValues"),
        F.when(kind == "id", F.array(F.lit("Account"))).alias("referenceTo"),
    )
    # A describe lists the columns of one table, at most seven here.
    describes = t["cat_columns"].groupBy(F.col("table_name").alias("name")).agg(
        F.sort_array(F.collect_list(one)).alias("fields")
    )
    return catalog.describe_columns(describes).select(
        "table_name", F.col("ordinal").cast("bigint").alias("ordinal"), "column_name", "raw_type", "canonical",
        "max_length", "is_nullable", "is_read_only", "is_indexed", F.array_join("enum_values", ",").alias("enum_text"),
        F.array_join(F.map_keys("foreign_key_mapping"), ",").alias("references_text"),
    )


_DEFINITION = "CASE column_id % 7 WHEN 0 THEN 'Text(80)' WHEN 1 THEN 'Number(18, 2)' WHEN 2 THEN 'Checkbox' WHEN 3 THEN 'Date/Time' WHEN 4 THEN 'Multi-Select Picklist' WHEN 5 THEN 'File' ELSE 'Mystery' END"
_RELATIONAL = (
    "CASE WHEN data_type = 'NUMBER' AND data_scale = 0 THEN 'integer' WHEN data_type = 'NUMBER' THEN 'float'"
    " WHEN data_type LIKE '%TIMESTAMP%' THEN 'datetime' WHEN data_type = 'DATE' THEN 'date'"
    " WHEN data_type = 'BLOB' THEN 'byte' WHEN data_type = 'JSON' THEN 'json' ELSE 'string' END"
)


@query(
    "C3_type_map",
    f"SELECT table_name, column_name, {_RELATIONAL} AS relational, CASE {_CRM} WHEN 'int' THEN 'integer'"
    " WHEN 'currency' THEN 'float' WHEN 'datetime' THEN 'datetime' WHEN 'address' THEN 'json' ELSE 'string' END AS crm,"
    f" CASE {_DEFINITION} WHEN 'Number(18, 2)' THEN 'float' WHEN 'Checkbox' THEN 'boolean' WHEN 'Date/Time' THEN"
    " 'datetime' WHEN 'File' THEN 'byte' ELSE 'string' END AS definition FROM cat_columns",
    "cat_columns",
)
def type_map(t: Inputs) -> DataFrame:
    return t["cat_columns"].select(
        "table_name", "column_name",
        catalog.relational_canonical(F.col("data_type"), F.col("data_scale")).alias("relational"),
        catalog.crm_canonical(F.expr(_CRM)).alias("crm"),
        catalog.definition_canonical(F.expr(_DEFINITION)).alias("definition"),
    )


@query(
    "C4_target_type",
    f"WITH k AS (SELECT *, {_RELATIONAL} AS canonical, CASE WHEN column_id = 6 THEN 'clob' END AS forced FROM cat_columns)"
    " SELECT table_name, column_name, CASE WHEN forced IS NOT NULL THEN upper(forced)"
    " WHEN canonical = 'string' THEN CASE WHEN char_length IS NULL THEN 'CLOB' ELSE 'VARCHAR2(' || char_length || ' CHAR)' END"
    " WHEN canonical = 'integer' THEN 'NUMBER' WHEN canonical = 'float' THEN CASE WHEN data_precision IS NOT NULL"
    " AND data_scale IS NOT NULL THEN 'NUMBER(' || data_precision || ', ' || data_scale || ')' ELSE 'NUMBER' END"
    " WHEN canonical = 'datetime' THEN CASE WHEN column_id % 2 = 0 THEN 'TIMESTAMP WITH TIME ZONE' ELSE 'TIMESTAMP' END"
    " WHEN canonical = 'date' THEN 'DATE' WHEN canonical = 'byte' THEN 'BLOB' ELSE 'JSON' END AS target_type FROM k",
    "cat_columns",
)
def target_type(t: Inputs) -> DataFrame:
    made = catalog.target_type(
        catalog.relational_canonical(F.col("data_type"), F.col("data_scale")),
        F.col("char_length"), F.col("data_precision"), F.col("data_scale"),
        forced=F.when(F.col("column_id") == 6, "clob"), zoned=F.col("column_id") % 2 == 0,
    )
    return t["cat_columns"].select("table_name", "column_name", made.alias("target_type"))


_CONSTRAINTS = ("cat_constraints", "cat_cons_columns")
_CATALOG = ("cat_columns", "cat_constraints", "cat_cons_columns", "cat_indexes", "cat_ind_columns")
_FK = (
    "WITH named AS (SELECT * FROM cat_cons_columns JOIN cat_constraints USING (owner, constraint_name, table_name)),"
    " child AS (SELECT owner, table_name, column_name, position, r_constraint_name AS wanted FROM named WHERE constraint_type = 'R'),"
    " parent AS (SELECT owner, table_name AS ref_table, column_name AS ref_column, position, constraint_name AS wanted FROM named)"
    " SELECT owner, table_name, column_name, ref_table, ref_column FROM child JOIN parent USING (owner, wanted, position)"
)


@query(
    "C5_key_rollup",
    "WITH pk AS (SELECT DISTINCT c.owner, c.table_name, c.column_name FROM cat_constraints k JOIN cat_cons_columns c"
    " ON c.owner = k.owner AND c.constraint_name = k.constraint_name WHERE k.constraint_type = 'P'),"
    f" fk AS (SELECT owner, table_name, column_name, string_agg(ref_table || '=' || ref_column, ',' ORDER BY ref_table)"
    f" AS refs FROM ({_FK}) GROUP BY 1, 2, 3),"
    " ix AS (SELECT i.owner, c.table_name, c.column_name, bool_or(i.uniqueness = 'UNIQUE') AS is_unique FROM cat_indexes i"
    " JOIN cat_ind_columns c ON c.owner = i.owner AND c.index_name = i.index_name WHERE i.index_type <> 'LOB'"
    " AND i.generated = 'N' GROUP BY 1, 2, 3)"
    " SELECT c.table_name, c.column_name, pk.owner IS NOT NULL AS is_primary_key, fk.owner IS NOT NULL AS is_foreign_key,"
    " ix.owner IS NOT NULL AS is_indexed, coalesce(ix.is_unique, FALSE) AS is_unique, coalesce(fk.refs, '') AS refs"
    " FROM cat_columns c LEFT JOIN pk USING (owner, table_name, column_name)"
    " LEFT JOIN fk USING (owner, table_name, column_name) LEFT JOIN ix USING (owner, table_name, column_name)",
    *_CATALOG,
)
def key_rollup(t: Inputs) -> DataFrame:
    rolled = catalog.key_rollup(*(t[n] for n in _CATALOG))
    pairs = F.transform(F.map_entries("fk_map"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rolled.select(
        "table_name", "column_name", "is_primary_key", "is_foreign_key", "is_indexed", "is_unique",
        F.coalesce(F.array_join(pairs, ","), F.lit("")).alias("refs"),
    )


# Each input is worked out once; one engine has not come to an end with them inlined.
query("C6_fk_pairs", _FK.replace(" AS (", " AS MATERIALIZED ("), *_CONSTRAINTS, materialized=True)(lambda t: catalog.fk_pairs(t["cat_constraints"], t["cat_cons_columns"]))

_KINDS = ", ".join(f"('{k}', '{v}')" for k, v in catalog.CONSTRAINT_TEXT.items())
_LISTING = (
    f"WITH kinds(constraint_type, text) AS (VALUES {_KINDS}),"
    " placed AS (SELECT owner, constraint_name, table_name, column_name, position FROM cat_cons_columns),"
    " target AS (SELECT owner AS r_owner, constraint_name AS r_constraint_name, position, table_name AS r_table, column_name AS r_column FROM placed)"
    " SELECT owner, k.table_name, placed.column_name, constraint_name,"
    " coalesce(text, 'UNKNOWN (' || constraint_type || ')') AS constraint_type_desc, r_table, r_column"
    " FROM placed JOIN (SELECT owner, constraint_name, table_name, constraint_type, r_owner, r_constraint_name FROM cat_constraints) k USING (owner, constraint_name)"
    " LEFT JOIN kinds USING (constraint_type) LEFT JOIN target USING (r_owner, r_constraint_name, position)"
)
_LISTED = ["owner", "table_name", "column_name", "constraint_name", "constraint_type_desc", "r_table", "r_column"]
query("C7_constraint_listing", _LISTING, *_CONSTRAINTS)(
    lambda t: catalog.constraint_listing(t["cat_constraints"], t["cat_cons_columns"]).select(*_LISTED)
)
query(
    "C7_filtered_listing",
    _LISTING.replace(" AS (", " AS MATERIALIZED (") + " WHERE owner = 'OWN3' AND placed.column_name = 'C3'",
    *_CONSTRAINTS, materialized=True,
)(
    lambda t: catalog.constraint_listing(
        t["cat_constraints"], t["cat_cons_columns"], owner="own3", column_name="c3"
    ).select(*_LISTED)
)
query(
    "C8_composite_keys",
    "SELECT con.owner, con.table_name, con.constraint_name, string_agg(col.column_name, ' ' ORDER BY col.position)"
    " AS column_names, CASE WHEN count(*) > 1 THEN 'YES' ELSE 'NO' END AS is_composite FROM cat_constraints con"
    " JOIN cat_cons_columns col ON con.constraint_name = col.constraint_name AND con.owner = col.owner"
    " GROUP BY con.owner, con.table_name, con.constraint_name",
    *_CATALOG,
)(
    lambda t: catalog.composite_keys(t["cat_constraints"], t["cat_cons_columns"]).select(
        "owner", "table_name", "constraint_name", "column_names", "is_composite"
    )
)
query("C9_distinct_names", "SELECT DISTINCT owner, table_name FROM cat_columns", "cat_columns")(
    lambda t: catalog.distinct_names(t["cat_columns"], "owner", "table_name")
)
query(
    "C10_object_exists",
    "SELECT count(*) > 0 AS found FROM cat_constraints WHERE upper(table_name) = 'T42' AND upper(owner) = 'OWN4'",
    "cat_constraints",
)(
    lambda t: catalog.object_exists(
        t["cat_constraints"].select("owner", F.col("table_name").alias("object_name"), F.lit("TABLE").alias("object_type")),
        "t42", "own4", "table",
    )
)
query(
    "C11_immutable_constraints",
    "SELECT constraint_name FROM cat_constraints WHERE constraint_type IN ('P', 'U', 'R')",
    "cat_constraints",
)(lambda t: catalog.immutable_constraints(t["cat_constraints"]).select("constraint_name"))

_BOTH = (
    "WITH b AS (SELECT d.*, a.table_name IS NOT NULL AS there, regexp_replace(a.data_type, '\\(\\s*\\d+\\s*\\)', '') AS now,"
    " coalesce(a.char_length, a.data_length) AS len, a.nullable = 'Y' AS was_nullable FROM desired_columns d"
    " LEFT JOIN cat_columns a ON a.table_name = d.table_name AND a.column_name = d.column_name)"
)
_DRIFT = (
    " SELECT table_name, column_name, 'ADD' AS action, raw_type AS detail FROM b WHERE NOT there"
    " UNION ALL SELECT table_name, column_name, 'WIDEN', CAST(CASE WHEN canonical = 'boolean' THEN 1"
    " ELSE least(max_length + 50, 4000) END AS VARCHAR) FROM b WHERE there AND raw_type = 'VARCHAR2' AND now = 'VARCHAR2'"
    " AND CASE WHEN canonical = 'boolean' THEN 1 ELSE max_length END > len"
    " UNION ALL SELECT table_name, column_name, 'MODIFY TYPE', raw_type FROM b WHERE there AND raw_type <> now"
    " UNION ALL SELECT table_name, column_name, 'NULL', NULL FROM b WHERE there AND is_nullable AND NOT was_nullable"
)
query("C12_schema_drift", _BOTH + _DRIFT, "desired_columns", "cat_columns")(
    lambda t: catalog.schema_drift(t["desired_columns"], t["cat_columns"], enforce=False)
)
query(
    "C12_enforced_drift",
    _BOTH + _DRIFT
    + " UNION ALL SELECT table_name, column_name, 'NOT NULL', NULL FROM b WHERE there AND NOT is_nullable AND was_nullable",
    "desired_columns", "cat_columns",
)(lambda t: catalog.schema_drift(t["desired_columns"], t["cat_columns"]))

_DESIRED_TWICE = (
    "SELECT 'A' AS owner, table_name, column_name, raw_type, canonical, max_length, is_nullable FROM {d} UNION ALL"
    " SELECT 'B', table_name, column_name, raw_type, canonical, max_length + 500, is_nullable FROM {d}"
)
_ACTUAL_TWICE = (
    "SELECT 'A' AS owner, table_name, column_name, data_type, char_length, data_length, nullable FROM {a} UNION ALL"
    " SELECT 'B', table_name, column_name, data_type, char_length + 200, data_length, nullable FROM {a}"
)


@query(
    "C12_owner_drift",
    f"WITH d2 AS ({_DESIRED_TWICE.format(d='desired_columns')}), a2 AS ({_ACTUAL_TWICE.format(a='cat_columns')}), "
    + _BOTH.removeprefix("WITH ").replace("desired_columns d", "d2 d").replace("cat_columns a ON", "a2 a ON a.owner = d.owner AND")
    + _DRIFT.replace("SELECT table_name", "SELECT owner, table_name"),
    "desired_columns", "cat_columns",
)
def owner_drift(t: Inputs) -> DataFrame:
    """Tables of one name under two owners."""
    desired = t.spark.sql(_DESIRED_TWICE, d=t["desired_columns"])
    return catalog.schema_drift(desired, t.spark.sql(_ACTUAL_TWICE, a=t["cat_columns"]), enforce=False)


# What the profiled table declares.
_DECLARED = [
    ("doc_id", "NUMBER", None, False, True, True),
    ("text", "VARCHAR2", 100, True, False, False),
    ("source", "VARCHAR2", 4, False, False, False),
    ("ssn", "VARCHAR2", 8, False, False, True),
    ("lang", "VARCHAR2", 30, True, False, False),
    ("copy", "VARCHAR2", 100, True, True, False),
]


@query(
    "C13_overflow_plan",
    "WITH d AS (SELECT s.*, d.lang, s.text AS copy FROM sensitive s JOIN documents d ON d.doc_id = s.doc_id), p AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {'NULL' if kind == 'NUMBER' else f'max(length({name}))'} AS chars,"
        f" count(*) FILTER ({name} IS NULL) AS nulls, {length or 'NULL'} AS declared, {str(nullable).upper()} AS may_null,"
        f" {str(key or index).upper()} AS pinned FROM d"
        for name, kind, length, nullable, key, index in _DECLARED
    )
    + ") SELECT column_name, CASE WHEN chars > declared AND chars > 4000 AND pinned THEN 'REFUSED'"
    " WHEN chars > declared AND chars > 4000 THEN 'PROMOTE' WHEN chars > declared THEN 'WIDEN' ELSE 'NONE' END AS size_action,"
    " CASE WHEN chars > declared AND chars <= 4000 THEN CAST(least(chars + 50, 4000) AS INTEGER) END AS new_length,"
    " NOT may_null AND nulls > 0 AS relax_null FROM p",
    "sensitive",
)
def overflow_plan(t: Inputs) -> DataFrame:
    rows = t["sensitive"].join(t["documents"].select("doc_id", "lang"), "doc_id").withColumn("copy", F.col("text"))
    schema = (
        "column_name string, raw_type string, max_length int, is_nullable boolean, is_key boolean, is_indexed boolean"
    )
    declared = t.spark.createDataFrame(_DECLARED, schema)
    return catalog.overflow_plan(catalog.profile(rows), declared)


@query(
    "C14_rename_map",
    "WITH s AS (SELECT table_name, lower(column_name) || ' x' AS column_name FROM cat_columns),"
    " g AS (SELECT table_name, CASE WHEN column_id % 2 = 0 THEN column_name ELSE lower(column_name) END || '_X' AS column_name,"
    " column_id FROM cat_columns UNION ALL SELECT table_name, column_name || '__x', column_id FROM cat_columns"
    " UNION ALL SELECT table_name, column_name || '-X', column_id + 100 FROM cat_columns WHERE column_id = 2),"
    " t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, upper(replace(column_name, '-', '_'))"
    " ORDER BY column_id DESC) AS rn FROM g) z WHERE rn = 1)"
    " SELECT s.table_name, s.column_name AS source_column, t.column_name AS target_column FROM s JOIN t"
    " ON t.table_name = s.table_name AND upper(replace(t.column_name, '-', '_')) = upper(replace(s.column_name, ' ', '_'))",
    "cat_columns",
)
def rename_map(t: Inputs) -> DataFrame:
    base = t["cat_columns"]
    at = F.col("column_id")
    column = F.col("column_name")
    source = base.select("table_name", F.concat(F.lower(column), F.lit(" x")).alias("column_name"))
    cased = F.when(at % 2 == 0, column).otherwise(F.lower(column))
    target = (
        base.select("table_name", F.concat(cased, F.lit("_X")).alias("column_name"), at.alias("ordinal"))
        .unionByName(base.select("table_name", F.concat(column, F.lit("__x")).alias("column_name"), at.alias("ordinal")))
        .unionByName(
            base.filter(at == 2).select(
                "table_name", F.concat(column, F.lit("-X")).alias("column_name"), (at + 100).alias("ordinal")
            )
        )
    )
    return catalog.rename_map(source, target)


@query(
    "C14_owner_rename",
    "SELECT 'A' AS owner, table_name, lower(column_name) || ' x' AS source_column, column_name || '_X' AS target_column FROM cat_columns"
    " UNION ALL SELECT 'B', table_name, lower(column_name) || ' x', lower(column_name) || '-x' FROM cat_columns",
    "cat_columns",
)
def owner_rename(t: Inputs) -> DataFrame:
    """Tables of one name under two owners, whose columns are spelled differently."""

    def columns(owner: str, name: Column) -> DataFrame:
        return t["cat_columns"].select(F.lit(owner).alias("owner"), "table_name", name.alias("column_name"), F.col("column_id").alias("ordinal"))

    column = F.col("column_name")
    told = F.concat(F.lower(column), F.lit(" x"))
    target = columns("A", F.concat(column, F.lit("_X"))).unionByName(columns("B", F.concat(F.lower(column), F.lit("-x"))))
    return catalog.rename_map(columns("A", told).unionByName(columns("B", told)), target)


query(
    "C15_rename_columns",
    "SELECT c_custkey AS \"CUSTOMER_ID\", c_name AS \"NAME\", c_acctbal FROM customer",
)(
    lambda t: catalog.rename_columns(
        t["customer"].select("c_custkey", "c_name", "c_acctbal"), {"c_custkey": "CUSTOMER_ID", "c_name": "NAME", "x": "Y"}
    )
)
_RULED = (
    "SELECT table_name, column_id, CASE WHEN column_id % 2 = 0 THEN 'salesforce' ELSE 'oracle' END AS system,"
    " CASE column_id % 3 WHEN 0 THEN ' Case' WHEN 1 THEN 'CASE' ELSE 'Contact' END AS object_name,"
    " CASE WHEN column_id <= 4 THEN 'Description ' ELSE 'SSN__c' END AS field_name, 32000 AS max_length FROM {cat}"
)


@query(
    "C16_force_type_rules",
    "WITH r AS (" + _RULED.format(cat="cat_columns") + ") SELECT table_name, column_id, CASE WHEN hit THEN 'CLOB' END AS"
    " force_type, CASE WHEN NOT hit THEN max_length END AS max_length FROM (SELECT *, system = 'salesforce'"
    " AND lower(trim(object_name)) = 'case' AND lower(trim(field_name)) = 'description' AS hit FROM r)",
    "cat_columns",
)
def force_type_rules(t: Inputs) -> DataFrame:
    columns = t.spark.sql(_RULED.replace("{cat}", "{c}"), c=t["cat_columns"])
    ruled = catalog.force_type_rules(columns, catalog.rules_frame(t.spark))
    return ruled.select("table_name", "column_id", "force_type", "max_length")


# --- migrations and extension points ---------------------------------------

_CASE = TableSpec(
    "Case",
    system="salesforce",
    columns=(
        ColumnSpec("Id", "NUMBER", "integer", is_primary_key=True),
        ColumnSpec("Subject", max_length=255),
        ColumnSpec("Description", max_length=32000),
        ColumnSpec("SSN__c", max_length=20),
    ),
)
_MIGRATED = (
    "SELECT CAST(doc_id AS DECIMAL(38,10)) AS \"ID\", nullif(trim(source), '') AS \"SUBJECT\","
    f" regexp_replace(text, '{cell_queries._PATTERN}', '***-**-****', 'g') AS \"DESCRIPTION\","
    " nullif(trim(ssn), '') AS \"SSN__C\" FROM sensitive"
)


def _cases(t: Inputs) -> DataFrame:
    return t["sensitive"].select(
        F.col("doc_id").alias("Id"), F.col("source").alias("Subject"), F.col("text").alias("Description"),
        F.col("ssn").alias("SSN__c"),
    )


@query("P1_migrate_table", _MIGRATED, "sensitive")
def migrate_table(t: Inputs) -> DataFrame:
    root = _folder(t, "migrate")
    settings = migrate.Settings(action="upsert", redaction="full-mask")
    migrate.migrate_table(_cases(t), _CASE, root, settings)
    # A second run over the same rows must leave the table as it is.
    return migrate.migrate_table(_cases(t), _CASE, root, settings)


def _simple(name: str, df: DataFrame) -> TableSpec:
    return TableSpec(name, "salesforce", columns=tuple(ColumnSpec(c) for c in df.columns))


_CUSTOMER = TableSpec(
    "Account",
    "salesforce",
    columns=(
        ColumnSpec("Id", "NUMBER", "integer", is_primary_key=True, precision=18, scale=0), ColumnSpec("Name", max_length=18),
        ColumnSpec("NationCode", max_length=10),
    ),
)
_GROWN = replace(
    _CUSTOMER,
    columns=(
        *_CUSTOMER.columns[:1], ColumnSpec("Name", max_length=40), ColumnSpec("NationCode", "NUMBER", "integer"),
        ColumnSpec("Balance", "NUMBER", "float", precision=18, scale=2), ColumnSpec("Segment", max_length=12),
    ),
)


@query(
    "P1_drift",
    "SELECT CAST(c_custkey AS DECIMAL(18,0)) AS \"ID\", CASE WHEN c_custkey % 3 = 0 THEN c_name || ' of ' || c_mktsegment ELSE c_name END AS \"NAME\","
    " CAST(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS DECIMAL(38,0)) AS \"NATIONCODE\","
    " CASE WHEN c_custkey % 3 = 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS \"BALANCE\", CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS \"SEGMENT\""
    " FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0",
)
def migrate_drift(t: Inputs) -> DataFrame:
    """A second load that brings new columns, longer text and another type into a table that is there."""
    root, key, name, nation = _folder(t, "drift"), F.col("c_custkey"), F.col("c_name"), F.col("c_nationkey")
    first = t["customer"].filter(key % 2 == 0).select(key.alias("Id"), name.alias("Name"), nation.cast("string").alias("NationCode"))
    settings = migrate.Settings(action="upsert", buckets=16)
    migrate.migrate_table(first, _CUSTOMER, root, settings)
    second = t["customer"].filter(key % 3 == 0).select(
        key.alias("Id"), F.concat(name, F.lit(" of "), "c_mktsegment").alias("Name"), (nation + 100).cast("string").alias("NationCode"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("Balance"), F.col("c_mktsegment").alias("Segment"),
    )
    return migrate.migrate_table(second, _GROWN, root, settings)


@query(
    "P1_overflow",
    "WITH d AS (SELECT max(length(trim(text))) AS text_chars, max(length(trim(source))) AS source_chars, count(*) FILTER (nullif(trim(ssn), '') IS NULL) AS gaps FROM sensitive)"
    " SELECT 'ID' AS column_name, 'NUMBER' AS raw_type, NULL AS max_length, FALSE AS is_nullable FROM d"
    " UNION ALL SELECT 'TEXT', CASE WHEN text_chars > 4000 THEN 'CLOB' ELSE 'VARCHAR2' END, CASE WHEN text_chars <= 100 THEN 100"
    " WHEN text_chars <= 4000 THEN CAST(least(text_chars + 50, 4000) AS INTEGER) END, TRUE FROM d"
    " UNION ALL SELECT 'SOURCE', 'VARCHAR2', CASE WHEN source_chars > 2 THEN CAST(source_chars + 50 AS INTEGER) ELSE 2 END, TRUE FROM d"
    " UNION ALL SELECT 'SSN', 'VARCHAR2', 20, gaps > 0 FROM d",
    "sensitive",
)
def migrate_overflow(t: Inputs) -> DataFrame:
    """Rows that are too long, or lack a value, for the declared columns: the stored description follows them."""
    root = _folder(t, "overflow")
    spec = TableSpec(
        "Note",
        "salesforce",
        columns=(
            ColumnSpec("Id", "NUMBER", "integer", is_primary_key=True, is_nullable=False), ColumnSpec("Text", max_length=100),
            ColumnSpec("Source", max_length=2), ColumnSpec("Ssn", max_length=20, is_nullable=False),
        ),
    )
    rows = t["sensitive"].select(F.col("doc_id").alias("Id"), F.col("text").alias("Text"), F.col("source").alias("Source"), F.col("ssn").alias("Ssn"))
    migrate.migrate_table(rows, spec, root)
    stored = migrate.description(t.spark, root, "SF_Note")
    return migrate.spec_rows(t.spark, stored).select("column_name", "raw_type", "max_length", "is_nullable")


_LINE = TableSpec(
    "Line",
    "salesforce",
    columns=tuple(ColumnSpec(c, "NUMBER", "integer", is_primary_key=c in _KEYS) for c in ("order_id", "line_no", "quantity"))
    + (ColumnSpec("flag", max_length=10), ColumnSpec("supplier_id", "NUMBER", "integer"), ColumnSpec("ordinal", "NUMBER", "integer")),
)
_AS_LINE = ", ".join(f"CAST({c} AS DECIMAL(38,10)) AS \"{c.upper()}\"" for c in ("order_id", "line_no", "quantity", "supplier_id", "ordinal")) + ', flag AS "FLAG"'


@query(
    "P1_first_load_upsert",
    f"WITH s AS (SELECT * FROM upsert_source UNION ALL SELECT order_id, line_no, quantity, 'old', supplier_id, ordinal - 1 FROM upsert_source),"
    " latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_no ORDER BY ordinal DESC) AS rn FROM s WHERE order_id IS NOT NULL) x WHERE rn = 1)"
    f" SELECT {_AS_LINE} FROM latest UNION ALL SELECT {_AS_LINE} FROM s WHERE order_id IS NULL",
    "upsert_source",
)
def migrate_first_upsert(t: Inputs) -> DataFrame:
    """Several rows of one key in the first load: the table is made empty and gets one of them."""
    new = t["upsert_source"]
    old = new.withColumns({"flag": F.lit("old"), "ordinal": F.col("ordinal") - 1})
    return migrate.migrate_table(new.unionByName(old), _LINE, _folder(t, "first"), migrate.Settings(action="upsert", buckets=16), order="ORDINAL")


@query(
    "P1_first_load_update",
    "SELECT CAST(c_custkey AS DECIMAL(18,0)) AS \"ID\", CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS \"NAME\","
    " CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS \"NATIONCODE\" FROM customer WHERE c_custkey % 2 = 0",
)
def migrate_first_update(t: Inputs) -> DataFrame:
    """An update of a missing table makes it and loads nothing; one after an insert changes only what is there."""
    root, key = _folder(t, "first"), F.col("c_custkey")
    rows = t["customer"].select(key.alias("Id"), F.upper("c_name").alias("Name"), F.lit(None).cast("string").alias("NationCode"))
    update = migrate.Settings(action="update", buckets=16)
    migrate.migrate_table(rows, _CUSTOMER, root, update)
    some = t["customer"].filter(key % 2 == 0).select(key.alias("Id"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("NationCode"))
    migrate.migrate_table(some, _CUSTOMER, root)
    return migrate.migrate_table(rows.filter(F.col("Id") % 3 == 0), _CUSTOMER, root, update)


_CRM_ACCOUNT = TableSpec(
    "Account",
    "salesforce",
    columns=(
        ColumnSpec("Id", "id", is_read_only=True), ColumnSpec("Number__c", "string", is_external_id=True), ColumnSpec("Name", "string"),
        ColumnSpec("Segment__c", "picklist"), ColumnSpec("Nation_Id__c", "int", "integer"), ColumnSpec("CreatedBy", "string", is_read_only=True),
    ),
)
_CHANGED = (
    "SELECT id, name, CASE WHEN ordinal % 10 = 0 THEN '#N/A' ELSE segment END AS segment, nation_id, created_by, ordinal FROM account_changes"
)


def _crm_rows(df: DataFrame) -> DataFrame:
    """Account rows under the names of a relational table."""
    return df.withColumnsRenamed({"id": "NUMBER__C", "name": "NAME", "segment": "SEGMENT__C", "nation_id": "NATION_ID__C", "created_by": "CREATEDBY"})


@query(
    "P1_to_crm",
    f"WITH changed AS ({_CHANGED}), last AS (SELECT id, {_LAST} FROM changed WHERE id IS NOT NULL GROUP BY id)"
    " SELECT NULL AS \"Id\", coalesce(a.id, l.id) AS \"Number__c\", coalesce(l.name, a.name) AS \"Name\","
    " nullif(coalesce(l.segment, a.segment), '#N/A') AS \"Segment__c\", coalesce(l.nation_id, a.nation_id) AS \"Nation_Id__c\","
    " NULL AS \"CreatedBy\" FROM accounts a FULL JOIN last l ON l.id = a.id"
    " UNION ALL SELECT NULL, NULL, name, nullif(segment, '#N/A'), nation_id, NULL FROM changed WHERE id IS NULL",
    "accounts", "account_changes",
)
def migrate_to_crm(t: Inputs) -> DataFrame:
    """Relational rows into a CRM object: NULL leaves a field alone, the marker empties it, read-only fields are not sent."""
    root = _folder(t, "crm")
    spec = TableSpec("SF_Account", "oracle")
    settings = migrate.Settings(source_system="oracle", target_system="salesforce", action="insert", clear_marker="#N/A", buckets=16)
    migrate.migrate_table(_crm_rows(t["accounts"]), spec, root, settings, target=_CRM_ACCOUNT)
    changes = t.spark.sql(_CHANGED.replace("account_changes", "{c}"), c=t["account_changes"])
    return migrate.migrate_table(_crm_rows(changes), spec, root, replace(settings, action="upsert"), order="ordinal", target=_CRM_ACCOUNT)


@query(
    "P2_migrate_all",
    "SELECT 'Nation' AS table_name, 'SF_Nation' AS target_name, 'migrated' AS status, NULL AS code, count(*) AS processed, 0 AS rejected"
    " FROM nation UNION ALL SELECT 'Part', 'SF_Part', 'migrated', NULL, count(*), 0 FROM part"
    " UNION ALL SELECT 'Secret', 'SF_Secret', 'skipped', 'INSUFFICIENT_ACCESS', NULL, NULL"
    " UNION ALL SELECT 'ora_customer__c', 'customer', 'migrated', NULL, count(*), count(*) FILTER (c_custkey % 9 = 0) FROM customer",
)
def migrate_all(t: Inputs) -> DataFrame:
    def denied() -> DataFrame:
        raise migrate.AccessDenied("INSUFFICIENT_ACCESS")

    dated = t["customer"].withColumn("since", F.when(F.col("c_custkey") % 9 == 0, "soon").otherwise("2024-01-31"))
    chosen = {"Nation": t["nation"], "Part": t["part"]}
    tables = {n: ((lambda df=df: df), _simple(n, df)) for n, df in chosen.items()}
    spec = _simple("ora_customer__c", dated)
    tables["ora_customer__c"] = (lambda: dated), spec.with_columns(replace(c, raw_type="DATE", canonical="date") if c.name == "since" else c for c in spec.columns)
    tables["Secret"] = (denied, TableSpec("Secret", "salesforce"))
    return migrate.migrate_all(t.spark, tables, _folder(t, "all"), migrate.Settings(keep_rejects=True))


@query(
    "P3_csv_to_table",
    source_queries.CONTACTS_SQL + " UNION ALL " + source_queries.CONTACTS_SQL,
    "contacts",
)
def csv_to_table(t: Inputs) -> DataFrame:
    path, root = source_queries.contacts_csv(t), _folder(t, "contacts-table")
    migrate.csv_to_table(t.spark, path, source_queries._CONTACTS, root)
    return migrate.csv_to_table(t.spark, path, source_queries._CONTACTS, root, append=True)[0]


query(
    "U1_mask_strategy_plugin",
    f"SELECT doc_id, regexp_replace(text, '{cell_queries._PATTERN}', '[gone]', 'g') AS text FROM sensitive",
    "sensitive",
)(
    lambda t: t["sensitive"].select(
        "doc_id", masking.redact_scan(F.col("text"), lambda m: F.when(m.isNotNull(), "[gone]")).alias("text")
    )
)


@query(
    "U2_pattern_plugin",
    "SELECT 'text' AS column_name, 'mail' AS pattern_name, count(*) FILTER (len(regexp_extract_all(text,"
    " '[A-Za-z0-9._]+@[A-Za-z0-9.]+')) > 0) AS matching_rows, CAST(sum(len(regexp_extract_all(text,"
    " '[A-Za-z0-9._]+@[A-Za-z0-9.]+'))) AS BIGINT) AS matches FROM documents",
)
def pattern_plugin(t: Inputs) -> DataFrame:
    mail = masking.TextPattern("mail", r"[A-Za-z0-9._]+@[A-Za-z0-9.]+")
    return masking.discover(t["documents"], ["text"], (mail,))


@query(
    "U3_guard_rule_plugin",
    "SELECT write_id, upper(table_name) LIKE '%RED%' AS is_vetoed FROM write_plan",
    "write_plan",
)
def guard_plugin(t: Inputs) -> DataFrame:
    def protected() -> Column:
        return F.when(F.upper("table_name").contains("RED"), F.lit("red tables are protected"))

    judged = guard.evaluate(t["write_plan"], (*guard.DEFAULT_RULES, protected))
    return judged.select("write_id", F.array_contains("reasons", "red tables are protected").alias("is_vetoed"))

