"""Inputs derived from the given tables, as SQL text both engines run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

DERIVED: dict[str, str] = {}

DERIVED["members"] = """
SELECT c_custkey AS member_id,
       CASE WHEN c_custkey % 97 = 0 THEN 'N/A' ELSE lpad(cast(c_custkey AS string), 9, '0') END AS pid,
       c_mktsegment AS first_name,
       CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ''
            ELSE 'Mid' || cast(c_custkey % 26 AS string) END AS middle_name,
       c_name AS last_name,
       CASE WHEN c_custkey % 6 = 0 THEN c_custkey % 5 + 1 END AS name_prefix_id,
       CASE WHEN c_custkey % 9 = 0 THEN c_custkey % 13 + 1 END AS name_suffix_id,
       DATE '1950-01-01' + cast(c_custkey % 18000 AS int) AS birthdate,
       CASE WHEN c_custkey % 31 = 0 THEN DATE '2015-03-01' + cast(c_custkey % 900 AS int) END AS dt_of_death,
       CASE WHEN c_custkey % 3 = 1
            THEN lower(c_mktsegment) || cast(c_custkey AS string) || '@example.org' END AS email_addr,
       20 + c_custkey % 2 AS gender_id,
       23 + c_custkey % 3 AS mar_status_id,
       CASE WHEN c_custkey % 2 = 0
            THEN lpad(cast((c_custkey * 7919) % 1000 AS string), 3, '0') || '-'
              || lpad(cast((c_custkey * 31) % 100 AS string), 2, '0') || '-'
              || lpad(cast((c_custkey * 104729) % 10000 AS string), 4, '0') END AS ssn,
       CASE WHEN c_custkey % 10 = 0 THEN '12' ELSE '37' END AS status_id
FROM {customer}
"""

_ADDRESS = """
SELECT c.c_custkey AS member_id, c.c_custkey * 10 + %(nth)d AS addr_id,
       cast(c.c_custkey %% 900 + 1 AS string) || ' Main Street' AS address1,
       CASE WHEN c.c_custkey %% 8 = 0 THEN 'Unit %(nth)d' END AS address2,
       cast(NULL AS string) AS address3, cast(NULL AS string) AS address4,
       n.n_name AS city, r.r_name AS county, 'S' || cast(n.n_nationkey AS string) AS state,
       lpad(cast(c.c_custkey %% 100000 AS string), 5, '0') AS postal, 'C' || cast(r.r_regionkey AS string) AS country
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
WHERE %(test)s
"""
DERIVED["addresses"] = (
    _ADDRESS % {"nth": 1, "test": "c.c_custkey % 5 <> 0"}
    + "UNION ALL"
    + _ADDRESS % {"nth": 2, "test": "c.c_custkey % 50 = 1"}
)

DERIVED["phones"] = """
SELECT c_custkey AS member_id, c_custkey * 10 + 1 AS phn_id,
       '555-' || lpad(cast(c_custkey % 10000 AS string), 4, '0') AS phone, cast(1 AS bigint) AS phone_type_id
FROM {customer} WHERE c_custkey % 3 <> 0
UNION ALL
SELECT c_custkey AS member_id, c_custkey * 10 + 2 AS phn_id,
       '556-' || lpad(cast(c_custkey % 10000 AS string), 4, '0') AS phone, cast(2 AS bigint) AS phone_type_id
FROM {customer} WHERE c_custkey % 7 = 0
"""

DERIVED["census"] = """
SELECT m.pid, m.first_name, substr(m.middle_name, 1, 1) AS middle_initial, m.last_name, m.birthdate, m.dt_of_death,
       a.address1, a.address2, a.address3, a.city, a.state, a.postal, a.country, p.phone,
       CASE WHEN m.member_id % 13 = 0 THEN 'old@example.org' ELSE m.email_addr END AS email_addr,
       m.mar_status_id, m.gender_id
FROM {members} m
LEFT JOIN {addresses} a ON a.member_id = m.member_id AND a.addr_id = m.member_id * 10 + 1
LEFT JOIN {phones} p ON p.member_id = m.member_id AND p.phn_id = m.member_id * 10 + 1
WHERE m.pid <> 'N/A' AND m.member_id % 17 <> 0
"""

# The small code tables members refer to.
DERIVED["lov"] = """
SELECT cast(i AS bigint) AS lov_id, t AS lov_type, d AS lov_desc FROM (
  VALUES (20, 'CSM_SEX', 'Female'), (21, 'CSM_SEX', 'Male'), (23, 'CSM_MARITAL_ST', 'Single'),
         (24, 'CSM_MARITAL_ST', 'Married'), (25, 'CSM_MARITAL_ST', 'Widowed')) AS v(i, t, d)
"""
DERIVED["prefixes"] = """
SELECT cast(i AS bigint) AS name_prefix_id, d AS name_prefix
FROM (VALUES (1, 'Mr'), (2, 'Ms'), (3, 'Mrs'), (4, 'Dr')) AS v(i, d)
"""
DERIVED["suffixes"] = """
SELECT cast(i AS bigint) AS name_suffix_id, d AS name_suffix
FROM (VALUES (1, 'Jr'), (2, 'Sr'), (3, 'I'), (4, 'II'), (5, 'III'), (6, 'IV'), (7, 'V'), (8, 'VI'), (9, 'VII'),
             (10, 'MD'), (11, 'PhD'), (12, 'Esq'), (13, 'CPA')) AS v(i, d)
"""
DERIVED["phone_types"] = """
SELECT cast(i AS bigint) AS phone_type_id, d AS phone_type
FROM (VALUES (1, 'Home'), (2, 'Work'), (3, 'Mobile')) AS v(i, d)
"""

DERIVED["inbound"] = """
SELECT e.event_id AS mq_id, lpad(cast(e.user_id * 11 AS string), 9, '0') AS pid,
       CASE WHEN e.event_type = 'error' AND e.event_id % 2 = 0 THEN repeat('X', 100)
            WHEN m.member_id IS NULL THEN 'New' ELSE m.first_name END AS first_name,
       m.middle_name,
       CASE WHEN e.event_type = 'signup' THEN coalesce(m.last_name, 'None') || '-' || cast(e.event_id % 3 AS string)
            ELSE m.last_name END AS last_name,
       CASE WHEN e.event_type = 'error' AND e.event_id % 2 = 1 THEN 100013 ELSE m.name_suffix_id END AS name_suffix_id,
       m.birthdate, m.dt_of_death,
       CASE WHEN e.event_id % 29 = 0 THEN NULL ELSE m.email_addr END AS email_addr,
       m.gender_id, m.mar_status_id,
       CASE WHEN e.event_type = 'click' THEN '557-' || lpad(cast(e.event_id % 4 AS string), 4, '0')
            ELSE p.phone END AS phone,
       CASE WHEN e.event_type = 'click' AND e.event_id % 5 = 0 THEN NULL
            WHEN e.event_type = 'click' AND e.event_id % 11 = 0 THEN cast(2 AS bigint)
            WHEN e.event_type = 'click' THEN cast(1 AS bigint) ELSE p.phone_type_id END AS phone_type_id,
       a.address1, a.address2, a.address3, a.address4,
       CASE WHEN e.event_type = 'purchase' THEN 'Town ' || cast(e.event_id % 3 AS string) ELSE a.city END AS city,
       a.county, a.state, a.postal, a.country, 202 AS mq_status
FROM {events} e
LEFT JOIN {members} m ON m.member_id = e.user_id * 11
LEFT JOIN {addresses} a ON a.member_id = m.member_id AND a.addr_id = m.member_id * 10 + 1
LEFT JOIN {phones} p ON p.member_id = m.member_id AND p.phn_id = m.member_id * 10 + 1
"""


DERIVED["cells"] = """
SELECT o_orderkey AS row_id,
       CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'TRUE' WHEN 2 THEN 'false' WHEN 3 THEN 'yes' WHEN 4 THEN ''
       END AS flag,
       CASE o_orderkey % 7 WHEN 0 THEN ' ' || cast(o_orderkey AS string) || ' ' WHEN 1 THEN '+' || cast(o_orderkey AS string)
            WHEN 2 THEN '3.14' WHEN 3 THEN '' WHEN 4 THEN '-' || cast(o_orderkey AS string)
            WHEN 5 THEN 'x' || cast(o_orderkey AS string) END AS whole,
       CASE o_orderkey % 5 WHEN 0 THEN '1e3' WHEN 1 THEN 'abc' WHEN 2 THEN ''
            ELSE cast(cast(o_totalprice AS decimal(18, 2)) AS string) END AS real_text,
       CASE o_orderkey % 5 WHEN 0 THEN '1,234,' || lpad(cast(o_orderkey % 1000 AS string), 3, '0') || '.50'
            WHEN 1 THEN ' 100.50 ' WHEN 2 THEN 'n/a' WHEN 3 THEN ''
            ELSE cast(cast(o_totalprice AS decimal(18, 2)) AS string) END AS money,
       CASE o_orderkey % 6 WHEN 0 THEN cast(cast(o_orderdate AS date) AS string) || 'T00:00:00' WHEN 1 THEN 'not a date'
            WHEN 2 THEN '' WHEN 3 THEN '2024-13-45' ELSE cast(cast(o_orderdate AS date) AS string) END AS day,
       CASE o_orderkey % 9 WHEN 7 THEN 'later' WHEN 8 THEN ''
            WHEN 5 THEN cast(cast(o_orderdate AS date) AS string) || ' 08:15:00'
            ELSE cast(cast(o_orderdate AS date) AS string) || 'T12:' || lpad(cast(o_orderkey % 60 AS string), 2, '0') || ':00'
              || CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'Z' WHEN 2 THEN '+0000' WHEN 3 THEN '+02:00'
                                     WHEN 4 THEN '.123' ELSE '-05:30' END END AS stamp,
       CASE o_orderkey % 5 WHEN 0 THEN '12:30:00.000Z' WHEN 1 THEN '08:15' WHEN 2 THEN '25:00:00' WHEN 3 THEN ''
            ELSE '23:59:' || lpad(cast(o_orderkey % 60 AS string), 2, '0') END AS clock,
       CASE o_orderkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN ' y ' WHEN 2 THEN 'N' WHEN 3 THEN '' END AS yn,
       CASE o_orderkey % 5 WHEN 0 THEN '   ' WHEN 1 THEN chr(9) || ' ' WHEN 2 THEN chr(0) || ' '
            WHEN 3 THEN 'a' || chr(0) || o_orderpriority ELSE ' ' || o_orderpriority || chr(9) END AS note
FROM {orders}
"""

DERIVED["names"] = """
SELECT DISTINCT name FROM (
  SELECT p_name || '.' || p_type AS name FROM {part}
  UNION ALL SELECT url AS name FROM {pages}
  UNION ALL SELECT '  ' || c_name || ' ' AS name FROM {customer}
  UNION ALL SELECT cast(p_size AS string) || ' ' || p_name AS name FROM {part}
  UNION ALL SELECT 'Org_' || replace(p_name, ' ', '') || cast(p_partkey AS string) || '__c' AS name FROM {part}
  UNION ALL SELECT repeat(p_name || ' ', 20) || cast(p_partkey AS string) AS name FROM {part}
  UNION ALL SELECT CASE p_partkey % 9 WHEN 0 THEN 'Select' WHEN 1 THEN 'Index' WHEN 2 THEN 'order' WHEN 3 THEN 'Case'
                   WHEN 4 THEN '  group ' WHEN 5 THEN '***' WHEN 6 THEN '' WHEN 7 THEN 'Date!' ELSE p_brand END AS name
            FROM {part}) AS n
"""

DERIVED["table_names"] = """
SELECT p_partkey AS name_id,
       CASE p_partkey % 5 WHEN 0 THEN 'Contact' || cast(p_partkey AS string)
            WHEN 1 THEN 'ora_unit' || cast(p_partkey AS string) || '__c' WHEN 2 THEN 'SF_Case' || cast(p_partkey AS string)
            WHEN 3 THEN 'ORA_Part' || cast(p_partkey AS string) ELSE 'sf_' || replace(p_name, ' ', '_') END AS name,
       CASE WHEN p_size % 2 = 0 THEN 'salesforce' ELSE 'oracle' END AS source_system,
       CASE WHEN p_size % 3 = 0 THEN 'salesforce' ELSE 'oracle' END AS target_system
FROM {part}
"""

DERIVED["statements"] = """
SELECT p_partkey AS statement_id,
       CASE p_partkey % 4
         WHEN 0 THEN 'SELECT Id, (SELECT Id FROM Kids) FROM ' || replace(p_name, ' ', '_') || '__c WHERE a IN (1, 2)'
         WHEN 1 THEN 'select Id from   Obj' || cast(p_partkey AS string) || ' limit 5'
         WHEN 2 THEN 'SELECT COUNT() FROM ' || p_type ELSE 'DESCRIBE ' || p_name END AS statement
FROM {part}
"""

_SSN = (
    "lpad(cast((doc_id * 7919) % 1000 AS string), 3, '0') || {s} || lpad(cast((doc_id * 31) % 100 AS string), 2, '0')"
    " || {s} || lpad(cast((doc_id * 104729) % 10000 AS string), 4, '0')"
)
_ANY_SSN = (
    f"CASE doc_id % 3 WHEN 0 THEN {_SSN.format(s=repr('-'))} WHEN 1 THEN {_SSN.format(s=repr(' '))}"
    f" ELSE {_SSN.format(s=repr(''))} END"
)
DERIVED["sensitive"] = f"""
SELECT doc_id, source,
       CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN 'pt SSN ' || {_ANY_SSN} || ', call back. ' || text
            WHEN 2 THEN substr(text, 1, 40) || ' (' || {_ANY_SSN} || ') ' || substr(text, 41) || ' id ' || {_ANY_SSN}
            ELSE text || ' ' || {_ANY_SSN} END AS text,
       CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN '12' WHEN 3 THEN ' ' || {_ANY_SSN} || ' '
            ELSE {_ANY_SSN} END AS ssn
FROM {{documents}}
"""


DERIVED["upsert_target"] = """
SELECT l_orderkey AS order_id, cast(l_linenumber AS bigint) AS line_no, max(l_partkey % 50) AS quantity,
       max(l_returnflag) AS flag, max(l_suppkey) AS supplier_id
FROM {lineitem} WHERE l_orderkey % 2 = 0 GROUP BY l_orderkey, l_linenumber
"""

DERIVED["upsert_source"] = """
SELECT CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_orderkey END AS order_id, cast(l_linenumber AS bigint) AS line_no,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_partkey % 60 END AS quantity,
       CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'U' || cast(l_suppkey % 9 AS string) END AS flag,
       l_suppkey AS supplier_id, l_partkey * 100000 + l_suppkey AS ordinal
FROM {lineitem} WHERE l_orderkey % 3 <> 1
"""

DERIVED["accounts"] = """
SELECT 'A' || cast(c_custkey AS string) AS id, c_name AS name, c_mktsegment AS segment,
       cast(c_nationkey AS bigint) AS nation_id, 'sys' AS created_by
FROM {customer}
"""

DERIVED["account_changes"] = """
SELECT CASE WHEN event_id % 41 = 0 THEN NULL ELSE 'A' || cast(user_id * 11 AS string) END AS id,
       CASE WHEN event_id % 3 = 0 THEN 'Name ' || cast(event_id AS string) END AS name,
       CASE WHEN event_id % 5 = 0 THEN event_type END AS segment,
       CASE WHEN event_id % 7 = 0 THEN event_id % 25 END AS nation_id, 'me' AS created_by, event_id AS ordinal
FROM {events}
"""

DERIVED["contacts"] = """
SELECT CASE WHEN c_custkey % 11 = 0 THEN 'n' || cast(c_custkey AS string) ELSE cast(c_custkey AS string) END AS idx,
       'C-' || cast(c_custkey AS string) AS customer_id, c_name AS full_name,
       c_mktsegment || ', "' || cast(c_nationkey AS string) || '"' AS company,
       CASE WHEN c_custkey % 13 = 0 THEN 'soon' WHEN c_custkey % 17 = 0 THEN '2023-02-30'
            ELSE cast(DATE '2020-01-01' + cast(c_custkey % 1000 AS int) AS string) END AS subscribed
FROM {customer}
"""

DERIVED["objects"] = """
SELECT CASE p_partkey % 9 WHEN 0 THEN 'Account' || cast(p_partkey AS string) WHEN 1 THEN 'AccountHistory'
            WHEN 2 THEN 'Unit' || cast(p_partkey AS string) || '__ChangeEvent' WHEN 3 THEN 'LoginGeo'
            WHEN 4 THEN 'Box' || cast(p_partkey AS string) || '__e' WHEN 5 THEN 'Ware' || cast(p_partkey AS string) || '__c'
            ELSE replace(p_name, ' ', '') || cast(p_partkey AS string) END AS name,
       p_partkey AS object_no, p_size % 7 <> 0 AS queryable, p_size % 5 <> 0 AS retrieveable,
       p_partkey % 4 = 0 AS layoutable, p_partkey % 3 <> 0 AS searchable
FROM {part}
"""

DERIVED["cat_columns"] = """
SELECT DISTINCT 'OWN' || cast(cast(floor(l_orderkey / 10) AS bigint) % 10 AS string) AS owner,
       'T' || cast(l_orderkey AS string) AS table_name, 'C' || cast(l_linenumber AS string) AS column_name,
       cast(l_linenumber AS bigint) AS column_id,
       CASE (l_orderkey + l_linenumber) % 8 WHEN 0 THEN 'VARCHAR2' WHEN 1 THEN 'NUMBER' WHEN 2 THEN 'DATE'
            WHEN 3 THEN 'TIMESTAMP(6)' WHEN 4 THEN 'CLOB' WHEN 5 THEN 'BLOB' WHEN 6 THEN 'JSON' ELSE 'SDO_GEOMETRY'
       END AS data_type,
       CASE WHEN (l_orderkey + l_linenumber) % 16 = 1 THEN 0 WHEN (l_orderkey + l_linenumber) % 24 = 9 THEN 4
       END AS data_scale,
       CASE WHEN (l_orderkey + l_linenumber) % 8 = 1 AND l_orderkey % 2 = 0 THEN 18 END AS data_precision,
       CASE WHEN (l_orderkey + l_linenumber) % 8 = 0 THEN cast(l_orderkey % 300 AS int) + 1 END AS char_length,
       cast(4000 AS int) AS data_length,
       CASE WHEN l_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS nullable
FROM {lineitem}
"""

DERIVED["desired_columns"] = """
SELECT table_name, column_name,
       CASE WHEN column_id % 5 = 4 THEN 'CLOB' WHEN data_type = 'TIMESTAMP(6)' THEN 'TIMESTAMP'
            WHEN data_type IN ('VARCHAR2', 'NUMBER', 'DATE', 'CLOB', 'BLOB') THEN data_type ELSE 'VARCHAR2' END AS raw_type,
       CASE WHEN data_type = 'VARCHAR2' AND column_id % 3 = 0 THEN 'boolean' ELSE 'string' END AS canonical,
       coalesce(char_length, 40) + CASE WHEN column_id % 2 = 0 THEN 3900 ELSE -1 END AS max_length,
       column_id % 4 <> 1 AS is_nullable
FROM {cat_columns}
UNION ALL
SELECT DISTINCT table_name, 'NEW_COL' AS column_name, 'NUMBER' AS raw_type, 'integer' AS canonical,
       cast(NULL AS int) AS max_length, TRUE AS is_nullable FROM {cat_columns}
"""

_CONSTRAINT = """
SELECT 'OWN' || cast(cast(floor(o_orderkey / 10) AS bigint) %% 10 AS string) AS owner,
       'T' || cast(o_orderkey AS string) AS table_name, '%(kind)sK_T' || cast(o_orderkey AS string) AS constraint_name,
       '%(kind)s' AS constraint_type, %(r_owner)s AS r_owner, %(r_name)s AS r_constraint_name
FROM {orders} WHERE %(test)s
"""
_NO_REFERENCE = {"r_owner": "cast(NULL AS string)", "r_name": "cast(NULL AS string)"}
DERIVED["cat_constraints"] = " UNION ALL ".join(
    _CONSTRAINT % part
    for part in (
        {"kind": "P", "test": "TRUE", **_NO_REFERENCE},
        {"kind": "U", "test": "o_orderkey % 5 = 0", **_NO_REFERENCE},
        {"kind": "C", "test": "o_orderkey % 4 = 0", **_NO_REFERENCE},
        {"kind": "Z", "test": "o_orderkey % 50 = 7", **_NO_REFERENCE},
        {
            "kind": "R",
            "test": "o_orderkey % 3 = 0",
            "r_owner": "'OWN' || cast(cast(floor((o_orderkey + 2) / 10) AS bigint) % 10 AS string)",
            "r_name": "'PK_T' || cast(o_orderkey + 2 AS string)",
        },
    )
)
_CONS_COLUMN = """
SELECT 'OWN' || cast(cast(floor(o_orderkey / 10) AS bigint) %% 10 AS string) AS owner,
       '%(kind)sK_T' || cast(o_orderkey AS string) AS constraint_name, 'T' || cast(o_orderkey AS string) AS table_name,
       '%(column)s' AS column_name, cast(%(at)d AS bigint) AS position
FROM {orders} WHERE %(test)s
"""
DERIVED["cat_cons_columns"] = " UNION ALL ".join(
    _CONS_COLUMN % {"kind": k, "column": c, "at": at, "test": test}
    for k, c, at, test in (
        ("P", "C1", 1, "TRUE"),
        ("P", "C2", 2, "o_orderkey % 2 = 0"),
        ("U", "C2", 1, "o_orderkey % 5 = 0"),
        ("C", "C5", 1, "o_orderkey % 4 = 0"),
        ("Z", "C6", 1, "o_orderkey % 50 = 7"),
        ("R", "C3", 1, "o_orderkey % 3 = 0"),
        ("R", "C4", 2, "o_orderkey % 6 = 0"),
    )
)
DERIVED["cat_indexes"] = """
SELECT owner, 'IX_' || constraint_name AS index_name, table_name, 'UNIQUE' AS uniqueness,
       CASE WHEN constraint_type = 'U' THEN 'LOB' ELSE 'NORMAL' END AS index_type, 'N' AS generated
FROM {cat_constraints} WHERE constraint_type IN ('P', 'U')
UNION ALL
SELECT owner, 'IX_' || constraint_name AS index_name, table_name, 'NONUNIQUE' AS uniqueness, 'NORMAL' AS index_type,
       CASE WHEN length(table_name) % 2 = 0 THEN 'N' ELSE 'Y' END AS generated
FROM {cat_constraints} WHERE constraint_type = 'R'
"""
DERIVED["cat_ind_columns"] = """
SELECT owner, 'IX_' || constraint_name AS index_name, table_name, column_name FROM {cat_cons_columns}
"""

DERIVED["write_plan"] = """
SELECT p_partkey AS write_id, CASE p_partkey % 3 WHEN 0 THEN 'drop' WHEN 1 THEN 'truncate' ELSE 'alter' END AS op,
       CASE p_size % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'restricted' WHEN 2 THEN 'dev-only' ELSE 'yes' END AS mode,
       'env' || cast(p_partkey % 7 AS string) AS environment,
       CASE p_partkey % 5 WHEN 0 THEN 'dev' WHEN 1 THEN 'qa' WHEN 2 THEN 'prod' WHEN 3 THEN 'unknown' ELSE 'dev'
       END AS env_class,
       CASE WHEN p_partkey % 2 = 0 THEN 'SF_' ELSE '' END || upper(replace(p_name, ' ', '_')) AS table_name,
       p_partkey % 2 = 0 AS is_managed, p_partkey % 11 = 0 AS break_glass
FROM {part}
"""


# What Spark runs instead of a text of ``DERIVED``, for the same rows. Of a column's row in the catalog everything
# follows from its two keys, and its names tell these, so the keys alone are made distinct.
SPARK_FORM = {
    "cat_columns": DERIVED["cat_columns"]
    .replace("SELECT DISTINCT", "SELECT")
    .replace("FROM {lineitem}", "FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) AS l")
}


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


class Inputs:
    """Given and derived tables of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in DERIVED:
                text = SPARK_FORM.get(name, DERIVED[name])
                self._made[name] = self.spark.sql(text, **{n: self[n] for n in _needs(text)})
            else:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._made[name]


def oracle(text: str, *names: str, materialized: bool = False) -> str:
    """SQL for the oracle: ``text`` after a WITH list of the derived inputs it names."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in DERIVED and name not in order:
            for need in _needs(DERIVED[name]):
                visit(need)
            order.append(name)

    for name in names:
        visit(name)
    how = "AS MATERIALIZED" if materialized else "AS"
    parts = [f"{n} {how} ({re.sub(r'{(\w+)}', r'\1', DERIVED[n]).strip()})" for n in order]
    body = text.strip()
    if not parts:
        return body
    head = ",\n".join(parts)
    return f"WITH {head},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {head}\n{body}"
