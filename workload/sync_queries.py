"""Record sync: M1 to M17."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsync.plans import sync
from loomsync.session import shared_dir, staged
from loomsync.streaming.queue import run_stream
from workload.base import Registry
from workload.codes import http_codes
from workload.inputs import Inputs

def _state(t: Inputs) -> sync.State:
    return sync.State(t["members"], t["addresses"], t["phones"], t["census"])


def _references(t: Inputs) -> dict[str, DataFrame]:
    return {
        "gender_id": t["lov"].filter("lov_type = 'CSM_SEX'").select("lov_id"),
        "mar_status_id": t["lov"].filter("lov_type = 'CSM_MARITAL_ST'").select("lov_id"),
        "name_suffix_id": t["suffixes"].select("name_suffix_id"),
    }


registry = Registry()
query = registry.add


# --- the same work as SQL --------------------------------------------------


def _md5(columns: list[str], alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    return "upper(md5(" + " || ".join(f"coalesce(nullif(cast({dot}{c} AS varchar), ''), '|')" for c in columns) + "))"


_NONE = "upper(md5('||'))"
_VIEW = f"""
view_rows AS (
  SELECT m.pid, m.member_id, a.addr_id, p.phn_id, {_md5(sync.DEMOGRAPHICS, "m")} AS dh,
         {_md5(sync.ADDRESS, "a")} AS ah, {_md5(sync.PHONE, "p")} AS ph
  FROM members m LEFT JOIN addresses a ON a.member_id = m.member_id
  LEFT JOIN phones p ON p.member_id = m.member_id AND p.phone_type_id = 1
  WHERE m.status_id = '37' AND m.pid <> 'N/A'),
known AS (
  SELECT pid, count(*) AS n, max(member_id) AS member_id, max(addr_id) AS addr_id, max(phn_id) AS phn_id,
         max(dh) AS dh, max(ah) AS ah, max(ph) AS ph FROM view_rows GROUP BY pid),
hashed AS (
  SELECT i.* EXCLUDE (mq_status), {_md5(sync.DEMOGRAPHICS, "i")} AS demogr_hash, {_md5(sync.ADDRESS, "i")} AS address_hash,
         {_md5(sync.PHONE, "i")} AS phone_hash,
         ({" OR ".join(f"coalesce(length(i.{c}), 0) > {w}" for c, w in sync.WIDTHS.items())}
          OR (gender_id IS NOT NULL AND gender_id NOT IN (SELECT lov_id FROM lov WHERE lov_type = 'CSM_SEX'))
          OR (mar_status_id IS NOT NULL
              AND mar_status_id NOT IN (SELECT lov_id FROM lov WHERE lov_type = 'CSM_MARITAL_ST'))
          OR (name_suffix_id IS NOT NULL AND name_suffix_id NOT IN (SELECT name_suffix_id FROM suffixes))) AS bad
  FROM inbound i)"""


def _chain(windows: int, test: str = "TRUE") -> str:
    """The windows run one after another, each on the state the last one left."""
    width = f"(SELECT (max(mq_id) + {windows}) // {windows} FROM inbound)"
    parts = [_VIEW, f"rows AS (SELECT *, mq_id // {width} AS w FROM hashed WHERE {test})"]
    parts.append(
        "s0 AS (SELECT pid, n, member_id, addr_id, phn_id, dh, ah, ph, NULL::BIGINT AS did, NULL::BIGINT AS aid,"
        " NULL::BIGINT AS pidx, 0 AS seg FROM known)"
    )
    for k in range(windows):
        parts.append(f"""
j{k} AS (
  SELECT r.*, s.n, s.member_id, s.addr_id, s.phn_id, s.seg,
         s.dh <> r.demogr_hash AS dc, s.ah <> r.address_hash AS ac, s.ph <> r.phone_hash AS pc,
         s.n IS NOT NULL AND s.n = 1 AND NOT r.bad AS good
  FROM rows r LEFT JOIN s{k} s ON s.pid = r.pid WHERE r.w = {k}),
win{k} AS (
  SELECT pid, max(mq_id) FILTER (dc) AS did, max(mq_id) FILTER (ac) AS aid, max(mq_id) FILTER (pc) AS pidx,
         max(mq_id) FILTER (dc OR ac OR pc) AS tid
  FROM j{k} WHERE good GROUP BY pid),
s{k + 1} AS (
  SELECT s.pid, s.n, s.member_id, s.addr_id,
         CASE WHEN p.mq_id IS NOT NULL AND coalesce(p.phone_type_id, 1) <> 1 THEN NULL ELSE s.phn_id END AS phn_id,
         coalesce(d.demogr_hash, s.dh) AS dh, coalesce(a.address_hash, s.ah) AS ah,
         CASE WHEN p.mq_id IS NULL THEN s.ph WHEN coalesce(p.phone_type_id, 1) <> 1 THEN {_NONE}
              ELSE upper(md5(coalesce(nullif(p.phone, ''), '|') || '1')) END AS ph,
         coalesce(d.mq_id, s.did) AS did, coalesce(a.mq_id, s.aid) AS aid,
         p.mq_id AS pidx,
         s.seg + CASE WHEN p.mq_id IS NOT NULL AND coalesce(p.phone_type_id, 1) <> 1 THEN 1 ELSE 0 END AS seg
  FROM s{k} s LEFT JOIN win{k} x ON x.pid = s.pid
  LEFT JOIN rows d ON d.mq_id = x.did LEFT JOIN rows a ON a.mq_id = x.aid LEFT JOIN rows p ON p.mq_id = x.pidx)""")
    union = " UNION ALL ".join(f"SELECT * FROM j{k}" for k in range(windows))
    parts.append(f"""
judged AS (
  SELECT *, CASE WHEN n IS NULL THEN 404 WHEN n > 1 OR bad THEN 500 WHEN dc OR ac OR pc THEN 200 ELSE 304 END
         AS mq_status FROM ({union}) u)""")
    return "WITH " + ",\n".join(parts)


_ALL = ("inbound", "members", "addresses", "phones", "lov", "suffixes")
_WINDOWS = 4


def _three(t: Inputs, windows: int = _WINDOWS, **more) -> sync.Options:
    top = t["inbound"].agg(F.max("mq_id")).first()[0] or 0
    return sync.Options(commit_size=(top + windows) // windows, **more)


def _queue(t: Inputs) -> DataFrame:
    """The queue as it is stored: a table in id order, in as many files as a shuffle has partitions."""
    files = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return staged(t["inbound"].repartitionByRange(files, "mq_id"), "queue")


def _whole(t: Inputs, **more) -> sync.Options:
    return _three(t, 1, **more)


# --- queries ---------------------------------------------------------------

_STATE_TEXT = """
SELECT m.member_id, m.pid, m.first_name, m.last_name, m.birthdate, m.gender_id, g.lov_desc AS gender,
       s.lov_desc AS mar_status, x.name_prefix, y.name_suffix, a.addr_id, a.city, p.phn_id, p.phone, t.phone_type,
       {d} AS demogr_hash, {a} AS address_hash, {p} AS phone_hash
FROM members m
LEFT JOIN lov s ON m.mar_status_id = s.lov_id AND s.lov_type = 'CSM_MARITAL_ST'
LEFT JOIN lov g ON m.gender_id = g.lov_id AND g.lov_type = 'CSM_SEX'
LEFT JOIN prefixes x ON x.name_prefix_id = m.name_prefix_id
LEFT JOIN suffixes y ON y.name_suffix_id = m.name_suffix_id
LEFT JOIN addresses a ON a.member_id = m.member_id
LEFT JOIN phones p ON p.member_id = m.member_id AND p.phone_type_id = 1
LEFT JOIN phone_types t ON t.phone_type_id = p.phone_type_id
WHERE m.status_id = '37' AND m.pid <> 'N/A'
""".format(d=_md5(sync.DEMOGRAPHICS, "m"), a=_md5(sync.ADDRESS, "a"), p=_md5(sync.PHONE, "p"))


@query(
    "M1_current_state", _STATE_TEXT,
    "members", "addresses", "phones", "lov", "prefixes", "suffixes", "phone_types",
)
def current_state(t: Inputs) -> DataFrame:
    view = sync.current_state(_state(t), t["lov"], t["prefixes"], t["suffixes"], t["phone_types"])
    return view.select(
        "member_id", "pid", "first_name", "last_name", "birthdate", "gender_id", "gender", "mar_status", "name_prefix",
        "name_suffix", "addr_id", "city", "phn_id", "phone", "phone_type", "demogr_hash", "address_hash", "phone_hash",
    )


@query(
    "M2_fingerprint",
    f"SELECT mq_id, {_md5(sync.DEMOGRAPHICS)} AS demogr_hash, {_md5(sync.ADDRESS)} AS address_hash,"
    f" {_md5(sync.PHONE)} AS phone_hash FROM inbound",
    "inbound",
)
def fingerprints(t: Inputs) -> DataFrame:
    return sync.with_hashes(t["inbound"]).select("mq_id", "demogr_hash", "address_hash", "phone_hash")


@query(
    "M3_hydrate",
    f"WITH {_VIEW} SELECT h.mq_id, h.pid, h.demogr_hash, h.address_hash, h.phone_hash,"
    " CASE WHEN k.n = 1 THEN k.member_id END AS member_id, CASE WHEN k.n = 1 THEN k.addr_id END AS addr_id,"
    " CASE WHEN k.n = 1 THEN k.phn_id END AS phn_id FROM hashed h LEFT JOIN known k ON k.pid = h.pid",
    *_ALL,
)
def hydrate(t: Inputs) -> DataFrame:
    rows = sync.hydrate(t["inbound"], _state(t))
    one = F.col("view_rows") == 1
    return rows.select(
        "mq_id", "pid", "demogr_hash", "address_hash", "phone_hash",
        *[F.when(one, F.col(c)).alias(c) for c in ("member_id", "addr_id", "phn_id")],
    )


@query(
    "M4_detect_changes",
    f"WITH {_VIEW} SELECT h.mq_id, coalesce(h.demogr_hash <> k.dh, FALSE) AS demogr_changed,"
    " coalesce(h.address_hash <> k.ah, FALSE) AS address_changed, coalesce(h.phone_hash <> k.ph, FALSE) AS phone_changed"
    " FROM hashed h LEFT JOIN known k ON k.pid = h.pid",
    *_ALL,
)
def detect_changes(t: Inputs) -> DataFrame:
    flags = sync.change_flags(sync.hydrate(t["inbound"], _state(t)))
    return flags.select(
        "mq_id", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("demogr_changed", "address_changed", "phone_changed")]
    )


def _patched(columns: list[str], alias: str, hit: str) -> str:
    return ", ".join(f"CASE WHEN {hit} IS NOT NULL THEN r.{c} ELSE {alias}.{c} END AS {c}" for c in columns)


@query(
    "M5_apply_demographics",
    _chain(1) + f" SELECT m.member_id, m.pid, {_patched(sync.DEMOGRAPHICS, 'm', 'r.mq_id')}, m.status_id"
    " FROM members m LEFT JOIN s1 ON s1.member_id = m.member_id AND s1.did IS NOT NULL"
    " LEFT JOIN rows r ON r.mq_id = s1.did",
    *_ALL,
)
def apply_demographics(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _whole(t))
    return sync.apply_demographics(t["members"], rows).select("member_id", "pid", *sync.DEMOGRAPHICS, "status_id")


_NEW_ADDRESS = (
    "SELECT s.member_id, (SELECT max(addr_id) FROM addresses) + row_number() OVER (ORDER BY s.member_id) AS addr_id,"
    f" {', '.join('r.' + c for c in sync.ADDRESS)} FROM s{{k}} s JOIN rows r ON r.mq_id = s.aid WHERE s.addr_id IS NULL"
)


@query(
    "M6_apply_address",
    _chain(1) + f" SELECT a.member_id, a.addr_id, {_patched(sync.ADDRESS, 'a', 'r.mq_id')}"
    " FROM addresses a LEFT JOIN s1 ON s1.member_id = a.member_id AND s1.addr_id = a.addr_id AND s1.aid IS NOT NULL"
    " LEFT JOIN rows r ON r.mq_id = s1.aid UNION ALL " + _NEW_ADDRESS.format(k=1),
    *_ALL,
)
def apply_address(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _whole(t))
    return sync.apply_address(t["addresses"], rows)


@query(
    "M7_apply_phone",
    _chain(1) + " SELECT p.member_id, p.phn_id, CASE WHEN r.mq_id IS NOT NULL THEN r.phone ELSE p.phone END AS phone,"
    " CASE WHEN r.mq_id IS NOT NULL THEN coalesce(r.phone_type_id, 1) ELSE p.phone_type_id END AS phone_type_id"
    " FROM phones p LEFT JOIN (SELECT k.phn_id, x.pidx FROM win0 x JOIN known k ON k.pid = x.pid) w"
    " ON w.phn_id = p.phn_id LEFT JOIN rows r ON r.mq_id = w.pidx"
    " UNION ALL SELECT k.member_id, (SELECT max(phn_id) FROM phones) + row_number() OVER (ORDER BY k.member_id),"
    " r.phone, coalesce(r.phone_type_id, 1) FROM win0 x JOIN known k ON k.pid = x.pid JOIN rows r ON r.mq_id = x.pidx"
    " WHERE k.phn_id IS NULL",
    *_ALL,
)
def apply_phone(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _whole(t))
    return sync.apply_phone(t["phones"], rows)


_CENSUS = ["last_name", "email_addr", "city", "phone", "mar_status_id", "gender_id"]


@query(
    "M8_census_sync",
    _chain(1) + f" SELECT c.pid, {_patched(['first_name'] + _CENSUS, 'c', 'r.mq_id')},"
    " CASE WHEN r.mq_id IS NOT NULL THEN substr(r.middle_name, 1, 1) ELSE c.middle_initial END AS middle_initial"
    " FROM census c LEFT JOIN win0 x ON x.pid = c.pid LEFT JOIN rows r ON r.mq_id = x.tid",
    *_ALL, "census",
)
def census_sync(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _whole(t))
    return sync.sync_census(t["census"], rows).select("pid", "first_name", *_CENSUS, "middle_initial")


@query("M9_finalize_status", _chain(1) + " SELECT mq_id, mq_status FROM judged", *_ALL)
def finalize_status(t: Inputs) -> DataFrame:
    return sync.resolve(t["inbound"], _state(t), _references(t), _whole(t)).select("mq_id", "mq_status")


@query(
    "M10_commit_windows",
    _chain(_WINDOWS) + " SELECT mq_id, pid, CAST(w AS BIGINT) AS window_no, mq_status FROM judged",
    *_ALL,
)
def commit_windows(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _three(t))
    return rows.select("mq_id", "pid", "window_no", "mq_status")


@query(
    "M11_max_records_cap",
    "SELECT mq_id, CASE WHEN row_number() OVER (ORDER BY mq_id) <= (SELECT count(*) FROM inbound) // 3 THEN 1 ELSE 0 END"
    " AS in_run FROM inbound",
    "inbound",
)
def max_records_cap(t: Inputs) -> DataFrame:
    cap = t["inbound"].count() // 3
    _, high = sync.run_ceiling(t["inbound"], sync.Options(max_records=cap))
    return t["inbound"].select("mq_id", F.when(F.col("mq_id") <= high, 1).otherwise(0).alias("in_run"))


@query(
    "M12_isolate_bad_rows",
    _chain(1) + " SELECT mq_id, bad AS row_is_bad, coalesce(n > 1, FALSE) AS pid_is_ambiguous, mq_status FROM judged",
    *_ALL,
)
def isolate_bad_rows(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _whole(t))
    several = F.array_contains("reasons", "pid has several current rows")
    return rows.select(
        "mq_id", (F.size("reasons") - several.cast("int") > 0).alias("row_is_bad"),
        several.alias("pid_is_ambiguous"), "mq_status",
    )


@query(
    "M13_error_log",
    _chain(1) + " SELECT 999 + row_number() OVER (ORDER BY mq_id) AS mq_log_id, mq_id, 500 AS mq_status_code,"
    " 'process_inbound' AS procedure_name FROM judged WHERE mq_status = 500",
    *_ALL,
)
def error_log(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _whole(t)).filter("mq_status = 500")
    log = sync.error_log(rows, ["mq_id", "pid", *sync.DEMOGRAPHICS], "process_inbound", "sync")
    return log.select("mq_log_id", "mq_id", "mq_status_code", "procedure_name")


_MAIN_NONE = "upper(md5('|1'))"
# With one record per window the state a record meets is the one its predecessor of the same pid left.
_SINGLE = f"""
WITH {_VIEW},
good AS (
  SELECT h.*, k.dh, k.ah, k.ph, h.phone_hash = {_NONE} AS blank,
         CASE WHEN coalesce(h.phone_type_id, 1) <> 1 THEN {_NONE}
              ELSE upper(md5(coalesce(nullif(h.phone, ''), '|') || '1')) END AS after
  FROM hashed h JOIN known k ON k.pid = h.pid WHERE k.n = 1 AND NOT h.bad),
met AS (
  SELECT *, coalesce(lag(demogr_hash) OVER w, dh) AS sd, coalesce(lag(address_hash) OVER w, ah) AS sa,
         coalesce(lag(blank) OVER w, FALSE) AS after_blank,
         coalesce(last_value(CASE WHEN NOT blank THEN after END IGNORE NULLS)
                  OVER (PARTITION BY pid ORDER BY mq_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ph) AS left_phone
  FROM good WINDOW w AS (PARTITION BY pid ORDER BY mq_id)),
judged AS (
  SELECT mq_id, CASE WHEN sd <> demogr_hash OR sa <> address_hash OR phone_hash <>
           CASE WHEN after_blank AND left_phone <> {_NONE} THEN {_MAIN_NONE} ELSE left_phone END
         THEN 200 ELSE 304 END AS mq_status FROM met)
SELECT h.mq_id, h.pid, CASE WHEN k.n IS NULL THEN 404 ELSE coalesce(j.mq_status, 500) END AS mq_status,
       CASE WHEN k.n IS NOT NULL AND j.mq_status IS NULL THEN 1 ELSE 0 END AS response
FROM hashed h LEFT JOIN known k ON k.pid = h.pid LEFT JOIN judged j ON j.mq_id = h.mq_id
"""


@query("M14_single_record", _SINGLE, *_ALL)
def single_record(t: Inputs) -> DataFrame:
    rows = sync.resolve(_queue(t), _state(t), _references(t), sync.Options(commit_size=1))
    return sync.response_code(rows.select("mq_id", "pid", "mq_status"))


@query(
    "M15_status_summary",
    _chain(1) + ", codes AS (SELECT * FROM (VALUES (200, 'OK', 200), (304, 'Not Modified', 300),"
    " (404, 'Not Found', 400), (500, 'Internal Server Error', 500)) AS v(code, description, code_class))"
    " SELECT j.mq_status, count(*) AS \"rows\", c.description, c.code_class FROM judged j"
    " LEFT JOIN codes c ON c.code = j.mq_status GROUP BY j.mq_status, c.description, c.code_class",
    *_ALL,
)
def status_summary(t: Inputs) -> DataFrame:
    rows = sync.resolve(t["inbound"], _state(t), _references(t), _whole(t))
    codes = http_codes(t.spark).select("code", "description", "code_class")
    return sync.status_summary(rows.select("mq_status"), codes)


@query(
    "M16_sync_batch",
    _chain(_WINDOWS) + " SELECT mq_id, j.pid, demogr_hash, address_hash, phone_hash, mq_status,"
    " CASE WHEN j.n = 1 THEN j.member_id END AS member_id,"
    " mq_id IN (" + " UNION ALL ".join(f"SELECT did FROM win{k} WHERE did IS NOT NULL" for k in range(_WINDOWS)) + ")"
    " AS wins_demographics FROM judged j",
    *_ALL,
)
def sync_batch(t: Inputs) -> DataFrame:
    outcome = sync.sync_batch(_queue(t), _state(t), _references(t), _three(t, block_census=True))
    return outcome.rows.select(
        "mq_id", "pid", "demogr_hash", "address_hash", "phone_hash", "mq_status", "member_id",
        F.col("applies_demographics").alias("wins_demographics"),
    )


@query(
    "M16_members_after",
    _chain(_WINDOWS) + f" SELECT m.member_id, m.pid, {_patched(sync.DEMOGRAPHICS, 'm', 'r.mq_id')}"
    f" FROM members m LEFT JOIN s{_WINDOWS} s ON s.member_id = m.member_id AND s.did IS NOT NULL"
    " LEFT JOIN rows r ON r.mq_id = s.did",
    *_ALL,
)
def members_after(t: Inputs) -> DataFrame:
    outcome = sync.sync_batch(t["inbound"], _state(t), _references(t), _three(t))
    return outcome.state.members.select("member_id", "pid", *sync.DEMOGRAPHICS)


@query("M17_sync_stream", _chain(1) + " SELECT mq_id, mq_status FROM judged", *_ALL)
def sync_stream(t: Inputs) -> DataFrame:
    root = f"{shared_dir(t.spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    t["inbound"].write.parquet(f"{root}/staging")
    files = len(t.spark.read.parquet(f"{root}/staging").inputFiles())  # all of them in one micro-batch
    done = run_stream(t.spark, f"{root}/staging", f"{root}/tables", _state(t), _references(t), _whole(t), max_files=files)
    return done.select("mq_id", "mq_status")


@query("M17_stream_files", _chain(_WINDOWS) + " SELECT mq_id, pid, mq_status FROM judged", *_ALL)
def stream_files(t: Inputs) -> DataFrame:
    """Several files, a micro-batch each: every batch starts from the state that the one before has left."""
    root = f"{shared_dir(t.spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    inbound, window = _queue(t), F.expr(f"mq_id div {_three(t).commit_size}")
    for k in range(_WINDOWS):
        inbound.filter(window == k).coalesce(1).write.mode("append").parquet(f"{root}/staging")
    done = run_stream(t.spark, f"{root}/staging", f"{root}/tables", _state(t), _references(t), _whole(t), max_files=1, compact_after=2)
    return done.select("mq_id", "pid", "mq_status")
