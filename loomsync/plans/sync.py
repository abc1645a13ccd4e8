"""Inbound record sync: find what changed, apply it, give every row a status.

Staged rows are processed in windows of ids, each window seeing the result of
the one before. Windows are not run one after another: what a window does to a
member's fingerprint depends only on two candidate rows, so each window becomes
a small step, steps compose, and a running composition per member gives the
fingerprint every window starts from. One pass handles any number of windows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomsync.functions.cells import record_json
from loomsync.functions.fingerprints import differs, fingerprint
from loomsync.functions.names import initial
from loomsync.operators import loads
from loomsync.operators.joins import join_unique, latest_per_key, left_join_many, typed_lookup
from loomsync.operators.numbering import nth_smallest, number_rows
from loomsync.session import staged

# Statuses, the active member status and the audit user.
ACCEPTED, CHANGED, UNCHANGED, UNKNOWN, FAILED = 202, 200, 304, 404, 500
ACTIVE, NO_PID, MAIN_PHONE, SYNC_USER = "37", "N/A", 1, "MDM"
DEFAULT_WINDOW = 50_000

SCAN_BLOCK = 16_384
# Ids per window up to which combining rows before the shuffle cannot pay.
SMALL_WINDOW = 16

# The fields of each fingerprint, in its order.
DEMOGRAPHICS = [
    "first_name", "middle_name", "last_name", "name_suffix_id", "birthdate",
    "dt_of_death", "email_addr", "gender_id", "mar_status_id",
]
ADDRESS = ["address1", "address2", "address3", "address4", "city", "county", "state", "postal", "country"]
PHONE = ["phone", "phone_type_id"]

# Widest text each target column takes.
WIDTHS = {
    "first_name": 64, "middle_name": 64, "last_name": 64, "email_addr": 120, "phone": 32,
    "address1": 64, "address2": 64, "address3": 64, "address4": 64, "city": 64,
    "county": 64, "state": 64, "postal": 16, "country": 16,
}

# Census columns, each with the inbound expression that fills it.
CENSUS = {
    "first_name": F.col, "middle_initial": lambda _: initial(F.col("middle_name")), "last_name": F.col,
    "birthdate": F.col, "dt_of_death": F.col, "address1": F.col, "address2": F.col, "address3": F.col,
    "city": F.col, "state": F.col, "postal": F.col, "country": F.col, "phone": F.col, "email_addr": F.col,
    "mar_status_id": F.col, "gender_id": F.col,
}


@dataclass(frozen=True)
class State:
    """The tables a sync reads and rewrites."""

    members: DataFrame
    addresses: DataFrame
    phones: DataFrame
    census: DataFrame | None = None


@dataclass(frozen=True)
class Options:
    start_id: int = 0
    status: int = ACCEPTED
    max_records: int | None = None
    commit_size: int | None = None
    block_census: bool = False
    allow_partial: bool = True
    widths: Mapping[str, int] = field(default_factory=lambda: dict(WIDTHS))
    scan_block: int = SCAN_BLOCK
    stamp: str | None = None  # audit time, the current time when not given


@dataclass(frozen=True)
class Outcome:
    """Processed rows with their status, and the tables they lead to."""

    rows: DataFrame
    before: State
    block_census: bool = False

    @cached_property
    def state(self) -> State:
        """Every table as it is after the run."""
        old, census = self.before, self.before.census
        if self.block_census and census is not None:
            census = sync_census(census, self.rows)
        return State(
            apply_demographics(old.members, self.rows),
            apply_address(old.addresses, self.rows),
            apply_phone(old.phones, self.rows),
            census,
        )

    def statuses(self) -> DataFrame:
        return self.rows.select(
            "mq_id", "pid", "member_id", "addr_id", "phn_id",
            "demogr_hash", "address_hash", "phone_hash", "mq_status",
        )

    def failures(self) -> DataFrame:
        return self.rows.filter(F.col("mq_status") == FAILED)


def active_members(members: DataFrame) -> DataFrame:
    return members.filter((F.col("status_id") == ACTIVE) & (F.col("pid") != NO_PID))


def _group(columns: list[str]) -> Column:
    return fingerprint([F.col(c) for c in columns])


def _empty(columns: list[str]) -> Column:
    return fingerprint([F.lit(None).cast("string") for _ in columns])


def current_state(
    state: State, lov: DataFrame, prefixes: DataFrame, suffixes: DataFrame, phone_types: DataFrame
) -> DataFrame:
    """Active members with lookup texts, address, main phone and fingerprints.

    A member with several addresses gives several rows, as stored.
    """
    spec = {"id_col": "lov_id", "type_col": "lov_type", "text_col": "lov_desc"}
    people = active_members(state.members).withColumn("demogr_hash", _group(DEMOGRAPHICS))
    people = typed_lookup(people, lov, "mar_status_id", "CSM_MARITAL_ST", "mar_status", **spec)
    people = typed_lookup(people, lov, "gender_id", "CSM_SEX", "gender", **spec)
    people = people.join(prefixes, "name_prefix_id", "left").join(suffixes, "name_suffix_id", "left")
    main = state.phones.filter(F.col("phone_type_id") == MAIN_PHONE)
    known = active_members(state.members).select("member_id")
    placed = left_join_many(left_join_many(people, state.addresses, ["member_id"], known), main, ["member_id"], known)
    return placed.join(phone_types, "phone_type_id", "left").withColumns(
        {"address_hash": _group(ADDRESS), "phone_hash": _group(PHONE)}
    )


def state_by_pid(state: State) -> DataFrame:
    """One narrow row per pid: ids, fingerprints and how many view rows it has.

    Addresses and phones are folded per member before the join, so a pid with
    many of them is counted instead of multiplied out.
    """
    addresses = state.addresses.groupBy("member_id").agg(
        F.count("*").alias("_addresses"), F.max("addr_id").alias("addr_id"), F.max(_group(ADDRESS)).alias("_a")
    )
    main = state.phones.filter(F.col("phone_type_id") == MAIN_PHONE)
    phones = main.groupBy("member_id").agg(
        F.count("*").alias("_phones"), F.max("phn_id").alias("phn_id"), F.max(_group(PHONE)).alias("_p")
    )
    people = active_members(state.members).select("pid", "member_id", _group(DEMOGRAPHICS).alias("_d"))
    joined = people.join(addresses, "member_id", "left").join(phones, "member_id", "left")
    fanout = F.coalesce("_addresses", F.lit(1)) * F.coalesce("_phones", F.lit(1))
    return joined.groupBy("pid").agg(
        F.sum(fanout).alias("view_rows"),
        F.max("member_id").alias("member_id"),
        F.max("addr_id").alias("addr_id"),
        F.max("phn_id").alias("phn_id"),
        F.max("_d").alias("_d"),
        F.max(F.coalesce("_a", _empty(ADDRESS))).alias("_a"),
        F.max(F.coalesce("_p", _empty(PHONE))).alias("_p"),
    )


def with_hashes(inbound: DataFrame) -> DataFrame:
    return inbound.withColumns(
        {"demogr_hash": _group(DEMOGRAPHICS), "address_hash": _group(ADDRESS), "phone_hash": _group(PHONE)}
    )


def hydrate(inbound: DataFrame, state: State) -> DataFrame:
    """Fingerprints and current ids on every staged row; unknown pids get NULL ids."""
    known = state_by_pid(state).withColumnsRenamed({"_d": "state_demogr", "_a": "state_address", "_p": "state_phone"})
    hashed = with_hashes(inbound.drop("member_id", "addr_id", "phn_id"))
    return join_unique(hashed, known, ["pid"])


def change_flags(hydrated: DataFrame) -> DataFrame:
    """Which groups of a row differ from the state before anything is applied."""
    known = F.col("view_rows").isNotNull()
    return hydrated.withColumns(
        {
            "demogr_changed": known & differs(F.col("demogr_hash"), F.col("state_demogr")),
            "address_changed": known & differs(F.col("address_hash"), F.col("state_address")),
            "phone_changed": known & differs(F.col("phone_hash"), F.col("state_phone")),
        }
    )


def reject_reasons(
    inbound: DataFrame,
    references: Mapping[str, DataFrame],
    widths: Mapping[str, int] = WIDTHS,
) -> DataFrame:
    """Adds ``reasons``: why a row could not be applied, judged from the row and its lookups.

    Lookups are plain joins at any row count: small parents are broadcast by their size, and
    adaptive execution splits hot values where a parent is too large for that.
    """
    checks = [
        F.when(F.length(name) > width, F.lit(f"{name} is longer than {width}"))
        for name, width in widths.items()
        if name in inbound.columns
    ]
    checked = inbound
    for name, parent in references.items():
        keys = parent.select(F.col(parent.columns[0]).alias(name)).distinct().withColumn(f"_known_{name}", F.lit(True))
        checked = checked.join(keys, name, "left")
        orphan = F.col(name).isNotNull() & F.col(f"_known_{name}").isNull()
        checks.append(F.when(orphan, F.lit(f"{name} has no parent")))
    found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return checked.select(*inbound.columns, found.alias("reasons"))


def run_ceiling(inbound: DataFrame, options: Options) -> tuple[int | None, int | None]:
    """First and last id this run touches; a cap ends it at the n-th waiting row."""
    waiting = inbound.filter((F.col("mq_status") == options.status) & (F.col("mq_id") >= options.start_id))
    low, high = waiting.agg(F.min("mq_id"), F.max("mq_id")).first()
    if options.max_records and high is not None:
        high = nth_smallest(waiting.select("mq_id"), "mq_id", options.max_records)
    return low, high


# --- windows as steps ------------------------------------------------------
#
# A step maps the fingerprint a window starts from to the one it leaves, and to
# the row it applied. It gives (c, cid, cn) for every fingerprint but p, and
# (d, did, dn) for p itself, because the latest row that differs is the latest
# row unless that one is what is stored already. cid and did are the applied
# rows, NULL when nothing applies; cn and dn count main phones taken out of the
# view by being stored under another type.

_STEP = ("p", "c", "cid", "cn", "d", "did", "dn")


def _step(*values: Column) -> Column:
    return F.struct(*[v.alias(n) for v, n in zip(values, _STEP)])


def _lead(group: str) -> Column:
    """Step of one group from its two latest distinct fingerprints."""
    first = F.max(F.when((F.col("grp") == group) & (F.col("rank") == 1), F.struct("hash", "after", "latest")))
    second = F.max(F.when((F.col("grp") == group) & (F.col("rank") == 2), F.struct("after", "latest")))
    other = F.coalesce(second["after"], first["hash"])

    def closings(after: Column, applied: Column) -> Column:
        closed = applied.isNotNull() & (after == _empty(PHONE)) & F.lit(group == "p")
        return closed.cast("bigint")

    return _step(
        first["hash"], first["after"], first["latest"], closings(first["after"], first["latest"]),
        other, second["latest"], closings(other, second["latest"]),
    ).alias(group)


def _steps(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per pid and window with the step of each group.

    ``by`` names the columns of the scan's blocks where windows hold a few ids: rows are then dealt out by these at once,
    as nothing would be combined before, and neither the steps nor their scan move them again.
    """
    main_after = fingerprint([F.col("phone"), F.lit(MAIN_PHONE)])
    is_main = F.coalesce(F.col("phone_type_id"), F.lit(MAIN_PHONE)) == MAIN_PHONE
    phone_after = F.when(is_main, main_after).otherwise(_empty(PHONE))
    triple = F.concat("demogr_hash", "address_hash", "phone_hash")
    good = F.size("reasons") == 0

    def entry(group: str, value: Column, after: Column) -> Column:
        return F.struct(
            F.lit(group).alias("grp"),
            F.when(good, value).alias("hash"),
            F.when(good, after).alias("after"),
        )

    entries = F.array(
        entry("d", F.col("demogr_hash"), F.col("demogr_hash")),
        entry("a", F.col("address_hash"), F.col("address_hash")),
        entry("p", F.col("phone_hash"), phone_after),
        entry("t", triple, triple),
    )
    window = [*(by or ["pid"]), "window_no"]
    keys = [*window, "grp"]
    if by:
        needed = ["mq_id", "demogr_hash", "address_hash", "phone_hash", "phone", "phone_type_id", "reasons"]
        rows = rows.select(*window, *needed).repartition(*by)
    long = rows.select(*window, F.when(good, F.col("mq_id")).alias("mq_id"), F.inline(entries))
    distinct = long.groupBy(*keys, "hash").agg(F.max(F.struct("mq_id", "after")).alias("_top"))
    distinct = distinct.select(*keys, "hash", F.col("_top.mq_id").alias("latest"), F.col("_top.after").alias("after"))
    newest = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("latest"))
    ranked = distinct.withColumn("rank", F.row_number().over(newest)).filter("rank <= 2")
    return ranked.groupBy(*window).agg(*[_lead(group) for group in "dapt"])


def _compose(earlier: Column, later: Column) -> Column:
    """The step ``earlier`` followed by ``later``; either may be NULL."""
    first = {n: earlier[n] for n in _STEP}
    then = {n: later[n] for n in _STEP}

    def follow(mark: str, row: str, count: str) -> list[Column]:
        same = first[mark] == then["p"]
        return [
            F.when(same, then["d"]).otherwise(then["c"]),
            F.when(same, F.coalesce(then["did"], first[row])).otherwise(then["cid"]),
            first[count] + F.when(same, then["dn"]).otherwise(then["cn"]),
        ]

    both = _step(first["p"], *follow("c", "cid", "cn"), *follow("d", "did", "dn"))
    # A window with no usable row of this pid changes nothing: its p is NULL.
    return F.when(first["p"].isNull(), later).when(then["p"].isNull(), earlier).otherwise(both)


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    return rows if "_block" in rows.columns else rows.withColumn("_block", F.expr(f"window_no div {block}"))


def _scan(steps: DataFrame, windows: int, block: int = SCAN_BLOCK) -> DataFrame:
    """Add to each step the composition of all steps before it, as d_prev, a_prev and p_prev.

    Doubling distances need log2 rounds; all rounds use one partitioning and
    sort order, so the rows are shuffled once. A pid seen in very many windows
    is cut into blocks of windows: blocks are scanned on their own, their totals
    are scanned in turn, so no task holds more than a block of one pid.
    """
    keys = ["pid"]
    if windows > block:
        steps, keys = _in_blocks(steps, block), ["pid", "_block"]
    order = Window.partitionBy(*keys).orderBy("window_no")
    distance = 1
    while distance < min(windows, block):
        steps = steps.withColumns({f"_{g}": F.lag(g, distance).over(order) for g in "dap"})
        folded = [
            F.when(F.col(f"_{g}").isNull(), F.col(g)).otherwise(_compose(F.col(f"_{g}"), F.col(g))).alias(g)
            for g in "dap"
        ]
        steps = steps.select(*keys, "window_no", "t", *folded)
        distance *= 2
    steps = steps.withColumns({f"{g}_prev": F.lag(g, 1).over(order) for g in "dap"})
    if windows <= block:
        return steps
    steps = staged(steps, "blocks")
    totals = steps.groupBy("pid", F.col("_block").alias("window_no")).agg(
        F.max_by(F.struct("d", "a", "p"), "window_no").alias("_s")
    )
    totals = totals.select("pid", "window_no", "_s.*", F.lit(None).cast("string").alias("t"))
    before = _scan(totals, windows // block + 1, block).select(
        "pid", F.col("window_no").alias("_block"), *[F.col(f"{g}_prev").alias(f"_{g}") for g in "dap"]
    )
    joined = steps.join(before, keys)
    whole = {}
    for g in "dap":
        earlier = F.col(f"_{g}")
        for name in (g, f"{g}_prev"):
            later = F.col(name)
            whole[name] = F.when(earlier.isNull(), later).when(later.isNull(), earlier).otherwise(_compose(earlier, later))
    return joined.withColumns(whole).drop("_block", "_d", "_a", "_p")


def plan_windows(
    rows: DataFrame, known: DataFrame, windows: int, block: int = SCAN_BLOCK, window: int = DEFAULT_WINDOW
) -> DataFrame:
    """Per pid and window, of ``window`` ids each: what it starts from and which rows it applies."""
    based = known.withColumnsRenamed({"_d": "d_base", "_a": "a_base", "_p": "p_base"})
    if windows > block and window <= SMALL_WINDOW:
        steps = _steps(_in_blocks(rows, block), ["pid", "_block"])
    else:
        steps = _steps(rows)
    steps = join_unique(_scan(steps, windows, block), based, ["pid"], "inner")
    single = F.col("view_rows") == 1
    done: dict[str, Column] = {}
    for g in "dap":
        base = F.col(f"{g}_base")
        for name, step in ((f"{g}_start", F.col(f"{g}_prev")), (f"{g}_end", F.col(g))):
            none = step["p"].isNull()
            hit = base == step["p"]
            done[name] = F.when(none, base).when(hit, step["d"]).otherwise(step["c"])
            done[f"{name}_row"] = F.when(single & ~none, F.when(hit, step["did"]).otherwise(step["cid"]))
            if name == "p_start":
                done["segment"] = F.coalesce(F.when(hit, step["dn"]).otherwise(step["cn"]), F.lit(0))
    steps = steps.select("pid", "window_no", "view_rows", "member_id", "addr_id", "phn_id", "t",
                         *[c.alias(n) for n, c in done.items()])

    def applied(group: str) -> Column:
        last = F.col(f"{group}_end_row")
        return F.when(~last.eqNullSafe(F.col(f"{group}_start_row")), last)

    start = F.concat("d_start", "a_start", "p_start")
    differing = F.when(F.col("t.p") != start, F.col("t.cid")).otherwise(F.col("t.did"))
    # A phone stored under another type leaves the view; the next one is a new row.
    new_phone = (F.col("segment") > 0) | F.col("phn_id").isNull()
    return steps.select(
        "pid", "window_no", "view_rows", "member_id", "addr_id", "phn_id", "segment",
        "d_start", "a_start", "p_start",
        applied("d").alias("d_applied"), applied("a").alias("a_applied"), applied("p").alias("p_applied"),
        F.when(single, differing).alias("t_applied"),
        F.col("a_start_row").isNotNull().alias("address_seen"),
        (F.col("p_start_row").isNotNull() & (F.col("p_start") != _empty(PHONE))).alias("phone_seen"),
        (F.col("addr_id").isNull() & applied("a").isNotNull()).alias("new_address"),
        (new_phone & applied("p").isNotNull()).alias("new_phone"),
    )


def _next_id(table: DataFrame, column: str) -> int:
    return (table.agg(F.max(column)).first()[0] or 0) + 1


def _with_new_ids(plan: DataFrame, state: State) -> DataFrame:
    """Ids for the addresses and phones this run inserts, in member order.

    Both kinds are numbered in one pass, addresses first; phones are moved down
    by the number of addresses.
    """
    addresses = plan.filter("new_address").select(F.lit(0).alias("_kind"), "member_id", F.lit(0).alias("segment"))
    phones = plan.filter("new_phone").select(F.lit(1).alias("_kind"), "member_id", "segment")
    wanted = addresses.unionByName(phones).distinct()
    numbered = number_rows(wanted, ["_kind", "member_id", "segment"], "_nth", 0)
    shift = plan.filter("new_address").agg(F.countDistinct("member_id")).first()[0]
    address_id = F.col("_nth") + _next_id(state.addresses, "addr_id")
    phone_id = F.col("_nth") - shift + _next_id(state.phones, "phn_id")
    new_addresses = numbered.filter("_kind = 0").select("member_id", address_id.alias("new_addr_id"))
    new_phones = numbered.filter("_kind = 1").select("member_id", "segment", phone_id.alias("new_phn_id"))
    homes = join_unique(plan, new_addresses, ["member_id"])
    return join_unique(homes, new_phones, ["member_id", "segment"])


def resolve(
    inbound: DataFrame, state: State, references: Mapping[str, DataFrame], options: Options = Options()
) -> DataFrame | None:
    """Every row of the run with hashes, ids, status and the patches it is the source of."""
    low, high = run_ceiling(inbound, options)
    if high is None:
        return None
    window = options.commit_size or DEFAULT_WINDOW
    windows = (high - options.start_id) // window - (low - options.start_id) // window + 1
    waiting = inbound.filter(
        (F.col("mq_status") == options.status) & F.col("mq_id").between(max(low, options.start_id), high)
    )
    waiting = waiting.drop("member_id", "addr_id", "phn_id", "demogr_hash", "address_hash", "phone_hash", "mq_status")
    number = F.expr(f"(mq_id - {options.start_id}) div {window}")
    # Hashed and checked once: the windows are planned from a few columns of this copy, the rows resolved from all.
    rows = staged(reject_reasons(with_hashes(waiting), references, options.widths).withColumn("window_no", number), "checked")
    plan = staged(plan_windows(rows, state_by_pid(state), windows, options.scan_block, window), "windows")
    joined = join_unique(rows, _with_new_ids(plan, state), ["pid", "window_no"])
    changed = (
        differs(F.col("demogr_hash"), F.col("d_start"))
        | differs(F.col("address_hash"), F.col("a_start"))
        | differs(F.col("phone_hash"), F.col("p_start"))
    )
    ambiguous = F.when(F.col("view_rows") > 1, F.array(F.lit("pid has several current rows")))
    reasons = F.concat(F.col("reasons"), F.coalesce(ambiguous, F.array().cast("array<string>")))
    status = (
        F.when(F.col("view_rows").isNull(), UNKNOWN)
        .when(F.size(reasons) > 0, FAILED)
        .when(changed, CHANGED)
        .otherwise(UNCHANGED)
    )
    single = F.col("view_rows") == 1
    stored = F.when(F.col("segment") == 0, F.col("phn_id"))
    return joined.withColumns(
        {
            "mq_status": status,
            "reasons": reasons,
            "updated_by": F.lit(SYNC_USER),
            "updated_at": F.lit(options.stamp).cast("timestamp") if options.stamp else F.current_timestamp(),
            "applies_demographics": F.coalesce(F.col("mq_id") == F.col("d_applied"), F.lit(False)),
            "applies_address": F.coalesce(F.col("mq_id") == F.col("a_applied"), F.lit(False)),
            "applies_phone": F.coalesce(F.col("mq_id") == F.col("p_applied"), F.lit(False)),
            "applies_census": F.coalesce(F.col("mq_id") == F.col("t_applied"), F.lit(False)),
            "target_addr_id": F.coalesce("addr_id", "new_addr_id"),
            "target_phn_id": F.coalesce(stored, F.col("new_phn_id")),
            "member_id": F.when(single, F.col("member_id")),
            "addr_id": F.when(single, F.coalesce("addr_id", F.when(F.col("address_seen"), F.col("new_addr_id")))),
            "phn_id": F.when(single, F.coalesce(stored, F.when(F.col("phone_seen"), F.col("new_phn_id")))),
        }
    )


def _patch(outcome: DataFrame, flag: str, keys: dict[str, Column], cells: list[Column]) -> DataFrame:
    """Cells of the last row applied per key; earlier windows of the run are overwritten."""
    audit = [c for c in ("updated_by", "updated_at") if c in outcome.columns]
    rows = outcome.filter(flag).select("mq_id", *[c.alias(n) for n, c in keys.items()], *cells, *audit)
    return latest_per_key(rows, list(keys), "mq_id").drop("mq_id")


def _member_patch(outcome: DataFrame) -> DataFrame:
    cells = [F.col(c) for c in DEMOGRAPHICS]
    return _patch(outcome, "applies_demographics", {"member_id": F.col("member_id")}, cells)


def _address_patch(outcome: DataFrame) -> DataFrame:
    keys = {"member_id": F.col("member_id"), "addr_id": F.col("target_addr_id")}
    fresh = F.col("target_addr_id").eqNullSafe(F.col("new_addr_id")).alias("is_new")
    return _patch(outcome, "applies_address", keys, [*[F.col(c) for c in ADDRESS], fresh])


def _phone_patch(outcome: DataFrame) -> DataFrame:
    keys = {"member_id": F.col("member_id"), "phn_id": F.col("target_phn_id")}
    kind = F.coalesce(F.col("phone_type_id"), F.lit(MAIN_PHONE)).alias("phone_type_id")
    fresh = F.col("target_phn_id").eqNullSafe(F.col("new_phn_id")).alias("is_new")
    return _patch(outcome, "applies_phone", keys, [F.col("phone"), kind, fresh])


def _census_patch(outcome: DataFrame) -> DataFrame:
    cells = [make(name).alias(name) for name, make in CENSUS.items()]
    return _patch(outcome, "applies_census", {"pid": F.col("pid")}, cells)


def apply_demographics(members: DataFrame, outcome: DataFrame) -> DataFrame:
    """Update only; members are never inserted."""
    return loads.update_unique(members, _member_patch(outcome), ["member_id"])


def _created(table: DataFrame) -> DataFrame:
    """Rows added by the sync carry its user as their creator, where the table keeps one."""
    if "created_by" not in table.columns:
        return table
    return table.withColumn("created_by", F.coalesce("created_by", F.lit(SYNC_USER)))


def apply_address(addresses: DataFrame, outcome: DataFrame) -> DataFrame:
    patch = _address_patch(outcome).drop("is_new")
    return _created(loads.merge_unique(addresses, patch, ["member_id", "addr_id"]))


def apply_phone(phones: DataFrame, outcome: DataFrame) -> DataFrame:
    patch = _phone_patch(outcome).drop("is_new")
    return _created(loads.merge_unique(phones, patch, ["member_id", "phn_id"]))


def sync_census(census: DataFrame, outcome: DataFrame) -> DataFrame:
    """Latest differing row of each changed member overwrites its census row."""
    return loads.update_unique(census, _census_patch(outcome), ["pid"])


def touched_rows(state: State, outcome: DataFrame, block_census: bool = False) -> State:
    """Only the rows of each table that the run changes or adds, as they are after it."""

    def merged(table: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
        old = loads.touched(table, patch.filter("NOT is_new").drop("is_new"), keys)
        new = patch.filter("is_new").select(*[c for c in patch.columns if c in table.columns])
        return old.unionByName(_created(loads.fit(new, table)))

    census = state.census
    if census is not None:
        census = loads.touched(census, _census_patch(outcome), ["pid"]) if block_census else census.limit(0)
    return State(
        members=loads.touched(state.members, _member_patch(outcome), ["member_id"]),
        addresses=merged(state.addresses, _address_patch(outcome), ["member_id", "addr_id"]),
        phones=merged(state.phones, _phone_patch(outcome), ["member_id", "phn_id"]),
        census=census,
    )


def sync_batch(
    inbound: DataFrame, state: State, references: Mapping[str, DataFrame], options: Options = Options()
) -> Outcome | None:
    """One run over the staged rows; None when no row is waiting.

    The resolved rows are written once and every table is derived from that
    copy, so a change set is computed a single time.
    """
    resolved = resolve(inbound, state, references, options)
    if resolved is None:
        return None
    rows = staged(resolved, "resolved")
    if not options.allow_partial and not rows.filter(F.col("mq_status") == FAILED).isEmpty():
        raise RuntimeError("the run has rows that cannot be applied and partial success is off")
    return Outcome(rows, state, options.block_census)


def settle_queue(queue: DataFrame, outcome: Outcome | None) -> DataFrame:
    """The queue with the run's statuses, hashes and ids filled in."""
    if outcome is None:
        return queue
    names = [c for c in outcome.statuses().columns if c in queue.columns and c not in ("mq_id", "pid")]
    return loads.update(queue, outcome.statuses().select("mq_id", *names), ["mq_id"])


def error_log(failures: DataFrame, columns: list[str], procedure: str, package: str, first_id: int = 1000) -> DataFrame:
    """One log row per failed row, numbered in id order."""
    entries = failures.select(
        "mq_id",
        record_json(columns).alias("json_record"),
        F.array_join("reasons", "; ").alias("error_message"),
        F.lit(FAILED).alias("mq_status_code"),
        F.lit(procedure).alias("procedure_name"),
        F.lit(package).alias("package_name"),
    )
    return number_rows(entries, ["mq_id"], "mq_log_id", first_id)


def response_code(statuses: DataFrame) -> DataFrame:
    """0 when a record was handled, 1 when it failed."""
    return statuses.withColumn("response", F.when(F.col("mq_status") == FAILED, 1).otherwise(0))


def status_summary(statuses: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows per status with its description and class."""
    counts = statuses.groupBy("mq_status").agg(F.count("*").alias("rows"))
    return counts.join(codes.withColumnRenamed("code", "mq_status"), "mq_status", "left")

