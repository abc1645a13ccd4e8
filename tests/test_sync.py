"""Record sync against a plain row-by-row simulation, and its documented scenarios."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loomsync.plans import sync
from loomsync.plans.sync import ADDRESS, DEMOGRAPHICS, PHONE
from loomsync.streaming.queue import run_stream, state_tables

KINDS = {"name_suffix_id": "bigint", "gender_id": "bigint", "mar_status_id": "bigint", "phone_type_id": "bigint",
         "birthdate": "date", "dt_of_death": "date"}
PAYLOAD = [*DEMOGRAPHICS, *PHONE, *ADDRESS]
CENSUS = ["pid", *sync.CENSUS]


def ddl(names, **more):
    kinds = {"mq_id": "bigint", "member_id": "bigint", "addr_id": "bigint", "phn_id": "bigint", "mq_status": "int", **KINDS, **more}
    return ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)


def frame(spark, rows, names):
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl(names))


MEMBER = ["member_id", "pid", "status_id", *DEMOGRAPHICS]
ADDR = ["member_id", "addr_id", *ADDRESS]
PHN = ["member_id", "phn_id", *PHONE]
INBOUND = ["mq_id", "pid", "mq_status", *PAYLOAD]


class World:
    """The tables as plain rows, with the engine's window semantics spelled out."""

    def __init__(self, members, addresses, phones, census):
        self.members, self.addresses, self.phones, self.census = members, addresses, phones, census
        self.next_id = -1

    def frames(self, spark):
        return sync.State(
            frame(spark, self.members, MEMBER), frame(spark, self.addresses, ADDR),
            frame(spark, self.phones, PHN), frame(spark, self.census, CENSUS),
        )

    def view(self, pid):
        out = []
        for m in self.members:
            if m["pid"] != pid or m["status_id"] != "37" or pid == "N/A":
                continue
            homes = [a for a in self.addresses if a["member_id"] == m["member_id"]] or [None]
            lines = [p for p in self.phones if p["member_id"] == m["member_id"] and p["phone_type_id"] == 1] or [None]
            out += [(m, a, p) for a in homes for p in lines]
        return out

    @staticmethod
    def text(row, names):
        plain = lambda v: "|" if v in (None, "") else str(v)
        return "".join(plain((row or {}).get(n)) for n in names)

    def window(self, rows, bad, block):
        before = {r["mq_id"]: self.view(r["pid"]) for r in rows}
        wins, status, ids = {}, {}, {}
        for r in rows:
            seen = before[r["mq_id"]]
            if not seen:
                status[r["mq_id"]] = 404
                continue
            if len(seen) > 1 or bad(r):
                status[r["mq_id"]] = 500
                continue
            m, a, p = seen[0]
            ids[r["mq_id"]] = (a is not None, p is not None)
            diff = [self.text(r, g) != self.text(row, g) for g, row in ((DEMOGRAPHICS, m), (ADDRESS, a), (PHONE, p))]
            status[r["mq_id"]] = 200 if any(diff) else 304
            for name, hit in zip("dapc", [*diff, any(diff)]):
                if hit:
                    wins[r["pid"], name] = (r, seen[0])
        for (pid, name), (r, (m, a, p)) in wins.items():
            if name == "d":
                m.update({n: r.get(n) for n in DEMOGRAPHICS})
            elif name == "a":
                if a is None:
                    a = {"member_id": m["member_id"], "addr_id": self.fresh()}
                    self.addresses.append(a)
                a.update({n: r.get(n) for n in ADDRESS})
            elif name == "p":
                if p is None:
                    p = {"member_id": m["member_id"], "phn_id": self.fresh()}
                    self.phones.append(p)
                p.update(phone=r["phone"], phone_type_id=r["phone_type_id"] or 1)
            elif block:
                for c in self.census:
                    if c["pid"] == pid:
                        c.update({n: r.get(n) for n in sync.CENSUS if n != "middle_initial"})
                        c["middle_initial"] = r["middle_name"][:1] if r["middle_name"] else r["middle_name"]
        return status, ids

    def fresh(self):
        self.next_id -= 1
        return self.next_id


def make_world(rng, people=14):
    pick = rng.choice
    members = [
        {
            "member_id": i, "pid": "N/A" if i == 3 else f"P{i}", "status_id": "12" if i == 4 else "37",
            "first_name": pick(["Ann", "Bob", None]), "middle_name": pick(["Mo", "", None]), "last_name": "L",
            "gender_id": pick([20, 21]), "birthdate": dt.date(1980, 1, 1),
        }
        for i in range(people)
    ]
    addresses = [{"member_id": i, "addr_id": 100 + i, "city": pick(["X", "Y"])} for i in range(people) if i % 3]
    addresses.append({"member_id": 1, "addr_id": 300, "city": "Z"})
    phones = [{"member_id": i, "phn_id": 200 + i, "phone": pick(["1", "2"]), "phone_type_id": 1} for i in range(people) if i % 4]
    phones.append({"member_id": 5, "phn_id": 400, "phone": "9", "phone_type_id": 2})
    census = [{"pid": f"P{i}", "city": "C"} for i in range(people) if i % 5]
    return World(members, addresses, phones, census)


def make_inbound(rng, count, people=14):
    rows, mq_id = [], 0
    for _ in range(count):
        mq_id += rng.choice([1, 1, 1, 4])
        rows.append(
            {
                "mq_id": mq_id, "pid": f"P{rng.choice([0, 0, 0, 6, 9, rng.randrange(people + 2)])}", "mq_status": 202,
                "first_name": rng.choice(["Ann", "Bob", None, "X" * 70 if rng.random() < 0.2 else "Bob"]),
                "middle_name": rng.choice(["Mo", "", None]), "last_name": "L",
                "gender_id": rng.choice([20, 21, 99 if rng.random() < 0.2 else 20]), "birthdate": dt.date(1980, 1, 1),
                "city": rng.choice(["X", "Y", None]), "phone": rng.choice(["1", "2", None]),
                "phone_type_id": rng.choice([1, 1, 1, 2, None]),
            }
        )
    return rows


def references(spark):
    return {"gender_id": spark.createDataFrame([(20,), (21,)], "lov_id bigint")}


def is_bad(row):
    return len(row["first_name"] or "") > 64 or row["gender_id"] not in (20, 21)


def bag(df, names, new_id=None, old=()):
    """Rows as a bag; ids given during the run count only as new."""
    def cell(r, n):
        return "new" if n == new_id and r[n] not in old else r[n]

    return Counter(tuple(cell(r, n) for n in names) for r in df)


@pytest.mark.parametrize("seed,size,block", [(1, 1000, 100), (2, 7, 100), (3, 1, 5)])
def test_windows_equal_simulation(spark, seed, size, block):
    rng = random.Random(seed)
    world, inbound = make_world(rng), make_inbound(rng, 120)
    state, rows = world.frames(spark), frame(spark, inbound, INBOUND)
    old_addr, old_phn = {a["addr_id"] for a in world.addresses}, {p["phn_id"] for p in world.phones}
    options = sync.Options(commit_size=size, block_census=True, scan_block=block)
    outcome = sync.sync_batch(rows, state, references(spark), options)
    status, ids = {}, {}
    for start in range(0, inbound[-1]["mq_id"] + 1, size):
        part = [r for r in inbound if start <= r["mq_id"] < start + size]
        s, i = world.window(part, is_bad, True)
        status |= s
        ids |= i
    got = outcome.rows.collect()
    assert {r["mq_id"]: r["mq_status"] for r in got} == status
    assert len(got) == len(inbound)
    for r in got:
        if r["mq_id"] in ids:
            assert (r["addr_id"] is not None, r["phn_id"] is not None) == ids[r["mq_id"]]
    after = outcome.state
    assert bag(after.members.collect(), MEMBER) == bag([{n: m.get(n) for n in MEMBER} for m in world.members], MEMBER)
    wanted = [{n: a.get(n) for n in ADDR} for a in world.addresses]
    stored = after.addresses.collect()
    assert bag(stored, ADDR, "addr_id", old_addr) == bag(wanted, ADDR, "addr_id", old_addr)
    assert len({r["addr_id"] for r in stored}) == len(stored)
    wanted = [{n: p.get(n) for n in PHN} for p in world.phones]
    stored = after.phones.collect()
    assert bag(stored, PHN, "phn_id", old_phn) == bag(wanted, PHN, "phn_id", old_phn)
    assert len({r["phn_id"] for r in stored}) == len(stored)
    assert bag(after.census.collect(), CENSUS) == bag([{n: c.get(n) for n in CENSUS} for c in world.census], CENSUS)


def one(world, pid, **changes):
    member = next(m for m in world.members if m["pid"] == pid)
    home = next((a for a in world.addresses if a["member_id"] == member["member_id"]), {})
    line = next((p for p in world.phones if p["member_id"] == member["member_id"] and p["phone_type_id"] == 1), {})
    row = {n: (member | home | line).get(n) for n in PAYLOAD}
    return {**row, "pid": pid, "mq_status": 202, **changes}


def test_scenarios(spark):
    """Change, resend, restore, clear, unknown pid, bad row, and B before A in one window."""
    world = make_world(random.Random(7))
    state = world.frames(spark)
    refs = references(spark)

    def run(state, *rows, **options):
        numbered = [{**r, "mq_id": n + 1} for n, r in enumerate(rows)]
        out = sync.sync_batch(frame(spark, numbered, INBOUND), state, refs, sync.Options(**options))
        found = {r["mq_id"]: r["mq_status"] for r in out.rows.collect()}
        return [found.get(n + 1) for n in range(len(rows))], out

    same, other = one(world, "P2"), one(world, "P5")
    changed = {**same, "last_name": "New"}
    cleared = {**one(world, "P7"), "last_name": None}
    # A NULL phone type never equals a stored phone, though it is stored as the main type.
    loose = one(world, "P10", phone_type_id=None)
    first, out = run(state, changed, same, other, {**same, "pid": "nope"}, cleared, {**other, "gender_id": 99}, loose)
    assert first == [200, 304, 304, 404, 200, 500, 200]
    names = {r["pid"]: r["last_name"] for r in out.state.members.collect()}
    assert names["P2"] == "New" and names["P7"] is None and names["P5"] == "L"
    assert out.failures().count() == 1
    log = sync.error_log(out.failures(), ["mq_id", "pid"], "process", "sync").collect()
    assert [(r["mq_log_id"], r["mq_id"]) for r in log] == [(1000, 6)] and "gender_id" in log[0]["error_message"]
    assert out.state.census.filter("last_name IS NOT NULL").isEmpty()
    audited = state.members.withColumns({"updated_by": F.lit("load"), "updated_at": F.lit("2020-01-01").cast("timestamp")})
    users = sync.apply_demographics(audited, out.rows).groupBy("updated_by").count().collect()
    assert {r["updated_by"]: r["count"] for r in users} == {"MDM": 2, "load": len(world.members) - 2}

    again, back = run(out.state, changed, cleared, loose, commit_size=1)
    assert again == [304, 304, 200]
    apart, out = run(state, changed, same, commit_size=1)
    assert apart == [200, 200] and out.state.members.filter("pid = 'P2'").first()["last_name"] == "L"
    assert run(state, changed, same, other, max_records=2)[0] == [200, 304, None]
    with pytest.raises(RuntimeError):
        run(state, {**same, "gender_id": 99}, allow_partial=False)
    assert sync.sync_batch(frame(spark, [], INBOUND), state, refs) is None
    queue = frame(spark, [{**changed, "mq_id": 1}, {**same, "mq_id": 9, "mq_status": 304}], INBOUND)
    settled = sync.settle_queue(queue, sync.sync_batch(queue, state, refs))
    assert {r["mq_id"]: r["mq_status"] for r in settled.collect()} == {1: 200, 9: 304}


def test_stream_equals_windows(spark, tmp_path):
    """Three files as three micro-batches give what three windows give; a second start adds nothing."""
    rng = random.Random(11)
    world, inbound = make_world(rng), make_inbound(rng, 60)
    state, refs = world.frames(spark), references(spark)
    size = -(-(inbound[-1]["mq_id"] + 1) // 3)
    options = sync.Options(commit_size=10**6, block_census=True)
    for part in range(3):
        rows = [r for r in inbound if r["mq_id"] // size == part]
        frame(spark, rows, INBOUND).coalesce(1).write.mode("append").parquet(f"{tmp_path}/staging")
        done = run_stream(
            spark, f"{tmp_path}/staging", f"{tmp_path}/out", state, refs, options, max_files=1, compact_after=2
        )
    again = run_stream(spark, f"{tmp_path}/staging", f"{tmp_path}/out", state, refs, options)
    assert again.count() == done.count() == len(inbound)
    batch = sync.sync_batch(frame(spark, inbound, INBOUND), state, refs, sync.Options(commit_size=size, block_census=True))
    pick = lambda df: {r["mq_id"]: r["mq_status"] for r in df.select("mq_id", "mq_status").collect()}
    assert pick(again) == pick(batch.rows)
    tables = state_tables(spark, f"{tmp_path}/out")
    assert tables["members"].depth() < 3 and tables["members"].base.read().count() == len(world.members)
    for name, columns in (("members", MEMBER), ("census", CENSUS), ("addresses", ["member_id", *ADDRESS]), ("phones", ["member_id", *PHONE])):
        streamed, whole = tables[name].read(), getattr(batch.state, name)
        assert bag(streamed.collect(), columns) == bag(whole.collect(), columns), name


def test_current_state_fans_out(spark):
    world = make_world(random.Random(1))
    state = world.frames(spark)
    lov = spark.createDataFrame([(20, "CSM_SEX", "F"), (21, "CSM_MARITAL_ST", "x")], "lov_id bigint, lov_type string, lov_desc string")
    empty = lambda ddl: spark.createDataFrame([], ddl)
    extended = sync.State(state.members.withColumn("name_prefix_id", F.lit(None).cast("bigint")), state.addresses, state.phones)
    view = sync.current_state(
        extended, lov, empty("name_prefix_id bigint, name_prefix string"), empty("name_suffix_id bigint, name_suffix string"),
        empty("phone_type_id bigint, phone_type string"),
    )
    rows = view.collect()
    assert Counter(r["pid"] for r in rows)["P1"] == 2
    assert {r["pid"] for r in rows}.isdisjoint({"N/A", "P4"})
    assert {r["gender"] for r in rows if r["gender_id"] == 21} <= {None}


def test_stream_spreads_a_file(spark, tmp_path, monkeypatch):
    """Rows of one file are dealt out before a batch is worked on."""
    frame(spark, make_inbound(random.Random(3), 20), INBOUND).coalesce(1).write.parquet(f"{tmp_path}/staging")
    plans = []
    monkeypatch.setattr(sync, "sync_batch", lambda batch, *a: plans.append(batch._jdf.queryExecution().optimizedPlan().toString()))
    empty = sync.State(*[spark.createDataFrame([(1,)], "member_id long") for _ in range(3)])
    with pytest.raises(AnalysisException):  # no batch is kept
        run_stream(spark, f"{tmp_path}/staging", f"{tmp_path}/out", empty, {})
    assert len(plans) == 1 and "RepartitionByExpression [mq_id" in plans[0]
