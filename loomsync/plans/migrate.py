"""Table migration: describe, reconcile, redact, rename, coerce, load.

The source is read once: its rows are prepared and staged, and the same write measures
them. The stored description of the target is then reconciled with the wanted one and
adapted to what was measured, both before a single row of the target changes; a load that
would break a key is refused there. Only then the rows are merged and the pointer moves.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomsync.functions import cells, masking
from loomsync.operators import catalog, guard, loads
from loomsync.session import staged
from loomsync.sources.text_files import typed_csv
from loomsync.spec import ColumnSpec, TableSpec

ACTIONS = ("insert", "reset", "full_load", "upsert", "update")
_LOBS = ("CLOB", "NCLOB", "BLOB")


class AccessDenied(RuntimeError):
    """The source refused to show a table."""

    def __init__(self, code: str) -> None:
        self.code = code
        super().__init__(code)


@dataclass(frozen=True)
class Settings:
    source_system: str = "salesforce"
    target_system: str = "oracle"
    action: str = "insert"
    redaction: str = "none"
    secret: bytes | None = None
    rules: tuple = tuple(catalog.FIELD_RULES)
    destructive: str = "restricted"
    environment: str = "dev"
    env_class: str = "dev"
    break_glass: bool = False
    keep_rejects: bool = False
    external_key: str | None = None
    clear_marker: str | None = None
    buckets: int | None = None


@dataclass(frozen=True)
class Loaded:
    """A target after a load, what the load counted while staging, and the changes of its description."""

    table: DataFrame
    processed: int
    rejected: int
    changes: tuple[tuple[str, str, str | None], ...] = ()


def target_name(name: str, source: str, target: str) -> str:
    """Name of one table on the target; the column form is ``names.cross_system_name``."""
    if source == target:
        return name
    if target == "oracle":
        bare = name[4:] if name.lower().startswith("ora_") else None
        if bare is None:
            return f"SF_{name}"
        return bare[:-3] if bare.lower().endswith("__c") else bare
    return name[3:] if name.upper().startswith("SF_") else f"ora_{name.lower()}__c"


def forced_types(spec: TableSpec, rules: Iterable[tuple]) -> TableSpec:
    """Column types a rule forces; a forced LOB has no length."""
    forced = {(s, o, f): kind for s, o, f, kind, _ in rules if kind}

    def apply(column: ColumnSpec) -> ColumnSpec:
        kind = forced.get((spec.system, spec.name.strip().lower(), column.name.strip().lower()))
        if kind is None:
            return column
        length = None if kind.upper() in _LOBS else column.max_length
        return replace(column, force_type=kind, raw_type=kind.upper(), max_length=length)

    return spec.with_columns(apply(c) for c in spec.columns)


def target_spec(spec: TableSpec, settings: Settings) -> TableSpec:
    """The source description with forced types, under its target name; text beyond the longest column is a LOB."""
    forced = forced_types(spec, settings.rules)
    name = target_name(spec.name, settings.source_system, settings.target_system)

    def sized(column: ColumnSpec) -> ColumnSpec:
        if column.raw_type.upper() == "VARCHAR2" and (column.max_length or 0) > catalog.MAX_TEXT:
            return replace(column, raw_type="CLOB", max_length=None)
        return column

    return replace(forced, name=name, system=settings.target_system).with_columns(sized(c) for c in forced.columns)


def prepare(rows: DataFrame, spec: TableSpec, settings: Settings) -> DataFrame:
    """Rows ready for the target: redacted under source names, then renamed and coerced."""
    strategy = masking.strategy_for(settings.redaction, settings.secret)
    scopes = catalog.redaction_plan(settings.source_system, spec.name, rows.columns, settings.rules)
    clean = masking.apply_plan(rows, scopes, strategy)
    return cells.normalize_frame(clean, target_spec(spec, settings))


_SPEC_ROWS = (
    "table_name string, column_name string, raw_type string, canonical string, max_length int, precision int, scale int,"
    " is_nullable boolean, is_key boolean, is_indexed boolean, ordinal int"
)


def spec_rows(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """A description as catalog rows."""
    rows = [
        (
            spec.name, c.target_name, c.raw_type, c.canonical, c.max_length, c.precision, c.scale,
            c.is_nullable, c.is_primary_key or c.is_unique, c.is_indexed, i,
        )
        for i, c in enumerate(spec.columns)
    ]
    return spark.createDataFrame(rows, _SPEC_ROWS)


def _described(rows: DataFrame, system: str) -> TableSpec:
    """The description that ``spec_rows`` gave."""
    found = sorted(rows.collect(), key=lambda r: r["ordinal"])  # one row per column
    columns = [
        ColumnSpec(
            r["column_name"], r["raw_type"], r["canonical"], is_primary_key=r["is_key"], is_nullable=r["is_nullable"],
            is_indexed=r["is_indexed"], max_length=r["max_length"], precision=r["precision"], scale=r["scale"],
        )
        for r in found
    ]
    return TableSpec(found[0]["table_name"], system, columns=tuple(columns))


def reconcile(spark: SparkSession, stored: TableSpec, wanted: TableSpec, *, enforce: bool) -> tuple[TableSpec, list[tuple]]:
    """The stored description with what the wanted one adds, widens, retypes or makes nullable, and these changes."""
    actual = spec_rows(spark, stored).select(
        "table_name",
        "column_name",
        F.col("raw_type").alias("data_type"),
        F.col("max_length").alias("char_length"),
        F.when(F.col("raw_type") == "VARCHAR2", catalog.MAX_TEXT).alias("data_length"),
        F.when(F.col("is_nullable"), "Y").otherwise("N").alias("nullable"),
    )
    drift = catalog.schema_drift(spec_rows(spark, replace(wanted, name=stored.name)), actual, enforce=enforce)
    found = [(r["column_name"], r["action"], r["detail"]) for r in drift.collect()]  # a few rows per column
    ours = {c.target_name: c for c in stored.columns}
    for column in wanted.columns:
        name = column.target_name
        for _, action, detail in (f for f in found if f[0] == name):
            if action == "ADD":
                ours[name] = replace(column, name=name)
            elif action == "WIDEN":
                ours[name] = replace(ours[name], max_length=int(detail))
            elif action == "MODIFY TYPE":
                ours[name] = replace(column, name=name, is_nullable=ours[name].is_nullable)
            else:
                ours[name] = replace(ours[name], is_nullable=action == "NULL")
        if name in ours:
            ours[name] = replace(ours[name], is_primary_key=ours[name].is_primary_key or column.is_primary_key)
    return stored.with_columns(ours.values()), sorted(found)


def adapt(profiled: DataFrame, spec: TableSpec) -> tuple[TableSpec, list[tuple]]:
    """The description that holds the profiled rows, and what had to change; a key or index is never made a LOB."""
    plan = catalog.overflow_plan(profiled, spec_rows(profiled.sparkSession, spec)).collect()  # one row per column
    refused = sorted(r["column_name"] for r in plan if r["size_action"] == "REFUSED")
    if refused:
        raise ValueError(f"values of {', '.join(refused)} in {spec.name} are too long for a key or an indexed column")
    ours = {c.target_name: c for c in spec.columns}
    changes = []
    for r in plan:
        name = r["column_name"]
        if r["size_action"] == "WIDEN":
            ours[name] = replace(ours[name], max_length=r["new_length"])
            changes.append((name, "WIDEN", str(r["new_length"])))
        elif r["size_action"] == "PROMOTE":
            ours[name] = replace(ours[name], raw_type="CLOB", max_length=None)
            changes.append((name, "PROMOTE", "CLOB"))
        if r["relax_null"]:
            ours[name] = replace(ours[name], is_nullable=True)
            changes.append((name, "RELAX", None))
    return spec.with_columns(ours.values()), sorted(changes, key=str)


_ORDER = "_order"


def _stage(ready: DataFrame, order: str | None) -> tuple[DataFrame, dict]:
    """Prepared rows written once with their place in the source, and what that write saw of them."""
    seen = Observation()
    bad = F.size(cells.REJECTS) > 0
    place = F.monotonically_increasing_id()  # fixed by being written
    rows = ready.withColumn(_ORDER, F.struct(F.col(order).alias("given"), place.alias("place")) if order else place)
    measured = catalog.measures(ready.drop(cells.REJECTS))
    watched = rows.observe(
        seen,
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(bad).alias("_rejected"),
        F.min(F.when(bad, F.get(cells.REJECTS, F.lit(0)))).alias("_example"),
        *[value.alias(name) for name, value in measured.items()],
    )
    return staged(watched, "load"), seen.get


def _profile(spark: SparkSession, columns: list[str], seen: dict) -> DataFrame:
    rows = [(c, seen[f"{c}_chars"], seen[f"{c}_nulls"]) for c in columns]
    return spark.createDataFrame(rows, "column_name string, max_chars int, nulls bigint")


def _kind_for(old: str, new: str) -> str:
    """Type of a stored column that takes values of type ``new`` as well."""
    if old.startswith("decimal") and new.startswith("decimal"):
        sizes = [tuple(map(int, kind[8:-1].split(","))) for kind in (old, new)]
        scale = max(s for _, s in sizes)
        whole = max(p - s for p, s in sizes)
        if whole + scale > 38:
            raise ValueError(f"no decimal holds both {old} and {new}")
        return f"decimal({whole + scale},{scale})"
    return new


def _recast(current: DataFrame, ready: DataFrame, name: str) -> DataFrame:
    """Stored rows in the columns and types after the load; a stored value that does not convert stops it."""
    old, new = dict(current.dtypes), dict(ready.dtypes)
    kinds = {c: _kind_for(old[c], new[c]) if c in new and old[c] != new[c] else old[c] for c in current.columns}
    moved = [c for c in current.columns if kinds[c] != old[c]]
    lost = [F.col(c).isNotNull() & F.col(c).try_cast(kinds[c]).isNull() for c in moved]
    if lost and current.filter(reduce(Column.__or__, lost)).head(1):
        raise ValueError(f"stored values of {name} do not convert: {', '.join(moved)}")
    cast = current.withColumns({c: F.col(c).try_cast(kinds[c]) for c in moved}) if moved else current
    added = {c: F.lit(None).cast(new[c]) for c in ready.columns if c not in old}
    return cast.withColumns(added) if added else cast


def check_guard(spark: SparkSession, name: str, settings: Settings) -> None:
    """Ask the veto rules before rows are removed."""
    op = {"reset": "truncate", "full_load": "drop"}.get(settings.action)
    if op is None:
        return
    managed = name.upper().startswith("SF_") if settings.target_system == "oracle" else (
        name.lower().startswith("ora_") and name.lower().endswith("__c")
    )
    plan = [(op, settings.destructive, settings.environment, settings.env_class, name, managed, settings.break_glass)]
    schema = (
        "op string, mode string, environment string, env_class string, table_name string,"
        " is_managed boolean, break_glass boolean"
    )
    guard.enforce(spark.createDataFrame(plan, schema))


def _judge_rejects(rows: DataFrame, seen: dict, name: str, root: str, settings: Settings, tag: str) -> None:
    """Cells that did not parse stop the load, or are kept beside it."""
    if not seen["_rejected"]:
        return
    if not settings.keep_rejects:
        raise ValueError(f"cells of {name} do not fit their type, for example {seen['_example']}")
    bad = rows.filter(F.size(cells.REJECTS) > 0).drop(_ORDER)
    loads.VersionedTable(rows.sparkSession, f"{root.rstrip('/')}/{name}_rejects").append(bad, tag)


def description(spark: SparkSession, root: str, name: str, system: str = "oracle") -> TableSpec | None:
    """The stored description of a target, None if it has none."""
    table = loads.VersionedTable(spark, f"{root.rstrip('/')}/{name}_columns")
    return _described(table.read(), system) if table.exists() else None


def load_table(
    rows: DataFrame, spec: TableSpec, root: str, settings: Settings = Settings(), order: str | None = None, target: TableSpec | None = None
) -> Loaded:
    """Move one table into its target.

    Of rows with one key the last wins: by ``order``, a target column (for a CRM target a source column), then by their place in the source. A missing
    target is created empty and then loaded by the same action, so a first update loads nothing and a
    first upsert one row per key. ``target`` describes a CRM target; it defaults to the source's description.
    """
    if settings.action not in ACTIONS:
        raise ValueError(f"unknown load action '{settings.action}'")
    if settings.target_system == "salesforce" and settings.source_system != "salesforce":
        return _load_crm(rows, spec, root, settings, order, target)
    spark = rows.sparkSession
    wanted = target_spec(spec, settings)
    place, tag = f"{root.rstrip('/')}/{wanted.name}", f"load-{uuid.uuid4().hex}"
    table = loads.VersionedTable(spark, place)
    current = table.read() if table.exists() else None
    if current is not None:
        check_guard(spark, wanted.name, settings)
    staged_rows, seen = _stage(prepare(rows, spec, settings), order)
    _judge_rejects(staged_rows, seen, wanted.name, root, settings, tag)
    ready = staged_rows.drop(cells.REJECTS, _ORDER)
    ordered = staged_rows.drop(cells.REJECTS)

    stored = description(spark, root, wanted.name) if current is not None and settings.action != "full_load" else None
    known, drift = reconcile(spark, stored, wanted, enforce=settings.source_system != "salesforce") if stored else (wanted, [])
    known, grown = adapt(_profile(spark, ready.columns, seen), known)
    if current is None or settings.action == "full_load":
        before = ready.limit(0)
        physical = False
    else:
        before = _recast(current, ready, wanted.name)
        physical = dict(before.dtypes) != dict(current.dtypes)
    keys = known.primary_key if stored else wanted.primary_key
    if settings.action == "insert" and current is not None and not physical:
        loaded = table.append(loads.fit(ready, current), tag)
    elif settings.action == "insert" and current is not None:
        loaded = table.write(loads.insert(before, ready), tag)
    elif settings.action in ("insert", "reset", "full_load"):
        loaded = table.write(loads.fit(ready, before) if settings.action == "reset" else ready, tag)
    else:
        keyed = loads.KeyedTable(spark, place, _required(keys), settings.buckets)
        if current is None or physical:
            keyed.write(before, f"{tag}-base")
        loaded = keyed.upsert(ordered, _ORDER, tag) if settings.action == "upsert" else keyed.update(ordered, _ORDER, tag=tag)
    loads.VersionedTable(spark, f"{place}_columns").write(spec_rows(spark, known).coalesce(1), tag)
    return Loaded(loaded, seen["_rows"], seen["_rejected"], tuple(drift + grown))


def _required(keys: list[str]) -> list[str]:
    if not keys:
        raise ValueError("this load needs a key to match on and none is defined")
    return keys


_GIVEN = "_given"


def _sent(rows: DataFrame, described: TableSpec, key: str, settings: Settings, order: str | None) -> DataFrame:
    """Source rows as a CRM takes them: its names, the fields it lets write and the key, as text that its types are read from.

    A cell is NULL where nothing is sent, and else a struct whose value is NULL where the field is to be emptied.
    """
    by_name = {cells.canonical_name(c.name): c for c in described.columns}  # the last of equal names wins
    allowed = {*described.writable, key}
    chosen: dict[str, tuple[str, str, ColumnSpec]] = {}
    for name, kind in rows.dtypes:
        column = by_name.get(cells.canonical_name(name))
        if column is not None and column.name in allowed:
            chosen[column.name] = (name, kind.split("(")[0].split("<")[0], column)
    texts = rows.select(
        *[F.when(F.col(f"`{n}`").isNotNull(), cells.to_text(F.col(f"`{n}`"), kind)).alias(target) for target, (n, kind, _) in chosen.items()],
        *[F.col(f"`{order}`").alias(_GIVEN)] * (order is not None),
    )
    fields = list(chosen)
    marker = settings.clear_marker
    emptied = {c: (F.col(c) == marker) if marker is not None and c != key else F.lit(False) for c in fields}
    told = texts.withColumns({f"_clear_{c}": F.coalesce(value, F.lit(False)) for c, value in emptied.items()})
    told = told.withColumns({c: F.when(~F.col(f"_clear_{c}"), F.col(c)) for c in fields})
    read = cells.cast_text_frame(told, {c: column.raw_type.lower() for c, (_, _, column) in chosen.items()})

    def cell(name: str) -> Column:
        return F.when(F.col(name).isNotNull() | F.col(f"_clear_{name}"), F.struct(F.col(name).alias("value"))).alias(name)

    return read.select(*[F.col(c) if c == key else cell(c) for c in fields], *[_GIVEN] * (order is not None), cells.REJECTS)


def _load_crm(rows: DataFrame, spec: TableSpec, root: str, settings: Settings, order: str | None, target: TableSpec | None) -> Loaded:
    """Partial-update load: only fields that a row sends change; a NULL source cell leaves the stored one alone."""
    spark = rows.sparkSession
    named = target or spec
    described = replace(named, name=target_name(spec.name, settings.source_system, settings.target_system), system="salesforce")
    key = "Id" if settings.action == "update" else settings.external_key or loads.external_key(described)
    place, tag = f"{root.rstrip('/')}/{described.name}", f"load-{uuid.uuid4().hex}"
    scopes = catalog.redaction_plan(settings.source_system, spec.name, rows.columns, settings.rules)
    clean = masking.apply_plan(rows, scopes, masking.strategy_for(settings.redaction, settings.secret))
    sent = _sent(clean, described, key, settings, order)
    if settings.action in ("insert", "reset", "full_load"):
        sent = sent.drop("Id")
    elif key not in sent.columns:
        raise ValueError(f"the source of {described.name} has no column for the key '{key}'")
    staged_rows, seen = _stage(sent, None if order is None else _GIVEN)
    _judge_rejects(staged_rows, seen, described.name, root, settings, tag)
    fresh = staged_rows.drop(cells.REJECTS, _GIVEN)
    schema = {c.name: F.lit(None).cast(_crm_type(c)) for c in described.columns}
    table = loads.VersionedTable(spark, place)
    if not table.exists():
        table.write(spark.range(0).select(*[v.alias(n) for n, v in schema.items()]), f"{tag}-base")
    elif settings.action in ("reset", "full_load"):  # objects cannot be dropped: every record is deleted
        check_guard(spark, described.name, replace(settings, action="reset"))
    if settings.action in ("insert", "reset", "full_load"):
        plain = loads.fit(fresh.drop(_ORDER).select(*[(F.col(c) if c == key else F.col(f"{c}.value")).alias(c) for c in fresh.columns if c != _ORDER]), table.read())
        loaded = table.append(plain, tag) if settings.action == "insert" else table.write(plain, tag)
        return Loaded(loaded, seen["_rows"], seen["_rejected"])
    keyed = loads.KeyedTable(spark, place, [key], settings.buckets)
    fields = [c for c in fresh.columns if c not in (key, _ORDER)]

    def lay(stored: DataFrame, new: DataFrame) -> DataFrame:
        """Cells are compared as structs, in which an emptied field is a value as any other."""
        boxed = stored.withColumns({c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("value"))) for c in fields})
        laid = loads.overlay(boxed, new, key, _ORDER, fields, insert_new=settings.action == "upsert")
        return laid.withColumns({c: F.col(f"{c}.value") for c in fields})

    return Loaded(keyed.merge(fresh, lay, tag), seen["_rows"], seen["_rejected"])


def _crm_type(column: ColumnSpec) -> str:
    # Spark types of the describe types that have a converter.
    kinds = {
        "int": "bigint", "integer": "bigint", "long": "bigint", "double": "double", "percent": "double", "currency": "decimal(38,10)",
        "boolean": "boolean", "date": "date", "datetime": "timestamp",
    }
    return kinds.get(column.raw_type.lower(), "string")


def migrate_table(
    rows: DataFrame, spec: TableSpec, root: str, settings: Settings = Settings(), order: str | None = None, target: TableSpec | None = None
) -> DataFrame:
    """``load_table``, returning the target."""
    return load_table(rows, spec, root, settings, order, target).table


def migrate_all(
    spark: SparkSession,
    tables: Mapping[str, tuple[Callable[[], DataFrame], TableSpec]],
    root: str,
    settings: Settings = Settings(),
    names: Iterable[str] = ("*",),
) -> DataFrame:
    """Move the named tables, or all of them, and return one ledger row per table: rows taken from its source, and
    rows with cells that were set aside.

    A table the source does not let us read is skipped; any other failure stops
    the run.
    """
    wanted = list(names)
    chosen = sorted(tables) if wanted == ["*"] else wanted
    ledger = []
    for name in chosen:
        open_rows, spec = tables[name]
        target = target_name(name, settings.source_system, settings.target_system)
        try:
            loaded = load_table(open_rows(), spec, root, settings)
            ledger.append((name, target, "migrated", None, loaded.processed, loaded.rejected))
        except AccessDenied as refused:
            if refused.code not in loads.ACCESS_ERRORS:
                raise
            ledger.append((name, target, "skipped", refused.code, None, None))
    return spark.createDataFrame(
        ledger, "table_name string, target_name string, status string, code string, processed bigint, rejected bigint"
    )


def csv_to_table(
    spark: SparkSession, path: str, declared: Mapping[str, str], root: str, *, append: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Load a CSV, recreating or extending the table; also counts NULLs from bad cells."""
    rows = typed_csv(spark, path, declared)
    table = loads.VersionedTable(spark, root)
    loaded = table.append(rows) if append and table.exists() else table.write(rows)
    return loaded, catalog.profile(loaded)
