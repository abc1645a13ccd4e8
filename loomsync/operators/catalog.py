"""Catalog rows as data: describe, map types, roll up keys, plan schema changes.

Inputs are DataFrames with one row per object, column, key or index, so one job
covers every table of every environment.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsync.functions.names import canonical_identifier
from loomsync.operators.joins import left_join_sparse

MAX_TEXT = 4000
GROWTH = 50

# Objects that are never migrated.
SKIP_NAMES = """
AccountFeed ContactFeed CaseFeed LeadFeed OpportunityFeed UserFeed CollaborationGroupFeed
AccountHistory ContactHistory CaseHistory LeadHistory OpportunityHistory OpportunityFieldHistory
AccountShare CaseShare LeadShare OpportunityShare
ApexClass ApexTrigger ApexLog ApexTestResult AsyncApexJob CronTrigger CronJobDetail
ContentVersion ContentDocument ContentDocumentLink ContentFolderItem IdeaComment
EntityDefinition FieldDefinition FieldPermissions
OauthToken AuthSession SessionPermSetActivation TwoFactorInfo VerificationHistory LoginHistory LoginGeo
StaticResource AuraDefinition AuraDefinitionBundle FlowDefinitionView FlowInterview PlatformEventChannel
PlatformEventChannelMember DataStatistics BackgroundOperation SetupAuditTrail
PermissionSet PermissionSetAssignment GroupMember UserRole UserLicense
""".split()
SKIP_SUFFIXES = ["__History", "__Feed", "__Share", "__Tag", "__ChangeEvent", "__e", "__mdt", "__b"]
SKIP_FIELD_TYPES = ["address", "location", "complexvalue", "base64"]

# Describe type to canonical type.
CRM_TYPES = {
    "string": "id string textarea email phone url encryptedstring picklist multipicklist combobox reference anytype",
    "integer": "int integer long",
    "float": "double currency percent",
    "boolean": "boolean",
    "date": "date",
    "datetime": "datetime",
    "time": "time",
    "byte": "base64",
    "json": "complexvalue address location",
}
# Field-definition type, one name per comma, to canonical type.
FIELD_DEFINITION_TYPES = {
    "string": "id,text,textarea,longtextarea,html,richtextarea,phone,url,email,picklist,multi-select picklist,"
    "combobox,reference,autonumber,encryptedtext,hierarchy,anytype",
    "float": "number,currency,percent,double",
    "integer": "integer,long",
    "boolean": "checkbox,boolean",
    "date": "date",
    "datetime": "date/time,datetime",
    "time": "time",
    "byte": "base64,file",
    "json": "json,address,location",
}
# Constraint type code to text.
CONSTRAINT_TEXT = {
    "C": "CHECK / NOT NULL",
    "P": "PRIMARY KEY",
    "U": "UNIQUE",
    "R": "FOREIGN KEY",
    "V": "VIEW CHECK OPTION",
    "O": "VIEW READ ONLY",
    "F": "REF COLUMN",
    "H": "HASH EXPRESSION",
    "S": "SUPPLEMENTAL LOGGING",
}
KEY_CONSTRAINTS = ["P", "U", "R"]

# System, object, field, forced type, redaction scope.
FIELD_RULES = [
    ("salesforce", "case", "description", "CLOB", "scan"),
    ("salesforce", "contact", "ssn__c", None, "field"),
]
_RULE_SCHEMA = "system string, object_name string, field_name string, force_type string, redact string"


def _truth(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def object_filter(objects: DataFrame) -> DataFrame:
    """Business objects that can be read, sorted by name."""
    readable = _truth("queryable") & _truth("retrieveable") & (_truth("layoutable") | _truth("searchable"))
    name = F.col("name")
    skipped = name.isin(SKIP_NAMES)
    for suffix in SKIP_SUFFIXES:
        skipped = skipped | name.endswith(suffix)
    return objects.filter(readable & ~skipped).orderBy("name")


def describe_columns(describes: DataFrame) -> DataFrame:
    """Nested describe rows (name, fields) to one row per kept field."""
    one = describes.select(F.col("name").alias("table_name"), F.posexplode("fields").alias("ordinal", "f"))
    f = F.col("f")

    def sized(name: str) -> Column:
        return F.nullif(f[name], F.lit(0)).alias({"length": "max_length"}.get(name, name))

    active = F.filter(F.coalesce(f["picklistValues"], F.array()), lambda v: v["active"])
    references = F.coalesce(f["referenceTo"], F.array().cast("array<string>"))
    return one.filter(~F.coalesce(f["type"], F.lit("")).isin(SKIP_FIELD_TYPES)).select(
        "table_name",
        "ordinal",
        f["name"].alias("column_name"),
        f["label"].alias("alias"),
        f["type"].alias("raw_type"),
        crm_canonical(f["type"]).alias("canonical"),
        (f["name"] == "Id").alias("is_primary_key"),
        F.coalesce(f["unique"], F.lit(False)).alias("is_unique"),
        F.coalesce(f["nillable"], F.lit(True)).alias("is_nullable"),
        (~F.coalesce(f["updateable"], F.lit(True))).alias("is_read_only"),
        F.coalesce(f["calculated"], F.lit(False)).alias("is_computed"),
        (F.coalesce(f["idLookup"], F.lit(False)) | F.coalesce(f["externalId"], F.lit(False))).alias("is_indexed"),
        (F.size(references) > 0).alias("is_foreign_key"),
        F.map_from_arrays(references, F.transform(references, lambda _: F.lit("Id"))).alias("foreign_key_mapping"),
        sized("length"),
        sized("precision"),
        sized("scale"),
        F.transform(active, lambda v: v["value"]).alias("enum_values"),
    )


def _decode(key: Column, names_by_type: dict[str, list[str]]) -> Column:
    chain = F
    for canonical, names in names_by_type.items():
        if canonical != "string":
            chain = chain.when(key.isin(names), canonical)
    return chain.otherwise(F.lit("string"))


def crm_canonical(raw: Column) -> Column:
    """Describe type to canonical type; an unknown type is text."""
    return _decode(F.lower(raw), {k: v.split() for k, v in CRM_TYPES.items()})


def definition_canonical(raw: Column) -> Column:
    """Field-definition type, its bracketed part removed, to canonical type."""
    bare = F.lower(F.trim(F.regexp_replace(raw, r"\(.*\)", "")))
    return _decode(bare, {k: v.split(",") for k, v in FIELD_DEFINITION_TYPES.items()})


def relational_canonical(raw: Column, scale: Column) -> Column:
    upper = F.upper(raw)
    return (
        F.when((upper == "NUMBER") & scale.eqNullSafe(F.lit(0)), "integer")
        .when(upper.isin("NUMBER", "FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE"), "float")
        .when(upper.contains("TIMESTAMP"), "datetime")
        .when(upper == "DATE", "date")
        .when(upper.isin("BLOB", "RAW", "LONG RAW", "BFILE"), "byte")
        .when(upper == "JSON", "json")
        .otherwise("string")
    )


def target_type(
    canonical: Column,
    length: Column,
    precision: Column,
    scale: Column,
    forced: Column | None = None,
    zoned: Column | None = None,
) -> Column:
    """Target type text; a forced type wins."""
    forced = F.lit(None).cast("string") if forced is None else forced
    zoned = F.lit(False) if zoned is None else F.coalesce(zoned, F.lit(False))
    sized = F.format_string("NUMBER(%s, %s)", precision.cast("string"), scale.cast("string"))
    text = F.format_string("VARCHAR2(%s CHAR)", length.cast("string"))
    return (
        F.when(forced.isNotNull(), F.upper(forced))
        .when((canonical == "string") & (length.isNull() | (length > MAX_TEXT)), "CLOB")
        .when(canonical == "string", text)
        .when(canonical == "integer", "NUMBER")
        .when((canonical == "float") & precision.isNotNull() & scale.isNotNull(), sized)
        .when(canonical == "float", "NUMBER")
        .when(canonical == "boolean", "VARCHAR2(1 CHAR)")
        .when((canonical == "datetime") & zoned, "TIMESTAMP WITH TIME ZONE")
        .when(canonical == "datetime", "TIMESTAMP")
        .when(canonical == "date", "DATE")
        .when(canonical == "time", "VARCHAR2(15 CHAR)")
        .when(canonical == "byte", "BLOB")
        .when(canonical == "json", "JSON")
        .otherwise("VARCHAR2(255 CHAR)")
    )


def fk_pairs(constraints: DataFrame, cons_columns: DataFrame) -> DataFrame:
    """Foreign key columns beside the columns they refer to, matched by position."""
    of = ["owner", "constraint_name"]
    fk = constraints.filter("constraint_type = 'R'").select(*of, "r_constraint_name")
    child = fk.join(cons_columns, of).select(
        "owner", "constraint_name", "r_constraint_name", "table_name", "column_name", "position"
    )
    parents = constraints.select("owner", "constraint_name").join(cons_columns, of)
    parent = parents.select(
        "owner",
        F.col("constraint_name").alias("r_constraint_name"),
        "position",
        F.col("table_name").alias("ref_table"),
        F.col("column_name").alias("ref_column"),
    )
    return child.join(parent, ["owner", "r_constraint_name", "position"]).select(
        "owner", "table_name", "column_name", "ref_table", "ref_column"
    )


def key_rollup(
    columns: DataFrame, constraints: DataFrame, cons_columns: DataFrame, indexes: DataFrame, index_columns: DataFrame
) -> DataFrame:
    """Columns with what keys and indexes say about them."""
    at = ["owner", "table_name", "column_name"]
    pk = (
        constraints.filter("constraint_type = 'P'")
        .select("owner", "constraint_name")
        .join(cons_columns, ["owner", "constraint_name"])
        .groupBy(*at)
        .agg(F.lit(True).alias("is_primary_key"))
    )
    # One entry per referenced table; of several columns for one table the last name stays.
    fk = (
        fk_pairs(constraints, cons_columns)
        .groupBy(*at, "ref_table")
        .agg(F.max("ref_column").alias("ref_column"))
        .groupBy(*at)
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("ref_table", "ref_column")))).alias("fk_map"))
    )
    usable = indexes.filter("index_type <> 'LOB' AND generated = 'N'").select("owner", "index_name", "uniqueness")
    idx = (
        usable.join(index_columns, ["owner", "index_name"])
        .groupBy(*at)
        .agg(F.bool_or(F.col("uniqueness") == "UNIQUE").alias("is_unique"))
        .withColumn("is_indexed", F.lit(True))
    )
    return (
        columns.join(pk, at, "left")
        .join(fk, at, "left")
        .join(idx, at, "left")
        .withColumns({c: _truth(c) for c in ("is_primary_key", "is_unique", "is_indexed")})
        .withColumn("is_foreign_key", F.col("fk_map").isNotNull())
    )


def _same(column: str, wanted: str) -> Column:
    return F.upper(F.col(column)) == wanted.upper()


def constraint_listing(
    constraints: DataFrame,
    cons_columns: DataFrame,
    *,
    owner: str = "",
    table_name: str = "",
    constraint_type: str = "*",
    column_name: str | None = None,
) -> DataFrame:
    """Constraints with type text and referenced columns; filters ignore case."""
    con = constraints
    con = con.filter(_same("owner", owner)) if owner else con
    con = con.filter(_same("table_name", table_name)) if table_name else con
    con = con.filter(_same("constraint_type", constraint_type)) if constraint_type != "*" else con
    col = cons_columns.select("owner", "constraint_name", "column_name", "position")
    col = col.filter(_same("column_name", column_name)) if column_name else col
    ref = cons_columns.select(
        F.col("owner").alias("r_owner"),
        F.col("constraint_name").alias("r_constraint_name"),
        "position",
        F.col("table_name").alias("r_table"),
        F.col("column_name").alias("r_column"),
    )
    text = F
    for code, words in CONSTRAINT_TEXT.items():
        text = text.when(F.col("constraint_type") == code, words)
    text = text.otherwise(F.concat(F.lit("UNKNOWN ("), F.col("constraint_type"), F.lit(")")))
    return (
        left_join_sparse(
            con.join(col, ["owner", "constraint_name"]), ref, ["r_owner", "r_constraint_name", "position"],
            ["owner", "constraint_name", "column_name"],
        )
        .withColumn("constraint_type_desc", text)
    )


def composite_keys(constraints: DataFrame, cons_columns: DataFrame) -> DataFrame:
    """Per constraint its columns in order and whether there are several."""
    of = ["owner", "constraint_name"]
    ordered = F.sort_array(F.collect_list(F.struct("position", "column_name")))
    keys = constraints.select(*of, "table_name", "constraint_type", "r_owner", "r_constraint_name")
    return (
        keys.join(cons_columns.select(*of, "column_name", "position"), of)
        .groupBy(*keys.columns)
        .agg(
            F.array_join(F.transform(ordered, lambda e: e["column_name"]), " ").alias("column_names"),
            F.when(F.count("column_name") > 1, "YES").otherwise("NO").alias("is_composite"),
        )
    )


def distinct_names(columns: DataFrame, *names: str) -> DataFrame:
    return columns.select(*names).distinct().orderBy(*names)


def object_exists(objects: DataFrame, name: str, owner: str | None = None, kind: str | None = None) -> DataFrame:
    """One row telling whether the object is there, ignoring case."""
    found = objects.filter(_same("object_name", name))
    found = found.filter(_same("owner", owner)) if owner else found
    found = found.filter(_same("object_type", kind)) if kind else found
    return found.agg((F.count("object_name") > 0).alias("found"))


def immutable_constraints(constraints: DataFrame) -> DataFrame:
    """Primary, unique and foreign keys, which schema changes must leave alone."""
    return constraints.filter(F.upper(F.coalesce("constraint_type", F.lit(""))).isin(KEY_CONSTRAINTS))


def bare_type(raw: Column) -> Column:
    """Catalog type without its bracketed number."""
    text = F.coalesce(raw, F.lit(""))
    plain = F.when(F.contains(text, F.lit("(")), F.regexp_replace(text, r"\(\s*\d+\s*\)", "")).otherwise(text)
    return F.upper(F.trim(plain))


def _of_table(one: DataFrame, other: DataFrame) -> list[str]:
    """Columns that name a table on both sides."""
    return ["owner", "table_name"] if "owner" in one.columns and "owner" in other.columns else ["table_name"]


def schema_drift(desired: DataFrame, actual: DataFrame, *, enforce: bool = True) -> DataFrame:
    """Changes that make the actual columns fit the desired ones.

    Tables of one name and different owners are different tables, where both sides name an owner.
    ``enforce`` is off for sources whose NOT NULL cannot be trusted.
    """
    of = _of_table(desired, actual)
    now = actual.select(
        *of,
        "column_name",
        F.col("data_type").alias("_type"),
        F.coalesce("char_length", "data_length", F.lit(0)).alias("_length"),
        (F.coalesce("nullable", F.lit("Y")) == "Y").alias("_nullable"),
        F.lit(True).alias("_there"),
    )
    both = desired.join(now, [*of, "column_name"], "left")
    is_flag = F.col("canonical") == "boolean"
    text = (F.col("raw_type") == "VARCHAR2") & (F.upper("_type") == "VARCHAR2")
    required = F.when(is_flag, 1).otherwise(F.coalesce("max_length", F.lit(0)))
    grown = F.when(is_flag, 1).otherwise(F.least(required + GROWTH, F.lit(MAX_TEXT)))

    def action(name: str, detail: Column) -> Column:
        return F.struct(F.lit(name).alias("action"), detail.cast("string").alias("detail"))

    nothing = F.lit(None).cast("string")
    there = F.col("_there").isNotNull()
    retype = ~F.coalesce(text, F.lit(False)) & (F.upper("raw_type") != bare_type(F.col("_type")))
    null_moves = F.col("is_nullable") != F.col("_nullable")
    steps = [
        F.when(~there, action("ADD", F.col("raw_type"))),
        F.when(there & text & (required > F.col("_length")), action("WIDEN", grown)),
        F.when(there & retype, action("MODIFY TYPE", F.col("raw_type"))),
        F.when(there & null_moves & F.col("is_nullable"), action("NULL", nothing)),
        F.when(there & null_moves & ~F.col("is_nullable") & F.lit(enforce), action("NOT NULL", nothing)),
    ]
    # As columns first, which compiled code fills; inside the array everything would be interpreted row by row.
    tried = both.select(*of, "column_name", *[step.alias(f"_step{k}") for k, step in enumerate(steps)])
    return tried.select(*of, "column_name", F.inline(F.array_compact(F.array(*[f"_step{k}" for k in range(len(steps))]))))


def measures(df: DataFrame) -> dict[str, Column]:
    """Aggregates that tell the longest text and the NULL count of every column."""
    found = {}
    for name, kind in df.dtypes:
        cell = F.col(f"`{name}`")
        longest = F.max(F.length(cell)) if kind == "string" else F.max(F.lit(None).cast("int"))
        found[f"{name}_chars"] = longest.cast("int")
        found[f"{name}_nulls"] = F.count_if(cell.isNull())
    return found


def profile(df: DataFrame) -> DataFrame:
    """Longest text and NULL count of every column, in one pass over the data."""
    wide = df.agg(F.count("*").alias("_rows"), *[value.alias(name) for name, value in measures(df).items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"`{name}_chars`").alias("max_chars"),
                F.col(f"`{name}_nulls`").alias("nulls"),
            )
            for name in df.columns
        ]
    )
    return wide.select(F.inline(rows))


def overflow_plan(profiled: DataFrame, declared: DataFrame) -> DataFrame:
    """What must change so that the profiled data fits the declared columns.

    ``declared`` has column_name, raw_type, max_length, is_nullable, is_key (part
    of a key constraint) and is_indexed.
    """
    both = declared.join(profiled, "column_name")
    text = F.col("raw_type") == "VARCHAR2"
    over = text & (F.col("max_chars") > F.col("max_length"))
    too_long = over & (F.col("max_chars") > MAX_TEXT)
    pinned = F.col("is_key") | F.col("is_indexed")
    size = (
        F.when(too_long & pinned, "REFUSED")
        .when(too_long, "PROMOTE")
        .when(over, "WIDEN")
        .otherwise("NONE")
    )
    width = F.when(over & ~too_long, F.least(F.col("max_chars") + GROWTH, F.lit(MAX_TEXT)))
    relax = ~F.col("is_nullable") & (F.col("nulls") > 0)
    return both.select("column_name", size.alias("size_action"), width.alias("new_length"), relax.alias("relax_null"))


def rename_map(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target columns with one canonical identifier; the last target wins.

    Where both sides name an owner, it is part of the table's name.
    """
    of = _of_table(source, target)
    canon = canonical_identifier(F.col("column_name"))
    # A name without an identifier meets nothing: its key differs between the sides and is no identifier. A key that
    # may be NULL would be tested below whatever the columns come from, identifiers worked out there a second time.
    by_canon = (
        target.select(*of, F.coalesce(canon, F.lit(" ")).alias("_canon"), "column_name", "ordinal")
        .groupBy(*of, "_canon")
        .agg(F.max_by("column_name", "ordinal").alias("target_column"))
    )
    named = source.select(*of, F.coalesce(canon, F.lit("")).alias("_canon"), F.col("column_name").alias("source_column"))
    return named.join(by_canon, [*of, "_canon"]).select(*of, "source_column", "target_column")


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def rules_frame(spark: SparkSession, rules: Iterable[tuple] = FIELD_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), _RULE_SCHEMA)


def force_type_rules(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns with the type a rule forces; a forced LOB has no length."""
    keyed = rules.filter("force_type IS NOT NULL").select(
        F.col("system").alias("_s"), F.col("object_name").alias("_o"), F.col("field_name").alias("_f"), "force_type"
    )
    hit = (
        (columns["system"] == F.col("_s"))
        & (F.lower(F.trim(columns["object_name"])) == F.col("_o"))
        & (F.lower(F.trim(columns["field_name"])) == F.col("_f"))
    )
    joined = columns.join(keyed, hit, "left").drop("_s", "_o", "_f")
    lob = F.upper("force_type").isin("CLOB", "NCLOB", "BLOB")
    return joined.withColumn("max_length", F.when(~F.coalesce(lob, F.lit(False)), F.col("max_length")))


def redaction_plan(system: str, object_name: str, fields: Iterable[str], rules: Iterable[tuple] = FIELD_RULES) -> dict:
    """Field to scope for one object, under the names the source uses."""
    scopes = {(s, o, f): scope for s, o, f, _, scope in rules if scope}
    at = (system, object_name.strip().lower())
    return {f: scopes[(*at, f.strip().lower())] for f in fields if (*at, f.strip().lower()) in scopes}
