"""Typed cell expressions: text to typed, typed to text, and target coercion.

Bad input never fails a job: the typed column is NULL and the row carries the
raw text in a rejects array, so nothing is lost.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsync.functions.names import RESERVED_WORDS, strip_nul, strip_whitespace

REJECTS = "_rejects"
_NO_REJECTS = "array<struct<field:string,raw:string>>"
_DIGITS = r"^([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\z"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
_POWER = r"^[+-]?(\d+\.?\d*|\.\d+)[eE]"


def present(text: Column) -> Column:
    """Empty text is the same as no value."""
    return F.nullif(text, F.lit(""))


def to_bool(text: Column) -> Column:
    """True only for the word true; any other non-empty text is false."""
    return F.lower(present(text)) == "true"


def to_int(text: Column) -> Column:
    digits = F.replace(strip_whitespace(text), F.lit("_"), F.lit(""))
    return F.when(text.rlike(r"^\s*[+-]?\d+(_\d+)*\s*\z"), digits.try_cast("bigint"))


def to_double(text: Column) -> Column:
    number = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*\z"
    special = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*\z"
    return F.when(text.rlike(number) | text.rlike(special), strip_whitespace(text).try_cast("double"))


def _canonical_digits(number: Column) -> Column:
    """Sign, significant digits and place of the point of a number's text; NULL if it is none."""
    sign, whole, part, power = (F.regexp_extract(number, _DIGITS, i) for i in (1, 2, 3, 4))
    digits = F.concat(whole, part)
    led = F.regexp_replace(digits, r"^0+", "")
    point = F.length(whole) + F.when(power == "", 0).otherwise(power.try_cast("int")) - F.length(digits) + F.length(led)
    found = F.concat(F.when(sign == "-", "-").otherwise(""), F.regexp_replace(led, r"0+\z", ""), F.lit("e"), point.cast("string"))
    return F.when(number.rlike(_DIGITS) & (digits != ""), F.when(led == "", "0").otherwise(found))


def _fits(precision: int, scale: int) -> str:
    """Pattern of the plain numbers that a decimal of this size holds digit by digit."""
    return rf"^[+-]?(?=\.?\d)0*\d{{0,{precision - scale}}}(\.\d{{0,{scale}}}0*)?\z"


def _exact_text(number: Column, kind: str) -> Column:
    """A number's text as the decimal ``kind``, NULL if that would change its value.

    Only text with an exponent needs its digits moved before they can be compared; that part is kept
    apart in a lambda, so that the text is worked out once and the rest of the row stays small code.
    """
    precision, scale = map(int, re.findall(r"\d+", kind))

    def moved(text: Column) -> Column:
        value = text.try_cast(kind)
        return F.when(_canonical_digits(text) == _canonical_digits(value.cast("string")), value)

    plain = F.when(number.rlike(_fits(precision, scale)), number.try_cast(kind))
    return plain.when(number.rlike(_POWER), F.get(F.transform(F.array(number), moved), F.lit(0)))


def _exact(number: Column, source: str, kind: str) -> Column:
    """A number of the type ``source`` as ``kind``, NULL if the way there and back changes it."""
    value = number.try_cast(kind)
    return F.when(value.try_cast(source) == number, value)


def to_decimal_plain(text: Column) -> Column:
    """A decimal. A number it cannot hold digit by digit is NULL, not rounded."""
    return _exact_text(strip_whitespace(present(text)), "decimal(38,10)")


def to_date_iso(text: Column) -> Column:
    dashed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text)
    compact = F.when(text.rlike(r"^\d{8}\z"), F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})\z", "$1-$2-$3"))
    return F.coalesce(dashed, compact).try_cast("date")


def to_datetime_iso(text: Column) -> Column:
    """ISO text to an instant. Text without an offset is read in the session zone."""
    zoned = F.regexp_replace(text, r"Z\z", "+00:00")
    zoned = F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})\z", "$1:$2")
    zoned = F.when(text.rlike(r"T.*([+-]\d{4}|Z)\z"), zoned).otherwise(text)
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([+-]\d{2}:\d{2})?)?\z"
    return F.when(zoned.rlike(shape), F.replace(zoned, F.lit(","), F.lit(".")).try_cast("timestamp"))


def to_time(text: Column) -> Column:
    """ISO time kept as text, without the zone letter."""
    bare = F.regexp_replace(text, r"Z\z", "")
    return F.when(bare.rlike(r"^([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d{1,9})?)?)?\z"), bare)


# Describe types that have a converter; the rest stay text.
CONVERTERS = {
    "int": to_int,
    "integer": to_int,
    "long": to_int,
    "double": to_double,
    "currency": to_decimal_plain,
    "percent": to_double,
    "boolean": to_bool,
    "date": to_date_iso,
    "datetime": to_datetime_iso,
    "time": to_time,
}


def _with_rejects(df: DataFrame, cells: list[tuple[str, str, Column, Column | None]]) -> DataFrame:
    """Typed columns and the rejects array, from (source, target, value, checked text).

    Values are made in one projection and judged in the next, so that a costly
    conversion is referred to twice but evaluated once.
    """
    made = [value.alias(f"_v{i}") for i, (_, _, value, _) in enumerate(cells)]
    kept = [text.alias(f"_t{i}") for i, (_, _, _, text) in enumerate(cells) if text is not None]
    raws = [F.col(f"`{source}`").cast("string").alias(f"_r{i}") for i, (source, _, _, text) in enumerate(cells) if text is not None]
    wide = df.select(*made, *kept, *raws)
    failures = [
        F.when(
            F.col(f"_t{i}").isNotNull() & F.col(f"_v{i}").isNull(),
            F.struct(F.lit(target).alias("field"), F.col(f"_r{i}").alias("raw")),
        )
        for i, (_, target, _, text) in enumerate(cells)
        if text is not None
    ]
    found = F.array_compact(F.array(*failures)) if failures else F.array()
    named = [F.col(f"_v{i}").alias(target) for i, (_, target, _, _) in enumerate(cells)]
    return wide.select(*named, found.cast(_NO_REJECTS).alias(REJECTS))


def cast_text_frame(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns by describe type and collect what did not parse."""
    cells = []
    for name in df.columns:
        raw = F.col(f"`{name}`")
        if name not in types:
            cells.append((name, name, raw, None))
            continue
        convert, text = CONVERTERS.get(types[name]), present(raw)
        cells.append((name, name, convert(text) if convert else text, text if convert else None))
    return _with_rejects(df, cells)


def _double_text(value: Column) -> Column:
    """Shortest decimal text: plain from 0.0001 up to 1e16, else with an exponent."""
    size = F.abs(value)
    fixed = F.regexp_replace(value.try_cast("decimal(38,21)").cast("string"), r"0+\z", "")
    fixed = F.when(fixed.endswith("."), F.concat(fixed, F.lit("0"))).otherwise(fixed)
    power = F.regexp_replace(value.cast("string"), r"(\.0)?E(\d)", "e+$2")
    power = F.regexp_replace(power, r"(\.0)?E-", "e-")
    power = F.regexp_replace(power, r"e([+-])(\d)\z", "e$10$2")
    plain = (size == 0) | ((size >= 1e-3) & (size < 1e7)) | F.isnan(value)
    return (
        F.when(plain, value.cast("string"))
        .when((size >= 1e-4) & (size < 1e16), fixed)
        .otherwise(F.regexp_replace(power, r"Infinity", "inf"))
    )


def to_text(value: Column, kind: str) -> Column:
    """Text sent to a CRM target for a value of the given Spark type name."""
    if kind == "boolean":
        text = F.when(value, "true").when(~value, "false")
    elif kind in ("timestamp", "timestamp_ntz"):
        whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(value, "SSSSSS")
        text = F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
        text = F.concat(text, F.date_format(value, "xxx")) if kind == "timestamp" else text
    elif kind in ("struct", "array", "map"):
        text = F.to_json(value)
    elif kind == "double":
        text = _double_text(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def omit_nulls(fields: Mapping[str, Column], clear: Column | None = None, kinds: Mapping[str, str] | None = None) -> Column:
    """JSON object of the fields' texts without NULL keys; names listed in ``clear`` stay as null.

    ``kinds`` names the Spark types of fields that are no text, whose text is that of ``to_text``.
    """
    kinds = kinds or {}

    def text(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), to_text(value, kinds.get(name, "string")))

    kept = F.array(*[F.struct(F.lit(name).alias("key"), text(name, value).alias("value")) for name, value in fields.items()])
    cleared = F.array().cast("array<string>") if clear is None else F.coalesce(clear, F.array().cast("array<string>"))
    chosen = F.filter(kept, lambda e: e["value"].isNotNull() | F.array_contains(cleared, e["key"]))
    blanked = F.transform(
        chosen,
        lambda e: F.struct(
            e["key"].alias("key"), F.when(~F.array_contains(cleared, e["key"]), e["value"]).alias("value")
        ),
    )
    return F.to_json(F.map_from_entries(blanked), {"ignoreNullFields": "false"})


def norm_bool_yn(value: Column, is_text: bool) -> Column:
    """Y or N. Text counts as true when it is not empty, whatever it says."""
    truth = F.length(value) > 0 if is_text else value
    return F.when(truth, "Y").when(~truth, "N")


def yn_to_bool(text: Column) -> Column:
    return F.upper(strip_whitespace(text)) == "Y"


def norm_blank_null(text: Column) -> Column:
    """Text of whitespace only is NULL, judged after NUL characters are gone."""
    clean = strip_nul(text)
    return F.when(clean.rlike(r"(?U)\S"), clean)


def _number_text(text: Column) -> Column:
    return F.replace(strip_whitespace(strip_nul(text)), F.lit(","), F.lit(""))


def norm_number(text: Column, kind: str = "decimal(38,10)") -> Column:
    """Text as ``kind``. A number it cannot hold digit by digit is NULL, not rounded."""
    return _exact_text(_number_text(text), kind)


_NUMERIC = ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _number_type(source: str, column) -> str:
    """Type of a NUMBER column: as declared, else one that holds what the source holds."""
    p, s = column.precision, column.scale
    if p is not None and s is not None and 0 <= s <= p <= 38:
        return f"decimal({p},{s})"
    if source in ("tinyint", "smallint", "int", "bigint"):
        return "decimal(38,10)"  # holds every one of them
    if column.canonical == "integer":
        return "decimal(38,0)"
    return "decimal(38,10)" if source == "string" else "double" if source == "float" else source


def _coerce_number(raw: Column, source: str, column) -> tuple[Column, Column | None]:
    """A NUMBER cell, and the number's text if it may not fit. Text that is no number is NULL and no reject."""
    kind = _number_type(source, column)
    if source == "string":
        number = _number_text(raw)
        return norm_number(raw, kind), F.when(number.rlike(_NUMBER), number)
    if kind in (source, "double"):
        return raw.cast(kind), None
    return _exact(raw, source, kind), raw.cast("string")


def norm_date(text: Column) -> Column:
    """First ten characters as a date."""
    head = F.substring(strip_whitespace(strip_nul(text)), 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), head.try_cast("date"))


def norm_timestamp(text: Column) -> Column:
    """A trailing offset is dropped, not applied. Other zone forms do not parse."""
    bare = F.regexp_replace(strip_whitespace(strip_nul(text)), r"[+-]\d{2}:\d{2}\z", "")
    clock = r"\d{1,2}:\d{1,2}:\d{1,2}"
    shape = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}(T{clock}(\.\d{{1,6}})?| {clock})\z"
    return F.when(bare.rlike(shape), bare.try_cast("timestamp_ntz"))


def norm_text(text: Column) -> Column:
    return F.nullif(strip_whitespace(strip_nul(text)), F.lit(""))


def _coerce(raw: Column, source: str, target: str, canonical: str | None) -> tuple[Column, bool]:
    """Expression for one cell and whether unparsable text is a reject."""
    target = target.upper()
    if source == "boolean" or canonical == "boolean":
        return norm_bool_yn(raw, source == "string"), False
    if source == "date":
        return (raw.cast("timestamp_ntz") if target == "TIMESTAMP" else raw), False
    if source in ("timestamp", "timestamp_ntz", "binary"):
        return raw, False
    if source != "string":
        return raw.cast("string"), False
    if target == "DATE":
        return norm_date(raw), True
    if "TIMESTAMP" in target:
        return norm_timestamp(raw), True
    if target in ("CLOB", "BLOB"):
        return norm_blank_null(raw), False
    return norm_text(raw), False


def normalize_frame(df: DataFrame, spec) -> DataFrame:
    """Coerce every column to its target type under its target name.

    A source column the target does not have fails while the plan is built.
    Date and timestamp text that does not parse goes to the rejects array, and so does every
    number that its column cannot hold unchanged.
    """
    by_name = {c.target_name: c for c in spec.columns}
    cells = []
    for name, kind in df.dtypes:
        key = canonical_name(name)
        if key not in by_name:
            raise KeyError(f"field '{name}' is not a column of '{spec.name}'")
        column = by_name[key]
        raw = F.col(f"`{name}`")
        source = kind.split("(")[0]
        if column.raw_type.upper() == "NUMBER" and column.canonical != "boolean" and source in _NUMERIC:
            value, checked = _coerce_number(raw, kind, column)
            cells.append((name, key, value, checked))
            continue
        value, strict = _coerce(raw, source, column.raw_type, column.canonical)
        cells.append((name, key, value, norm_blank_null(raw) if strict else None))
    return _with_rejects(df, cells)


def canonical_name(name: str) -> str:
    """Canonical form of one schema name, for use while a plan is built."""
    word = re.sub(r"[^A-Za-z0-9_]+", "_", name.strip()).strip("_").upper()
    if not word:
        raise ValueError(f"no identifier can be made from {name!r}")
    word = f"C_{word}" if word[0].isdigit() else word
    word = f"SF_{word}" if word in RESERVED_WORDS else word
    return word if len(word) <= 128 else word[:128].rstrip("_")


def record_json(columns: list[str]) -> Column:
    """Whole row as pretty JSON, NULL fields included, keys in the given order."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false", "pretty": "true"})


def status_class(code: Column) -> Column:
    return (F.floor(code / 100) * 100).cast("int")


def default_on_null(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill NULL cells, and columns that are missing, with their defaults."""
    filled = {
        name: F.coalesce(F.col(name), value) if name in df.columns else value for name, value in defaults.items()
    }
    return df.withColumns(filled)
