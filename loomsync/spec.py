"""Table descriptions and the canonical types shared by every system."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomsync.functions.cells import canonical_name

# Canonical type names and the Spark type each one becomes.
SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "datetime": T.TimestampNTZType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "byte": T.BinaryType(),
    "bytearray": T.BinaryType(),
    "json": T.StringType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    raw_type: str = "VARCHAR2"
    canonical: str = "string"
    is_primary_key: bool = False
    is_unique: bool = False
    is_nullable: bool = True
    is_read_only: bool = False
    is_computed: bool = False
    is_indexed: bool = False
    is_external_id: bool = False
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    ordinal: int = 0
    force_type: str | None = None

    @property
    def target_name(self) -> str:
        return canonical_name(self.name)

    @property
    def spark_type(self) -> T.DataType:
        if self.canonical == "float" and self.precision is not None and self.scale is not None:
            return T.DecimalType(self.precision, self.scale)
        return SPARK_TYPES[self.canonical]


@dataclass(frozen=True)
class TableSpec:
    name: str
    system: str = "oracle"
    environment: str = "dev"
    namespace: str | None = None
    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)

    @property
    def primary_key(self) -> list[str]:
        return [c.target_name for c in self.columns if c.is_primary_key]

    @property
    def writable(self) -> list[str]:
        return [c.name for c in self.columns if not c.is_read_only and not c.is_computed]

    def with_columns(self, columns) -> TableSpec:
        return replace(self, columns=tuple(columns))

    def schema(self) -> T.StructType:
        """Spark schema carrying each column's description as field metadata."""
        fields = []
        for c in self.columns:
            notes = {"raw_type": c.raw_type, "canonical": c.canonical, "primary_key": c.is_primary_key}
            if c.max_length is not None:
                notes["max_length"] = c.max_length
            fields.append(T.StructField(c.target_name, c.spark_type, True, notes))
        return T.StructType(fields)


def _describe(name: str, kind: T.DataType) -> tuple[str, str, int | None, int | None]:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "NUMBER", "integer", None, 0
    if isinstance(kind, T.DecimalType):
        return "NUMBER", "integer" if kind.scale == 0 else "float", kind.precision, kind.scale
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "NUMBER", "float", None, None
    if isinstance(kind, T.BooleanType):
        return "VARCHAR2", "boolean", None, None
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP", "datetime", None, None
    if isinstance(kind, T.DateType):
        return "DATE", "date", None, None
    if isinstance(kind, T.BinaryType):
        return "BLOB", "byte", None, None
    if isinstance(kind, T.StringType):
        return "VARCHAR2", "string", None, None
    return "JSON", "json", None, None


def spec_of(df: DataFrame, name: str, *, system: str = "oracle", key: tuple[str, ...] = ()) -> TableSpec:
    """Describe a DataFrame as a table."""
    columns = []
    for position, f in enumerate(df.schema.fields):
        raw, canonical, precision, scale = _describe(f.name, f.dataType)
        columns.append(
            ColumnSpec(
                name=f.name,
                raw_type=raw,
                canonical=canonical,
                precision=precision,
                scale=scale,
                is_nullable=f.nullable,
                is_primary_key=f.name in key,
                max_length=f.metadata.get("max_length"),
                ordinal=position,
            )
        )
    return TableSpec(name=name, system=system, columns=tuple(columns))
