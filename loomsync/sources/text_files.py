"""CSV and JSON files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from loomsync.functions.cells import canonical_name
from loomsync.functions.names import strip_nul

# Dialect names and their characters.
DELIMITERS = {"BACKQUOTE": "`", "CARET": "^", "COMMA": ",", "PIPE": "|", "SEMICOLON": ";", "TAB": "\t"}
LINE_ENDINGS = {"LF": "\n", "CRLF": "\r\n"}
MAX_FILE_BYTES = 99 * 1024 * 1024


def write_csv(rows: DataFrame, path: str, delimiter: str = "COMMA", line_ending: str = "LF") -> None:
    """Quoted only where needed, quotes doubled, header on, NULL as nothing."""
    rows.write.csv(
        path,
        sep=DELIMITERS[delimiter],
        lineSep=LINE_ENDINGS[line_ending],
        header=True,
        quote='"',
        escape='"',
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(
    spark: SparkSession, path: str, delimiter: str = "COMMA", columns: list[str] | None = None, *, whole_files: bool = False
) -> DataFrame:
    """Every column as text, NUL characters removed, nothing inferred.

    Columns go by the header: a file whose header has other names or another order than
    ``columns`` (or the first file) fails. Quoted fields may hold line ends. A file is read by as many tasks as
    it has splits, for which fields with quotes must be quoted, as every writer of minimal quoting does;
    ``whole_files`` reads each file by one task and takes bare quotes inside a field as well.
    """
    sep = DELIMITERS[delimiter]
    if whole_files:
        reader = spark.read
        if columns:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        raw = reader.csv(path, sep=sep, header=True, multiLine=True, enforceSchema=False, **_OPTIONS)
    else:
        # The header alone is read for this.
        names = columns or spark.read.csv(path, sep=sep, header=True, multiLine=True, **_OPTIONS).columns
        raw = _parsed(csv_records(spark, path), names, sep)
    return raw.select(*[strip_nul(F.col(f"`{c}`")).alias(c) for c in raw.columns])


def _parsed(records: DataFrame, names: list[str], sep: str) -> DataFrame:
    """Fields of the records; each file's first one must be the header."""
    fields = [f"_c{i}" for i in range(len(names))]
    schema = ", ".join(f"{f} string" for f in [*fields, "_more"])
    options = {**_OPTIONS, "sep": sep, "multiLine": "true", "mode": "PERMISSIVE"}
    row = F.from_csv("record", schema, options)
    found = F.array(*[F.coalesce(F.col(f"row.{f}"), F.lit("")) for f in [*fields, "_more"]])
    wanted = F.array(*[F.lit(n) for n in [*names, ""]])
    wrong = F.raise_error(F.concat(F.lit("the header of a CSV file is "), F.array_join(found, sep), F.lit(f", not {sep.join(names)}")))
    is_row = F.when(F.col("is_first"), F.when(found == wanted, F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(True)
    return records.withColumn("row", row).filter(is_row).select(*[F.col(f"row.{f}").alias(n) for f, n in zip(fields, names, strict=True)])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record, is_first`` (of its file) of quoted CSV files, each read by several tasks.

    A line end is part of a record while the number of quotes before it is odd. Each split counts its lines
    with an odd number of quotes; running sums over a file's splits, one row each, tell whether a split begins inside a
    quoted field and which split holds the beginning of that record. So every task cuts its own lines, and
    only the pieces at the edges of splits, two per split at most, are brought together.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    splits = lines.groupBy("file", "start").agg(F.count_if(odd).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    placed = splits.withColumn("inside", inside)
    opens = ((F.col("odd") % 2 == 1) != F.col("inside")) & (~F.col("inside") | (F.col("odd") > 0))
    owner = F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before)
    # Splits that begin inside a field; all others are left out.
    cut = {(r["file"], r["start"]): r["owner"] for r in placed.withColumn("owner", owner).filter("inside").collect()}
    known = spark.sparkContext.broadcast(cut)
    schema = T.StructType.fromDDL("file long, owner long, start long, is_whole boolean, is_first boolean, record string")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: list[str] = []
        is_odd, owned, first = False, 0, False
        out: list[tuple] = []

        def close(whole: bool) -> None:
            nonlocal owned, first
            text = "\n".join(held)
            if text not in ("", "\r"):  # blank lines are no records
                out.append((at[0], owned, at[1], whole, first, text))
                first = False
            held.clear()
            owned = at[1]

        for batch in batches:
            for file, start, line in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")), strict=True):
                if (file, start) != at:
                    if at is not None:
                        close(False)
                    at, first = (file, start), start == 0
                    is_odd, owned = at in known.value, known.value.get(at, start)
                held.append(line)
                if line.count('"') % 2:
                    is_odd = not is_odd
                if not is_odd:
                    close(owned == start)
            yield _arrow(out, schema)
            out = []
        if at is not None:
            close(False)
        if out:
            yield _arrow(out, schema)

    found = lines.mapInArrow(gather, schema)
    ordered = F.sort_array(F.collect_list(F.struct("start", "is_first", "record")))
    joined = F.array_join(F.transform(ordered, lambda e: e["record"]), "\n")
    edges = found.filter("not is_whole").groupBy("file", "owner").agg(joined.alias("record"), F.bool_or("is_first").alias("is_first"))
    both = found.filter("is_whole").select("record", "is_first").unionByName(edges.select("record", "is_first"))
    # A writer of CRLF files writes line ends in fields alike.
    plain = F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))
    return both.withColumn("record", F.when(F.endswith("record", F.lit("\r")), plain).otherwise(F.col("record")))


def _arrow(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def typed_csv(spark: SparkSession, path: str, declared: Mapping[str, str]) -> DataFrame:
    """CSV cast by declared target types, under canonical names.

    A missing column fails; a cell that does not parse is NULL.
    """
    raw = read_csv(spark, path)
    missing = [name for name in declared if name not in raw.columns]
    if missing:
        raise ValueError(f"CSV is missing expected columns: {', '.join(missing)}")
    picked = []
    for name, kind in declared.items():
        cell = F.col(f"`{name}`")
        if kind.startswith("NUMBER"):
            cell = F.when(cell.rlike(r"^[+-]?\d+\z"), cell.try_cast("bigint"))
        elif kind == "DATE":
            cell = F.when(cell.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), cell.try_cast("date"))
        picked.append(cell.alias(canonical_name(name)))
    return raw.select(*picked)


def union_header(frames: list[DataFrame]) -> DataFrame:
    """Rows with different columns under one header, in order of appearance."""
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame, allowMissingColumns=True)
    return rows


def _records(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("records").alias("r")).select("r.*").drop("attributes")


def json_pages(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Records of result pages, one page per file, without their attributes envelope."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return _records(reader.json(path, multiLine=True))


def json_page_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The same for files with one page per line, which can be split between tasks."""
    return _records(spark.read.schema(schema).json(path))


def csv_bytes(rows: DataFrame, delimiter: str = "COMMA", line_ending: str = "LF") -> Column:
    """Bytes of a row as a CSV line: cells, the quotes they need, separators and the line end."""
    special = [DELIMITERS[delimiter], '"', "\n", "\r"]
    size = F.lit(len(rows.columns) - 1 + len(LINE_ENDINGS[line_ending]))
    for name in rows.columns:
        text = F.col(f"`{name}`").cast("string")
        quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
        quoted = reduce(Column.__or__, [F.contains(text, F.lit(c)) for c in special])
        size = size + F.coalesce(F.octet_length(text) + F.when(quoted, quotes + 2).otherwise(0), F.lit(0))
    return size.cast("bigint")


def chunk_by_bytes(
    rows: DataFrame, order_by: list[str], max_records: int, max_bytes: int = MAX_FILE_BYTES, name: str = "chunk",
    delimiter: str = "COMMA", line_ending: str = "LF", columns: list[str] | None = None,
) -> DataFrame:
    """Chunk label of every row so that no chunk, as a CSV file with a header, exceeds either limit.

    ``columns`` are those to give back, all by default; what is neither among them nor ordered by is measured and left out
    before rows are moved.

    Rows are range-partitioned by a total order and cut greedily inside each
    partition; a partition boundary always starts a chunk. A row longer than a file is a chunk of its own.
    """
    measured = rows.withColumn("_bytes", csv_bytes(rows, delimiter, line_ending))
    header = len(DELIMITERS[delimiter].join(rows.columns).encode()) + len(LINE_ENDINGS[line_ending])
    kept = rows.columns if columns is None else columns
    narrow = measured.select(*[c for c in rows.columns if c in kept or c in order_by], "_bytes")
    ordered = narrow.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    schema = T.StructType([*narrow.schema.fields, T.StructField(name, T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, held_bytes = TaskContext.get().partitionId(), 0, 0, header
        for batch in batches:
            labels = []
            for row_bytes in batch.column("_bytes").to_pylist():
                if held and (held + 1 > max_records or held_bytes + row_bytes > max_bytes):
                    number, held, held_bytes = number + 1, 0, header
                held, held_bytes = held + 1, held_bytes + row_bytes
                labels.append(f"{part}-{number}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string())], names=[*batch.schema.names, name])

    labelled = ordered.mapInArrow(cut, schema)
    return labelled.select(*[f"`{c}`" for c in kept], "_bytes", name)
