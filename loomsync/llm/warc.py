"""WARC archives written from and read as a table of chunks.

A payload is a run of rows (record, chunk number) of at most ``CHUNK`` bytes, so no step after the
scan holds a whole record: the writer sorts and streams chunk rows, the reader gives them
out one by one, each with the digest of the payload up to its end.

Archives are WARC/1.1. Spark's text writer puts a line end after each row, so the block of a
response is an HTTP message in chunked transfer coding, where each chunk ends with just that
line end: rows are chunks, and bytes are as the format wants them. A record that repeats the payload of
another is a revisit, which names it and carries no payload. Files are gzip members that one
task reads line by line; lengths in the headers, not the lines, decide where a record ends.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loomsync.session import shared_dir

CHUNK = 1 << 16
#: Payload bytes aimed at per archive, before compression.
ARCHIVE_BYTES = 1 << 25
_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = _END.join(("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", ""))
_CHUNKED = _HTTP + "Transfer-Encoding: chunked" + 2 * _END
_RECORD = (
    "record string, nth long, type string, uri string, source_id string, refers_to string, declared_bytes long,"
    " declared_digest string, data binary, upto long, digest string, last boolean, intact boolean"
)
#: Rows and bytes of chunks that the reader holds before it gives them out.
_HELD_ROWS, _HELD_BYTES = 1000, 1 << 23


def base32_digest(data: Column) -> Column:
    """SHA-1 in upper-case base 32: each five hex digits are four of its own."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def chunk_table(pages: DataFrame, source_id: str, uri: str, payload: str, chunk: int = CHUNK) -> DataFrame:
    """``record, nth, data`` of every row; the first chunk also has ``source_id, uri, size, digest, same``.

    ``same`` is the SHA-256 of the payload, by which equal payloads are known. A null payload is an empty one,
    which has one empty chunk. ``record`` is unique, also where source ids repeat or are null.
    """
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.monotonically_increasing_id().alias("record"), F.col(source_id).alias("source_id"), F.col(uri).cast("string").alias("uri"), data.alias("payload"))
    rows = rows.withColumns({"size": F.length("payload").cast("long"), "digest": base32_digest(F.col("payload")), "same": F.unhex(F.sha2("payload", 256))})
    last = F.greatest((F.col("size") - 1).cast("long"), F.lit(0).cast("long"))
    numbered = rows.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / chunk).cast("long"))))
    first = [F.when(F.col("nth") == 0, F.col(c)).alias(c) for c in ("source_id", "uri", "size", "digest", "same")]
    at = (F.col("nth") * chunk + 1).cast("int")
    table = numbered.select("record", "nth", F.substring("payload", at, F.lit(chunk)).alias("data"), *first)
    path = f"{shared_dir(pages.sparkSession).rstrip('/')}/chunks-{uuid.uuid4().hex}"
    table.write.option("compression", "zstd").parquet(path)
    return pages.sparkSession.read.schema(table.schema).parquet(path)


def decide(records: DataFrame, least: int) -> DataFrame:
    """``record``, ``whole`` (its size) and ``refers_to``, ``first_id``: of equal payloads of at least ``least`` bytes the record with the largest
    source id (null: smallest; of equals the last row) stays, the rest refer to it; null where a record stays."""
    groups = records.where(F.col("size") >= least).groupBy("same", "size").agg(F.max(F.struct("source_id", "record")).alias("kept"), F.count(F.lit(1)).alias("copies"))
    kept = groups.where("copies > 1").select("same", "size", "kept")
    joined = records.join(kept, ["same", "size"], "left")
    repeats = F.col("kept").isNotNull() & (F.col("kept.record") != F.col("record"))
    return joined.select("record", F.col("size").alias("whole"), F.when(repeats, F.col("kept.record")).alias("refers_to"), F.when(repeats, F.col("kept.source_id")).alias("first_id"))


def _name(source_id: Column, record: Column) -> Column:
    return F.concat(F.lit("urn:x-record:"), F.coalesce(source_id.cast("string"), F.lit("null")), F.lit(":"), record.cast("string"))


def _hex_size(size: Column) -> Column:
    return F.length(F.hex(size)).cast("long") + size + 2 * len(_END)


def _lines(date: str, chunk: int) -> Column:
    """Bytes of one chunk row in the archive, but for the line end that the text writer adds."""
    size, repeat = F.col("size"), F.col("refers_to").isNotNull()
    rest = size % chunk
    body = F.floor(size / chunk).cast("long") * _hex_size(F.lit(chunk).cast("long")) + F.when(rest > 0, _hex_size(rest)).otherwise(0)
    short = F.concat(F.lit(_HTTP + "Content-Length: "), size.cast("string"), F.lit(2 * _END))
    block = F.when(repeat, F.length(short)).otherwise(body + len(_CHUNKED) + len("0" + 2 * _END)).cast("string")

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(_END))

    fields = [
        F.lit("WARC/1.1" + _END),
        field("WARC-Type", F.when(repeat, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<"), _name(F.col("source_id"), F.col("record")), F.lit(">"))),
        field("WARC-Date", F.lit(date)),
        F.coalesce(field("WARC-Target-URI", F.regexp_replace("uri", r"[\x00-\x20\x7F]", "%20")), F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(repeat, F.concat(field("WARC-Refers-To", F.concat(F.lit("<"), _name(F.col("first_id"), F.col("refers_to")), F.lit(">"))), field("WARC-Profile", F.lit(_PROFILE)))).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", block),
        F.lit(_END),
    ]
    head = F.when(F.col("nth") == 0, F.concat(*fields, F.when(repeat, short).otherwise(_CHUNKED))).otherwise("").cast("binary")
    length = F.length("data")
    part = F.when(repeat | (length == 0), F.lit(b"")).otherwise(F.concat(F.hex(length.cast("long")).cast("binary"), F.lit(_END).cast("binary"), F.col("data")))
    end = F.when(repeat, _END).when(F.col("final") & (length > 0), _END + "0" + 3 * _END).when(F.col("final"), "0" + 3 * _END).otherwise("").cast("binary")
    return F.concat(head, part, end).cast("string")


def write_archives(
    pages: DataFrame, path: str, source_id: str = "page_id", uri: str = "url", payload: str = "html", least: int = 0, date: str = "2000-01-01T00:00:00Z",
    chunk: int = CHUNK, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write a record per row of ``pages`` to new gzip archives in the folder ``path``.

    Null and repeated ids, empty and very long payloads and repeated rows each make a record; white space
    in a URI is escaped, a null one left out. An empty table makes no records. Other columns are not written.
    """
    table = chunk_table(pages, source_id, uri, payload, chunk)
    records = table.where("nth = 0").select("record", "source_id", "uri", "size", "digest", "same")
    total = records.agg(F.sum("size")).first()[0] or 0
    archives = 1 + total // archive_bytes
    # Both sides are dealt alike, so chunks are shuffled once, and all of a record to one archive.
    joined = table.repartition(archives, "record").join(decide(records, least).repartition(archives, "record"), "record")
    dealt = joined.where("nth = 0 or refers_to is null").sortWithinPartitions("record", "nth")
    final = (F.col("nth") + 1) * chunk >= F.col("whole")
    dealt.withColumn("final", final).select(_lines(date, chunk).alias("value")).write.option("lineSep", _END).option("compression", "gzip").text(path)


class _Parser:
    """One archive, line by line. ``feed`` gives the chunk rows that a line completes."""

    def __init__(self, chunk: int, payload: bool) -> None:
        self.chunk, self.payload = chunk, payload
        self.step = self.between
        self.left = 0

    def feed(self, line: bytes) -> list[tuple]:
        return self.step(line)

    def between(self, line: bytes) -> list[tuple]:
        if line.startswith(b"WARC/"):
            self.fields: dict[str, str] = {}
            self.step = self.header
        elif line:
            raise ValueError(f"no record begins with {line[:40]!r}")
        return []

    def header(self, line: bytes) -> list[tuple]:
        if line:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            self.fields[name.strip().lower()] = value.strip()
            return []
        self.left = int(self.fields["content-length"])
        self.http: dict[str, str] = {}
        self.held, self.upto, self.nth = bytearray(), 0, 0
        self.sha = hashlib.sha1(usedforsecurity=False)
        self.coded = self.part = 0
        is_http = self.fields.get("content-type", "").startswith("application/http")
        self.step = self.message if is_http else self.body
        return self.close() if not self.left else []

    def taken(self, line: bytes) -> bytes:
        """The part of a line and its end that belongs to the block."""
        whole = (line + b"\r\n")[: self.left]
        self.left -= len(whole)
        return whole

    def message(self, line: bytes) -> list[tuple]:
        self.taken(line)
        name, mark, value = line.decode("utf-8", "replace").partition(":")
        if mark:
            self.http[name.strip().lower()] = value.strip()
        elif not line:
            self.step = self.size if self.http.get("transfer-encoding", "").lower() == "chunked" else self.body
        return [] if self.left else self.close()

    def size(self, line: bytes) -> list[tuple]:
        self.taken(line)
        if self.coded == 0 and line:
            self.part = int(line.split(b";")[0], 16)
            self.coded = 2 if self.part else 1
            if self.part:
                self.step = self.coded_body
        return [] if self.left else self.close()

    def coded_body(self, line: bytes) -> list[tuple]:
        whole = self.taken(line)
        self.held += whole[: self.part]
        over = len(whole) >= self.part + 2 or (not self.left and len(whole) >= self.part)
        self.part = max(0, self.part - len(whole))
        if over:
            self.coded, self.step = 0, self.size
        return self.full() + ([] if self.left else self.close())

    def body(self, line: bytes) -> list[tuple]:
        self.held += self.taken(line)
        return self.full() + ([] if self.left else self.close())

    def full(self) -> list[tuple]:
        made = []
        while len(self.held) > self.chunk:  # the last chunk is given out when the record ends
            made.append(self.row(bytes(self.held[: self.chunk]), False))
            del self.held[: self.chunk]
        return made

    def close(self) -> list[tuple]:
        self.step = self.between
        return [self.row(bytes(self.held), True)]

    def row(self, data: bytes, last: bool) -> tuple:
        self.sha.update(data)
        self.upto += len(data)
        self.nth += 1
        digest = base64.b32encode(self.sha.digest()).decode()
        name, target = (self.fields.get(f, "").strip("<>") for f in ("warc-record-id", "warc-refers-to"))
        declared = self.fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        revisit = self.fields.get("warc-type") == "revisit"
        size = self.http.get("content-length") if revisit else self.upto if last else None
        intact = None if not last or revisit or declared is None else declared == digest
        return (
            name, self.nth - 1, self.fields.get("warc-type"), self.fields.get("warc-target-uri"), _source_of(name), _source_of(target),
            None if size is None else int(size), declared, data if self.payload else None, self.upto, digest, last, intact,
        )


def _source_of(name: str) -> str | None:
    """The source id in a record name of ours."""
    parts = name.split(":")
    return parts[2] if name.startswith("urn:x-record:") and len(parts) == 4 and parts[2] != "null" else None


def read_archives(spark: SparkSession, path: str, payload: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of all records in the gzip archives of ``path``, in order within a record.

    ``upto`` and ``digest`` (base 32) tell bytes and SHA-1 of the payload up to the end of the chunk; the row with
    ``last`` tells those of the whole payload and, in ``intact``, whether they are as declared. A record without
    payload has one empty chunk. ``declared_bytes`` and ``declared_digest`` of a revisit are those of the payload
    it repeats. Without ``payload`` the bytes are left out. Other archives than ours are read too, where
    they are gzip files; one that ends within a record fails.
    """
    lines = spark.read.option("lineSep", _END).text(path)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    schema = to_arrow_schema(StructType.fromDDL(_RECORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, at, held, size = None, None, [], 0
        for batch in batches:
            for file, start, line in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if file != at:
                    if start:
                        raise ValueError("an archive that is no gzip file was split")
                    _ended(parser)
                    parser, at = _Parser(chunk, payload), file
                for row in parser.feed(line):
                    held.append(row)
                    size += len(row[8] or b"")
                if len(held) >= _HELD_ROWS or size >= _HELD_BYTES:
                    yield _batch(held, schema)
                    held, size = [], 0
        _ended(parser)
        if held:
            yield _batch(held, schema)

    return lines.mapInArrow(run, _RECORD)


def _ended(parser: _Parser | None) -> None:
    if parser is not None and parser.step != parser.between:
        raise ValueError("an archive ends within a record")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def records(chunks: DataFrame) -> DataFrame:
    """A row per record of chunk rows: what it is, and bytes and digest of its payload."""
    revisit = F.col("type") == "revisit"
    return chunks.where("last").select(
        F.col("source_id").cast("long").alias("page_id"),
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("upto")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )
