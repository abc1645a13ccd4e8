"""Load semantics as DataFrame merges, and the versioned table they write to."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsync.operators.joins import join_unique, latest_per_key
from loomsync.operators.numbering import number_rows

# Access errors that skip a table instead of failing the run.
ACCESS_ERRORS = (
    "INSUFFICIENT_ACCESS",
    "INSUFFICIENT_ACCESS_OR_READONLY",
    "INSUFFICIENT_ACCESS_ON_CROSS_REFERENCE_ENTITY",
    "MALFORMED_QUERY",
)


def insert(target: DataFrame, source: DataFrame, *, drop_key: str | None = None) -> DataFrame:
    """Target followed by the source rows, fitted to the target's columns."""
    rows = source.drop(drop_key) if drop_key else source
    return target.unionByName(fit(rows, target), allowMissingColumns=True)


def fit(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source with exactly the target's columns; absent ones are NULL."""
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"source columns unknown to the target: {', '.join(unknown)}")
    kinds = dict(target.dtypes)
    return source.select(
        *[
            (F.col(c) if c in source.columns else F.lit(None)).cast(kinds[c]).alias(c)
            for c in target.columns
        ]
    )


def reset(target: DataFrame, source: DataFrame) -> DataFrame:
    """Only the source rows, in the target's columns."""
    return fit(source, target)


def full_load(source: DataFrame) -> DataFrame:
    """Only the source, in its own columns; stale target columns are gone."""
    return source


def _keyed(source: DataFrame, keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def _matched(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    insert_new: bool,
    overlay: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Target rewritten from a source that is unique by key and has no NULL key."""
    kinds = dict(target.dtypes)
    changed = [c for c in (columns or source.columns) if c not in keys and c in target.columns]
    new = source.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in changed]
    )
    old = target.withColumn("_old", F.lit(True))
    if insert_new:
        joined = old.join(new, keys, "full")
    else:
        joined = join_unique(old, new, keys, "left")

    def cell(name: str) -> Column:
        if name in keys or name not in changed:
            return F.col(name)
        fresh = F.col(f"_new_{name}").cast(kinds[name])
        if overlay:
            return F.coalesce(fresh, F.col(name)).alias(name)
        return F.when(F.col("_hit"), fresh).otherwise(F.col(name)).alias(name)

    return joined.select(*[cell(c) for c in target.columns])


def merge_unique(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert of a source that has one row per key and no NULL key."""
    return _matched(target, source, keys, insert_new=True)


def update_unique(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Update where both sides have one row per key, so no key can be hot."""
    return _matched(target, source, keys, insert_new=False)


def touched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Only the target rows a source, unique by key, changes, as they are after it."""
    changed = [c for c in source.columns if c not in keys and c in target.columns]
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in changed])
    kinds = dict(target.dtypes)
    cells = [F.col(f"_new_{c}").cast(kinds[c]).alias(c) if c in changed else F.col(c) for c in target.columns]
    return target.join(new, keys).select(*cells)


def _require(keys: list[str]) -> None:
    if not keys:
        raise ValueError("this load needs a key to match on and none is defined")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Matched rows take every source cell, NULLs included; the rest are inserted.

    The highest ``order`` of a key wins. Rows with a NULL key match nothing, so
    each of them is inserted.
    """
    _require(keys)
    keyed = latest_per_key(source.filter(_keyed(source, keys)), keys, order).drop(order)
    loose = source.filter(~_keyed(source, keys)).drop(order)
    whole = target.filter(_keyed(target, keys))
    apart = target.filter(~_keyed(target, keys))
    merged = _matched(whole, keyed, keys, insert_new=True, overlay=False, columns=None)
    return merged.unionByName(apart).unionByName(fit(loose, target))


def update(
    target: DataFrame, source: DataFrame, keys: list[str], order: str | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Matched rows take the source cells; source rows without a match are ignored."""
    _require(keys)
    keyed = source.filter(_keyed(source, keys))
    if order:
        keyed = latest_per_key(keyed, keys, order)
        keyed = keyed if order in target.columns else keyed.drop(order)
    return _matched(target, keyed, keys, insert_new=False, overlay=False, columns=columns)


def external_key(spec) -> str:
    """First external id column, else Id."""
    return next((c.name for c in spec.columns if c.is_external_id), "Id")


def overlay(
    target: DataFrame, source: DataFrame, key: str, order: str, writable: list[str], *, insert_new: bool = True
) -> DataFrame:
    """CRM form: a NULL source cell leaves the target cell alone.

    Only writable columns are sent; the key is kept though it may be read-only.
    Rows of one key apply in order, so for every column the last value that is
    not NULL wins.
    """
    sent = [c for c in source.columns if c in writable and c not in (key, order)]
    known = source.filter(F.col(key).isNotNull())
    last = known.groupBy(key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in sent]
    )
    loose = source.filter(F.col(key).isNull()).select(key, *sent)
    whole, apart = target.filter(F.col(key).isNotNull()), target.filter(F.col(key).isNull())
    merged = _matched(whole, last, [key], insert_new=insert_new, overlay=True, columns=sent).unionByName(apart)
    return merged.unionByName(fit(loose, target)) if insert_new else merged


def delete(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Target without the listed ids; the list must hold the id column only."""
    if [c.lower() for c in ids.columns] != [key.lower()]:
        raise ValueError(f"a delete takes only '{key}', got: {', '.join(ids.columns)}")
    listed = ids.filter(F.col(ids.columns[0]).isNotNull()).distinct()
    return target.join(listed.withColumnRenamed(ids.columns[0], key), key, "left_anti").select(*target.columns)


def load_report(rows: DataFrame, chunk: str, failed: Column) -> DataFrame:
    """Processed, failed and total per chunk, with a last row (NULL chunk) for the load."""
    per_chunk = rows.groupBy(chunk).agg(F.count("*").alias("total"), F.count_if(failed).alias("failed"))
    whole = per_chunk.agg(
        F.lit(None).cast("bigint").alias(chunk),
        F.sum("total").alias("total"),
        F.sum("failed").alias("failed"),
    )
    both = per_chunk.select(F.col(chunk).cast("bigint").alias(chunk), "total", "failed").unionByName(whole)
    return both.select(chunk, (F.col("total") - F.col("failed")).alias("processed"), "failed", "total")


def split_results(rows: DataFrame, state: str) -> dict[str, DataFrame]:
    """Successful, failed and unprocessed rows."""
    return {
        name: rows.filter(F.col(state) == name) if name != "unprocessed" else rows.filter(F.col(state).isNull())
        for name in ("successful", "failed", "unprocessed")
    }


class VersionedTable:
    """Parquet folders behind a pointer file, replaced or extended as a whole.

    Rows are written to a folder of their own and become current only when the
    next pointer, which lists the current folders, is put in place. A reader or
    a failed job never sees half a table, and a table may be rewritten from
    itself.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path(".").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path("_pointers")
        if not fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())

    def _folders(self, number: int) -> list[str]:
        # A pointer is a short text file with one folder name per line.
        return [r["value"] for r in self.spark.read.text(f"{self.root}/_pointers/{number:012d}").collect()]

    def _latest(self) -> tuple[int, list[str]]:
        numbers = self._numbers()
        return (numbers[-1], self._folders(numbers[-1])) if numbers else (0, [])

    def exists(self) -> bool:
        return bool(self._numbers())

    def folders(self) -> list[str]:
        return self._latest()[1]

    def holds(self, tag: str) -> bool:
        """True when the tagged rows are part of the table."""
        return tag in self._latest()[1]

    def _open(self, folders: list[str]) -> DataFrame:
        if not folders:
            raise FileNotFoundError(f"{self.root} holds no data")
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._open(self._latest()[1])

    def read_before(self, tag: str) -> DataFrame:
        """The table as it was before ``tag``, or as it is when the tag is not current."""
        number, folders = self._latest()
        return self._open(self._folders(number - 1) if tag in folders else folders)

    def _publish(self, df: DataFrame, keep_old: bool, tag: str | None, options: dict) -> DataFrame:
        number, folders = self._latest()
        name = tag or f"v{uuid.uuid4().hex}"
        if name not in folders:
            df.write.mode("overwrite").options(**options).parquet(f"{self.root}/{name}")
            return self._point(number, [*folders, name] if keep_old else [name])
        return self.read()

    def _point(self, number: int, folders: list[str]) -> DataFrame:
        """Make ``folders`` the table, unless it has changed since pointer ``number``."""
        draft = self._path(f"_drafts/{uuid.uuid4().hex}")
        out = self._fs().create(draft, False)
        out.write(bytearray("\n".join(folders), "utf-8"))
        out.close()
        self._fs().mkdirs(self._path("_pointers"))
        if not self._fs().rename(draft, self._path(f"_pointers/{number + 1:012d}")):
            raise RuntimeError(f"{self.root} was changed by another writer")
        return self.read()

    def write(self, df: DataFrame, tag: str | None = None, **options) -> DataFrame:
        """Replace the rows. Repeating a tag that is current changes nothing."""
        return self._publish(df, False, tag, options)

    def append(self, df: DataFrame, tag: str | None = None, **options) -> DataFrame:
        """Add rows without touching the ones that are there."""
        return self._publish(df, True, tag, options)


class KeyedTable(VersionedTable):
    """A versioned table whose rows lie in buckets of their key, so that a load rewrites only the buckets it touches.

    The pointer lists bucket folders. A load reads the buckets of its source's keys, writes them anew
    and switches the pointer; all other folders stay as they are. Rows with a NULL key match
    nothing and are only ever added. There are ``buckets`` folders, whatever the number of rows; choose them so that
    one bucket is a task's work. Without a number it is that of the table, for a new one the session's shuffle partitions.
    A table written without buckets is dealt to buckets by its first keyed load.
    """

    BUCKET = "_bucket"
    _NO_KEY = -1
    _NO_KEY_FILES = 64

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int | None = None) -> None:
        super().__init__(spark, root)
        _require(keys)
        self.keys, self.buckets = keys, buckets

    def _dealt(self, df: DataFrame) -> DataFrame:
        place = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return df.withColumn(self.BUCKET, F.when(_keyed(df, self.keys), place).otherwise(self._NO_KEY))

    def _is_dealt(self, folders: list[str]) -> bool:
        return all(f".{self.buckets}/{self.BUCKET}=" in f for f in folders)

    def _write_buckets(self, df: DataFrame, name: str) -> list[str]:
        """Write rows in buckets to the folder ``name``; returns the bucket folders."""
        rest = [c for c, kind in df.dtypes if c != self.BUCKET and not kind.startswith(("map", "variant"))]
        spread = F.when(F.col(self.BUCKET) == self._NO_KEY, F.pmod(F.xxhash64(*rest), F.lit(self._NO_KEY_FILES))).otherwise(0)
        dealt = df.repartition(F.col(self.BUCKET), spread)
        dealt.write.mode("overwrite").partitionBy(self.BUCKET).parquet(f"{self.root}/{name}")
        found = self._fs().listStatus(self._path(name))
        return sorted(f"{name}/{f}" for f in (s.getPath().getName() for s in found) if f.startswith(f"{self.BUCKET}="))

    def merge(self, source: DataFrame, load, tag: str | None = None) -> DataFrame:
        """Replace the rows of the touched buckets by ``load(rows, source)``, both without NULL keys; then add the keyless rows of ``source``."""
        number, folders = self._latest()
        before = self._open(folders)
        if self.buckets is None:
            counts = {f.split("/")[0].rsplit(".", 1)[-1] for f in folders if f"/{self.BUCKET}=" in f}
            self.buckets = int(counts.pop() if len(counts) == 1 else self.spark.conf.get("spark.sql.shuffle.partitions"))
        kinds = dict(before.dtypes)
        source = source.withColumns({k: F.col(k).cast(kinds[k]) for k in self.keys})
        name = f"{tag or uuid.uuid4().hex}.{self.buckets}"
        if any(f.startswith(f"{name}/") for f in folders):
            return self.read()
        if self._is_dealt(folders):
            hit = {r[0] for r in self._dealt(source).select(self.BUCKET).distinct().collect()} - {self._NO_KEY}  # one row per bucket
            read = [f for f in folders if int(f.rsplit("=", 1)[1]) in hit]
            kept = [f for f in folders if f not in set(read)]
            rows = self._open(read) if read else before.limit(0)
            loose = None
        else:
            kept, rows, loose = [], before.filter(_keyed(before, self.keys)), before.filter(~_keyed(before, self.keys))
        merged, added = load(rows, source.filter(_keyed(source, self.keys))), load(before.limit(0), source.filter(~_keyed(source, self.keys)))
        merged = merged.unionByName(added) if loose is None else merged.unionByName(added).unionByName(loose)
        written = self._write_buckets(self._dealt(merged), name)
        # A table without rows still needs a folder that holds its schema.
        return self._point(number, [*kept, *written] or self._empty(before, name))

    def _empty(self, like: DataFrame, name: str) -> list[str]:
        like.limit(0).write.mode("overwrite").parquet(f"{self.root}/{name}/{self.BUCKET}=0")
        return [f"{name}/{self.BUCKET}=0"]

    def upsert(self, source: DataFrame, order: str, tag: str | None = None) -> DataFrame:
        """``upsert`` of the touched buckets."""
        return self.merge(source, lambda rows, new: upsert(rows, new, self.keys, order), tag)

    def update(self, source: DataFrame, order: str | None = None, columns: list[str] | None = None, tag: str | None = None) -> DataFrame:
        """``update`` of the touched buckets; keyless source rows are ignored."""
        known = source.filter(_keyed(source, self.keys))
        return self.merge(known, lambda rows, new: update(rows, new, self.keys, order, columns), tag)

    def overlay(self, source: DataFrame, order: str, writable: list[str], *, insert_new: bool = True, tag: str | None = None) -> DataFrame:
        """``overlay`` of the touched buckets by a single key."""
        (key,) = self.keys
        return self.merge(source, lambda rows, new: overlay(rows, new, key, order, writable, insert_new=insert_new), tag)


class LayeredTable:
    """A large keyed table with the rows changed by each run kept in layers on top.

    A run writes only the rows it touches. Reading replaces base rows by their
    newest layer through an anti join on the changed keys, so the base is never
    shuffled while the layers are small. ``compact`` folds the layers in.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str]) -> None:
        self.base = VersionedTable(spark, f"{root}/base")
        self.layers = VersionedTable(spark, f"{root}/layers")
        self.keys = keys

    def exists(self) -> bool:
        return self.base.exists()

    def read(self, below: int | None = None) -> DataFrame:
        """The rows, or with ``below`` the rows before that layer was added."""
        base = self.base.read()
        if not self.layers.exists():
            return base
        layers = self.layers.read()
        layers = layers if below is None else layers.filter(F.col("_layer") < below)
        newest = latest_per_key(layers, self.keys, "_layer").drop("_layer")
        return base.join(newest.select(*self.keys), self.keys, "left_anti").unionByName(newest)

    def add(self, rows: DataFrame, layer: int) -> None:
        self.layers.append(rows.withColumn("_layer", F.lit(layer)), f"layer-{layer}")

    def depth(self) -> int:
        return len(self.layers.folders())

    def compact(self, layer: int) -> None:
        """Fold in all layers below ``layer``.

        Stopping between the two writes is harmless: the layers then repeat what
        the base already holds.
        """
        rows = self.read(layer)
        kept = self.layers.read().filter(F.col("_layer") >= layer)
        self.base.write(rows, f"base-{layer}")
        self.layers.write(kept, f"kept-{layer}")


class StatusQueue:
    """A queue kept in two parts: rows still waiting, and rows with a final status.

    A run reads only the waiting part. When it ends its rows move over; both
    steps carry the run's tag, so a repeated run moves nothing twice.
    """

    def __init__(self, spark: SparkSession, root: str, waiting_status: int, status: str = "mq_status") -> None:
        self.waiting = VersionedTable(spark, f"{root}/waiting")
        self.settled = VersionedTable(spark, f"{root}/settled")
        self.waiting_status, self.status = waiting_status, status

    def stage(self, rows: DataFrame, tag: str | None = None) -> None:
        self.waiting.append(rows, tag)

    def settle(self, key: str, done: DataFrame, tag: str) -> None:
        """Move the rows listed in ``done`` (key and new status) out of the waiting part."""
        before = self.waiting.read_before(tag)
        queue = update(before, done.select(key, self.status), [key])
        self.settled.append(queue.filter(F.col(self.status) != self.waiting_status), tag)
        self.waiting.write(queue.filter(F.col(self.status) == self.waiting_status), tag)

    def rows(self) -> DataFrame:
        return self.waiting.read().unionByName(self.settled.read()) if self.settled.exists() else self.waiting.read()


def assign_sequence(rows: DataFrame, column: str, order_by: list[str], start: int = 1) -> DataFrame:
    """Give rows without an id the next numbers from ``start``, in the given order."""
    kept = rows.filter(F.col(column).isNotNull())
    fresh = number_rows(rows.filter(F.col(column).isNull()).drop(column), order_by, column, start)
    return kept.unionByName(fresh.select(*rows.columns))
