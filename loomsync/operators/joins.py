"""Join shapes used by migration and sync, including skew-proof ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Inner or left join of many rows to at most one row per key, whatever keys are hot.

    Nothing is counted beforehand. The left side may be cut wherever a key (or NULL) fills a partition,
    since a row meets one row at most: adaptive execution does so from the sizes the shuffle has seen,
    also where another exchange follows, which the session settings ask for.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a {how} join cannot be cut on its left side")
    return left.join(right, keys, how)


def left_join_many(one: DataFrame, many: DataFrame, keys: list[str], known: DataFrame | None = None) -> DataFrame:
    """Left join where the right side may hold a hot key.

    A left join cannot be cut on its right side, an inner join can. So the right side gets one empty row for each
    key that it lacks, and NULL, which matches nothing, is one of these; what is worked out for ``one`` is worked out
    once. ``known`` are the keys of ``one``, or more, where they are to be had for less.
    """
    there = many.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    lacking = (one if known is None else known).select(*keys).distinct().join(there.select(*keys).distinct(), keys, "left_anti")
    right = there.unionByName(lacking, allowMissingColumns=True).withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return one.join(right, same, "inner").drop(*[f"_right_{k}" for k in keys])


def left_join_sparse(left: DataFrame, right: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Left join whose left side has no value in some key of most rows, as references have.

    Such rows match nothing but would all meet in one partition. A further key, a hash of the others, deals them out
    by their columns ``by`` instead.
    """
    kinds = dict(right.dtypes)
    hashed = [k for k, kind in left.dtypes if k in keys and kinds[k] == kind and kind in ("string", "int", "bigint", "date")]
    if not hashed:
        return left.join(right, keys, "left")
    place = F.xxhash64(*hashed)
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    dealt = left.withColumn("_place", F.when(whole, place).otherwise(F.xxhash64(*by)))
    return dealt.join(right.withColumn("_place", place), [*keys, "_place"], "left").drop("_place")


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Row with the highest ``order`` of every key.

    An aggregate, so map tasks shrink a hot key to one row before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)


def typed_lookup(
    df: DataFrame, lookup: DataFrame, key: str, kind: str, label: str, *, id_col: str, type_col: str, text_col: str
) -> DataFrame:
    """Left join to one type of a list-of-values table, adding its text."""
    one = lookup.filter(F.col(type_col) == kind).select(F.col(id_col).alias(key), F.col(text_col).alias(label))
    return df.join(one, key, "left")


def orphans(df: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Rows whose non-NULL reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")
