"""Change fingerprints over groups of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = "|"


def fingerprint(fields: list[Column]) -> Column:
    """Upper-case MD5 of the field texts run together.

    There is no separator and an absent or empty field counts as one bar, as
    stored fingerprints already do; changing either would flag every record.
    """
    texts = [F.coalesce(F.nullif(f.cast("string"), F.lit("")), F.lit(ABSENT)) for f in fields]
    return F.upper(F.md5(F.concat(*texts)))


def differs(left: Column, right: Column) -> Column:
    """NULL-safe inequality; a NULL also equals a bar."""
    return F.coalesce(left, F.lit(ABSENT)) != F.coalesce(right, F.lit(ABSENT))
