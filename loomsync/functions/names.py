"""Identifier and text expressions. Every function maps Column to Column."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words a relational target refuses as plain identifiers.
RESERVED_WORDS = frozenset(
    """
    ACCESS ADD ALL ALTER AND ANY AS ASC AUDIT BETWEEN BY CASE CHAR CHECK CLUSTER COLUMN COMMENT COMPRESS
    CONNECT COUNT CREATE CROSS CUBE CURRENT DATE DECIMAL DEFAULT DELETE DESC DISTINCT DROP ELSE EXCLUSIVE
    EXISTS FETCH FILE FLOAT FOR FROM FULL GRANT GROUP HAVING IDENTIFIED IMMEDIATE IN INCREMENT INDEX INITIAL
    INNER INSERT INTEGER INTERSECT INTO IS JOIN LEFT LEVEL LIKE LOCK LONG MAXEXTENTS MERGE MINUS MLSLABEL
    MODE MODIFY NATURAL NOAUDIT NOCOMPRESS NOT NOWAIT NULL NUMBER OF OFFLINE OFFSET ON ONLINE OPTION OR
    ORDER OUTER PCTFREE PRIOR PRIVILEGES PUBLIC RAW RENAME RESOURCE REVOKE RIGHT ROLLUP ROW ROWID ROWNUM
    ROWS SELECT SESSION SET SHARE SIZE SMALLINT START SUCCESSFUL SYNONYM SYSDATE TABLE THEN TO TRIGGER UID
    UNION UNIQUE UPDATE USER USING VALIDATE VALUES VARCHAR VARCHAR2 VIEW WHEN WHENEVER WHERE WITH
    """.split()
)


def strip_whitespace(text: Column) -> Column:
    """Remove whitespace of any kind from both ends (``trim`` only knows blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, however often ``then`` refers to it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def strip_nul(text: Column) -> Column:
    """Remove NUL characters."""
    return F.replace(text, F.char(F.lit(0)), F.lit(""))


def digits_only(text: Column) -> Column:
    """Keep decimal digits."""
    return F.regexp_replace(text, r"(?U)\D", "")


def canonical_identifier(
    name: Column,
    *,
    max_length: int = 128,
    reserved: Iterable[str] = RESERVED_WORDS,
    force_prefix: bool = False,
    force_suffix: bool = False,
    prefix: str = "SF",
    suffix: str = "COL",
    strict: bool = False,
) -> Column:
    """Upper-case identifier legal on a relational target.

    A name with no usable character gives NULL, or fails the job when
    ``strict`` is set.
    """
    lead = prefix.rstrip("_") if force_prefix else prefix
    digit_lead = F.lit(f"{lead}_" if force_prefix else "C_")
    words = sorted(reserved)

    def led(word: Column) -> Column:
        return F.when(F.substring(word, 1, 1).between("0", "9"), F.concat(digit_lead, word)).otherwise(word)

    def escaped(word: Column) -> Column:
        other = F.concat(word, F.lit(f"_{suffix}")) if force_suffix and not force_prefix else F.concat(F.lit(f"{lead}_"), word)
        return F.when(word.isin(words), other).otherwise(word)

    # One pattern only, and no list of words in it: patterns take most of the time where names are many.
    word = _once(F.btrim(F.upper(F.regexp_replace(name, r"[^A-Za-z0-9_]+", "_")), F.lit("_")), led)
    word = _once(word, escaped) if words else word
    word = _once(F.rtrim(F.substring(word, 1, max_length), F.lit("_")), lambda w: F.when(w != "", w))
    if not strict:
        return word
    failure = F.raise_error(F.concat(F.lit("no identifier can be made from: "), F.coalesce(name, F.lit("NULL"))))
    return F.coalesce(word, failure.cast("string"))


def cross_system_name(name: Column, source: Column | str, target: Column | str) -> Column:
    """Name of a table on the other system; a returning table loses its prefix."""
    source = F.lit(source) if isinstance(source, str) else source
    target = F.lit(target) if isinstance(target, str) else target
    lower = F.lower(name)
    without_prefix = F.substring(name, 5, 2147483647)
    returning = F.when(
        F.lower(without_prefix).endswith("__c"),
        F.substr(without_prefix, F.lit(1), F.length(without_prefix) - 3),
    ).otherwise(without_prefix)
    to_relational = F.when(lower.startswith("ora_"), returning).otherwise(F.concat(F.lit("SF_"), name))
    to_crm = F.when(F.upper(name).startswith("SF_"), F.substring(name, 4, 2147483647)).otherwise(
        F.concat(F.lit("ora_"), lower, F.lit("__c"))
    )
    return (
        F.when((source == "salesforce") & (target == "oracle"), to_relational)
        .when((source == "oracle") & (target == "salesforce"), to_crm)
        .otherwise(name)
    )


def is_managed_table(name: Column, system: Column | str) -> Column:
    """True for tables created by a migration, judged by their name."""
    system = F.lit(system) if isinstance(system, str) else system
    crm = F.lower(name).startswith("ora_") & F.lower(name).endswith("__c")
    return F.when(system == "salesforce", crm).otherwise(F.upper(name).startswith("SF_"))


def statement_object(statement: Column) -> Column:
    """Main object of a query text, NULL when there is none."""
    flat = F.regexp_replace(statement, r"\(.*?\)", "")
    found = F.regexp_extract(flat, r"(?i)\bFROM\s+([a-zA-Z0-9_]+)", 1)
    return F.nullif(found, F.lit(""))


def iso8601_escaped(stamp: Column) -> Column:
    """UTC timestamp as ISO 8601 with ``:`` and ``+`` escaped for a URL."""
    text = F.concat(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return F.replace(F.replace(text, F.lit(":"), F.lit("%3A")), F.lit("+"), F.lit("%2B"))


def initial(text: Column) -> Column:
    """First character."""
    return F.substring(text, 1, 1)
