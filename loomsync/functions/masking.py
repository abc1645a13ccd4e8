"""Redaction of sensitive fields and of sensitive passages in free text."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsync.functions.names import digits_only, strip_whitespace

SECRET_VARIABLE = "REDACTION_SECRET"
MODES = ("none", "full_mask", "part_mask", "hash_mask")
FULL_MASK = "***-**-****"

Strategy = Callable[[Column], Column]


@dataclass(frozen=True)
class TextPattern:
    """A named detector. The pattern must not contain capture groups."""

    name: str
    regex: str


# Nine digits in 3-2-4 groups, optionally separated.
SSN = TextPattern("ssn", r"(?U)\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b")
PATTERNS: tuple[TextPattern, ...] = (SSN,)


def normalize_mode(text: str) -> str:
    mode = text.strip().lower().replace("-", "_")
    if mode not in MODES:
        raise ValueError(f"invalid redaction mode '{text}' (choose from: {', '.join(MODES)})")
    return mode


def full_mask(matched: Column) -> Column:
    return F.when(matched.isNotNull(), F.lit(FULL_MASK))


def part_mask(matched: Column) -> Column:
    digits = digits_only(matched)
    last = F.when(F.length(digits) >= 4, F.right(digits, F.lit(4))).otherwise("****")
    return F.when(matched.isNotNull(), F.concat(F.lit("***-**-"), last))


def hash_mask(secret: bytes) -> Strategy:
    """Keyed token: HMAC-SHA256 over the digits, built from ``sha2`` alone."""
    if not secret:
        raise ValueError("hash_mask needs a non-empty secret")
    import hashlib

    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in key))
    outer = F.lit(bytes(b ^ 0x5C for b in key))

    def apply(matched: Column) -> Column:
        message = F.encode(digits_only(matched), "UTF-8")
        first = F.unhex(F.sha2(F.concat(inner, message), 256))
        return F.concat(F.lit("SSN:"), F.substring(F.sha2(F.concat(outer, first), 256), 1, 12))

    return apply


def strategy_for(mode: str, secret: bytes | None = None) -> Strategy | None:
    """Strategy of a mode, None when redaction is off."""
    mode = normalize_mode(mode)
    if mode == "none":
        return None
    if mode == "full_mask":
        return full_mask
    if mode == "part_mask":
        return part_mask
    secret = secret or os.environ.get(SECRET_VARIABLE, "").encode()
    if not secret:
        raise RuntimeError(f"hash_mask redaction needs {SECRET_VARIABLE} in the environment")
    return hash_mask(secret)


def redact_field(value: Column, strategy: Strategy | None) -> Column:
    """The whole value is sensitive. NULL and blank values stay as they are."""
    if strategy is None:
        return value
    text = value.cast("string")
    return F.when(text.rlike(r"(?U)\S"), strategy(strip_whitespace(text))).otherwise(text)


def redact_scan(
    value: Column, strategy: Strategy | None, patterns: Iterable[TextPattern] = PATTERNS
) -> Column:
    """Replace every match inside free text, leaving the rest as it is."""
    if strategy is None:
        return value
    text = value.cast("string")
    for pattern in patterns:
        rest = F.split(text, pattern.regex, -1)
        tokens = F.transform(F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0)), strategy)
        woven = F.zip_with(rest, tokens, lambda part, token: F.concat(part, F.coalesce(token, F.lit(""))))
        text = F.when(text.rlike(pattern.regex), F.array_join(woven, "")).otherwise(text)
    return text


def apply_plan(df: DataFrame, plan: Mapping[str, str], strategy: Strategy | None) -> DataFrame:
    """Redact the planned columns; planned names the frame lacks are skipped."""
    if strategy is None:
        return df
    handlers = {"field": redact_field, "scan": redact_scan}
    unknown = {scope for scope in plan.values() if scope not in handlers}
    if unknown:
        raise ValueError(f"unknown redaction scope: {', '.join(sorted(unknown))}")
    return df.withColumns(
        {name: handlers[scope](F.col(name), strategy) for name, scope in plan.items() if name in df.columns}
    )


def discover(df: DataFrame, columns: list[str], patterns: Iterable[TextPattern] = PATTERNS) -> DataFrame:
    """Rows with a match and number of matches, per text column and pattern.

    One pass over the data: matches are counted per row and column, then summed
    with map-side combine.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(p.name).alias("pattern_name"),
                F.coalesce(F.regexp_count(F.col(name), F.lit(p.regex)), F.lit(0)).cast("bigint").alias("hits"),
            )
            for name in columns
            for p in patterns
        ]
    )
    return (
        df.select(F.inline(cells))
        .groupBy("column_name", "pattern_name")
        .agg(F.count_if(F.col("hits") > 0).alias("matching_rows"), F.sum("hits").alias("matches"))
    )
