"""Veto rules for destructive writes, evaluated over a plan of writes.

A rule maps a plan row to a reason or NULL. A write is permitted when no rule
gives a reason; new rules are appended, existing ones never change. The plan has
the columns op, mode, environment, env_class, table_name, is_managed and
break_glass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Modes, operations that lose data, and classes that are not production.
MODES = ("no", "restricted", "dev_only", "yes")
DATA_LOSS = ["truncate", "drop"]
SAFE_CLASSES = ["dev", "qa"]

Rule = Callable[[], Column]


class GuardRefused(RuntimeError):
    """Raised by a sink for writes the rules do not permit.

    ``refused`` holds every one of them (op, table_name, reasons) and ``count`` their number;
    only the message stops after the first few.
    """

    def __init__(self, refused: DataFrame, count: int, shown: int) -> None:
        self.refused, self.count = refused, count
        first = [f"{r['op'].upper()} on '{r['table_name']}': {', '.join(r['reasons'])}" for r in refused.take(shown)]
        super().__init__(f"{count} refused: " + "; ".join(first) + ("; ..." if count > shown else ""))


def normalize_mode(text: str) -> str:
    mode = text.strip().lower().replace("-", "_")
    if mode not in MODES:
        raise ValueError(f"invalid destructive mode '{text}' (choose from: {', '.join(MODES)})")
    return mode


def is_production(env_class: Column) -> Column:
    """Anything not known to be dev or qa counts as production."""
    return ~F.coalesce(F.lower(env_class), F.lit("unknown")).isin(SAFE_CLASSES)


def mode_rule() -> Column:
    mode = F.replace(F.lower(F.trim("mode")), F.lit("-"), F.lit("_"))
    return (
        F.when(mode == "no", F.lit("all destructive operations are disabled"))
        .when(
            (mode == "restricted") & ~F.col("is_managed"),
            F.concat(F.lit("only managed tables may be changed; not managed: "), F.col("table_name")),
        )
        .when(
            (mode == "dev_only") & is_production(F.col("env_class")),
            F.concat(F.lit("not allowed outside dev: "), F.col("environment"), F.lit(" is "), F.col("env_class")),
        )
    )


def break_glass_rule() -> Column:
    stopped = F.lower("op").isin(DATA_LOSS) & is_production(F.col("env_class")) & ~F.col("break_glass")
    return F.when(stopped, F.concat(F.lit("data loss in production needs break-glass: "), F.col("environment")))


DEFAULT_RULES: tuple[Rule, ...] = (mode_rule, break_glass_rule)


def evaluate(plan: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES) -> DataFrame:
    """The plan with the reasons against every write; none means permitted."""
    return plan.withColumn("reasons", F.array_compact(F.array(*[rule() for rule in rules])))


def enforce(plan: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, shown: int = 20) -> None:
    """Fail when a write of the plan is refused; the message lists at most ``shown``, the error holds all."""
    refused = evaluate(plan, rules).filter(F.size("reasons") > 0).select("op", "table_name", "reasons")
    count = refused.count()
    if count:
        raise GuardRefused(refused, count, shown)
