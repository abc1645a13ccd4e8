"""Registration of a query together with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from loomsync.session import configure
from workload.inputs import Inputs, oracle


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None, *tables: str, materialized: bool = False):
        """Register the decorated ``Inputs -> DataFrame`` function under ``name``; its SQL may ask for inputs worked out once."""

        def register(fn: Callable[[Inputs], DataFrame]):
            self.queries[name] = lambda spark, folder: fn(Inputs(configure(spark), folder))
            if sql is not None:
                self.oracle[name] = oracle(sql, *tables, materialized=materialized)
            return fn

        return register
