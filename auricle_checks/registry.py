"""Registers a query together with its SQL, when SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from auricle_checks.tables import PRELUDE, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None, whole: bool = False):
    """Register `fn(tables) -> DataFrame`.

    `sql` follows the shared CTEs and may open with more of them (", x AS (…) SELECT"); with
    `whole` it stands alone.
    """

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            body = sql.strip()
            joint = "" if body.startswith(",") else "\n"
            ORACLE[name] = body if whole else f"WITH {PRELUDE.strip()}{joint}{body}"
        return fn

    return add
