"""Registered driver workloads: one Spark callable and (where SQL can say it)

Every callable takes ``(spark, sf_dir)``, reads the driver's tables and
returns a DataFrame; column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate workload {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registries
    from quayside.workloads import (  # noqa: F401
        w_clean,
        w_colocated,
        w_html,
        w_keys_cdc,
        w_messages,
        w_model,
        w_more,
        w_pipelines,
        w_parse,
        w_risk,
        w_rollups,
        w_stream,
        w_vessels,
    )
