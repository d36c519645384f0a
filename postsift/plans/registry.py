"""Registry of query keys: a Spark builder and (when SQL can state it) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = "2026-01-22"  # run stamp parameter of the registered queries
RUN_ID = "r0"


@dataclass
class Entry:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    survey_id: str


REGISTRY: dict[str, Entry] = {}


def query(key: str, survey_id: str, sql: str | None = None):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql, survey_id)
        return fn

    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules fills the registry
    from . import (  # noqa: F401
        evaluation_queries,
        io_queries,
        leads_queries,
        page_queries,
        scoring_queries,
        state_queries,
        stream_queries,
        telemetry_queries,
        text_queries,
    )

    return REGISTRY
