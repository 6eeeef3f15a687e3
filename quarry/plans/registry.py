"""Registered queries: a Spark plan and, where SQL can say it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    bench: bool
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None, bench: bool = False):
    """Decorator: add ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(name, fn, oracle, bench, (fn.__doc__ or "").strip())
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module so that its queries register themselves."""
    from quarry.plans import (  # noqa: F401 - imported for registration
        basket_plans,
        classify_plans,
        cluster_plans,
        outlier_plans,
        reader_plans,
        sink_plans,
        token_plans,
        wide_plans,
    )

    return REGISTRY
