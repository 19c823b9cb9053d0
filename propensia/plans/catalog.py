"""Registry of the engine's queries: one Spark builder and, where SQL can say
it, the DuckDB oracle text, keyed by the names used in SURVEY §2."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    survey_ids: str
    build: Builder
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, survey_ids: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, survey_ids, fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from . import (catalog_features, catalog_assembly, catalog_evaluation,  # noqa: F401
                   catalog_customers, catalog_model, catalog_stream)
    return REGISTRY
