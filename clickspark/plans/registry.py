"""Named query registry: ``name -> (spark builder, DuckDB oracle SQL)``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    oracle: str | None
    doc: str


REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, oracle, (fn.__doc__ or "").strip())
        return fn
    return deco


def queries() -> dict[str, Builder]:
    _load()
    return {k: e.build for k, e in REGISTRY.items()}


def oracles() -> dict[str, str]:
    _load()
    return {k: e.oracle for k, e in REGISTRY.items() if e.oracle}


def _load() -> None:
    # importing the catalog modules fills REGISTRY
    from clickspark.plans import catalog  # noqa: F401
