"""Shared inputs and SQL fragments for the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.model import click_sql, clicks, load

CLICKS_CTE = f"c AS ({click_sql()})"


def click_view(spark: SparkSession, sf_dir: str, users: Sequence[str] | None = None) -> DataFrame:
    """The click view of ``events``; ``users`` keeps those users' rows by a
    predicate on the source column, which reaches the Parquet scan (one on
    the cast to text would not)."""
    events = load(spark, sf_dir, "events")
    if users is not None:
        events = events.where(F.col("user_id").isin([int(u) for u in users]))
    return clicks(events)


_CUTS: dict[tuple, list] = {}


def event_cuts(spark: SparkSession, sf_dir: str) -> list[tuple]:
    """Arrival-block bounds of ``event_id`` for in-order scans (drawn once per
    input folder and partition setting)."""
    from clickspark.operators.scan import order_cuts
    from clickspark.session import shuffle_partitions
    key = (spark.sparkContext.applicationId, sf_dir, shuffle_partitions(spark))
    if key not in _CUTS:
        _CUTS[key] = order_cuts(load(spark, sf_dir, "events"), ["event_id"])
    return _CUTS[key]


def with_clicks(body: str, *ctes: str) -> str:
    """``WITH c AS (click view), <ctes> <body>`` for DuckDB."""
    return "WITH " + ", ".join([CLICKS_CTE, *ctes]) + "\n" + body
