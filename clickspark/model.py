"""Data model: click records, window results, arrival order.

A click is ``(user STRING, url STRING, ms BIGINT)`` where ``ms`` is event
time in epoch milliseconds.  Operators that depend on arrival order take
it as columns (``seq`` by default): a stream's ingestion offset, or any
unique sortable key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLICK_SCHEMA = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("ms", T.LongType()),
])

LONG_MIN = -(2 ** 63)
LONG_MAX = 2 ** 63 - 1

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_ms(ts: Column | str) -> Column:
    """Zone-free epoch milliseconds of a TIMESTAMP_NTZ column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def event_time(ms: Column | str) -> Column:
    """TIMESTAMP for windowing / watermarks (``withWatermark`` refuses NTZ)."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(ms)


def to_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a TIMESTAMP (LTZ) column, e.g. window bounds."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_millis(ts)


def clicks(events: DataFrame) -> DataFrame:
    """Click view of the ``events`` table.

    user = user_id as text, url = event_type, ms = event time,
    seq = event_id (the arrival order of an in-order stream).
    Only four columns are read, so the parquet scan is pruned.
    """
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("user"),
        F.col("event_type").alias("url"),
        epoch_ms("ts").alias("ms"),
    )


def disordered(df: DataFrame, seq: str = "seq", ms: str = "ms", out: str = "arr",
               every: int = 10, hit: int = 3, mult: int = 7919, spread: int = 97,
               unit_ms: int = 300_000) -> DataFrame:
    """Deterministic out-of-order arrival used by the late-data replays.

    One row in ``every`` (those with ``seq % every == hit``) arrives
    ``((seq*mult) % spread) * unit_ms`` after its event time; arrival
    order is then ``(arr, seq)``.
    """
    delay = F.when(F.col(seq) % every == hit, ((F.col(seq) * mult) % spread) * unit_ms)
    return df.withColumn(out, F.col(ms) + F.coalesce(delay, F.lit(0)))


# DuckDB's epoch_ms() rounds to the nearest ms; Java/Spark truncate.
MS_SQL = "(epoch_us(ts) // 1000)"


def click_sql(table: str = "events") -> str:
    """The click view as a DuckDB CTE body (used by oracles)."""
    return (f"SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS \"user\", "
            f"event_type AS url, {MS_SQL} AS ms FROM {table}")


def disordered_sql(src: str = "c") -> str:
    return (f"SELECT *, ms + CASE WHEN seq % 10 = 3 THEN ((seq * 7919) % 97) * 300000 "
            f"ELSE 0 END AS arr FROM {src}")
