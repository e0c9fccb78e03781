"""PF2: keyed processing-time timers, replayed on a bounded table.

Each arrival emits an "arrived" record and registers a timer ``delay``
after its processing time; each timer emits a "fired" record.  Timers of
one key with the same timestamp collapse into one (a timer service keeps
one timer per key and time).  Arrival and timer records of the same
instant have no defined order, so the output is a set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.functions.scalars import java_timestamp

# ---- fixed values: the reference's messages --------------------------------
ARRIVED_TEXT = "数据到达，到达时间："
FIRED_TEXT = "定时器触发，触发时间："
# ---------------------------------------------------------------------------


def timer_replay(df: DataFrame, at_ms: str, delay_ms: int, key: str | None = None,
                 zone: str = "UTC") -> DataFrame:
    """-> (key, kind, at_ms, message) with kind 'arrival' or 'timer'.

    ``at_ms`` is the processing time of each arrival.  With ``key=None``
    all rows share one key (``keyBy(x -> true)``).
    """
    k = F.col(key).cast("string") if key else F.lit("true")
    arrivals = df.select(k.alias("key"), F.lit("arrival").alias("kind"),
                         F.col(at_ms).alias("at_ms"))
    fired = (df.select(k.alias("key"), (F.col(at_ms) + F.lit(delay_ms)).alias("at_ms"))
               .distinct()
               .select("key", F.lit("timer").alias("kind"), "at_ms"))
    both = arrivals.unionByName(fired)
    text = F.when(F.col("kind") == "arrival", F.lit(ARRIVED_TEXT)).otherwise(F.lit(FIRED_TEXT))
    return both.withColumn("message", F.concat(text, java_timestamp("at_ms", zone)))
