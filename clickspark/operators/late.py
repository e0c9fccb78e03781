"""Late data: dropped rows, allowed lateness re-firings, side outputs.

Batch replays of a tumbling event-time window with a bounded-delay
watermark, given an arrival order.  All steps are joins, aggregates and
two-level scans; nothing gathers a key or the whole table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.model import LONG_MAX
from clickspark.operators.scan import Cuts, materialize, running
from clickspark.operators.watermark import classify_late, close_watermarks

# ---- fixed values: the reference's window report text ---------------------
WINDOW_REPORT = ("窗口", " ~ ", "中共有", "个元素，窗口闭合计算时，水位线处于：")
# ---------------------------------------------------------------------------


def _classified(df: DataFrame, order: Sequence[str], size_ms: int, delay_ms: int,
                lateness_ms: int, ms: str, width: int | Cuts | None) -> DataFrame:
    """Classified rows, written once: every caller reads them from several
    branches."""
    return materialize(classify_late(df, order, size_ms, delay_ms, lateness_ms, ms, width))


def windows_with_watermark(df: DataFrame, key: str, order: Sequence[str], size_ms: int,
                           delay_ms: int, ms: str = "ms",
                           width: int | Cuts | None = None) -> DataFrame:
    """Tumbling window count per key; late rows dropped; each window
    reports the watermark at which it closed (``Long.MAX`` if only the end
    of input closed it).

    -> (key, windowStart, windowEnd, count, watermark, message)
    """
    q = _classified(df, order, size_ms, delay_ms, 0, ms, width)
    counts = (q.where(F.col("cls") == "on_time")
                .groupBy(key, "windowStart", "windowEnd").agg(F.count(F.lit(1)).alias("count")))
    marks = close_watermarks(q, size_ms, delay_ms, "_wm")
    res = counts.join(marks, "windowEnd", "left").select(
        key, "windowStart", "windowEnd", "count",
        F.coalesce(F.col("_wm"), F.lit(LONG_MAX)).alias("watermark"))
    a, b, c, d = WINDOW_REPORT
    msg = F.concat(F.lit(a), F.col("windowStart").cast("string"), F.lit(b),
                   F.col("windowEnd").cast("string"), F.lit(c), F.col("count").cast("string"),
                   F.lit(d), F.col("watermark").cast("string"))
    return res.withColumn("message", msg)


def lateness_replay(df: DataFrame, key: str, order: Sequence[str], size_ms: int,
                    delay_ms: int, lateness_ms: int, ms: str = "ms",
                    width: int | Cuts | None = None) -> DataFrame:
    """Classified rows of W7: ``cls`` in on_time / refire / late, with their
    window.  Firings, final counts and the side output all read it; it is
    never recomputed from the input (see ``_classified``)."""
    return _classified(df, order, size_ms, delay_ms, lateness_ms, ms, width)


def late_firings(replay: DataFrame, key: str, order: Sequence[str],
                 seq: str = "seq") -> DataFrame:
    """One firing when the watermark passes the window end (count of
    on-time rows), then one updated firing per row that arrives within the
    allowed lateness, reporting the window's rows so far.
    -> (key, windowStart, windowEnd, kind, seq, count)

    A window's rows within the lateness all arrive after its on-time rows
    (the running max only grows), so a re-firing reports the on-time count
    plus its rank among the window's re-firings.  Only those few rows are
    scanned, in blocks, so a hot window stays split.
    """
    on_time = (replay.where(F.col("cls") == "on_time")
                     .groupBy(key, "windowStart", "windowEnd")
                     .agg(F.count(F.lit(1)).alias("count")))
    first = on_time.select(key, "windowStart", "windowEnd", F.lit("first").alias("kind"),
                           F.lit(None).cast("long").alias(seq), "count")
    ranked = running(replay.where(F.col("cls") == "refire"), [key, "windowStart"], order,
                     {"_rank": ("count", F.lit(1))})
    before = on_time.select(F.struct(key, "windowStart").alias("_win"), F.col("count").alias("_n"))
    refire = (ranked.withColumn("_win", F.struct(key, "windowStart")).join(before, "_win", "left")
              .select(key, "windowStart", "windowEnd", F.lit("refire").alias("kind"), F.col(seq),
                      (F.coalesce(F.col("_n"), F.lit(0)) + F.col("_rank")).alias("count")))
    return first.unionByName(refire)


def final_counts(replay: DataFrame, key: str) -> DataFrame:
    """The last firing of each window: all rows that were not late."""
    return (replay.where(F.col("cls") != "late")
                  .groupBy(key, "windowStart", "windowEnd")
                  .agg(F.count(F.lit(1)).alias("count")))


def late_side_output(replay: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows past the allowed lateness, as their own output."""
    return replay.where(F.col("cls") == "late").select(*cols)


def tagged_union(inputs: DataFrame, results: DataFrame, late: DataFrame) -> DataFrame:
    """The three outputs of one job as one frame with a ``tag``
    (``input`` / ``result`` / ``late``), as the reference prints them."""
    return (inputs.withColumn("tag", F.lit("input"))
            .unionByName(results.withColumn("tag", F.lit("result")), allowMissingColumns=True)
            .unionByName(late.withColumn("tag", F.lit("late")), allowMissingColumns=True))
