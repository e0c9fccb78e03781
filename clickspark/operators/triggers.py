"""W6 / ST2: a custom event-time trigger that fires a window early.

On the first row of a (key, window) the trigger registers event-time
timers at ``start, start+step, ..., end-step`` (plus the window's own
close timer at ``end-1``).  Every timer FIREs the window without purging
(or FIRE_AND_PURGE with ``purge=True``).  A timer ``t`` fires after the
first row ``n`` at or after the window's first row whose watermark
``runmax_n - d - 1`` reaches ``t``; the firing reports the rows of the
window that arrived up to ``n``.  Timers already passed when registered
fire right away, each with its own output row.

Replay plan (all distributed):
1. global exclusive running max -> late rows dropped, records;
2. per (key, window): first arrival and the timer list (bounded: size/step+1);
3. thresholds on two small grids (timer grid, window-end grid) -> the
   record that first crosses each (one row per grid cell of the time span);
4. "count of window rows arrived up to the firing row" is an as-of lookup:
   timers become marker rows placed right after their firing row, and a
   running count per (key, window) over rows + markers answers all of
   them in one two-level scan (no pairs of rows and timers are formed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickspark.model import LONG_MAX
from clickspark.operators.scan import Cuts, add_blocks, materialize, running
from clickspark.operators.watermark import (first_crossing, floor_div, records,
                                            window_start, with_prev_max)


def early_firings(df: DataFrame, key: str, seq: str, size_ms: int, step_ms: int,
                  delay_ms: int = 0, ms: str = "ms", width: int | Cuts | None = None,
                  purge: bool = False) -> DataFrame:
    """-> (key, windowStart, windowEnd, timer, fired_at, count) per timer firing;
    ``fired_at`` is the arrival ``seq`` after which the timer fired (NULL:
    only the end of input fired it).

    ``seq`` is the arrival order (a unique integral column).  With
    ``purge`` each firing reports only the rows since the window's
    previous firing and empty firings emit nothing (FIRE_AND_PURGE).
    """
    if size_ms % step_ms:
        raise ValueError("window size must be a multiple of the timer step")
    d = delay_ms
    rows = with_prev_max(df.select(key, seq, ms), [seq], ms, "prevmax", width)
    ws = window_start(ms, size_ms)
    rows = rows.withColumn("windowStart", ws).withColumn("windowEnd", ws + F.lit(size_ms))
    # read by the window table, the crossing tables and the row markers
    rows = materialize(rows)
    # rows whose window was already purged are dropped (lateness 0)
    on_time = rows.where(F.col("prevmax").isNull()
                         | (F.col("prevmax") - F.lit(d) < F.col("windowEnd")))

    wins = on_time.groupBy(key, "windowStart", "windowEnd").agg(F.min(seq).alias("first_seq"))
    grid = F.sequence(F.col("windowStart"), F.col("windowEnd") - F.lit(step_ms),
                      F.lit(step_ms).cast("long"))
    named = [key, "windowStart", "windowEnd", "first_seq"]
    on_step = wins.select(*named, F.explode(grid).alias("timer"))
    on_close = wins.select(*named, (F.col("windowEnd") - 1).alias("timer"))

    # Thresholds: grid timer t fires once runmax >= t + d + 1; the close
    # timer (end - 1) once runmax >= end + d.
    recs = records(rows)
    pad = size_ms + d + step_ms
    reach = size_ms + d + step_ms
    on_grid = first_crossing(recs, step_ms, d + 1, pad, "_v", [F.col(seq).alias("_cs")],
                             reach=reach)
    on_ends = first_crossing(recs, size_ms, d, pad, "_v", [F.col(seq).alias("_cs")],
                             reach=reach + size_ms)
    # step and close timers look their crossing up apart, each on a key that
    # is never null
    on_step = on_step.withColumn("k", floor_div(F.col("timer"), step_ms)).join(
        on_grid.select("k", "_cs"), "k", "left")
    on_close = on_close.withColumn("k", floor_div(F.col("windowEnd"), size_ms)).join(
        on_ends.select("k", "_cs"), "k", "left")
    fire_seq = F.when(F.col("_cs").isNotNull(), F.greatest("_cs", "first_seq"))
    # written once: the scan reads its input for the rows and for the totals
    markers = materialize(on_step.unionByName(on_close).select(
        key, "windowStart", "windowEnd", "timer",
        F.coalesce(fire_seq, F.lit(LONG_MAX)).alias("_pos"),
        F.lit(1).alias("_mark"), F.lit(0).alias("_real")))

    real = on_time.select(key, "windowStart", "windowEnd",
                          F.lit(None).cast("long").alias("timer"),
                          F.col(seq).alias("_pos"), F.lit(0).alias("_mark"),
                          F.lit(1).alias("_real"))
    both = real.unionByName(markers)
    order = ["_pos", "_mark", "timer"]
    both = add_blocks(both, order, width)
    # both parts come from written tables; there are size/step + 1 markers per
    # window, so up to several per row
    counted = running(both, [key, "windowStart"], order, {"count": ("sum", F.col("_real"))})
    fired = counted.where(F.col("_mark") == 1).select(
        key, "windowStart", "windowEnd", "timer",
        F.when(F.col("_pos") != F.lit(LONG_MAX), F.col("_pos")).alias("fired_at"),
        F.col("count").cast("long").alias("count"))
    if not purge:
        return fired
    # FIRE_AND_PURGE: report what arrived since the previous firing; per
    # window there are only size/step + 1 timers.
    prev = F.lag("count", 1, 0).over(Window.partitionBy(key, "windowStart").orderBy("timer"))
    return (fired.withColumn("count", (F.col("count") - prev).cast("long"))
                 .where(F.col("count") > 0))

