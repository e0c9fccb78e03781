"""Event-time windows over a bounded table (every window fires at the end).

Windows are epoch aligned, start inclusive, end exclusive; bounds are
returned as BIGINT epoch ms (``windowStart``/``windowEnd``) so results do
not depend on a session time zone.  ``F.window`` is used for both batch and
streaming, so the same function works on a ``readStream`` frame.
Sliding windows become Spark's ``Expand`` (size/slide copies per row) and
aggregate map-side before the shuffle; a window holding a third of the
rows is still combined partially on every task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.functions.scalars import java_timestamp
from clickspark.model import event_time, to_ms

# ---- fixed values: the reference's distinct-visitor report text ------------
UV_REPORT = ("窗口: ", " ~ ", " 的独立访客数量是：")
# ---------------------------------------------------------------------------


def _dur(ms: int) -> str:
    return f"{int(ms)} milliseconds"


def window_col(ms: str | Column, size_ms: int, slide_ms: int | None = None) -> Column:
    """``F.window`` over an epoch-ms column (or a TIMESTAMP column)."""
    ts = event_time(ms) if isinstance(ms, str) else ms
    if slide_ms is None or slide_ms == size_ms:
        return F.window(ts, _dur(size_ms))
    return F.window(ts, _dur(size_ms), _dur(slide_ms))


def window_bounds(win: str = "window") -> list[Column]:
    return [to_ms(F.col(f"{win}.start")).alias("windowStart"),
            to_ms(F.col(f"{win}.end")).alias("windowEnd")]


def window_bounds_from(ms: str, size_ms: int, slide_ms: int | None = None) -> list[Column]:
    """Explode rows into their windows: ``windowStart``/``windowEnd`` columns
    (use inside ``select``; sliding windows yield one row per window)."""
    w = window_col(ms, size_ms, slide_ms)
    return [to_ms(w.start).alias("windowStart"), to_ms(w.end).alias("windowEnd")]


def window_agg(df: DataFrame, keys: Sequence[str], size_ms: int, aggs: Mapping[str, Column],
               slide_ms: int | None = None, time_col: str = "ms",
               ts_col: str | None = None) -> DataFrame:
    """``groupBy(window, *keys).agg(...)`` with BIGINT window bounds.

    ``aggs`` maps output column name -> aggregate expression.
    """
    src = F.col(ts_col) if ts_col else time_col
    win = window_col(src, size_ms, slide_ms).alias("window")
    return (df.groupBy(win, *keys).agg(*[e.alias(n) for n, e in aggs.items()])
              .select(*keys, *aggs.keys(), *window_bounds()))


def tumbling_count(df: DataFrame, key: str, size_ms: int, out: str = "count",
                   time_col: str = "ms", ts_col: str | None = None) -> DataFrame:
    """Tumbling window count per key (incremental reduce in the reference)."""
    return window_agg(df, [key], size_ms, {out: F.count(F.lit(1))},
                      time_col=time_col, ts_col=ts_col)


def sliding_count(df: DataFrame, keys: Sequence[str], size_ms: int, slide_ms: int,
                  time_col: str = "ms", out: str = "count") -> DataFrame:
    """Sliding-window count by panes: count per (key, slide-sized pane)
    first, then copy each pane's count into the ``size/slide`` windows that
    contain it and add up.  Only the aggregated panes are duplicated, never
    the input rows (``F.window`` expands every row before aggregating).
    Needs ``size`` to be a multiple of ``slide``."""
    t = F.col(time_col)
    pane = (t - F.pmod(t, F.lit(slide_ms))).alias("_pane")
    per = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("_n"))
    first = F.col("_pane") - F.lit(size_ms - slide_ms)
    win = per.select(*keys, "_n", F.explode(F.sequence(first, F.col("_pane"),
                                                       F.lit(slide_ms).cast("long")))
                     .alias("windowStart"))
    return (win.groupBy(*keys, "windowStart").agg(F.sum("_n").cast("long").alias(out))
               .select(*keys, out, "windowStart",
                       (F.col("windowStart") + F.lit(size_ms)).alias("windowEnd")))


def url_view_count(df: DataFrame, size_ms: int, slide_ms: int, key: str = "url",
                   time_col: str = "ms", ts_col: str | None = None) -> DataFrame:
    """Sliding window count per url -> (url, count, windowStart, windowEnd).

    Batch input (epoch-ms column) is aggregated by panes; a stream (``ts_col``,
    watermarked TIMESTAMP) uses ``F.window`` so Spark's state and watermark
    handling apply."""
    if ts_col is None and size_ms % slide_ms == 0:
        return sliding_count(df, [key], size_ms, slide_ms, time_col)
    return window_agg(df, [key], size_ms, {"count": F.count(F.lit(1))},
                      slide_ms=slide_ms, time_col=time_col, ts_col=ts_col)


def pv_uv(df: DataFrame, size_ms: int, slide_ms: int | None = None, user: str = "user",
          time_col: str = "ms", ts_col: str | None = None) -> DataFrame:
    """Page views, unique visitors and PV/UV per window (all rows, no key).

    ``count(distinct)`` is planned as an aggregation on (window, user)
    first, so the distinct set is spread over the cluster by user and
    never gathered in one task.
    """
    res = window_agg(df, [], size_ms,
                     {"pv": F.count(F.lit(1)), "uv": F.count_distinct(F.col(user))},
                     slide_ms=slide_ms, time_col=time_col, ts_col=ts_col)
    return res.withColumn("avg_pv", F.col("pv").cast("double") / F.col("uv").cast("double"))


def pv_uv_two_stage(df: DataFrame, size_ms: int, slide_ms: int | None = None,
                    user: str = "user", time_col: str = "ms",
                    ts_col: str | None = None) -> DataFrame:
    """W2 in the streaming-safe form: per (window, user) first, then per window.

    Structured Streaming refuses ``count(distinct)``; two chained
    aggregations give the same exact answer and stay distributed.
    """
    src = F.col(ts_col) if ts_col else time_col
    win = window_col(src, size_ms, slide_ms).alias("window")
    per_user = df.groupBy(win, F.col(user)).agg(F.count(F.lit(1)).alias("_n"))
    res = per_user.groupBy("window").agg(F.sum("_n").cast("long").alias("pv"),
                                         F.count(F.lit(1)).alias("uv"))
    return res.select(F.col("pv"), F.col("uv"),
                      (F.col("pv").cast("double") / F.col("uv").cast("double")).alias("avg_pv"),
                      *window_bounds())


def unique_visitors(df: DataFrame, size_ms: int, user: str = "user", time_col: str = "ms",
                    ts_col: str | None = None, approx: bool = False) -> DataFrame:
    """Distinct users per tumbling window (``approx`` = HyperLogLog++)."""
    agg = F.approx_count_distinct(F.col(user)) if approx else F.count_distinct(F.col(user))
    return window_agg(df, [], size_ms, {"uv": agg}, time_col=time_col, ts_col=ts_col)


def uv_report(zone: str = "UTC") -> Column:
    """W3's report line: window bounds as ``Timestamp`` text and the count."""
    a, b, c = UV_REPORT
    return F.concat(F.lit(a), java_timestamp("windowStart", zone), F.lit(b),
                    java_timestamp("windowEnd", zone), F.lit(c), F.col("uv").cast("string"))


def process_windows(aggregated: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """A window function that sees the key, the window bounds and the
    incremental aggregate of its window (the reference's
    ``aggregate(agg, processWindowFunction)`` pairing).

    ``fn(pandas.DataFrame) -> pandas.DataFrame`` runs on Arrow batches of
    already-aggregated rows (one row per key and window), so no window's
    elements are ever gathered in one place.
    """
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return aggregated.mapInPandas(run, schema)
