"""Watermark replay on a bounded table with an explicit arrival order.

Model (bounded out-of-orderness ``d``; monotonous = ``d = 0``): the
watermark emitted after row ``n`` is ``max(ms of rows <= n) - d - 1``;
before the first row it is ``Long.MIN``.  A window ``[s, e)`` closes when
the watermark reaches ``e - 1``, i.e. when the running max reaches
``e + d``.  At the end of a bounded input the watermark jumps to
``Long.MAX`` and everything still open fires.

The running max over the whole table in arrival order is the two-level
scan of :mod:`clickspark.operators.scan`, never one global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.model import LONG_MIN
from clickspark.operators.scan import BLOCK, Cuts, add_blocks, running


def floor_div(x: Column, n: int) -> Column:
    """Exact floor division of a BIGINT column by a positive constant
    (decimal arithmetic: a double quotient loses digits above 2^53)."""
    exact = (x - F.pmod(x, F.lit(n))).cast("decimal(20,0)")
    return (exact / F.lit(n).cast("decimal(20,0)")).cast("long")


def window_start(ms: Column | str, size_ms: int) -> Column:
    ms = F.col(ms) if isinstance(ms, str) else ms
    return ms - F.pmod(ms, F.lit(size_ms))


def blocked(df: DataFrame, order: Sequence[str], width: int | Cuts | None = None) -> DataFrame:
    """Attach arrival blocks unless the frame already has them."""
    return df if BLOCK in df.columns else add_blocks(df, order, width)


def _global_max(df: DataFrame, order: Sequence[str], ms: str, out: str,
                width: int | Cuts | None, exclusive: bool) -> DataFrame:
    return running(blocked(df, order, width), [], order, {out: ("max", F.col(ms))},
                   exclusive=exclusive)


def with_prev_max(df: DataFrame, order: Sequence[str], ms: str = "ms",
                  out: str = "prevmax", width: int | Cuts | None = None) -> DataFrame:
    """``max(ms)`` over the rows that arrived strictly before each row."""
    return _global_max(df, order, ms, out, width, exclusive=True)


def with_run_max(df: DataFrame, order: Sequence[str], ms: str = "ms",
                 out: str = "runmax", width: int | Cuts | None = None) -> DataFrame:
    """``max(ms)`` over the rows up to and including each row."""
    return _global_max(df, order, ms, out, width, exclusive=False)


def watermark_before(df: DataFrame, order: Sequence[str], delay_ms: int, ms: str = "ms",
                     out: str = "watermark", width: int | Cuts | None = None) -> DataFrame:
    """M1/M2/M3/M5: the watermark a row sees when it is processed."""
    res = with_prev_max(df, order, ms, "_prevmax", width)
    wm = F.coalesce(F.col("_prevmax") - F.lit(delay_ms + 1), F.lit(LONG_MIN))
    return _keep_cols(res.withColumn(out, wm), df, out)


def watermark_after(df: DataFrame, order: Sequence[str], delay_ms: int, ms: str = "ms",
                    out: str = "watermark", width: int | Cuts | None = None) -> DataFrame:
    """M4: the watermark emitted right after each row (punctuated
    ``emitWatermark(ts - 1)``; a lower value never moves it back)."""
    res = with_run_max(df, order, ms, "_runmax", width)
    return _keep_cols(res.withColumn(out, F.col("_runmax") - F.lit(delay_ms + 1)), df, out)


def _keep_cols(res: DataFrame, src: DataFrame, out: str) -> DataFrame:
    return res.select(*src.columns, out)


def records(df: DataFrame, prevmax: str = "prevmax", ms: str = "ms") -> DataFrame:
    """Rows that raise the running max: each is the first row whose running
    max reaches any threshold in ``(prevmax, ms]``."""
    return df.where(F.col(prevmax).isNull() | (F.col(ms) > F.col(prevmax)))


def first_crossing(recs: DataFrame, grid: int, offset: int, lower_pad: int,
                   out: str, carry: Sequence[Column] = (), prevmax: str = "prevmax",
                   ms: str = "ms", reach: int | None = None) -> DataFrame:
    """For thresholds ``T = k*grid + offset``: the record that first lifts the
    running max to ``T`` or more.  Returns ``(k, <carry>, <out>)`` with
    ``<out>`` the running max at that row.

    Each record covers the thresholds in ``(prevmax, ms]``.  The very first
    row has no ``prevmax``; ``lower_pad`` bounds how far before it a
    threshold can still matter.

    ``reach``: thresholds of windows that can exist lie within ``reach`` of
    either end of a record's interval.  A window whose on-time rows arrived
    before the record ends by ``prevmax + size``.  A window opened by the
    record or by later rows starts after ``ms - size - delay``.  So with
    ``reach = size + delay + step`` each record explodes at most two short
    ranges, whatever the gap (an event-time outlier costs nothing).
    Without ``reach`` the result has one row per grid cell of the time span.
    """
    v = F.col(ms)
    u = F.coalesce(F.col(prevmax), v - F.lit(lower_pad))
    lo = floor_div(u - F.lit(offset), grid) + 1
    hi = floor_div(v - F.lit(offset), grid)
    picked = recs.select(lo.alias("_lo"), hi.alias("_hi"), u.alias("_u"), v.alias(out), *carry)
    kept = [c for c in picked.columns if c not in ("_lo", "_hi", "_u")]
    picked = picked.where(F.col("_hi") >= F.col("_lo"))
    if reach is None:
        cells = F.sequence("_lo", "_hi")
    else:
        near_u = F.least(F.col("_hi"), floor_div(F.col("_u") + F.lit(reach - offset), grid) + 1)
        near_v = F.greatest(F.col("_lo"), floor_div(F.col(out) - F.lit(reach + offset), grid))
        cells = (F.when(near_u + 1 >= near_v, F.sequence("_lo", "_hi"))
                  .otherwise(F.concat(F.sequence(F.col("_lo"), near_u),
                                      F.sequence(near_v, F.col("_hi")))))
    return picked.select(F.explode(cells).alias("k"), *kept)


def classify_late(df: DataFrame, order: Sequence[str], size_ms: int, delay_ms: int,
                  lateness_ms: int = 0, ms: str = "ms", width: int | Cuts | None = None) -> DataFrame:
    """Tag each row with its tumbling window and its fate on arrival.

    ``cls`` = ``on_time`` (window not fired yet), ``refire`` (fired but within
    allowed lateness: the window is updated and fires again) or ``late``
    (past lateness: dropped or sent to the side output).
    """
    res = with_prev_max(df, order, ms, "prevmax", width)
    ws = window_start(ms, size_ms)
    res = res.withColumn("windowStart", ws).withColumn("windowEnd", ws + F.lit(size_ms))
    passed = F.col("prevmax") - F.lit(delay_ms)
    cls = (F.when(F.col("prevmax").isNull() | (passed < F.col("windowEnd")), F.lit("on_time"))
            .when(passed < F.col("windowEnd") + F.lit(lateness_ms), F.lit("refire"))
            .otherwise(F.lit("late")))
    return res.withColumn("cls", cls)


def close_watermarks(classified: DataFrame, size_ms: int, delay_ms: int,
                     out: str = "watermark") -> DataFrame:
    """Watermark value at which each window end closed: ``(windowEnd, out)``.

    Window end ``e`` closes at the first row whose running max reaches
    ``e + d``; the watermark then is that running max ``- d - 1``.  Ends
    that never close are absent (the caller uses ``Long.MAX``).
    """
    marks = first_crossing(records(classified), size_ms, delay_ms, size_ms + delay_ms,
                           "_cross", reach=2 * size_ms + delay_ms)
    return marks.select((F.col("k") * F.lit(size_ms)).alias("windowEnd"),
                        (F.col("_cross") - F.lit(delay_ms + 1)).alias(out))


__all__ = ["floor_div", "window_start", "blocked", "with_prev_max",
           "with_run_max", "watermark_before", "watermark_after", "records",
           "first_crossing", "classify_late", "close_watermarks"]
