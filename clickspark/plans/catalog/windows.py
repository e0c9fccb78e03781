"""Window queries W1-W4 (every window of the whole table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickspark.operators import windows as W
from clickspark.plans import params as P
from clickspark.plans.catalog.common import click_view, with_clicks
from clickspark.plans.registry import register


def panes_sql(size: int, slide: int, src: str = "c", cols: str = "*") -> str:
    """Rows copied to every sliding window that contains them."""
    n = size // slide
    return (f"SELECT {cols}, ms - ms % {slide} - k * {slide} AS ws, "
            f"ms - ms % {slide} - k * {slide} + {size} AS we "
            f"FROM {src}, range(0, {n}) r(k)")


@register("win_slide_url_count", with_clicks(
    f'SELECT url, count(*) AS "count", ws AS windowStart, we AS windowEnd '
    f"FROM p GROUP BY url, ws, we",
    f"p AS ({panes_sql(P.URL_SIZE_MS, P.URL_STEP_MS)})"))
def win_slide_url_count(spark, sf_dir):
    """W4 (flagship): sliding 10 s / 5 s page views per url -> UrlViewCount."""
    return W.url_view_count(click_view(spark, sf_dir), P.URL_SIZE_MS, P.URL_STEP_MS)


@register("win_tumble_count", with_clicks(
    f'SELECT "user", count(*) AS "count", ms - ms % {P.TUMBLE_USER_MS} AS windowStart, '
    f"ms - ms % {P.TUMBLE_USER_MS} + {P.TUMBLE_USER_MS} AS windowEnd "
    f'FROM c GROUP BY ALL'))
def win_tumble_count(spark, sf_dir):
    """Tumbling 5 s clicks per user."""
    return W.tumbling_count(click_view(spark, sf_dir), "user", P.TUMBLE_USER_MS)


_PVUV_SQL = with_clicks(
    "SELECT count(*) AS pv, count(DISTINCT \"user\") AS uv, "
    "CAST(count(*) AS DOUBLE) / count(DISTINCT \"user\") AS avg_pv, "
    "ws AS windowStart, we AS windowEnd FROM p GROUP BY ws, we",
    f"p AS ({panes_sql(P.SLIDE_PVUV_SIZE_MS, P.SLIDE_PVUV_STEP_MS)})")


@register("win_slide_pv_uv", _PVUV_SQL)
def win_slide_pv_uv(spark, sf_dir):
    """Sliding 10 s / 2 s PV, UV and PV/UV over all clicks."""
    return W.pv_uv(click_view(spark, sf_dir), P.SLIDE_PVUV_SIZE_MS, P.SLIDE_PVUV_STEP_MS)


@register("win_slide_pv_uv_two_stage", _PVUV_SQL)
def win_slide_pv_uv_two_stage(spark, sf_dir):
    """W2, streaming-safe two-stage form (per window and user, then per window)."""
    return W.pv_uv_two_stage(click_view(spark, sf_dir), P.SLIDE_PVUV_SIZE_MS,
                             P.SLIDE_PVUV_STEP_MS)


@register("win_slide_pv_uv_panes", _PVUV_SQL)
def win_slide_pv_uv_panes(spark, sf_dir):
    """W2 by panes: distinct users as bitmaps that windows merge."""
    from clickspark.operators.distinct import pv_uv_panes
    return pv_uv_panes(click_view(spark, sf_dir), P.SLIDE_PVUV_SIZE_MS, P.SLIDE_PVUV_STEP_MS)


def _jts_sql(ms: str) -> str:
    return (f"regexp_replace(strftime(make_timestamp(({ms} + 28800000) * 1000), "
            "'%Y-%m-%d %H:%M:%S.%g'), '0{1,2}$', '')")


@register("win_uv", with_clicks(
    "SELECT uv, ws AS windowStart, ws + {s} AS windowEnd, '窗口: ' || {a} || ' ~ ' || {b} || "
    "' 的独立访客数量是：' || CAST(uv AS VARCHAR) AS message FROM (SELECT ms - ms % {s} AS ws, "
    'count(DISTINCT "user") AS uv FROM c GROUP BY 1)'.format(
        s=P.UV_SIZE_MS, a=_jts_sql("ws"), b=_jts_sql(f"ws + {P.UV_SIZE_MS}"))))
def win_uv(spark, sf_dir):
    """Distinct visitors per tumbling 10 s window, with the report line
    (bounds as Timestamp text in UTC+8)."""
    res = W.unique_visitors(click_view(spark, sf_dir), P.UV_SIZE_MS)
    return res.withColumn("message", W.uv_report("Asia/Shanghai"))


@register("udaf_pv_uv", with_clicks(
    "SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT \"user\") AS avg_pv, "
    "ws AS windowStart, we AS windowEnd FROM p GROUP BY ws, we",
    f"p AS ({panes_sql(P.SLIDE_PVUV_SIZE_MS, P.SLIDE_PVUV_STEP_MS)})"))
def udaf_pv_uv(spark, sf_dir):
    """PV/UV with a Python accumulator over sliding 10 s / 2 s windows: a
    fold over each window's sorted users, no set in memory."""
    from clickspark.operators.runs import PvUvRuns, aggregate_runs
    c = click_view(spark, sf_dir)
    win = W.window_col("ms", P.SLIDE_PVUV_SIZE_MS, P.SLIDE_PVUV_STEP_MS)
    panes = c.select(win.alias("w"), "user").select(*W.window_bounds("w"), "user")
    tot = aggregate_runs(panes, ["windowStart", "windowEnd"], "user", PvUvRuns())
    return tot.select((F.col("pv").cast("double") / F.col("uv").cast("double")).alias("avg_pv"),
                      "windowStart", "windowEnd")
