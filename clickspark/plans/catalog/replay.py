"""Watermark / late-data / trigger / timer replays (W5, W6, W7, M1-M2, PF2).

In-order queries use ``seq = event_id`` as the arrival order.  Late-data
queries use the deterministic disorder of :func:`clickspark.model.disordered`
(arrival order ``(arr, seq)``).
"""

from __future__ import annotations

from clickspark.model import LONG_MAX, LONG_MIN, disordered, disordered_sql
from clickspark.operators import late as L
from clickspark.operators.timers import ARRIVED_TEXT, FIRED_TEXT, timer_replay
from clickspark.operators.triggers import early_firings
from clickspark.operators.watermark import watermark_after, watermark_before
from clickspark.plans import params as P
from clickspark.plans.catalog.common import click_view, event_cuts, with_clicks
from clickspark.plans.catalog.transforms import ZONE, java_ts_sql
from clickspark.plans.registry import register

ARRIVAL = ["arr", "seq"]
A_CTE = f"a AS ({disordered_sql('c')})"
PREV = "max(ms) OVER (ORDER BY arr, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def arriving(spark, sf_dir):
    return disordered(click_view(spark, sf_dir))


@register("wm_bounded", with_clicks(
    f"SELECT seq, arr, ms, CAST(coalesce({PREV} - {P.WM_DELAY_MS + 1}, {LONG_MIN}) AS BIGINT) "
    "AS watermark FROM a", A_CTE))
def wm_bounded(spark, sf_dir):
    """M1/M3: bounded out-of-orderness (5 s) watermark seen by each row."""
    a = arriving(spark, sf_dir).select("seq", "arr", "ms")
    return watermark_before(a, ARRIVAL, P.WM_DELAY_MS)


@register("wm_monotonous", with_clicks(
    "SELECT seq, ms, CAST(coalesce(max(ms) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING "
    f"AND 1 PRECEDING) - 1, {LONG_MIN}) AS BIGINT) AS watermark FROM c"))
def wm_monotonous(spark, sf_dir):
    """M2: monotonous timestamps watermark seen by each row."""
    c = click_view(spark, sf_dir).select("seq", "ms")
    return watermark_before(c, ["seq"], 0, width=event_cuts(spark, sf_dir))


@register("wm_punctuated", with_clicks(
    "SELECT seq, ms, max(ms) OVER (ORDER BY seq) - 1 AS watermark FROM c"))
def wm_punctuated(spark, sf_dir):
    """M4: the watermark ``ms - 1`` emitted after each click; it never moves
    back."""
    c = click_view(spark, sf_dir).select("seq", "ms")
    return watermark_after(c, ["seq"], 0, width=event_cuts(spark, sf_dir))


@register("wm_generator", with_clicks(
    "SELECT seq, arr, ms, CAST(coalesce(max(wm) OVER (ORDER BY arr, seq ROWS BETWEEN UNBOUNDED PRECEDING "
    f"AND 1 PRECEDING), {LONG_MIN}) AS BIGINT) AS watermark FROM e", A_CTE,
    f"e AS (SELECT *, CASE WHEN seq % 20 = 0 THEN max(ms) OVER (ORDER BY arr, seq) - {P.WM_DELAY_MS + 1} "
    "END AS wm FROM a)"))
def wm_generator(spark, sf_dir):
    """M3 by a generator of the user: the greatest event time less 5 s,
    emitted with every twentieth click."""
    from pyspark.sql import functions as F

    from clickspark.operators.generators import periodic, watermark_by
    a = arriving(spark, sf_dir).select("seq", "arr", "ms")
    return watermark_by(a, ARRIVAL, periodic(P.WM_DELAY_MS, F.col("seq") % 20 == 0))


def _classified_sql(size: int, delay: int, late: int) -> str:
    return (f"q AS (SELECT *, CASE WHEN prevmax IS NULL OR prevmax - {delay} < we THEN 'on_time' "
            f"WHEN prevmax - {delay} < we + {late} THEN 'refire' ELSE 'late' END AS cls FROM "
            f"(SELECT *, {PREV} AS prevmax, ms - ms % {size} AS ws, ms - ms % {size} + {size} AS we "
            "FROM a))")


_W5 = P.WM_WINDOW_MS, P.WM_DELAY_MS


@register("win_late_dropped", with_clicks(
    'SELECT "user", ws AS windowStart, we AS windowEnd, n AS "count", '
    f"CAST(coalesce(wm, {LONG_MAX}) AS BIGINT) AS watermark, "
    "'窗口' || ws || ' ~ ' || we || '中共有' || n || '个元素，窗口闭合计算时，水位线处于：' || "
    f"CAST(coalesce(wm, {LONG_MAX}) AS BIGINT) AS message FROM n LEFT JOIN m USING (we)",
    A_CTE, _classified_sql(*_W5, 0),
    "rm AS (SELECT max(ms) OVER (ORDER BY arr, seq) AS runmax FROM a)",
    "n AS (SELECT \"user\", ws, we, count(*) AS n FROM q WHERE cls = 'on_time' GROUP BY ALL)",
    f"m AS (SELECT we, (SELECT min(runmax) FROM rm WHERE runmax >= we + {_W5[1]}) - {_W5[1] + 1} "
    "AS wm FROM (SELECT DISTINCT we FROM n))"))
def win_late_dropped(spark, sf_dir):
    """Tumbling 10 s per user, 5 s bounded delay, late rows dropped; each
    window reports the watermark at which it closed."""
    return L.windows_with_watermark(arriving(spark, sf_dir), "user", ARRIVAL, *_W5)


def _on_close(pdf):
    """A window function in Python: the share of the window's clicks per
    second of event time and how far the watermark had run past its end."""
    size = (pdf["windowEnd"] - pdf["windowStart"]) / 1000
    closed = pdf["watermark"] != LONG_MAX
    behind = (pdf["watermark"] - pdf["windowEnd"] + 1).where(closed, -1)
    return pdf.assign(per_second=pdf["count"] / size, behind_ms=behind.astype("int64"))[
        ["url", "windowStart", "windowEnd", "count", "watermark", "per_second", "behind_ms"]]


@register("win_apply_udf", with_clicks(
    f'SELECT url, ws AS windowStart, we AS windowEnd, n AS "count", '
    f"CAST(coalesce(wm, {LONG_MAX}) AS BIGINT) AS watermark, n / {P.WM_WINDOW_MS / 1000} AS per_second, "
    "CAST(coalesce(wm - we + 1, -1) AS BIGINT) AS behind_ms FROM n LEFT JOIN m USING (we)",
    A_CTE, _classified_sql(*_W5, 0),
    "rm AS (SELECT max(ms) OVER (ORDER BY arr, seq) AS runmax FROM a)",
    "n AS (SELECT url, ws, we, count(*) AS n FROM q WHERE cls = 'on_time' GROUP BY ALL)",
    f"m AS (SELECT we, (SELECT min(runmax) FROM rm WHERE runmax >= we + {_W5[1]}) - {_W5[1] + 1} "
    "AS wm FROM (SELECT DISTINCT we FROM n))"))
def win_apply_udf(spark, sf_dir):
    """A Python window function that gets each closed window's key,
    bounds, incremental count and the watermark at its firing."""
    from clickspark.operators.windows import process_windows
    wins = L.windows_with_watermark(arriving(spark, sf_dir), "url", ARRIVAL, *_W5).drop("message")
    return process_windows(wins, _on_close, "url string, windowStart long, windowEnd long, count long, "
                                            "watermark long, per_second double, behind_ms long")


_W7 = P.LATE_WINDOW_MS, P.LATE_DELAY_MS, P.LATE_LATENESS_MS
_W7_CTES = (A_CTE, _classified_sql(*_W7))
_FIRINGS_SQL = (
    "SELECT url, ws AS windowStart, we AS windowEnd, 'first' AS kind, CAST(NULL AS BIGINT) AS seq, "
    "count(*) AS \"count\" FROM q WHERE cls = 'on_time' GROUP BY url, ws, we "
    "UNION ALL SELECT url, ws, we, 'refire', seq, cnt FROM (SELECT *, count(*) OVER "
    "(PARTITION BY url, ws ORDER BY arr, seq) AS cnt FROM q WHERE cls <> 'late') WHERE cls = 'refire'")


def _replay(spark, sf_dir):
    return L.lateness_replay(arriving(spark, sf_dir), "url", ARRIVAL, *_W7)


@register("late_firings", with_clicks(_FIRINGS_SQL, *_W7_CTES))
def late_firings(spark, sf_dir):
    """Tumbling 10 s per url, 2 s delay, 1 min allowed lateness: the
    first firing and one re-firing per late-but-allowed row."""
    return L.late_firings(_replay(spark, sf_dir), "url", ARRIVAL)


@register("late_final_counts", with_clicks(
    'SELECT url, ws AS windowStart, we AS windowEnd, count(*) AS "count" FROM q '
    "WHERE cls <> 'late' GROUP BY ALL", *_W7_CTES))
def late_final_counts(spark, sf_dir):
    """Each window's count at its last firing."""
    return L.final_counts(_replay(spark, sf_dir), "url")


@register("late_side_output", with_clicks(
    "SELECT seq, \"user\", url, ms FROM q WHERE cls = 'late'", *_W7_CTES))
def late_side_output(spark, sf_dir):
    """Rows past the allowed lateness, in their own output."""
    return L.late_side_output(_replay(spark, sf_dir), ["seq", "user", "url", "ms"])


@register("late_tagged_union", with_clicks(
    "SELECT 'input' AS tag, seq, \"user\", url, ms, NULL::BIGINT AS windowStart, "
    "NULL::BIGINT AS windowEnd, NULL::VARCHAR AS kind, NULL::BIGINT AS \"count\" FROM a "
    "UNION ALL SELECT 'result', seq, NULL, url, NULL, windowStart, windowEnd, kind, \"count\" "
    f"FROM ({_FIRINGS_SQL}) "
    "UNION ALL SELECT 'late', seq, \"user\", url, ms, NULL, NULL, NULL, NULL FROM q WHERE cls = 'late'",
    *_W7_CTES))
def late_tagged_union(spark, sf_dir):
    """Input, result and late outputs of one job, tagged."""
    rep = _replay(spark, sf_dir)
    inputs = arriving(spark, sf_dir).select("seq", "user", "url", "ms")
    return L.tagged_union(inputs, L.late_firings(rep, "url", ARRIVAL),
                          L.late_side_output(rep, ["seq", "user", "url", "ms"]))


_W6 = P.TRIGGER_WINDOW_MS, P.TRIGGER_STEP_MS
_W6_SQL = with_clicks(
    'SELECT f.url, f.ws AS windowStart, f.we AS windowEnd, f.timer, f.fire_seq AS fired_at, '
    'count(*) AS "count" FROM f '
    "JOIN p ON p.url = f.url AND p.ws = f.ws AND (f.fire_seq IS NULL OR p.seq <= f.fire_seq) "
    "GROUP BY f.url, f.ws, f.we, f.timer, f.fire_seq",
    f"p AS (SELECT *, ms - ms % {_W6[0]} AS ws, ms - ms % {_W6[0]} + {_W6[0]} AS we, "
    "max(ms) OVER (ORDER BY seq) AS runmax FROM c)",
    "g AS (SELECT url, ws, we, min(seq) AS first_seq FROM p GROUP BY ALL)",
    f"t AS (SELECT url, ws, we, first_seq, unnest(list_append(range(ws, we, {_W6[1]}), we - 1)) "
    "AS timer FROM g)",
    "x AS (SELECT runmax, min(seq) AS seq FROM p GROUP BY runmax)",
    "f AS (SELECT t.*, CASE WHEN x.seq IS NOT NULL THEN greatest(x.seq, t.first_seq) END AS fire_seq "
    "FROM t ASOF LEFT JOIN x ON t.timer + 1 <= x.runmax)")


@register("win_trigger_early", _W6_SQL)
def win_trigger_early(spark, sf_dir):
    """Tumbling 10 s per url with a trigger that fires every 1 s of
    event time (timers registered on the window's first row)."""
    c = click_view(spark, sf_dir)
    return early_firings(c, "url", "seq", *_W6, width=event_cuts(spark, sf_dir))


@register("win_trigger_purge",
          "WITH e AS (" + _W6_SQL + ") SELECT url, windowStart, windowEnd, timer, fired_at, "
          "\"count\" FROM (SELECT url, windowStart, windowEnd, timer, fired_at, "
          "\"count\" - lag(\"count\", 1, 0) OVER "
          "(PARTITION BY url, windowStart ORDER BY timer) AS \"count\" FROM e) WHERE \"count\" > 0")
def win_trigger_purge(spark, sf_dir):
    """ST2: the same trigger answering FIRE_AND_PURGE: rows since the last firing."""
    c = click_view(spark, sf_dir)
    return early_firings(c, "url", "seq", *_W6, width=event_cuts(spark, sf_dir),
                         purge=True)


@register("timer_replay", with_clicks(
    f"SELECT key, kind, at_ms, CASE kind WHEN 'arrival' THEN '{ARRIVED_TEXT}' ELSE '{FIRED_TEXT}' "
    f"END || {java_ts_sql('at_ms')} AS message FROM (SELECT 'true' AS key, 'arrival' AS kind, "
    f"ms AS at_ms FROM c UNION ALL SELECT DISTINCT 'true', 'timer', ms + {P.TIMER_DELAY_MS} FROM c)"))
def timer_replay_q(spark, sf_dir):
    """PF2: one key; each arrival registers a processing-time timer 5 s later."""
    c = click_view(spark, sf_dir)
    return timer_replay(c, "ms", P.TIMER_DELAY_MS, zone=ZONE)

