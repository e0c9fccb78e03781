"""Row-wise queries: T1-T7, F1-F8 over the click view of ``events``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.functions import scalars as S
from clickspark.model import LONG_MIN
from clickspark.operators import transforms as T
from clickspark.operators import windows as W
from clickspark.operators.watermark import watermark_before
from clickspark.plans import params as P
from clickspark.plans.catalog.common import click_view, event_cuts, with_clicks
from clickspark.plans.registry import register

ZONE = "Asia/Shanghai"       # UTC+8 all year since 1991, as in the transcripts
ZONE_MS = 8 * 3600 * 1000    # the same offset for the DuckDB oracles
_TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$'"


def local_sql(ms: str) -> str:
    return f"make_timestamp(({ms} + {ZONE_MS}) * 1000)"


def java_ts_sql(ms: str) -> str:
    return f"regexp_replace(strftime({local_sql(ms)}, '%Y-%m-%d %H:%M:%S.%g'), '0{{1,2}}$', '')"


def csv_lines(c: DataFrame) -> DataFrame:
    """``user, url,<TAB>ms`` lines with some leading blanks, control
    characters and extra fields, derived row by row from the clicks."""
    pre = F.when(F.col("seq") % 3 == 0, F.lit(" \t")).otherwise(F.lit(""))
    post = (F.when(F.col("seq") % 5 == 0, F.lit(", extra"))
             .when(F.col("seq") % 7 == 0, F.lit("\u0001")).otherwise(F.lit("")))
    line = F.concat(pre, F.col("user"), F.lit(", "), F.col("url"), F.lit(",\t"),
                    F.col("ms").cast("string"), post)
    return c.select("seq", line.alias("value"))


CSV_LINES_SQL = ("SELECT seq, CASE WHEN seq % 3 = 0 THEN ' ' || chr(9) ELSE '' END || \"user\" || ', ' "
                 "|| url || ',' || chr(9) || CAST(ms AS VARCHAR) || CASE WHEN seq % 5 = 0 THEN ', extra' "
                 "WHEN seq % 7 = 0 THEN chr(1) ELSE '' END AS value FROM c")


def space_lines(c: DataFrame) -> DataFrame:
    """``user, url, ms`` lines split on single spaces (fields keep commas)."""
    return c.select("seq", F.concat_ws(", ", "user", "url", F.col("ms").cast("string")).alias("value"))


@register("map_user", with_clicks('SELECT "user" AS value FROM c'))
def map_user(spark, sf_dir):
    """Map each click to its user."""
    return T.map_user(click_view(spark, sf_dir))


@register("filter_user", with_clicks(f"SELECT * FROM c WHERE \"user\" = '{P.MARY}'"))
def filter_user(spark, sf_dir):
    """Keep one user's clicks."""
    return T.filter_user(click_view(spark, sf_dir, [P.MARY]), P.MARY)


@register("flatmap_user_url", with_clicks(
    f"SELECT \"user\" AS value FROM c WHERE \"user\" IN ('{P.MARY}', '{P.BOB}') "
    f"UNION ALL SELECT url FROM c WHERE \"user\" = '{P.BOB}'"))
def flatmap_user_url(spark, sf_dir):
    """One user -> [user]; another -> [user, url]; others -> nothing."""
    return T.flatmap_user_url(click_view(spark, sf_dir, [P.MARY, P.BOB]), P.MARY, P.BOB)


@register("map_pair", with_clicks('SELECT "user" AS f0, CAST(1 AS BIGINT) AS f1 FROM c'))
def map_pair(spark, sf_dir):
    """T4: (user, 1L) pairs with a declared type."""
    return T.map_pair(click_view(spark, sf_dir))


def _parse_sql(lines_sql: str, sep: str) -> str:
    f = f"string_split(value, '{sep}')"
    def fld(i: int) -> str:
        return f"regexp_replace({f}[{i}], {_TRIM}, '', 'g')"
    return with_clicks(f'SELECT seq, {fld(1)} AS "user", {fld(2)} AS url, '
                       f"CAST({fld(3)} AS BIGINT) AS ms FROM l", f"l AS ({lines_sql})")


@register("parse_click_csv", _parse_sql(CSV_LINES_SQL, ","))
def parse_click_csv(spark, sf_dir):
    """T5/F1: parse ``user, url, ms`` lines (Java trim, extra fields ignored)."""
    return T.parse_lines(csv_lines(click_view(spark, sf_dir)), ",", keep=("seq",))


@register("parse_click_space", _parse_sql(
    "SELECT seq, \"user\" || ', ' || url || ', ' || CAST(ms AS VARCHAR) AS value FROM c", " "))
def parse_click_space(spark, sf_dir):
    """T5/F2: parse lines split on single spaces; fields keep trailing commas."""
    return T.parse_lines(space_lines(click_view(spark, sf_dir)), " ", keep=("seq",))


def _emit_ms(pdf: pd.DataFrame, ctx) -> pd.DataFrame:
    return pd.DataFrame({"seq": pdf["seq"], "value": pdf["ms"]})


@register("rich_map_timestamp", with_clicks("SELECT seq, ms AS value FROM c"))
def rich_map_timestamp(spark, sf_dir):
    """Rich map (per-task open/close) emitting each click's timestamp."""
    return T.rich_map(click_view(spark, sf_dir).select("seq", "ms"), _emit_ms,
                      "seq long, value long", open_fn=lambda pid: {"task": pid},
                      close_fn=lambda pid, ctx: None)


@register("process_expand", with_clicks(
    f"SELECT \"user\" AS value FROM c WHERE \"user\" IN ('{P.MARY}', '{P.BOB}') "
    f"UNION ALL SELECT \"user\" FROM c WHERE \"user\" = '{P.BOB}'"))
def process_expand(spark, sf_dir):
    """T7/PF1: process function: one user once, another twice, others never."""
    c = click_view(spark, sf_dir, [P.MARY, P.BOB])
    n = (F.when(F.col("user") == P.MARY, 1).when(F.col("user") == P.BOB, 2).otherwise(0))
    return T.repeat_by(c, n, "user")


@register("process_watermark", with_clicks(
    "SELECT seq, \"user\", CAST(coalesce(max(ms) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED "
    f"PRECEDING AND 1 PRECEDING) - 1, {LONG_MIN}) AS BIGINT) AS watermark FROM c"))
def process_watermark(spark, sf_dir):
    """M5/PF1: the current watermark seen by a process function for each row
    (monotonous timestamps, in-order arrival)."""
    c = click_view(spark, sf_dir).select("seq", "user", "ms")
    wm = watermark_before(c, ["seq"], 0, width=event_cuts(spark, sf_dir))
    return wm.select("seq", "user", "watermark")


@register("event_json", with_clicks(
    "SELECT seq, CAST(json_object('user', \"user\", 'url', url, 'ts', ms) AS VARCHAR) AS doc FROM c"))
def event_json(spark, sf_dir):
    """Event.toJson -> {"user","url","ts"}."""
    return click_view(spark, sf_dir).select("seq", S.event_json().alias("doc"))


@register("event_string", with_clicks(
    "SELECT seq, 'Event{user=''' || \"user\" || ''', url=''' || url || ''', ts=' || "
    f"{java_ts_sql('ms')} || '}}' AS value FROM c"))
def event_string(spark, sf_dir):
    """Event.toString with java.sql.Timestamp text (UTC+8)."""
    return click_view(spark, sf_dir).select("seq", S.event_string(zone=ZONE).alias("value"))


def _url_view_sql(size: int, slide: int, col: str) -> str:
    from clickspark.plans.catalog.windows import panes_sql
    return with_clicks(
        'SELECT url, count(*) AS "count", ws AS windowStart, we AS windowEnd, '
        f"'UrlViewCount{{url=''' || url || ''', count=' || CAST(count(*) AS VARCHAR) || "
        f"', windowStart=' || {java_ts_sql('ws')} || ', windowEnd=' || {java_ts_sql('we')} || '}}' "
        f"AS {col} FROM p GROUP BY url, ws, we", f"p AS ({panes_sql(size, slide)})")


@register("url_view_string", _url_view_sql(P.URL_SIZE_MS, P.URL_STEP_MS, "value"))
def url_view_string(spark, sf_dir):
    """UrlViewCount.toString of the flagship's windows (UTC+8)."""
    res = W.url_view_count(click_view(spark, sf_dir), P.URL_SIZE_MS, P.URL_STEP_MS)
    return res.withColumn("value", S.url_view_string(zone=ZONE))


@register("hour_format_parse", with_clicks(
    f"SELECT seq, strftime({local_sql('ms')}, '%Y%m%d %H') AS hour, "
    f"strftime({local_sql('ms')}, '%Y%m%d') AS day, "
    f"epoch_ms(strptime(strftime({local_sql('ms')}, '%Y%m%d %H'), '%Y%m%d %H')) - {ZONE_MS} "
    "AS hour_ms FROM c"))
def hour_format_parse(spark, sf_dir):
    """``yyyyMMdd HH`` text of each click, its day, and the hour parsed back."""
    c = click_view(spark, sf_dir)
    h = S.hour_text("ms", ZONE)
    return c.select("seq", h.alias("hour"), S.day_of("ms", ZONE).alias("day"),
                    S.parse_hour(h, ZONE).alias("hour_ms"))
