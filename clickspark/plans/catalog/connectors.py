"""Source and sink queries: S1, S3, S6, K2-K6."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickspark.model import MS_SQL, epoch_ms, load
from clickspark.operators import transforms as T
from clickspark.operators.watermark import watermark_after
from clickspark.plans import params as P
from clickspark.plans.catalog.common import click_view, event_cuts, with_clicks
from clickspark.plans.catalog.transforms import (CSV_LINES_SQL, ZONE, ZONE_MS, _parse_sql,
                                                  csv_lines, java_ts_sql)
from clickspark.plans.registry import register
from clickspark.session import shared_dir
from clickspark.sinks import failures as FP
from clickspark.sinks import writers as K
from clickspark.sources import generators as G


@register("src_click_gen", G.generator_sql("event_id", MS_SQL, "events"))
def src_click_gen(spark, sf_dir):
    """The click generator (4 users x 5 urls), one click per event id."""
    ev = load(spark, sf_dir, "events")
    return G.clicks_from_ids(ev, "event_id", epoch_ms("ts"))


@register("wm_emit_in_source", "WITH g AS (" + G.generator_sql(
    "event_id", MS_SQL, "events", G.USERS_3, G.URLS_3) + ") SELECT *, "
    "max(ms) OVER (ORDER BY seq) - 1 AS watermark FROM g")
def wm_emit_in_source(spark, sf_dir):
    """A source with 3 users x 3 urls that emits ``ts - 1`` as the
    watermark after each row; the watermark never moves back."""
    ev = load(spark, sf_dir, "events")
    g = G.clicks_from_ids(ev, "event_id", epoch_ms("ts"), G.USERS_3, G.URLS_3)
    return watermark_after(g, ["seq"], 0, width=event_cuts(spark, sf_dir))


@register("src_text_lines", _parse_sql(CSV_LINES_SQL, ","))
def src_text_lines(spark, sf_dir):
    """S3: read click lines from text files (written here from ``events``
    to the shared folder), then parse them."""
    path = shared_dir(spark, "clickspark", "lines")
    K.write_text(csv_lines(click_view(spark, sf_dir)).select(
        F.concat_ws("|", F.col("seq").cast("string"), "value").alias("value")), path,
        mode="overwrite")
    raw = G.text_lines(spark, path)
    parts = F.split(F.col("value"), r"\|", 2)
    lines = raw.select(parts.getItem(0).cast("long").alias("seq"), parts.getItem(1).alias("value"))
    return T.parse_lines(lines, ",", keep=("seq",))


@register("sink_file_roundtrip", with_clicks(
    "SELECT 'Event{user=''' || \"user\" || ''', url=''' || url || ''', ts=' || "
    f"{java_ts_sql('ms')} || '}}' AS value FROM c"))
def sink_file_roundtrip(spark, sf_dir):
    """K2: write Event.toString lines as UTF-8 text files (rolled at 1 GiB)
    and read them back."""
    path = shared_dir(spark, "clickspark", "events-text")
    K.write_text(K.event_lines(click_view(spark, sf_dir), ZONE), path,
                 max_bytes=K.ROLL_MAX_BYTES, mode="overwrite")
    return G.text_lines(spark, path)


@register("sink_kafka_payload", with_clicks(
    "SELECT 'clicks' AS topic, value FROM l", f"l AS ({CSV_LINES_SQL})"))
def sink_kafka_payload(spark, sf_dir):
    """K3: the records sent to topic ``clicks`` (string value, no key)."""
    return K.kafka_payload(csv_lines(click_view(spark, sf_dir)), "clicks")


@register("sink_upsert_latest", with_clicks(
    'SELECT "user", arg_max(url, seq) AS url FROM c GROUP BY 1'))
def sink_upsert_latest(spark, sf_dir):
    """K4: HSET clicks <user> <url>: the hash after all writes."""
    return K.latest_per_key(click_view(spark, sf_dir), "user", "url", "seq")


@register("sink_index_route", with_clicks(
    f"SELECT 'clicks-' || CASE WHEN ms > {P.NOW_MS} + 3600000 THEN '19700101' "
    f"ELSE strftime(make_timestamp((ms + {ZONE_MS}) * 1000), '%Y%m%d') END AS index_name, "
    "CAST(json_object('user', \"user\", 'url', url, 'ts', ms) AS VARCHAR) AS doc FROM c"))
def sink_index_route(spark, sf_dir):
    """K5/F8: each document and the day index it is written to."""
    return K.routed_documents(click_view(spark, sf_dir), "clicks", P.NOW_MS, ZONE)


# Failure cases derived from events: (superclasses, cause chain, message).
# The first name of each list is the exception's own class.
_BASE = ["ElasticsearchException", "RuntimeException"]
_CASES = [
    (_BASE, ["ElasticsearchException"],
     "ElasticsearchException[type=circuit_breaking_exception, reason=Data too large]"),
    (["ElasticsearchStatusException", *_BASE], ["ElasticsearchStatusException"],
     "type=mapper_parsing_exception, reason=failed to parse"),
    (_BASE, ["ElasticsearchException"],
     "ElasticsearchException[type=index_not_found_exception, reason=no such index]"),
    (_BASE, ["ElasticsearchException", "EsRejectedExecutionException"], "rejected execution of bulk"),
    (["IOException"], ["IOException", "java.net.SocketTimeoutException"], "30,000 milliseconds timeout"),
    (["ElasticsearchParseException", *_BASE], ["ElasticsearchParseException"], "failed to parse date"),
    (["ElasticsearchParseException", *_BASE], ["ElasticsearchParseException"],
     "parse failure type=mapper_parsing_exception"),
    (["RuntimeException"], ["RuntimeException"], "connection reset"),
    (["CircuitBreakingException", *_BASE], ["CircuitBreakingException"],
     "[parent] type=circuit_breaking_exception"),
    (["org.elasticsearch.ElasticsearchException", "java.lang.RuntimeException"],
     ["org.elasticsearch.ElasticsearchException"], "shard type=index_not_found_exception"),
]


def _failures_sql() -> str:
    def arr(xs):
        return "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    n = len(_CASES)

    def case(show):
        return f"CASE seq % {n} " + " ".join(
            f"WHEN {i} THEN {show(c)}" for i, c in enumerate(_CASES)) + " END"
    return (f"SELECT seq, {case(lambda c: repr(c[0][0]))} AS exception_class, "
            f"{case(lambda c: arr(c[0]))} AS supers, {case(lambda c: arr(c[1]))} AS causes, "
            f"({case(lambda c: repr(c[2]))}) || ' doc=' || CAST(seq AS VARCHAR) || ' ' || url "
            "AS message FROM c")


def _policy_sql() -> str:
    def named(classes, name):
        return (f"list_contains(list_transform({classes}, lambda x: string_split(x, '.')[-1]), "
                f"'{name}')")
    isb = named("supers", FP.BASE_EXCEPTION)
    return with_clicks(
        "SELECT seq, exception_class, message, reason, action FROM (SELECT *, "
        f"CASE WHEN {isb} AND instr(message, '{FP.CIRCUIT_BREAKING}') > 1 THEN 'circuit_breaking' "
        f"WHEN {isb} AND instr(message, '{FP.MAPPER_PARSING}') > 1 THEN 'mapper_parsing' "
        f"WHEN {isb} AND instr(message, '{FP.INDEX_NOT_FOUND}') > 1 THEN 'index_not_found' "
        f"WHEN {named('causes', FP.REJECTED)} THEN 'rejected' "
        f"WHEN {named('causes', FP.SOCKET_TIMEOUT)} THEN 'socket_timeout' "
        f"WHEN {named('causes', FP.PARSE_ERROR)} THEN 'parse_error' ELSE 'other' END AS reason "
        "FROM f) x JOIN (VALUES " + ", ".join(f"('{r}', '{a}')" for r, a in FP.RULES)
        + ") AS r(reason, action) USING (reason)", f"f AS ({_failures_sql()})")


@register("sink_failure_policy", _policy_sql())
def sink_failure_policy(spark, sf_dir):
    """Retry / drop / log decision for failed bulk requests."""
    c = click_view(spark, sf_dir)
    n = len(_CASES)
    k = F.col("seq") % n

    def pick(value):
        expr = None
        for j, case in enumerate(_CASES):
            expr = (F if expr is None else expr).when(k == j, value(case))
        return expr

    def names(classes):
        return F.array(*[F.lit(x) for x in classes])
    failures = c.select("seq", pick(lambda x: F.lit(x[0][0])).alias("exception_class"),
                        pick(lambda x: names(x[0])).alias("supers"),
                        pick(lambda x: names(x[1])).alias("causes"),
                        F.concat(pick(lambda x: F.lit(x[2])), F.lit(" doc="),
                                 F.col("seq").cast("string"), F.lit(" "),
                                 F.col("url")).alias("message"))
    return FP.apply_policy(failures).select("seq", "exception_class", "message", "reason", "action")


@register("sink_jdbc_rows", with_clicks(
    "SELECT \"user\", url, CASE WHEN \"user\" IS NULL THEN 'user is null' "
    "WHEN length(\"user\") > 20 THEN 'user is longer than 20' WHEN url IS NULL THEN 'url is null' "
    "WHEN length(url) > 100 THEN 'url is longer than 100' END AS reject_reason FROM j",
    "j AS (SELECT \"user\", CASE WHEN seq % 50 = 0 THEN repeat(url, 20) ELSE url END AS url FROM c)"))
def sink_jdbc_rows(spark, sf_dir):
    """K6: every row for ``clicks(user varchar(20) not null, url varchar(100)
    not null)`` and why it does not fit; every 50th url is stretched so some
    are rejected."""
    c = click_view(spark, sf_dir)
    j = c.select("user", F.when(F.col("seq") % 50 == 0, F.repeat(F.col("url"), 20))
                 .otherwise(F.col("url")).alias("url"))
    return K.jdbc_rows(j)
