"""F3-F8 formats and routing, K5c failure policy."""

from pyspark.sql import functions as F

from clickspark.functions import scalars as S
from clickspark.sinks import failures as FP
from helpers import clicks, ms_of


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0].x


def test_java_timestamp_text(spark):
    zone = "Asia/Shanghai"
    assert one(spark, S.java_timestamp(F.lit(1000), zone)) == "1970-01-01 08:00:01.0"
    assert one(spark, S.java_timestamp(F.lit(ms_of("2022-04-28 10:47:37.630")), zone)) == \
        "2022-04-28 10:47:37.63"
    assert one(spark, S.java_timestamp(F.lit(ms_of("2022-05-12 15:07:54.700")), zone)) == \
        "2022-05-12 15:07:54.7"


def test_event_string_and_json(spark):
    c = clicks(spark, [("Mary", "./home", 1000), (None, "./x", 2000)])
    got = [r.s for r in c.select(S.event_string(zone="Asia/Shanghai").alias("s")).collect()]
    assert got == ["Event{user='Mary', url='./home', ts=1970-01-01 08:00:01.0}",
                   "Event{user='null', url='./x', ts=1970-01-01 08:00:02.0}"]
    js = [r.j for r in c.select(S.event_json().alias("j")).collect()]
    assert js == ['{"user":"Mary","url":"./home","ts":1000}', '{"url":"./x","ts":2000}']


def test_url_view_string(spark):
    df = spark.createDataFrame([("./home", 3, 0, 10000)],
                               "url string, count long, windowStart long, windowEnd long")
    s = df.select(S.url_view_string(zone="Asia/Shanghai").alias("s")).collect()[0].s
    assert s == ("UrlViewCount{url='./home', count=3, windowStart=1970-01-01 08:00:00.0, "
                 "windowEnd=1970-01-01 08:00:10.0}")


def test_hour_format_and_index_route(spark):
    zone = "Asia/Shanghai"
    t = ms_of("2022-05-12 09:49:11.831")
    assert one(spark, S.hour_text(F.lit(t), zone)) == "20220512 09"
    assert one(spark, S.parse_hour(F.lit("20220512 09"), zone)) == ms_of("2022-05-12 09:00:00.000")
    now = ms_of("2022-05-12 10:00:00.000")
    assert one(spark, S.index_name("clicks", F.lit(t), now, zone)) == "clicks-20220512"
    assert one(spark, S.index_name("clicks", F.lit(now + 3_600_000), now, zone)) == "clicks-20220512"
    assert one(spark, S.index_name("clicks", F.lit(now + 3_600_001), now, zone)) == "clicks-19700101"
    assert one(spark, S.index_name("clicks", F.lit(None).cast("long"), now, zone)) == "clicks-19700101"


def test_failure_policy_rules(spark):
    base = [FP.BASE_EXCEPTION, "RuntimeException"]
    parse = [FP.PARSE_ERROR, *base]
    rows = [
        (base, [FP.BASE_EXCEPTION], f"x {FP.CIRCUIT_BREAKING}"),
        (["CircuitBreakingException", *base], ["CircuitBreakingException"], f"x {FP.CIRCUIT_BREAKING}"),
        (["org.store." + FP.BASE_EXCEPTION], ["org.store." + FP.BASE_EXCEPTION], f"x {FP.INDEX_NOT_FOUND}"),
        (base, [FP.BASE_EXCEPTION], FP.CIRCUIT_BREAKING),
        (parse, [FP.PARSE_ERROR], f"a {FP.MAPPER_PARSING}"),
        (base, [FP.BASE_EXCEPTION], f"a {FP.INDEX_NOT_FOUND}"),
        (["X"], ["X", FP.REJECTED], "queue full"),
        (["IOException"], ["IOException", "java.net." + FP.SOCKET_TIMEOUT], "timeout"),
        (parse, [FP.PARSE_ERROR], "bad"),
        (["RuntimeException"], ["RuntimeException"], None),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "supers array<string>, causes array<string>, message string")
    got = [(r.reason, r.action) for r in FP.apply_policy(df).collect()]
    assert got == [("circuit_breaking", "retry"), ("circuit_breaking", "retry"),
                   ("index_not_found", "retry"), ("other", "drop"), ("mapper_parsing", "drop"),
                   ("index_not_found", "retry"), ("rejected", "retry"), ("socket_timeout", "log"),
                   ("parse_error", "drop"), ("other", "drop"), ("other", "drop")]
    assert [FP.decide(*r) for r in rows] == got
    assert FP.dead_letters(FP.apply_policy(df)).count() == 5
