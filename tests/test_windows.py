"""W1-W4, W8, W9 against the reference's window transcripts (original durations)."""

from clickspark.operators import udaf as U
from clickspark.operators import windows as W
from helpers import clicks, ms_of


def _rows(day, spec):
    return [(u, url, ms_of(f"{day} {t}")) for t, u, url in spec]


# Fixed values below: the transcripts' input rows and printed results.
W1 = _rows("2022-05-11", [
    ("20:12:45.374", "Alice", "./home"), ("20:12:46.378", "Cary", "./cart"),
    ("20:12:47.388", "Mary", "./prod?id=1"), ("20:12:48.393", "Bob", "./home"),
    ("20:12:49.397", "Mary", "./fav"), ("20:12:50.407", "Alice", "./home"),
    ("20:12:51.41", "Cary", "./prod?id=2"), ("20:12:52.412", "Bob", "./home"),
    ("20:12:53.422", "Cary", "./prod?id=2"), ("20:12:54.434", "Alice", "./fav"),
    ("20:12:55.438", "Bob", "./prod?id=2"), ("20:12:56.448", "Bob", "./fav"),
    ("20:12:57.449", "Bob", "./prod?id=1"), ("20:12:58.456", "Alice", "./home"),
    ("20:12:59.465", "Alice", "./prod?id=2")])


def test_tumbling_count_per_user(spark):
    res = W.tumbling_count(clicks(spark, W1), "user", 5000)
    got = {}
    for r in res.collect():
        got.setdefault(r.windowStart, {})[r.user] = r["count"]
    starts = sorted(got)
    assert [got[s] for s in starts] == [
        {"Alice": 1, "Cary": 1, "Bob": 1, "Mary": 2},
        {"Alice": 2, "Cary": 2, "Bob": 1},
        {"Bob": 3, "Alice": 2}]


W2 = _rows("2022-05-11", [
    ("20:45:56.127", "Alice", "./cart"), ("20:45:57.148", "Alice", "./prod?id=2"),
    ("20:45:58.15", "Mary", "./prod?id=1"), ("20:45:59.159", "Alice", "./prod?id=1"),
    ("20:46:00.167", "Alice", "./fav"), ("20:46:01.169", "Bob", "./prod?id=2"),
    ("20:46:02.179", "Mary", "./fav"), ("20:46:03.186", "Alice", "./home"),
    ("20:46:04.193", "Cary", "./prod?id=1"), ("20:46:05.202", "Alice", "./prod?id=2")])
W2_FIRST = [2.0, 2.0, 2.0, 2.6666666666666665, 2.5]


def test_sliding_pv_uv_all_forms(spark):
    c = clicks(spark, W2)
    for res in (W.pv_uv(c, 10000, 2000), W.pv_uv_two_stage(c, 10000, 2000)):
        got = [r.avg_pv for r in res.orderBy("windowEnd").collect()]
        assert got[:5] == W2_FIRST
        assert len(got) == 9          # the bounded input closes 4 more windows
    acc = U.aggregate_with(c.select(*W.window_bounds_from("ms", 10000, 2000), "user"),
                           ["windowStart", "windowEnd"], U.PvUv(), {"pv": "long", "uv": "long"},
                           max_rows=3)
    assert [r.pv / r.uv for r in acc.orderBy("windowEnd").collect()][:5] == W2_FIRST
    col = U.avg_pv().apply(c.select(*W.window_bounds_from("ms", 10000, 2000), "user"),
                           ["windowStart", "windowEnd"], "avg_pv")
    assert [r.avg_pv for r in col.orderBy("windowEnd").collect()][:5] == W2_FIRST


W3 = _rows("2022-05-12", [
    ("09:49:11.831", "Cary", "./cart"), ("09:49:12.831", "Alice", "./prod?id=1"),
    ("09:49:13.831", "Bob", "./fav"), ("09:49:14.841", "Bob", "./fav"),
    ("09:49:15.841", "Alice", "./home"), ("09:49:16.851", "Cary", "./prod?id=1"),
    ("09:49:17.853", "Bob", "./prod?id=1"), ("09:49:18.853", "Cary", "./home"),
    ("09:49:19.863", "Alice", "./prod?id=1"), ("09:49:20.873", "Alice", "./prod?id=2"),
    ("09:49:21.873", "Bob", "./prod?id=1"), ("09:49:22.883", "Bob", "./fav"),
    ("09:49:23.883", "Cary", "./cart"), ("09:49:24.884", "Mary", "./home"),
    ("09:49:25.893", "Alice", "./prod?id=1"), ("09:49:26.896", "Cary", "./prod?id=1"),
    ("09:49:27.905", "Mary", "./home"), ("09:49:28.905", "Mary", "./prod?id=2"),
    ("09:49:29.915", "Alice", "./fav"), ("09:49:30.925", "Mary", "./cart")])


def test_unique_visitors(spark):
    res = W.unique_visitors(clicks(spark, W3), 10000).orderBy("windowStart").collect()
    assert [r.uv for r in res] == [3, 4, 1]
    assert res[0].windowStart == ms_of("2022-05-12 09:49:10.000")
    approx = W.unique_visitors(clicks(spark, W3), 10000, approx=True).orderBy("windowStart")
    assert [r.uv for r in approx.collect()] == [3, 4, 1]


W4 = _rows("2022-05-12", [
    ("14:08:16.227", "Bob", "./prod?id=1"), ("14:08:17.227", "Cary", "./prod?id=1"),
    ("14:08:18.227", "Bob", "./fav"), ("14:08:19.23", "Mary", "./cart"),
    ("14:08:20.237", "Mary", "./fav"), ("14:08:21.237", "Mary", "./home"),
    ("14:08:22.237", "Cary", "./cart"), ("14:08:23.246", "Mary", "./fav"),
    ("14:08:24.246", "Bob", "./fav"), ("14:08:25.256", "Mary", "./cart"),
    ("14:08:26.256", "Mary", "./prod?id=1"), ("14:08:27.256", "Mary", "./home"),
    ("14:08:28.257", "Cary", "./prod?id=2"), ("14:08:29.257", "Mary", "./home"),
    ("14:08:30.258", "Mary", "./cart"), ("14:08:31.258", "Bob", "./cart"),
    ("14:08:32.258", "Alice", "./prod?id=1"), ("14:08:33.268", "Bob", "./prod?id=1"),
    ("14:08:34.268", "Mary", "./fav")])


def test_url_view_count_transcript(spark):
    res = W.url_view_count(clicks(spark, W4), 10000, 5000).collect()
    by_end = {}
    for r in res:
        by_end.setdefault(r.windowEnd, {})[r.url] = r["count"]
    t = ms_of
    assert by_end[t("2022-05-12 14:08:20.000")] == {"./prod?id=1": 2, "./fav": 1, "./cart": 1}
    assert by_end[t("2022-05-12 14:08:25.000")] == {"./cart": 2, "./prod?id=1": 2, "./fav": 4,
                                                    "./home": 1}
    assert by_end[t("2022-05-12 14:08:30.000")] == {"./home": 3, "./fav": 3, "./prod?id=2": 1,
                                                    "./cart": 2, "./prod?id=1": 1}
    assert by_end[t("2022-05-12 14:08:35.000")] == {"./cart": 3, "./prod?id=2": 1, "./fav": 1,
                                                    "./prod?id=1": 3, "./home": 2}


def test_process_windows_sees_context(spark):
    agg = W.url_view_count(clicks(spark, W4), 10000, 5000)

    def fn(pdf):
        return pdf.assign(span=pdf["windowEnd"] - pdf["windowStart"])
    out = W.process_windows(agg, fn, "url string, count long, windowStart long, "
                                     "windowEnd long, span long")
    assert {r.span for r in out.collect()} == {10000}


def test_uv_report_text(spark):
    res = W.unique_visitors(clicks(spark, W3), 10000).withColumn("m", W.uv_report("Asia/Shanghai"))
    first = res.orderBy("windowStart").collect()[0].m
    assert first == "窗口: 2022-05-12 09:49:10.0 ~ 2022-05-12 09:49:20.0 的独立访客数量是：3"


def test_panes_with_bitmaps_of_more_users_than_a_bucket(spark):
    """Null users, a hot user, more users than one bitmap holds."""
    from pyspark.sql import functions as F

    from clickspark.operators.distinct import dense_numbers, pv_uv_panes
    n = 90_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("u"), (F.col("id") % 40_000).cast("string"))).alias("user"),
        (F.col("id") * 7 % 60_000).alias("ms"))
    numbers = [r.number for r in dense_numbers(df, "user").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1)) and len(numbers) > 32_768 / 2
    for size, slide in ((10_000, 2_000), (10_000, None)):
        got = {tuple(r) for r in pv_uv_panes(df, size, slide).select("pv", "uv", "windowStart").collect()}
        want = {tuple(r) for r in W.pv_uv(df, size, slide).select("pv", "uv", "windowStart").collect()}
        assert got == want
    nobody = df.where("user is null")
    row = pv_uv_panes(nobody, 60_000).first()
    assert row.uv == 0 and row.avg_pv is None and row.pv == nobody.count()
    assert pv_uv_panes(df.limit(0), 10_000, 2_000).count() == 0


def test_runs_fold_sorted_elements_in_bounded_pieces(spark):
    """A user's aggregate that needs the order of the distinct elements, over
    Arrow batches far smaller than a group; null keys and elements."""
    from clickspark.operators.runs import PvUvRuns, RunAggregate, aggregate_runs

    class Gaps(RunAggregate):
        """Least and greatest element, how many, and the most rows of one."""

        state = "low long, high long, n long, most long"

        def fold(self, elements, counts):
            known = elements.dropna()
            assert known.is_monotonic_increasing and known.is_unique and len(elements) <= 16
            return {"low": known.min() if len(known) else None, "high": known.max() if len(known) else None,
                    "n": len(known), "most": int(counts.max())}

        def merge(self, a, b):
            low, high = ([x for x in (a[k], b[k]) if x is not None] for k in ("low", "high"))
            return {"low": min(low, default=None), "high": max(high, default=None), "n": a["n"] + b["n"],
                    "most": max(a["most"], b["most"])}
    rows = [(None if i % 11 == 0 else "hot" if i % 3 else "b", None if i % 17 == 0 else i * 7 % 400)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = {r.k: (r.low, r.high, r.n, r.most) for r in aggregate_runs(df, ["k"], "v", Gaps(), 3).collect()}
        pv = {r.k: (r.pv, r.uv) for r in aggregate_runs(df, ["k"], "v", PvUvRuns()).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in (None, "hot", "b"):
        own = [v for key, v in rows if key == k]
        some = [v for v in own if v is not None]
        assert got[k] == (min(some), max(some), len(set(some)), max(own.count(v) for v in set(own)))
        assert pv[k] == (len(own), len(set(some)))
    assert aggregate_runs(df.limit(0), ["k"], "v", PvUvRuns()).count() == 0
