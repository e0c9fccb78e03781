"""Watermarks, late data, early-firing trigger, timers: the reference's
transcripts with their original durations."""

from pyspark.sql import functions as F

from clickspark.model import LONG_MAX, LONG_MIN
from clickspark.operators import late as L
from clickspark.operators.timers import timer_replay
from clickspark.operators.triggers import early_firings
from clickspark.operators.watermark import watermark_after, watermark_before
from helpers import clicks, ms_of

# Fixed values in the tests below: the transcripts' input rows and printed
# results.


def test_process_function_watermark(spark):
    ts = ["16:51:28.593", "16:51:29.594", "16:51:30.594", "16:51:31.594", "16:51:32.604",
          "16:51:33.604", "16:51:34.604"]
    users = ["Mary", "Mary", "Bob", "Alice", "Mary", "Cary", "Bob"]
    c = clicks(spark, [(u, "./x", ms_of(f"2022-05-12 {t}")) for u, t in zip(users, ts)])
    for width in (3, None):
        wm = watermark_before(c, ["seq"], 0, width=width).orderBy("seq").collect()
        assert [r.watermark for r in wm] == [LONG_MIN, 1652345488592, 1652345489593,
                                             1652345490593, 1652345491593, 1652345492603,
                                             1652345493603]
    after = watermark_after(clicks(spark, [("a", "x", 5), ("a", "x", 3), ("a", "x", 9)]),
                            ["seq"], 0, width=2).orderBy("seq")
    assert [r.watermark for r in after.collect()] == [4, 4, 8]


def test_late_rows_dropped_and_close_watermark(spark):
    rows = [("Alice", "./home", 1000), ("Alice", "./cart", 2000), ("Alice", "./prod?id=100", 10000),
            ("Alice", "./prod?id=200", 8000), ("Alice", "./prod?id=300", 15000),
            ("Alice", "./prod?id=200", 9000)]
    c = clicks(spark, rows)
    for width in (2, None):
        res = L.windows_with_watermark(c, "user", ["seq"], 10000, 5000, width=width)
        got = sorted((r.windowStart, r.windowEnd, r["count"], r.watermark) for r in res.collect())
        assert got == [(0, 10000, 3, 9999), (10000, 20000, 2, LONG_MAX)]
        first = res.where(F.col("windowStart") == 0).collect()[0].message
        assert first == "窗口0 ~ 10000中共有3个元素，窗口闭合计算时，水位线处于：9999"


ALLOWED = [("./home", 1000), ("./home", 2000), ("./home", 10000), ("./home", 9000),
           ("./cart", 12000), ("./prod?id=100", 15000), ("./home", 9000), ("./home", 8000),
           ("./prod?id=200", 70000), ("./home", 8000), ("./prod?id=300", 72000),
           ("./home", 8000)]


def test_allowed_lateness_refires_and_side_output(spark):
    c = clicks(spark, [("Alice", u, m) for u, m in ALLOWED])
    for width in (5, None):
        rep = L.lateness_replay(c, "url", ["seq"], 10000, 2000, 60000, width=width)
        fir = L.late_firings(rep, "url", ["seq"]).collect()
        home0 = sorted((r.seq if r.seq is not None else -1, r["count"]) for r in fir
                       if r.url == "./home" and r.windowStart == 0)
        assert [n for _, n in home0] == [3, 4, 5, 6]
        second = {r.url: r["count"] for r in fir if r.windowStart == 10000}
        assert second == {"./home": 1, "./cart": 1, "./prod?id=100": 1}
        late = L.late_side_output(rep, ["seq", "url", "ms"]).collect()
        assert [(r.seq, r.url, r.ms) for r in late] == [(11, "./home", 8000)]
        final = {(r.url, r.windowStart): r["count"] for r in L.final_counts(rep, "url").collect()}
        assert final[("./home", 0)] == 6
        tagged = L.tagged_union(c, L.late_firings(rep, "url", ["seq"]), L.late_side_output(
            rep, ["seq", "user", "url", "ms"]))
        tags = {r.tag: r["n"] for r in tagged.groupBy("tag").agg(F.count("*").alias("n")).collect()}
        assert tags == {"input": 12, "result": 9, "late": 1}


TRIGGER = [("Cary", "./fav", "15:07:50.677"), ("Mary", "./cart", "15:07:51.688"),
           ("Cary", "./prod?id=1", "15:07:52.689"), ("Alice", "./prod?id=1", "15:07:53.69"),
           ("Bob", "./prod?id=2", "15:07:54.7"), ("Cary", "./home", "15:07:55.709")]


def test_early_firing_trigger_transcript(spark):
    c = clicks(spark, [(u, l, ms_of(f"2022-05-12 {t}")) for u, l, t in TRIGGER])
    for width in (2, None):
        res = early_firings(c, "url", "seq", 10000, 1000, width=width).collect()
        per_row = [sum(1 for r in res if r.fired_at == i) for i in range(6)]
        assert per_row == [1, 3, 5, 3, 8, 10]
        at3 = sorted((r.url, r["count"]) for r in res if r.fired_at == 3)
        assert at3 == [("./cart", 1), ("./fav", 1), ("./prod?id=1", 2)]
        # the rest fire at the end of input with the full counts (11 timers per window)
        assert len(res) == 5 * 11
        purge = early_firings(c, "url", "seq", 10000, 1000, width=width, purge=True).collect()
        prod = sorted((r.timer, r["count"]) for r in purge if r.url == "./prod?id=1")
        assert [n for _, n in prod] == [1, 1]


def test_processing_time_timers(spark):
    arrivals = [1000, 2000, 2000, 7000]
    c = clicks(spark, [("u", "./x", m) for m in arrivals])
    res = timer_replay(c, "ms", 5000).collect()
    got = sorted((r.kind, r.at_ms) for r in res)
    assert got == sorted([("arrival", m) for m in arrivals]
                         + [("timer", 6000), ("timer", 7000), ("timer", 12000)])
    assert sum(1 for r in res if r.message.startswith("定时器触发")) == 3


def test_outlier_does_not_inflate_crossing_tables(spark, monkeypatch):
    """A row a day ahead of the rest: clipped crossing tables give the same
    firings and close watermarks as the full explode, with few rows."""
    from clickspark.operators import triggers as TR
    from clickspark.operators import watermark as WM
    base = ms_of("2022-05-12 15:07:50.677")
    rows = [(u, l, ms_of(f"2022-05-12 {t}")) for u, l, t in TRIGGER]
    rows = rows[:3] + [("Eve", "./fav", base + 86_400_000)] + rows[3:] + \
        [("Bob", "./cart", base + 86_400_000 + 4_000)]
    c = clicks(spark, rows)
    seen = []
    real = WM.first_crossing

    def spy(*a, **k):
        res = real(*a, **k)
        seen.append(res.count())
        return res
    monkeypatch.setattr(TR, "first_crossing", spy)
    clipped = sorted(tuple(r) for r in early_firings(c, "url", "seq", 10000, 1000, width=4).collect())
    small = list(seen)

    def full(*a, **k):
        k.pop("reach", None)
        return real(*a, **k)
    monkeypatch.setattr(TR, "first_crossing", full)
    unclipped = sorted(tuple(r) for r in early_firings(c, "url", "seq", 10000, 1000,
                                                       width=4).collect())
    assert clipped == unclipped
    assert max(small) < 200            # the full explode has ~86,400 grid cells
    monkeypatch.setattr(WM, "first_crossing", full)
    w_full = sorted(tuple(r) for r in L.windows_with_watermark(c, "url", ["seq"], 10000, 5000,
                                                               width=4).collect())
    monkeypatch.setattr(WM, "first_crossing", real)
    w_clip = sorted(tuple(r) for r in L.windows_with_watermark(c, "url", ["seq"], 10000, 5000,
                                                               width=4).collect())
    assert w_clip == w_full
