"""Streaming twins vs the batch replays, one row per micro-batch."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from clickspark.operators import late as L
from clickspark.operators import windows as W
from clickspark.streaming import stateful as ST
from clickspark.streaming import twins as TW
from helpers import clicks, ms_of
from test_replay import ALLOWED, TRIGGER
from test_windows import W2, W4

BASE = 1_000_000_000_000          # keeps test times away from epoch 0 (window aligned)


def _feed(rows, sep=","):
    d = tempfile.mkdtemp(prefix="clickspark-stream-", dir="/tmp")
    for i, (u, url, ms) in enumerate(rows):
        p = os.path.join(d, f"part-{i:05d}.txt")
        with open(p, "w") as f:
            f.write(f"{u}{sep}{url}{sep}{ms}\n")
        os.utime(p, (1_600_000_000 + i, 1_600_000_000 + i))
    return d


def _run(df, name):
    ck = tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp")
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return df.sparkSession.sql(f"SELECT * FROM {name}").collect()


def test_url_view_count_stream_matches_batch(spark):
    src = TW.click_lines_stream(spark, _feed(W4), files_per_trigger=1)
    got = {(r.url, r.windowStart, r["count"]) for r in
           _run(TW.url_view_count_stream(src, 10000, 5000), "w4")}
    batch = {(r.url, r.windowStart, r["count"]) for r in
             W.url_view_count(clicks(spark, W4), 10000, 5000).collect()}
    closed_by = max(ms for _, _, ms in W4)        # append mode: closed windows only
    expect = {x for x in batch if x[1] + 10000 <= closed_by}
    assert got == expect and len(got) > 10


def test_pv_uv_stream_two_stage(spark):
    src = TW.click_lines_stream(spark, _feed(W2), files_per_trigger=1)
    got = sorted((r.windowEnd, r.avg_pv) for r in _run(TW.pv_uv_stream(src, 10000, 2000), "w2"))
    # [56 s, 06 s) needs a later row to close it (the transcript's next row
    # is not shown); a stream keeps it open, the batch replay closes it at the end
    assert [v for _, v in got] == [2.0, 2.0, 2.0, 2.6666666666666665]


def test_lateness_stream_matches_transcript(spark):
    rows = [("Alice", u, BASE + m) for u, m in ALLOWED]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    out = _run(ST.lateness_stream(src, "url", 10000, 2000, 60000), "w7")
    home0 = [r["count"] for r in sorted(out, key=lambda r: (r.kind != "first", r["count"] or 0))
             if r.key == "./home" and r.windowStart == BASE and r.kind != "late"]
    assert home0 == [3, 4, 5, 6]
    second = {r.key: r["count"] for r in out if r.windowStart == BASE + 10000}
    assert second == {"./home": 1, "./cart": 1, "./prod?id=100": 1}
    late = [(r.key, r.ms - BASE) for r in out if r.kind == "late"]
    assert late == [("./home", 8000)]
    # same as the batch replay, up to what only the end of input fires
    rep = L.lateness_replay(clicks(spark, rows), "url", ["seq"], 10000, 2000, 60000, width=4)
    top = max(ms for _, _, ms in rows)
    batch = sorted((r.url, r.windowStart, r["count"]) for r in L.late_firings(rep, "url", ["seq"]).collect()
                   if r.kind == "refire" or r.windowEnd + 2000 <= top)
    assert sorted((r.key, r.windowStart, r["count"]) for r in out if r.kind != "late") == batch


def _lateness_rows():
    """Out of order, equal times, late within and past the lateness, and far
    later than delay + size + lateness."""
    import random
    r = random.Random(8)
    out, now = [], 0
    for _ in range(160):
        now += r.randrange(0, 4000)
        back = r.choice([0, 0, 0, 500, 3000, 9000, 15_000, 40_000, 90_000, 200_000])
        out.append((r.choice("ab"), r.choice(["./x", "./y"]), BASE + 300_000 + max(0, now) - back))
    return out + [out[-1], ("a", "./x", BASE + 1000), ("a", "./x", BASE + 900_000),
                  ("a", "./x", BASE + 1000), ("b", "./y", BASE + 8000)]


def _lateness_by_batches(spark, rows, cuts):
    from clickspark.streaming.late_batches import lateness_batches
    out = {"result": [], "late": []}

    def write(frame, name, epoch):
        out[name] += [tuple(r) for r in frame.collect()]
    state = tempfile.mkdtemp(prefix="clickspark-late-", dir="/tmp") + "/state"
    run = lateness_batches(state, "url", ["seq"], 10000, 2000, 60000, write, ["seq", "url", "ms"])
    whole = clicks(spark, rows)
    bounds = [0, *cuts, len(rows)]
    for epoch, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        part = whole.where((F.col("seq") >= lo) & (F.col("seq") < hi))
        if epoch == 1:  # a failure after the outputs: the epoch is run again
            kept = {k: list(v) for k, v in out.items()}
            run(part, epoch)
            first = {k: sorted(v[len(kept[k]):], key=repr) for k, v in out.items()}
            out.update({k: list(v) for k, v in kept.items()})
            run(part, epoch)
            assert first == {k: sorted(out[k][len(kept[k]):], key=repr) for k in out}
            continue
        run(part, epoch)
    versions = [p for p in os.listdir(state) if p.startswith("v=")]
    assert len(versions) <= 2
    return out


def test_lateness_batches_lose_no_row(spark):
    rows = _lateness_rows()
    rep = L.lateness_replay(clicks(spark, rows), "url", ["seq"], 10000, 2000, 60000)
    top = max(ms for _, _, ms in rows)
    want = sorted((tuple(r) for r in L.late_firings(rep, "url", ["seq"]).collect()
                   if r.kind == "refire" or r.windowEnd + 2000 <= top), key=repr)
    late = sorted(tuple(r) for r in L.late_side_output(rep, ["seq", "url", "ms"]).collect())
    got = _lateness_by_batches(spark, rows, [1, 40, 41, 90])
    assert sorted(got["result"], key=repr) == want and sorted(got["late"]) == late
    assert len(late) > 10 and any(r[3] == "refire" for r in want)


def test_generator_of_the_user_on_a_stream(spark):
    """The periodic generator equals the bounded watermark; one that emits with
    some rows only equals a loop; for any cut into batches."""
    from clickspark.operators.generators import periodic
    from clickspark.streaming.late_batches import lateness_batches
    rows = _lateness_rows()[:60]
    whole = clicks(spark, rows)

    def run(cuts, delay, generator):
        out = {"result": [], "late": []}
        state = tempfile.mkdtemp(prefix="clickspark-late-", dir="/tmp") + "/state"
        step = lateness_batches(state, "url", ["seq"], 10000, delay, 60000,
                                lambda f, name, e: out[name].extend(map(tuple, f.collect())),
                                ["seq", "url", "ms"], generator=generator)
        for epoch, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            step(whole.where((F.col("seq") >= lo) & (F.col("seq") < hi)), epoch)
        return sorted(out["result"], key=repr), sorted(out["late"])
    assert run([7, 30], 0, periodic(2000)) == run([25], 2000, None)
    every = F.col("seq") % 4 == 3
    got = run([5, 6, 41], 0, periodic(2000, every))
    # a loop
    late, top, mark = [], None, None
    for seq, (_, url, ms) in enumerate(rows):
        end = ms - ms % 10000 + 10000
        if mark is not None and mark + 1 >= end + 60000:
            late.append((seq, url, ms))
        top = ms if top is None else max(top, ms)
        if seq % 4 == 3:
            mark = max(mark or 0, top - 2001)
    assert got[1] == late and len(late) > 3 and got == run([], 0, periodic(2000, every))


def test_lateness_state_is_a_bounded_log(spark, monkeypatch):
    """Many micro-batches leave a bounded folder and no stage tables; a batch
    that touches one window writes that window."""
    from clickspark.session import _checkpoint_dir
    from clickspark.streaming import late_batches as LB
    monkeypatch.setattr(LB, "MERGE", 3)
    state = tempfile.mkdtemp(prefix="clickspark-late-", dir="/tmp") + "/state"
    stages = _checkpoint_dir(spark).replace("file:", "") + "/clickspark/stage"
    before = len(os.listdir(stages)) if os.path.isdir(stages) else 0
    seen = []
    run = LB.lateness_batches(state, "url", ["seq"], 10000, 0, 30000,
                              lambda f, name, e: seen.extend(f.collect()) if name == "result" else None)
    users = [f"./u{i}" for i in range(40)]
    rows, total = [], {}
    for epoch in range(13):
        start = BASE + epoch * 4000
        part = [(len(rows) + i, "u", u, start + i) for i, u in enumerate(users if epoch % 6 == 0 else users[:1])]
        rows += part
        run(spark.createDataFrame(part, "seq long, user string, url string, ms long"), epoch)
        for _, _, u, ms in part:
            total[u, ms - ms % 10000] = total.get((u, ms - ms % 10000), 0) + 1
        own, = [d for d in os.listdir(state) if d.startswith(f"r={epoch:012d}-{epoch:012d}")]
        assert {p for p in os.listdir(f"{state}/{own}") if p.startswith("windowStart=")} == {
            f"windowStart={ms - ms % 10000}" for _, _, _, ms in part}
    folders = [d for d in os.listdir(state) if not d.startswith(".")]
    assert len([d for d in folders if d.startswith("r=")]) <= 9
    assert len([d for d in folders if d.startswith("max=")]) <= 2
    windows = {p for d in folders for p in os.listdir(f"{state}/{d}") if p.startswith("windowStart=")}
    assert len(windows) <= 6
    assert (len(os.listdir(stages)) if os.path.isdir(stages) else 0) == before
    first = {(r.url, r.windowStart): r["count"] for r in seen if r.kind == "first"}
    last = max(ms for *_, ms in rows)
    assert first == {k: n for k, n in total.items() if k[1] + 10000 <= last}


def test_bad_lines_fail_or_are_rejected(spark):
    d = _feed([("a", "./x", BASE + 1)])
    with open(f"{d}/part-00009.txt", "w") as f:
        f.write("not a click\n\na,./y,12x\n")
    import pytest
    with pytest.raises(Exception):
        _run(TW.click_lines_stream(spark, d), "strict")
    got = _run(TW.click_lines_stream(spark, d, rejects=True), "permissive")
    assert sorted(str(r.bad_line) for r in got) == ["", "None", "a,./y,12x", "not a click"]
    good, bad = TW.split_lines(spark.createDataFrame(got, "user string, url string, ms long, "
                                                          "bad_line string, ts timestamp"))
    assert [r.ms for r in good.collect()] == [BASE + 1] and bad.count() == 3


def test_fan_out_writes_every_output(spark):
    seen = {}

    def write(frame, name, epoch):
        seen[name] = seen.get(name, 0) + frame.count()
    src = TW.click_lines_stream(spark, _feed(W4), files_per_trigger=5)
    q = (src.writeStream.foreachBatch(TW.fan_out(
        {"all": lambda f: f, "carts": lambda f: f.where("url like '%cart%'")}, write))
        .option("checkpointLocation", tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp"))
        .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert seen == {"all": len(W4), "carts": sum("cart" in u for _, u, _ in W4)}


def test_watermark_drop_stream(spark):
    rows = [("Alice", "./home", BASE + 1000), ("Alice", "./cart", BASE + 2000),
            ("Alice", "./prod?id=100", BASE + 10000), ("Alice", "./prod?id=200", BASE + 8000),
            ("Alice", "./prod?id=300", BASE + 15000), ("Alice", "./prod?id=200", BASE + 9000)]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    out = _run(ST.lateness_stream(src, "user", 10000, 5000, 0), "w5")
    first = [(r.windowStart - BASE, r["count"]) for r in out if r.kind == "first"]
    assert first == [(0, 3)]
    assert [r.ms - BASE for r in out if r.kind == "late"] == [9000]


def test_early_firing_stream(spark):
    rows = [(u, l, ms_of(f"2022-05-12 {t}")) for u, l, t in TRIGGER]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    out = _run(ST.early_firings_stream(src, "url", 10000, 1000), "w6")
    from clickspark.operators.triggers import early_firings
    batch = early_firings(clicks(spark, rows), "url", "seq", 10000, 1000, width=2).collect()
    # the timers the reference fired during the transcript
    expect = sorted((r.url, r.timer, r["count"]) for r in batch if r.fired_at is not None)
    assert sorted((r.key, r.timer, r["count"]) for r in out) == expect and expect


def test_early_firing_stream_keeps_open_windows(spark):
    from clickspark.operators.triggers import early_firings
    # out of order, equal times, a row of a closed window, and a delay
    times = [1000, 5000, 2000, 5000, 9000, 12_500, 3000, 14_000, 11_000, 31_000, 12_000, 45_000]
    rows = [("a", "./x", BASE + t) for t in times]
    for delay, purge in ((0, False), (3000, False), (0, True)):
        src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
        out = _run(ST.early_firings_stream(src, "url", 10000, 1000, purge, delay_ms=delay),
                   f"w6_{delay}_{purge}")
        batch = early_firings(clicks(spark, rows), "url", "seq", 10000, 1000, delay, purge=purge).collect()
        expect = sorted((r.url, r.timer, r["count"]) for r in batch if r.fired_at is not None)
        assert sorted((r.key, r.timer, r["count"]) for r in out) == expect and len(expect) > 5


def test_upsert_foreach_batch(spark):
    rows = [("Mary", "./home", BASE + 1), ("Bob", "./cart", BASE + 2), ("Mary", "./fav", BASE + 3),
            ("Bob", "./prod?id=1", BASE + 4), ("Cid", "./x", BASE + 5), ("Mary", "./y", BASE + 6)]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    table = tempfile.mkdtemp(prefix="clickspark-upsert-", dir="/tmp") + "/clicks"
    ck = tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp")
    q = (src.withColumn("seq", F.col("ms")).writeStream
         .foreachBatch(TW.upsert_batches(spark, table, "user", "url", "seq", buckets=4))
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = {r.user: r.url for r in TW.read_upserts(spark, table).collect()}
    assert got == {"Mary": "./y", "Bob": "./prod?id=1", "Cid": "./x"}
    for bucket in [p for p in os.listdir(table) if p.startswith("bucket=")]:
        assert 1 <= len(os.listdir(f"{table}/{bucket}")) <= 2
    # a repeated epoch changes nothing
    again = spark.createDataFrame([("Mary", "./y", BASE + 6)], "user string, url string, seq long")
    TW.upsert_batches(spark, table, "user", "url", "seq", buckets=4)(again, 5)
    assert {r.user: r.url for r in TW.read_upserts(spark, table).collect()} == got


def test_processing_time_timers_stream(spark):
    rows = [("a", "./x", BASE + i) for i in range(3)]
    d = _feed(rows)
    src = TW.click_lines_stream(spark, d, files_per_trigger=1)
    ck = tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp")
    q = (ST.processing_timers_stream(src, 300).writeStream.format("memory").queryName("pf2")
         .outputMode("append").option("checkpointLocation", ck)
         .trigger(processingTime="200 milliseconds").start())
    deadline = time.time() + 60
    while time.time() < deadline:
        got = spark.sql("SELECT * FROM pf2").collect()
        if sum(r.kind == "timer" for r in got) >= 1 and sum(r.kind == "arrival" for r in got) == 3:
            break
        time.sleep(0.5)
    q.stop()
    arrivals = [r.at_ms for r in got if r.kind == "arrival"]
    timers = [r.at_ms for r in got if r.kind == "timer"]
    assert len(arrivals) == 3 and timers
    assert min(timers) >= min(arrivals) + 300


def _run_update(df, name):
    ck = tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp")
    q = (df.writeStream.format("memory").queryName(name).outputMode("update")
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    return df.sparkSession.sql(f"SELECT * FROM {name}").collect()


def test_rolling_stream_update_mode(spark):
    rows = [("Mary", "./home", 3000), ("Mary", "./home1", 1000), ("Bob", "./cart", 2000),
            ("Bob", "./cart", 4000)]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    # arrival sequence = the file's position in the feed
    src = src.withColumn("seq", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
                         .cast("long"))
    got = [(r.user, r.url, r.ms) for r in
           _run_update(TW.rolling_stream(src, "user", "seq", "min", "ms", ("url",)), "amin")]
    # one update per micro-batch, in arrival order (the rolling min transcript)
    assert got == [("Mary", "./home", 3000), ("Mary", "./home", 1000),
                   ("Bob", "./cart", 2000), ("Bob", "./cart", 2000)]


def test_click_generator_rate_stream(spark):
    from clickspark.sources import generators as G
    s = G.click_stream(spark, rows_per_second=20, start_ms=BASE)
    ck = tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp")
    q = (s.writeStream.format("memory").queryName("gen").outputMode("append")
         .option("checkpointLocation", ck).start())
    deadline = time.time() + 60
    while time.time() < deadline and spark.sql("SELECT count(*) c FROM gen").collect()[0].c < 5:
        time.sleep(0.5)
    q.stop()                       # the reference's cancel()
    got = spark.sql("SELECT * FROM gen").collect()
    assert len(got) >= 5
    assert {r.user for r in got} <= set(G.USERS) and {r.url for r in got} <= set(G.URLS)
    assert all(r.ms == BASE + r.seq * 50 for r in got)


def test_tumbling_and_uv_streams(spark):
    from test_windows import W1, W3
    src = TW.click_lines_stream(spark, _feed(W1), files_per_trigger=1)
    got = {(r.user, r.windowStart, r["count"]) for r in
           _run(TW.tumbling_count_stream(src, "user", 5000), "w1")}
    batch = {(r.user, r.windowStart, r["count"]) for r in
             W.tumbling_count(clicks(spark, W1), "user", 5000).collect()}
    last = max(ms for _, _, ms in W1)
    assert got == {x for x in batch if x[1] + 5000 <= last} and len(got) == 7
    src3 = TW.click_lines_stream(spark, _feed(W3), files_per_trigger=1)
    uv = sorted((r.windowStart, r.uv) for r in _run(TW.unique_visitors_stream(src3, 10000), "w3"))
    assert [n for _, n in uv] == [3, 4]


def test_console_takes_every_row(spark):
    """The console is the JVM's own output, so its progress is read."""
    src = TW.click_lines_stream(spark, _feed([("Mary", "./console", BASE), ("Bob", "./x", BASE + 1)]))
    q = (TW.console(src.select("user", "url"), "late")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert q.exception() is None and sum(p["numInputRows"] for p in q.recentProgress) == 2
    assert "onsole" in q.recentProgress[-1]["sink"]["description"]
