"""A1-A7 against the reference's transcripts, and the two-level scan
against a brute-force pandas computation on a skewed fixture."""

import random

from pyspark.sql import functions as F

from clickspark.operators import rolling as R
from clickspark.operators.scan import add_blocks, running
from helpers import clicks


def test_rolling_min_keeps_first_row_fields(spark):
    c = clicks(spark, [("Mary", "./home", 3000), ("Mary", "./home1", 1000),
                       ("Bob", "./cart", 2000), ("Bob", "./cart", 4000)])
    res = R.rolling_min(c, "user", "seq", "ms", ["url"], width=2).orderBy("seq")
    assert [(r.user, r.url, r.ms) for r in res.collect()] == [
        ("Mary", "./home", 3000), ("Mary", "./home", 1000),
        ("Bob", "./cart", 2000), ("Bob", "./cart", 2000)]


def test_min_by_first_wins_ties(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "a", 3), (2, "b", 3), (3, "b", 4), (4, "b", 3)],
                               "seq long, f0 string, f1 long")
    res = R.rolling_min_by(df, "f0", "seq", "f1", [], width=2).orderBy("at_seq")
    assert [(r.f0, r.f1, r.seq) for r in res.collect()] == [
        ("a", 1, 0), ("a", 1, 0), ("b", 3, 2), ("b", 3, 2), ("b", 3, 2)]
    mx = R.rolling_max_by(df, "f0", "seq", "f1", [], width=2).orderBy("at_seq")
    assert [(r.f1, r.seq) for r in mx.collect()] == [(1, 0), (3, 1), (3, 2), (4, 3), (4, 3)]
    s = R.rolling_sum(df, "f0", "seq", "f1", width=2).orderBy("seq")
    assert [r.f1 for r in s.collect()] == [1, 4, 3, 7, 10]


TOP_IN = "M C M A A A M M B A A C B C C M A C A M C B".split()
TOP_OUT = ("M1 C1 M2 M2 A2 A3 M3 M4 M4 A4 A5 A5 A5 A5 A5 M5 A6 A6 A7 A7 A7 A7").split()


def test_running_top_user_transcript(spark):
    c = clicks(spark, [(u, "./x", i * 1000) for i, u in enumerate(TOP_IN)])
    for width in (4, None):
        counts = R.rolling_count(c, "user", "seq", width=width)
        top = R.running_top(counts, "user", "seq", width=width).orderBy("seq")
        assert [f"{r.top_user}{r.top_count}" for r in top.collect()] == TOP_OUT
    final = R.final_top(c, "user", "seq").collect()
    assert [(r.user, r["count"]) for r in final] == [("A", 7)]


def _brute(rows):
    """Per-key and global running aggregates by a plain loop in arrival order."""
    out, state = {}, {}
    gmax = None
    for rid, k, v, _ in sorted(rows, key=lambda r: r[3]):
        s, mx, mn, c = state.get(k, (None, None, None, 0))
        if v is not None:
            s = v if s is None else s + v
            mx = v if mx is None else max(mx, v)
            mn = v if mn is None else min(mn, v)
        c += 1
        state[k] = (s, mx, mn, c)
        out[rid] = (s, mx, mn, c, gmax)
        if v is not None:
            gmax = v if gmax is None else max(gmax, v)
    return out


def test_scan_matches_brute_force_with_hot_key(spark):
    rnd = random.Random(7)
    n = 3000
    # key "hot" holds about a third of the rows; values include nulls
    keys = ["hot" if rnd.random() < 0.34 else f"k{rnd.randrange(40)}" for _ in range(n)]
    vals = [None if rnd.random() < 0.05 else rnd.randrange(-50, 50) for _ in range(n)]
    order = list(range(n))
    rnd.shuffle(order)               # arrival order = a permutation of ids
    rows = [(i, keys[i], vals[i], order[i] * 3 + 1) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, k string, v long, arr long")
    exp = _brute(rows)
    aggs = {"s": ("sum", F.col("v")), "mx": ("max", F.col("v")), "mn": ("min", F.col("v")),
            "c": ("count", F.lit(1))}
    for blocks in (add_blocks(df, ["arr"], width=97), add_blocks(df, ["arr"], partitions=6)):
        got = {r.id: (r.s, r.mx, r.mn, r.c) for r in running(blocks, ["k"], ["arr"], aggs).collect()}
        assert got == {i: e[:4] for i, e in exp.items()}
        glob = running(blocks, [], ["arr"], {"pm": ("max", F.col("v"))}, exclusive=True)
        assert {r.id: r.pm for r in glob.collect()} == {i: e[4] for i, e in exp.items()}


def test_keyed_final_is_last_rolling_row(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("abc"), f"u{i % 4}", rnd.randrange(10)) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, k string, url string, v long")
    last = {}
    for kind, roll in (("sum", lambda: R.rolling_sum(df, "k", "seq", "v", width=16)),
                       ("max", lambda: R.rolling_max(df, "k", "seq", "v", ["url"], width=16)),
                       ("min_by", lambda: R.rolling_min_by(df, "k", "seq", "v", ["url"],
                                                           width=16))):
        order = "at_seq" if kind == "min_by" else "seq"
        for r in roll().orderBy(order).collect():
            last[(kind, r.k)] = (r.v, None if kind == "sum" else r.url)
        fin = R.keyed_final(df, "k", "seq", kind, "v", () if kind == "sum" else ("url",))
        for r in fin.collect():
            assert (r.v, getattr(r, "url", None)) == last[(kind, r.k)], kind
    cnt = {r.k: r["count"] for r in R.keyed_final(df, "k", "seq", "count", "v").collect()}
    assert cnt == {k: sum(1 for x in rows if x[1] == k) for k in "abc"}


def test_running_matches_loop_with_hot_arrival(spark):
    rnd = random.Random(11)
    n = 2000
    # a third of the rows share one arrival instant (ties broken by id)
    rows = [(i, None if rnd.random() < 0.05 else rnd.randrange(-100, 100),
             5000 if i % 3 == 0 else rnd.randrange(0, 10_000)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v long, arr long")
    exp, cur = {}, None
    for i, v, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        exp[i] = cur
        if v is not None:
            cur = v if cur is None else max(cur, v)
    for parts in (5, None):
        cut = add_blocks(df, ["arr", "id"], partitions=parts)
        got = running(cut, [], ["arr", "id"], {"pm": ("max", F.col("v"))}, exclusive=True)
        assert {r.id: r.pm for r in got.collect()} == exp
        sizes = [r["count"] for r in cut.groupBy("_blk").count().collect()]
        assert max(sizes) <= 2 * n / len(sizes)  # the hot instant is split


def test_blocks_stay_even_under_sparse_and_outlier_ids(spark):
    ids = [*range(4000), *range(10**12, 10**12 + 4000 * 977, 977), 2**60, -2**60]
    df = spark.createDataFrame([(i,) for i in ids], "seq long")
    for parts in (8, None):
        sizes = [r["count"] for r in add_blocks(df, ["seq"], partitions=parts)
                 .groupBy("_blk").count().collect()]
        assert len(sizes) >= 8 and max(sizes) <= 2 * len(ids) / len(sizes)
    rows = add_blocks(df, ["seq"]).orderBy("seq").collect()
    assert [r._blk for r in rows] == sorted(r._blk for r in rows)


def test_blocks_of_empty_and_null_orders(spark):
    empty = spark.createDataFrame([], "seq long, v long")
    assert running(add_blocks(empty, ["seq"]), [], ["seq"], {"s": ("sum", F.col("v"))}).count() == 0
    df = spark.createDataFrame([(None, 1), (3, 2), (5, 4)], "seq long, v long")
    got = running(add_blocks(df, ["seq"]), [], ["seq"], {"s": ("sum", F.col("v"))}).collect()
    assert {r.seq: r.s for r in got} == {None: 1, 3: 3, 5: 7}


def test_extremes_skip_null_fields(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", None), (3, "a", 3), (4, "b", None), (5, "b", 7)],
                               "seq long, k string, v long")
    low = {r.at_seq: r.v for r in R.rolling_min_by(df, "k", "seq", "v", [], width=2).collect()}
    assert low == {1: 5, 2: 5, 3: 3, 4: None, 5: 7}
    high = {r.at_seq: r.v for r in R.rolling_max_by(df, "k", "seq", "v", []).collect()}
    assert high == {1: 5, 2: 5, 3: 5, 4: None, 5: 7}
    assert {r.k: r.v for r in R.keyed_final(df, "k", "seq", "min_by", "v").collect()} == {"a": 3, "b": 7}


def test_scan_over_more_blocks_than_a_table_holds(spark, monkeypatch):
    """More than 2 x 256 blocks, with a tree and a search of several levels
    and a carry that is dealt, not broadcast."""
    from clickspark.operators import scan
    monkeypatch.setattr(scan, "FAN", 8)
    monkeypatch.setattr(scan, "DRIVER_SAMPLE", 2048)
    rnd = random.Random(5)
    n = 30_000
    rows = [(i, rnd.randrange(n // 3), None if rnd.random() < 0.05 else rnd.randrange(10**6))
            for i in range(n)]
    df = spark.createDataFrame(rows, "id long, arr long, v long")
    cut = add_blocks(df, ["arr", "id"], partitions=600)
    assert scan.block_count(cut) > 512
    sizes = [r["count"] for r in cut.groupBy("_blk").count().collect()]
    assert len(sizes) > 512 and max(sizes) <= 8 * n / len(sizes)
    aggs = {"m": ("max", F.col("v")), "s": ("sum", F.col("v")), "c": ("count", F.col("v"))}
    got = running(cut, [], ["arr", "id"], aggs)
    exp, m, s, c = {}, None, None, 0
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        if v is not None:
            m, s, c = max(v, m or 0), (s or 0) + v, c + 1
        exp[i] = (m, s, c)
    assert {r.id: (r.m, r.s, r.c) for r in got.collect()} == exp


def test_rows_and_carry_of_many_blocks_meet_in_place(spark, monkeypatch):
    from clickspark.operators import scan
    monkeypatch.setattr(scan, "FAN", 4)
    df = spark.range(1000).select(F.col("id").alias("seq"), F.col("id").alias("v"))
    got = running(add_blocks(df, ["seq"], partitions=20), [], ["seq"], {"m": ("max", F.col("v"))})
    plan = got._jdf.queryExecution().executedPlan().toString()
    rows_side = plan.count("shufflepartitionidpassthrough") or plan.lower().count("repartition_by_num")
    assert rows_side == 2, plan  # the rows once, the carry once, nothing for the join
