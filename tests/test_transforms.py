"""The reference's inline fixtures and transcripts."""

from pyspark.sql import functions as F

from clickspark.operators import partitioning as PT
from clickspark.operators import transforms as T
from helpers import clicks, rows_of

TWO = [("Mary", "./home", 1000), ("Bob", "./cart", 2000)]


def test_map_filter_flatmap_pair(spark):
    c = clicks(spark, TWO)
    assert rows_of(T.map_user(c), "value") == [("Mary",), ("Bob",)]
    assert rows_of(T.filter_user(c, "Mary"), "user", "url", "ms") == [("Mary", "./home", 1000)]
    assert rows_of(T.flatmap_user_url(c, "Mary", "Bob"), "value") == [
        ("Mary",), ("Bob",), ("./cart",)]
    pair = T.map_pair(c)
    assert rows_of(pair, "f0", "f1") == [("Mary", 1), ("Bob", 1)]
    assert dict(pair.dtypes) == {"f0": "string", "f1": "bigint"}


def test_filter_drops_null_user(spark):
    c = clicks(spark, [(None, "./x", 1), ("Mary", "./y", 2)])
    assert rows_of(T.filter_user(c, "Mary"), "url") == [("./y",)]


def test_process_expand(spark):
    c = clicks(spark, [("Mary", "./a", 1), ("Bob", "./b", 2), ("Alice", "./c", 3)])
    n = F.when(F.col("user") == "Mary", 1).when(F.col("user") == "Bob", 2).otherwise(0)
    assert rows_of(T.repeat_by(c, n), "value") == [("Mary",), ("Bob",), ("Bob",)]


def test_rich_map_hooks_run_once_per_task(spark, tmp_path):
    four = [("Mary", "./home", 1000), ("Bob", "./cart", 2000),
            ("Alice", "./prod?id=1", 5000), ("Cary", "./home", 60000)]
    c = clicks(spark, four).repartition(2)
    log = tmp_path / "hooks"
    log.mkdir()

    def opened(pid):
        (log / f"open-{pid}").write_text("x")
        return pid

    def closed(pid, ctx):
        (log / f"close-{pid}").write_text(str(ctx))

    import pandas as pd
    out = T.rich_map(c.select("ms"), lambda pdf, ctx: pd.DataFrame({"value": pdf["ms"]}),
                     "value long", opened, closed)
    assert sorted(r.value for r in out.collect()) == [1000, 2000, 5000, 60000]
    names = sorted(p.name for p in log.iterdir())
    opens = [n for n in names if n.startswith("open")]
    assert opens and len(opens) == len([n for n in names if n.startswith("close")])


def test_custom_partition_transcript(spark):
    v = spark.range(1, 9).select(F.col("id").alias("value"))
    res = PT.custom_partition(v, 2, F.col("value") + 1)
    got = {p: sorted(r.value for r in res.collect() if r.partition == p) for p in (0, 1)}
    assert got == {1: [2, 4, 6, 8], 0: [1, 3, 5, 7]}


def test_parallel_share_and_rescale_transcript(spark):
    v = spark.range(0, 8).select((F.col("id") + 1).alias("value"), F.col("id"))
    share = PT.parallel_share(v, "value", 2)
    assert sorted(r.value for r in share.collect() if r.partition == 0) == [2, 4, 6, 8]
    res = PT.rescale(v, 4, 2, F.col("value") % 2, F.floor(F.col("id") / 2))
    got = {r.value: r.partition for r in res.collect()}
    # odd values go to the upstream-1 pair (3,4 printed 1-based), evens to 1,2
    assert [got[i] for i in (1, 3, 5, 7)] == [2, 3, 2, 3]
    assert [got[i] for i in (2, 4, 6, 8)] == [0, 1, 0, 1]


def test_rebalance_round_robin(spark):
    v = spark.range(0, 8).select(F.col("id").alias("seq"))
    res = PT.rebalance(v, 4, seq="seq")
    counts = {r.partition: r["count"] for r in res.groupBy("partition").count().collect()}
    assert counts == {0: 2, 1: 2, 2: 2, 3: 2}
    assert PT.rebalance(v, 4).rdd.getNumPartitions() == 4


def test_parse_lines_java_trim_and_errors(spark):
    lines = spark.createDataFrame(
        [(" Mary ,\t./home\u0001, 1000 ,extra",), ("Alice, ./prod?id=100, +8000",)], "value string")
    got = rows_of(T.parse_lines(lines, ","), "user", "url", "ms")
    assert got == [("Mary", "./home", 1000), ("Alice", "./prod?id=100", 8000)]
    space = spark.createDataFrame([("Alice, ./home, 1000",)], "value string")
    assert rows_of(T.parse_lines(space, " "), "user", "url", "ms") == [("Alice,", "./home,", 1000)]
    bad = spark.createDataFrame([("Bob, ./cart, 1.5",), ("Bob, ./cart",)], "value string")
    loose = rows_of(T.parse_lines(bad, ",", strict=False), "user", "ms")
    assert loose == [("Bob", None), ("Bob", None)]
    import pytest
    with pytest.raises(Exception):
        T.parse_lines(bad, ",").collect()


def test_key_by_keeps_a_key_in_one_partition(spark):
    from pyspark.sql import functions as F

    from clickspark.operators.partitioning import key_by
    df = spark.range(500).withColumn("k", F.col("id") % 13)
    for parts in (None, 6):
        at = key_by(df, "k", partitions=parts).withColumn("p", F.spark_partition_id())
        homes = at.groupBy("k").agg(F.count_distinct("p").alias("n")).collect()
        assert len(homes) == 13 and all(r.n == 1 for r in homes)


def test_spread_partitions_keep_their_rows(spark):
    from pyspark.sql import functions as F

    from clickspark.operators.partitioning import custom_partition
    df = spark.range(400).select(F.col("id").alias("value"))
    out = custom_partition(df, 2, F.col("value") + 1, spread=5)
    assert all(r.partition == (r.value + 1) % 2 for r in out.collect())
    tasks = out.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 2


def test_user_filters_reach_the_scan(spark, sf_dir):
    from clickspark.plans import queries
    for name in ("filter_user", "flatmap_user_url", "process_expand"):
        plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters"):]
        assert "user_id" in pushed[:200] and ("In(user_id" in pushed or "EqualTo(user_id" in pushed)
