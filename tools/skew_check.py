"""Skew check: one user holds a third of all clicks.

Builds a derived copy of ``events`` (every third row re-assigned to user 0)
in a scratch folder, runs the running count per user (A6) two ways, the
two-level scan and a naive ``Window.partitionBy(user)``, and reads the
per-task shuffle-read record counts from Spark's event log (the input
scan of one small file is a single task either way).  A second case gives a
third of the rows one arrival instant and runs the watermark's global
running max with range blocks and with a naive global window.  Prints the
largest task of each run as a share of all rows.

usage: python tools/skew_check.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    scratch = argv[1] if len(argv) > 1 else tempfile.mkdtemp(prefix="skew-", dir="/tmp")
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", "file://" + logs)
             .config("spark.eventLog.compress", "false")
             # small inputs would be coalesced into one partition; measure
             # the partitioning itself
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from clickspark.model import clicks
    from clickspark.operators.rolling import rolling_count

    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                           .otherwise(F.col("user_id")))
    path = os.path.join(scratch, "events.parquet")
    skewed.write.mode("overwrite").parquet(path)
    c = clicks(spark.read.parquet(path)).select("seq", "user")
    n = c.count()
    hot = c.where(F.col("user") == "0").count()

    sc = spark.sparkContext
    sc.setJobGroup("two_level", "two-level scan")
    rolling_count(c, "user", "seq", width=4096).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("naive", "naive window")
    naive = c.withColumn("count", F.count(F.lit(1)).over(
        Window.partitionBy("user").orderBy("seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    naive.write.format("noop").mode("overwrite").save()
    # Scenario 2: a third of the rows arrive at one instant (a backfill);
    # the watermark's global running max in arrival order (arr, seq).
    from clickspark.operators.watermark import with_prev_max
    burst = c.join(spark.read.parquet(path).select(F.col("event_id").alias("seq"), "ts"), "seq")
    burst = burst.withColumn("arr", F.when(F.col("seq") % 3 == 0, F.lit(1_700_000_000_000))
                             .otherwise(F.col("seq") * 1000 + F.lit(1_600_000_000_000)))
    burst = burst.withColumn("ms", F.col("arr"))
    sc.setJobGroup("range_blocks", "watermark scan, range blocks")
    with_prev_max(burst, ["arr", "seq"]).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("global_window", "naive global window")
    burst.withColumn("prevmax", F.max("ms").over(
        Window.orderBy("arr", "seq").rowsBetween(Window.unboundedPreceding, -1))) \
        .write.format("noop").mode("overwrite").save()
    names = ("two_level", "naive", "range_blocks", "global_window")
    groups = {g: set(sc.statusTracker().getJobIdsForGroup(g)) for g in names}
    spark.stop()

    stage_group, task_reads = {}, {}
    files = [f for f in glob.glob(os.path.join(logs, "**", "*"), recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith("events_")]
    for f in files:
        for line in open(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for g, ids in groups.items():
                    if e["Job ID"] in ids:
                        for s in e["Stage IDs"]:
                            stage_group[s] = g
            elif e["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in e:
                m = e["Task Metrics"].get("Shuffle Read Metrics", {})
                recs = m.get("Total Records Read", 0)
                task_reads.setdefault(e["Stage ID"], []).append(recs)
    result = {"rows": n, "hot_user_rows": hot}
    for g in groups:
        worst = max((max(v) for s, v in task_reads.items() if stage_group.get(s) == g and v),
                    default=0)
        result[f"{g}_max_task_records"] = worst
        result[f"{g}_max_task_share"] = round(worst / n, 3)
    print(json.dumps(result))


if __name__ == "__main__":
    main(sys.argv[1:])
