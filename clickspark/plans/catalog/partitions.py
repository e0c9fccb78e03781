"""Partitioning queries: S5, P3, P4, P5 (each row tagged with its partition)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickspark.model import load
from clickspark.operators import partitioning as PT
from clickspark.plans.catalog.common import with_clicks
from clickspark.plans.registry import register
from clickspark.session import shuffle_partitions


def _values(spark, sf_dir):
    # the reference's integer stream 1..n, here one value per event
    return load(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("value"))


@register("src_parallel_share",
          "SELECT event_id + 1 AS value, CAST((event_id + 1) % 2 AS INTEGER) AS partition FROM events")
def src_parallel_share(spark, sf_dir):
    """A 2-way parallel source; subtask i emits the values with value % 2 == i."""
    return PT.parallel_share(_values(spark, sf_dir), "value", 2)


@register("part_custom",
          "SELECT event_id + 1 AS value, CAST((event_id + 2) % 2 AS INTEGER) AS partition FROM events")
def part_custom(spark, sf_dir):
    """P5: partitionCustom with (key + 1) % 2 over 2 partitions, each spread
    over its share of the cluster's tasks."""
    v = _values(spark, sf_dir)
    return PT.custom_partition(v, 2, F.col("value") + 1,
                               spread=max(1, shuffle_partitions(spark) // 2))


@register("part_rebalance", with_clicks(
    'SELECT CAST(seq % 4 AS INTEGER) AS partition, count(*) AS "count" FROM c GROUP BY 1'))
def part_rebalance(spark, sf_dir):
    """Round robin over 4 partitions in arrival order; rows per partition."""
    ev = load(spark, sf_dir, "events").select(F.col("event_id").alias("seq"))
    dealt = PT.rebalance(ev, 4, seq="seq")
    return dealt.groupBy("partition").agg(F.count(F.lit(1)).alias("count"))


@register("part_rescale",
          "SELECT event_id + 1 AS value, CAST(((event_id + 1) % 2) * 2 + (event_id // 2) % 2 "
          "AS INTEGER) AS partition FROM events")
def part_rescale(spark, sf_dir):
    """Rescale 2 -> 4: upstream subtask g (value % 2) feeds only
    partitions 2g and 2g+1, alternating in its own arrival order."""
    ev = load(spark, sf_dir, "events").select("event_id")
    v = ev.select((F.col("event_id") + 1).alias("value"),
                  F.floor(F.col("event_id") / 2).alias("_pos"))
    res = PT.rescale(v, 4, 2, F.col("value") % 2, F.col("_pos"))
    return res.select("value", "partition")
