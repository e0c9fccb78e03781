"""Physical distribution: keyBy, rebalance, rescale, custom partitioners.

``keyBy`` has no operator of its own: ``groupBy``/``Window.partitionBy``
hash-partition on the key (and aggregate map-side first).  The functions
here move rows between partitions explicitly and tag each row with the
partition it landed in (``partition``), which makes the routing testable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tag(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, F.spark_partition_id())


def key_by(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition rows by key (``keyBy``) for a later keyed stage."""
    cols = [F.col(k) for k in keys]
    return df.repartition(partitions, *cols) if partitions else df.repartition(*cols)


def custom_partition(df: DataFrame, n: int, partition_of: Column,
                     out: str = "partition", spread: int = 1) -> DataFrame:
    """P5: ``partitionCustom``: row goes to partition ``partition_of`` (0..n-1).

    ``spread`` gives every partition that many tasks (rows are dealt among
    them by a hash of the row), so few logical partitions still use the whole
    cluster; ``out`` is the logical partition."""
    target = F.pmod(partition_of, F.lit(n)).cast("int")
    if spread > 1:
        dealt = F.pmod(F.xxhash64(*df.columns), F.lit(spread)).cast("int")
        moved = df.repartitionById(n * spread, target * spread + dealt)
        return moved.withColumn(out, F.floor(F.spark_partition_id() / spread).cast("int"))
    return _tag(df.repartitionById(n, target), out)


def rebalance(df: DataFrame, n: int, seq: str | None = None,
              out: str = "partition") -> DataFrame:
    """Global round robin over ``n`` partitions.

    With ``seq`` (a dense arrival sequence) the dealing is deterministic:
    row ``seq`` goes to ``seq % n``.  Without it Spark's round-robin
    ``repartition(n)`` is used (start position chosen per task).
    """
    if seq is None:
        return _tag(df.repartition(n), out)
    return custom_partition(df, n, F.col(seq), out)


def rescale(df: DataFrame, n_out: int, n_in: int, group: Column, pos: Column,
            out: str = "partition") -> DataFrame:
    """Local round robin.  Upstream group ``g`` (0..n_in-1) feeds only
    its own ``k = n_out / n_in`` downstream partitions ``g*k .. g*k+k-1``,
    dealt by the row's position ``pos`` within the group.  Scaling down
    (``n_out < n_in``) is ``coalesce``: no shuffle at all."""
    if n_out <= n_in:
        return _tag(df.coalesce(n_out), out)
    k = n_out // n_in
    target = group.cast("long") * k + F.pmod(pos.cast("long"), F.lit(k))
    return custom_partition(df, n_out, target, out)


def parallel_share(df: DataFrame, value: str, parallelism: int,
                   out: str = "partition") -> DataFrame:
    """A parallel source where subtask ``i`` emits the values with
    ``value % parallelism == i``."""
    return custom_partition(df, parallelism, F.col(value), out)
