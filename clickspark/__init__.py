"""clickspark: click-stream analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` built from the
DataFrame/SQL API so Catalyst can prune, push down and plan it.  Operators
that depend on arrival order (rolling aggregates, watermarks, late data,
custom triggers) take the arrival order as explicit columns and run as
batch replays at scale; most have a Structured Streaming twin in
``clickspark.streaming``.
"""

from clickspark.session import get_spark, shared_dir, shuffle_partitions

__all__ = ["get_spark", "shared_dir", "shuffle_partitions"]
