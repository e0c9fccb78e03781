"""Row-wise transforms: map, filter, flatMap, typed pairs, parsing, rich map.

All but :func:`rich_map` are Column expressions (codegen, pushdown).
``rich_map`` is the escape hatch for user code with per-task setup and
teardown; it runs on Arrow batches, never row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.functions.scalars import parse_click


def map_user(df: DataFrame, user: str = "user") -> DataFrame:
    """``map(e -> e.user)``."""
    return df.select(F.col(user).alias("value"))


def filter_user(df: DataFrame, name: str, user: str = "user") -> DataFrame:
    """``filter(e -> e.user.equals(name))`` (NULL users are dropped)."""
    return df.where(F.col(user) == F.lit(name))


def flatmap_user_url(df: DataFrame, one: str, two: str, user: str = "user",
                     url: str = "url") -> DataFrame:
    """``one`` -> [user]; ``two`` -> [user, url]; anyone else -> nothing."""
    arr = (F.when(F.col(user) == F.lit(one), F.array(F.col(user)))
            .when(F.col(user) == F.lit(two), F.array(F.col(user), F.col(url))))
    return df.select(F.explode(arr).alias("value"))


def map_pair(df: DataFrame, key: str = "user") -> DataFrame:
    """T4: ``map(e -> Tuple2.of(e.user, 1L))`` with the declared result type."""
    return df.select(F.col(key).cast("string").alias("f0"), F.lit(1).cast("long").alias("f1"))


def parse_lines(df: DataFrame, sep: str = ",", value: str = "value",
                strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """T5: text lines -> clicks (see :func:`clickspark.functions.scalars.parse_click`).
    ``keep`` columns are carried along."""
    return (df.select(*keep, parse_click(value, sep, strict).alias("_e"))
              .select(*keep, "_e.user", "_e.url", "_e.ms"))


def parse_or_reject(df: DataFrame, sep: str = ",", value: str = "value",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """T5, permissive: clicks with ``bad_line``, the text of a line that does
    not parse (NULL for good lines, which alone have fields)."""
    c = parse_click(value, sep, strict=False)
    parsed = df.select(*keep, F.col(value).alias("_line"), c.alias("_e"))
    good = F.col("_e.ms").isNotNull() & F.col("_e.user").isNotNull() & F.col("_e.url").isNotNull()
    return parsed.select(*keep, *[F.when(good, F.col(f"_e.{f}")).alias(f) for f in ("user", "url", "ms")],
                         F.when(~good, F.coalesce("_line", F.lit(""))).alias("bad_line"))


def repeat_by(df: DataFrame, counts: Column, value: Column | str = "user") -> DataFrame:
    """T7 ``ProcessFunction``: emit ``value`` ``counts`` times (0 = drop)."""
    v = F.col(value) if isinstance(value, str) else value
    return df.select(F.explode(F.array_repeat(v, counts.cast("int"))).alias("value"))


def rich_map(df: DataFrame, fn: Callable, schema: str,
             open_fn: Callable[[int], object] | None = None,
             close_fn: Callable[[int, object], None] | None = None) -> DataFrame:
    """A map with lifecycle hooks per task (``open``/``close``).

    ``open_fn(partition_id)`` runs once before the task's first batch and
    returns a context; ``fn(pdf, ctx)`` maps each Arrow batch (pandas);
    ``close_fn(partition_id, ctx)`` runs once when the task ends, also on
    failure.
    """
    def run(batches: Iterator):
        from pyspark import TaskContext
        tc = TaskContext.get()
        pid = tc.partitionId() if tc is not None else 0
        ctx = open_fn(pid) if open_fn else None
        try:
            for pdf in batches:
                yield fn(pdf, ctx)
        finally:
            if close_fn:
                close_fn(pid, ctx)
    return df.mapInPandas(run, schema)
