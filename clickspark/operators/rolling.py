"""Rolling keyed aggregates: one output row per input row, in arrival order.

``keyBy(k).sum/max/min/maxBy/minBy/reduce`` of the reference.  Each is a
two-level running scan (see :mod:`clickspark.operators.scan`), so a hot
key is spread over arrival blocks instead of one task.  ``max``/``min``
move only the aggregated field; the other fields keep the values of the
key's first row.  ``max_by``/``min_by`` return the whole row of the
current extreme; on ties the earlier row stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickspark.operators.scan import Cuts, add_blocks, running


def _prep(df: DataFrame, seq: str, width: int | Cuts | None) -> DataFrame:
    return df if "_blk" in df.columns else add_blocks(df, [seq], width)


def rolling_sum(df: DataFrame, key: str, seq: str, field: str, out: str | None = None,
                width: int | Cuts | None = None) -> DataFrame:
    """A1: running ``sum(field)`` per key (``out`` defaults to ``field``)."""
    out = out or field
    res = running(_prep(df, seq, width), [key], [seq], {"_r": ("sum", F.col(field))})
    return res.withColumn(out, F.col("_r")).drop("_r", "_blk")


def rolling_count(df: DataFrame, key: str, seq: str, out: str = "count",
                  width: int | Cuts | None = None) -> DataFrame:
    """Running count per key (``reduce((a, b) -> (a.f0, a.f1 + b.f1))``
    over ``(key, 1L)`` pairs)."""
    res = running(_prep(df, seq, width), [key], [seq], {out: ("count", F.lit(1))})
    return res.drop("_blk")


def _rolling_extreme(df: DataFrame, kind: str, key: str, seq: str, field: str,
                     others: Sequence[str], width: int | Cuts | None) -> DataFrame:
    first = F.struct(F.col(seq).alias("s"), *[F.col(o) for o in others])
    res = running(_prep(df, seq, width), [key], [seq],
                  {"_first": ("min", first), "_ext": (kind, F.col(field))})
    return res.select(key, seq, *[F.col(f"_first.{o}").alias(o) for o in others],
                      F.col("_ext").alias(field))


def rolling_max(df: DataFrame, key: str, seq: str, field: str, others: Sequence[str],
                width: int | Cuts | None = None) -> DataFrame:
    """A2: running ``max(field)``; ``others`` come from the key's first row."""
    return _rolling_extreme(df, "max", key, seq, field, others, width)


def rolling_min(df: DataFrame, key: str, seq: str, field: str, others: Sequence[str],
                width: int | Cuts | None = None) -> DataFrame:
    """A3: running ``min(field)``; ``others`` come from the key's first row."""
    return _rolling_extreme(df, "min", key, seq, field, others, width)


def _rolling_by(df: DataFrame, kind: str, key: str, seq: str, field: str,
                others: Sequence[str], width: int | Cuts | None) -> DataFrame:
    # ties: the earlier row wins, so the tiebreak is -seq for max, seq for min;
    # a row whose field is NULL never is the extreme
    tie = -F.col(seq) if kind == "max" else F.col(seq)
    best = F.when(F.col(field).isNotNull(), F.struct(F.col(field).alias("_f"), tie.alias("_t"),
                                                     *[F.col(o) for o in [*others, seq]]))
    res = running(_prep(df, seq, width), [key], [seq], {"_best": (kind, best)})
    return res.select(key, F.col(seq).alias("at_seq"),
                      *[F.col(f"_best.{o}").alias(o) for o in others],
                      F.col("_best._f").alias(field), F.col(f"_best.{seq}").alias(seq))


def rolling_max_by(df: DataFrame, key: str, seq: str, field: str, others: Sequence[str],
                   width: int | Cuts | None = None) -> DataFrame:
    """A4: the whole row with the largest ``field`` so far (first wins ties).
    ``at_seq`` is the input row, ``seq`` the row reported."""
    return _rolling_by(df, "max", key, seq, field, others, width)


def rolling_min_by(df: DataFrame, key: str, seq: str, field: str, others: Sequence[str],
                   width: int | Cuts | None = None) -> DataFrame:
    """A5: the whole row with the smallest ``field`` so far (first wins ties)."""
    return _rolling_by(df, "min", key, seq, field, others, width)


def running_top(counts: DataFrame, key: str, seq: str, count: str = "count",
                width: int | Cuts | None = None) -> DataFrame:
    """Running top-1 over a stream of ``(key, count)`` updates, all keys
    together; on equal counts the newer update wins (``v1 > v2 ? v1 : v2``).
    -> (seq, top_<key>, top_count)"""
    best = F.struct(F.col(count).alias("c"), F.col(seq).alias("s"), F.col(key).alias("k"))
    # the counts are themselves a scan: materialize them once for both branches
    res = running(_prep(counts, seq, width), [], [seq], {"_top": ("max", best)},
                  persist_input=True)
    return res.select(seq, F.col("_top.k").alias(f"top_{key}"),
                      F.col("_top.c").alias("top_count"))


def final_top(df: DataFrame, key: str, seq: str) -> DataFrame:
    """A7 final state: the key with the most rows; ties go to the key whose
    last row arrived latest.  Two partial aggregations, one output row."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"),
                                  F.max(seq).alias("last_seq"))
    top = per_key.agg(F.max(F.struct("count", "last_seq", key)).alias("_t"))
    return top.select(F.col(f"_t.{key}").alias(key), F.col("_t.count").alias("count"))


def keyed_final(df: DataFrame, key: str, seq: str, kind: str, field: str,
                   others: tuple[str, ...] = ()) -> DataFrame:
    """Final form of the rolling aggregates (the last rolling row per key)
    as one partial aggregation: ``groupBy(key).agg``.  ``kind``: sum / max /
    min / max_by / min_by / count.  ``others`` keep the key's first row
    (max/min) or come with the extreme row (max_by/min_by); ties keep the
    earlier row.  Works on batch and streaming frames (update mode)."""
    f, s = F.col(field), F.col(seq)
    if kind == "count":
        return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    if kind == "sum":
        return df.groupBy(key).agg(F.sum(f).alias(field))
    if kind in ("max", "min"):
        first = F.min_by(F.struct(*[F.col(o) for o in others]), s) if others else None
        ext = (F.max if kind == "max" else F.min)(f).alias(field)
        aggs = [ext] + ([first.alias("_first")] if first is not None else [])
        res = df.groupBy(key).agg(*aggs)
        return res.select(key, *[F.col(f"_first.{o}").alias(o) for o in others], field)
    if kind in ("max_by", "min_by"):
        tie = -s if kind == "max_by" else s
        best = F.when(f.isNotNull(), F.struct(f.alias("_f"), tie.alias("_t"),
                                              *[F.col(o) for o in others], s.alias(seq)))
        agg = (F.max if kind == "max_by" else F.min)(best).alias("_b")
        return df.groupBy(key).agg(agg).select(
            key, *[F.col(f"_b.{o}").alias(o) for o in others], F.col("_b._f").alias(field),
            F.col(f"_b.{seq}").alias(seq))
    raise ValueError(kind)
