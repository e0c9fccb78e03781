"""W2 / W3 by panes with mergeable distinct sets.

Rows are reduced to one per (pane, user) first, so neither a hot user nor a
hot pane travels, and no row is copied into the windows that hold it.  Users
get dense numbers; a pane's users are bitmaps of 32,768 numbers each (Spark's
``bitmap_construct_agg``), and a window is the union of its panes' bitmaps
(``bitmap_or_agg``).  What is copied ``size / slide`` times is 4 KB per pane
and bucket of users, whatever the number of rows.  Worth it where panes hold
many users; for sparse panes :func:`clickspark.operators.windows.pv_uv` moves
less.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickspark.operators.scan import materialize
from clickspark.session import shuffle_partitions


def dense_numbers(df: DataFrame, col: str, out: str = "number") -> DataFrame:
    """The distinct non-null values of ``col``, numbered from 1 without gaps.
    Values are numbered inside hash parts and shifted by the sizes of the
    parts before (a table of as many rows as there are parts, broadcast)."""
    parts = 4 * shuffle_partitions(df.sparkSession)
    values = df.where(F.col(col).isNotNull()).select(col).distinct()
    values = materialize(values.withColumn("_part", F.pmod(F.xxhash64(col), F.lit(parts))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = values.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(col))
    return values.withColumn("_rn", within).join(F.broadcast(offsets), "_part").select(
        col, (F.col("_first") + F.col("_rn")).alias(out))


def pv_uv_panes(df: DataFrame, size_ms: int, slide_ms: int | None = None, user: str = "user",
                time_col: str = "ms") -> DataFrame:
    """Page views, distinct users and their ratio per window, as
    :func:`clickspark.operators.windows.pv_uv`: rows without a user are views
    of nobody, and a window of only such rows has no ratio."""
    slide_ms = slide_ms or size_ms
    if size_ms % slide_ms:
        raise ValueError("the window size must be a multiple of the slide")
    t = F.col(time_col)
    pane = (t - F.pmod(t, F.lit(slide_ms))).alias("_pane")
    pairs = materialize(df.groupBy(pane, F.col(user).alias("_user")).agg(F.count(F.lit(1)).alias("_n")))
    windows = F.explode(F.sequence(F.col("_pane") - F.lit(size_ms - slide_ms), F.col("_pane"),
                                   F.lit(slide_ms).cast("long"))).alias("windowStart")
    views = (pairs.groupBy("_pane").agg(F.sum("_n").alias("_n")).select(windows, "_n")
             .groupBy("windowStart").agg(F.sum("_n").cast("long").alias("pv")))
    marked = pairs.join(dense_numbers(pairs, "_user"), "_user")
    sets = marked.groupBy("_pane", F.bitmap_bucket_number("number").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("_bits"))
    if size_ms > slide_ms:
        sets = sets.select(windows, "_bucket", "_bits").groupBy("windowStart", "_bucket").agg(
            F.bitmap_or_agg("_bits").alias("_bits"))
    else:
        sets = sets.withColumnRenamed("_pane", "windowStart")
    users = sets.groupBy("windowStart").agg(F.sum(F.bitmap_count("_bits")).cast("long").alias("uv"))
    res = views.join(users, "windowStart", "left").withColumn("uv", F.coalesce("uv", F.lit(0).cast("long")))
    return res.select(
        "pv", "uv", F.when(F.col("uv") > 0, F.col("pv").cast("double") / F.col("uv").cast("double")
                           ).alias("avg_pv"),
        "windowStart", (F.col("windowStart") + F.lit(size_ms)).alias("windowEnd"))
