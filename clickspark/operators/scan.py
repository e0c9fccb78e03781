"""Two-level running scans (prefix aggregates in arrival order).

A running aggregate over ``Window.partitionBy(key).orderBy(seq)`` sends all
rows of a key to one task, and a global running aggregate (no key) sends
the whole table to one task.  Both break when one key holds a third of the
data.  Here the order is cut into *blocks*; every row is scanned inside its
``(key, block)`` partition, block totals are aggregated map-side, an
exclusive prefix over the (small) block table gives each block its carry
in, and a join adds the carry to the in-block result.

Supported kinds are those with an associative merge: ``sum``, ``count``,
``min``, ``max``.  ``min``/``max`` work on structs too, which gives
``min_by``/``max_by`` (order the struct fields by priority).

Blocks are cut at sampled quantiles of the arrival order
(:func:`order_cuts`): one column-pruned pass counts the rows, which gives the
number of blocks (ROWS_PER_BLOCK rows each, and never fewer blocks than tasks
the cluster runs), and a hash sample gives the bounds, tuples of the order
columns.  A row finds its block by binary search, one projection a step.  The
block of a row is a deterministic expression of it.  So sparse ids, an outlier
id or one hot arrival instant give blocks of about the same size, every branch
of a plan sees the same blocks without pinning them by a write, and the rows
are exchanged once, by block.  (A fixed ``width`` of an integral sequence can
be asked for instead.)

Keyless scans (watermarks, the running top-1) send each block to its own task
(``repartitionById``).  Their block table is a prefix tree: blocks are summed
by groups of FAN, groups by groups of FAN, and the prefixes come back down, so
no task orders more than FAN rows of it.  The carry is broadcast while there
are at most FAN blocks; beyond, it is dealt by block like the rows and joined
in place.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickspark.session import shared_dir, shuffle_partitions

BLOCK = "_blk"
KEY = "_key"

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


#: Rows of a block of a large table; smaller ones have two blocks a task.
ROWS_PER_BLOCK = 4_000_000
#: Rows sampled for each bound.
PER_CUT = 32
#: Children of a node of the prefix tree, entries of a search table, and most
#: rows of a broadcast carry.
FAN = 1024
#: Most sampled rows that reach the driver; the bounds of more blocks are cut
#: from a distributed sample.
DRIVER_SAMPLE = 1 << 18

Cuts = list[tuple]


def order_cuts(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> Cuts:
    """Bounds that cut ``df`` into ``blocks`` about equal blocks in ``order``.

    Default: a block for every ROWS_PER_BLOCK rows, at least two per shuffle
    partition.  Two small jobs read the order columns alone: a count, and a
    hash sample of about PER_CUT rows per bound.  The sample depends only on
    the rows, so the bounds do too.  What reaches the driver is at most
    DRIVER_SAMPLE sampled tuples, or two a bound once those are more.
    """
    order = list(order)
    keys = df.select(*order)
    rows = keys.count()
    n_blocks = blocks or max(2 * shuffle_partitions(df.sparkSession), -(-rows // ROWS_PER_BLOCK))
    every = max(1, rows // (PER_CUT * n_blocks))
    drawn = keys.where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).dropna().distinct()
    if PER_CUT * n_blocks <= DRIVER_SAMPLE:
        sample = sorted(tuple(r) for r in drawn.collect())
    else:
        drawn = materialize(drawn)
        cells = add_blocks(drawn, order, order_cuts(drawn, order, DRIVER_SAMPLE // PER_CUT), name="_cell")
        nth = F.row_number().over(Window.partitionBy("_cell").orderBy(*order))
        some = max(1, PER_CUT // 2)  # every so many of a cell
        sample = sorted(tuple(r) for r in cells.withColumn("_n", nth)
                        .where(F.col("_n") % some == 0).select(*order).collect())
    bounds = [sample[len(sample) * i // n_blocks] for i in range(1, n_blocks)] if sample else []
    return sorted(set(bounds))


def _table(cuts: Cuts, types: Sequence[str]) -> Column:
    """The cuts as an array of structs, a constant of the plan."""
    if all(type(v) is int and abs(v) < 1 << 62 for c in cuts for v in c):
        rows = ("named_struct(" + ",".join(f"'c{i}',cast({v}L as {t})" for i, (v, t) in
                                           enumerate(zip(c, types))) + ")" for c in cuts)
        return F.expr("array(" + ",".join(rows) + ")")
    return F.array(*[F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in
                                enumerate(zip(c, types))]) for c in cuts])


def _reached(df: DataFrame, table: Column, entries: int, name: str) -> DataFrame:
    """Add ``name``: how many of the sorted entries of ``table`` are at most
    ``_key``.  One projection a step of the search, so none is duplicated;
    ``table`` may be shorter than ``entries``."""
    step = 1 << max(0, entries.bit_length() - 1)
    df = df.withColumn(name, F.lit(0))
    while step:
        entry = F.get(table, F.col(name) + F.lit(step - 1))
        df = df.withColumn(name, F.col(name) + F.when(entry <= F.col("_key_of"), F.lit(step))
                           .otherwise(F.lit(0)))
        step //= 2
    return df


def _search(df: DataFrame, order: Sequence[str], cuts: Cuts, name: str) -> DataFrame:
    """Attach the number of ``cuts`` that a row reaches (null order values
    come first): in one table, or in the table of every FAN-th cut and then
    in that part's own, broadcast by part."""
    cols = df.columns
    if not cuts:
        return df.withColumn(name, F.lit(0))
    types = [df.schema[c].dataType.simpleString() for c in order]
    df = df.withColumn("_key_of", F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)]))
    if len(cuts) <= FAN:
        return _reached(df, _table(cuts, types), len(cuts), name).select(*cols, name)
    parts = [cuts[i:i + FAN] for i in range(0, len(cuts), FAN)]
    inner = ",".join(f"c{i}:{t}" for i, t in enumerate(types))
    tables = df.sparkSession.createDataFrame(
        [(i, [tuple(c) for c in p]) for i, p in enumerate(parts)], f"_part int, _cuts array<struct<{inner}>>")
    tops = [p[0] for p in parts[1:]]
    df = _reached(df, _table(tops, types), len(tops), "_part")
    df = df.join(F.broadcast(tables), "_part")
    df = _reached(df, F.col("_cuts"), FAN, "_in_part")
    return df.select(*cols, (F.col("_part") * F.lit(FAN) + F.col("_in_part")).alias(name))


def add_blocks(df: DataFrame, order: Sequence[str], width: int | Cuts | None = None,
               partitions: int | None = None, name: str = BLOCK) -> DataFrame:
    """Attach a block id that is monotone in ``order``: by ``width`` of the
    leading integral column, by given cuts (of as many leading columns as
    they have), or by cuts drawn here (``partitions`` blocks)."""
    order = list(order)
    if isinstance(width, int):
        from clickspark.operators.watermark import floor_div
        return df.withColumn(name, floor_div(F.col(order[0]), width))
    cuts = order_cuts(df, order, partitions) if width is None else width
    found = _search(df, order[:len(cuts[0])] if cuts else order, cuts, name)
    # the number of blocks travels with the column
    return found.withMetadata(name, {"blocks": len(cuts) + 1})


def block_count(df: DataFrame, block: str = BLOCK) -> int | None:
    """Number of blocks of a block column; None for blocks of a fixed width."""
    return df.schema[block].metadata.get("blocks")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared checkpoint folder
    and read it back.

    Used where one intermediate result feeds several branches (a scan's
    rows and its block table, a classification and its summaries):
    without it every branch would recompute the whole lineage, including
    the input scan.  The written table also cuts the lineage, so a lost
    executor does not trigger recomputation of earlier stages, and readers
    get column pruning and vectorized scans.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "clickspark", "stage")
    for paths in getattr(_SCOPES, "open", []):
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SCOPES = threading.local()


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that :func:`materialize` writes inside, at the end:
    for jobs without one, like the micro-batches of a stream.  Frames built
    inside must not be used after it."""
    paths: list[str] = []
    _SCOPES.open = [*getattr(_SCOPES, "open", []), paths]
    try:
        yield
    finally:
        _SCOPES.open.pop()
        to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for p in paths:
            path = to_path(p)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _one_block_per_task(df: DataFrame, block: str) -> DataFrame:
    """Send every block to a task of its own; the result satisfies a window
    clustered by the block, so this is the scan's only exchange of rows.
    Blocks of a fixed width have no bound on their ids and are dealt by
    range."""
    blocks = block_count(df, block)
    if blocks:
        return df.repartitionById(blocks, F.col(block))
    return df.repartitionByRange(2 * shuffle_partitions(df.sparkSession), F.col(block))


def _frame_agg(kind: str, expr: Column) -> Column:
    if kind == "count":
        return F.sum(F.when(expr.isNotNull(), F.lit(1)).otherwise(F.lit(0)))
    return _AGG[kind](expr)


def _merge_agg(kind: str, c: Column) -> Column:
    return F.sum(c) if kind in ("sum", "count") else _AGG[kind](c)


def _combine(kind: str, pre: Column, cur: Column) -> Column:
    if kind == "count":
        return (F.coalesce(pre, F.lit(0)) + F.coalesce(cur, F.lit(0))).cast("long")
    if kind == "sum":
        return (F.when(pre.isNull(), cur).when(cur.isNull(), pre).otherwise(pre + cur))
    if kind == "min":
        return F.least(pre, cur)
    return F.greatest(pre, cur)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            aggs: Mapping[str, tuple[str, Column]], *, exclusive: bool = False,
            block: str = BLOCK, persist_input: bool = False) -> DataFrame:
    """Add running aggregates per ``keys`` in ``order`` (rows up to the
    current one, or strictly before it with ``exclusive=True``).

    ``df`` must carry a block column (see :func:`add_blocks`); ``order``
    must be unique within a key so the result is deterministic.
    ``aggs`` maps output name -> (kind, expression).  ``persist_input``
    materializes the input first when it is expensive to recompute (it is
    read twice: rows and block totals).
    """
    keys, order = list(keys), list(order)
    base_cols = df.columns
    # One struct key: null-safe under plain equality, and the same
    # expression partitions the window and the join (no extra exchange).
    keyed = df.withColumn(KEY, F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0))
    if persist_input:
        keyed = materialize(keyed)

    upper = -1 if exclusive else Window.currentRow
    if keys:
        # (key, block) hashes spread well: a hot key is cut by the blocks
        in_block = Window.partitionBy(KEY, block)
        scanned = keyed
    else:
        # one partition key per block would collide under hashing (several
        # blocks in one task)
        in_block = Window.partitionBy(block)
        scanned = _one_block_per_task(keyed, block)
    in_block = in_block.orderBy(*order).rowsBetween(Window.unboundedPreceding, upper)
    rows = scanned.select("*", *[_frame_agg(kind, e).over(in_block).alias(f"_in_{n}")
                               for n, (kind, e) in aggs.items()])

    totals = keyed.groupBy(KEY, block).agg(
        *[_frame_agg(kind, e).alias(f"_tot_{n}") for n, (kind, e) in aggs.items()])
    # Block table: at most (#keys x #blocks) rows, #blocks rows per key.
    blocks = None if keys else block_count(df, block)
    if blocks:
        carry = _prefix(totals, block, {n: kind for n, (kind, _) in aggs.items()}, blocks)
        # at most FAN rows: broadcast; else dealt as the rows are, and joined in place
        carry = F.broadcast(carry) if blocks <= FAN else _one_block_per_task(
            carry.withMetadata(block, {"blocks": blocks}), block)
        joined = rows.join(carry, on=[block], how="inner")
        return _carried(joined, base_cols, aggs)
    before = Window.partitionBy(KEY).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(KEY, block, *[_merge_agg(kind, F.col(f"_tot_{n}")).over(before)
                                        .alias(f"_pre_{n}") for n, (kind, _) in aggs.items()])
    return _carried(rows.join(carry, on=[KEY, block], how="inner"), base_cols, aggs)


def _carried(joined: DataFrame, base_cols: Sequence[str],
             aggs: Mapping[str, tuple[str, Column]]) -> DataFrame:
    return joined.select(*[F.col(c) for c in base_cols],
                         *[_combine(kind, F.col(f"_pre_{n}"), F.col(f"_in_{n}")).alias(n)
                           for n, (kind, _) in aggs.items()])


def _prefix(totals: DataFrame, block: str, kinds: Mapping[str, str], blocks: int) -> DataFrame:
    """``block, _pre_<name>``: what the blocks before each one sum up to, by a
    tree of FAN children a node."""
    def before(by: list) -> list[Column]:
        frame = Window.partitionBy(*by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
        return [_merge_agg(kind, F.col(f"_tot_{n}")).over(frame).alias(f"_pre_{n}")
                for n, kind in kinds.items()]
    if blocks <= FAN:
        return totals.select(block, *before([]))
    named = totals.withColumn("_up", F.floor(F.col(block) / F.lit(FAN)).cast("int"))
    above = _prefix(named.groupBy(F.col("_up").alias(block)).agg(
        *[_merge_agg(kind, F.col(f"_tot_{n}")).alias(f"_tot_{n}") for n, kind in kinds.items()]),
        block, kinds, -(-blocks // FAN))
    above = above.select(F.col(block).alias("_up"), *[F.col(f"_pre_{n}").alias(f"_top_{n}") for n in kinds])
    both = named.select(block, "_up", *before(["_up"])).join(above, "_up")
    return both.select(block, *[_combine(kind, F.col(f"_top_{n}"), F.col(f"_pre_{n}")).alias(f"_pre_{n}")
                                for n, kind in kinds.items()])
