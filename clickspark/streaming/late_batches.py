"""W7 as a stream without loss: lateness, re-firings and the side output per
micro-batch.

Spark removes rows older than its own watermark before any operator of a
stateful query sees them, so a late row could miss the side output.  Here a
``foreachBatch`` function keeps the state itself in the shared folder.  Each
micro-batch is classified like the batch replay, from the greatest event time
so far on, in its own arrival order; so the results equal the replay's for any
cut into micro-batches.

The state is a log of deltas.  A window's state is the number of its rows by
key, and whether it has fired follows from the watermark, so an epoch only
appends what it adds to the windows that it touches, as a folder ``r=lo-hi-
level`` with a part per window.  What is read is the windows that close in the
epoch and those that have rows within the lateness.  Every MERGE folders of a
level become one of the next, windows past their lateness are deleted, and the
stage tables of a micro-batch are removed at its end: the folder stays bounded
by the open windows, and bytes written follow the touched ones.

An epoch that is repeated after a failure starts from the same state and gives
the same rows: it reads folders of epochs before it, and merges only those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.model import LONG_MIN
from clickspark.operators.generators import Generator, generated
from clickspark.operators.scan import materialize, running, stage_scope
from clickspark.operators.watermark import with_prev_max, window_start
from clickspark.streaming.twins import _fs

#: Folders of a level that are merged into one of the next.
MERGE = 8

Write = Callable[[DataFrame, str, int], None]


def lateness_batches(state_path: str, key: str, order: Sequence[str], size_ms: int, delay_ms: int,
                     lateness_ms: int, write: Write, late_cols: Sequence[str] | None = None,
                     ms: str = "ms", generator: Generator | None = None
                     ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function.  ``order`` is the arrival order inside a
    micro-batch (unique); ``order[-1]`` names the row in re-firings.

    ``write(frame, name, epoch)`` gets ``result`` (key, windowStart,
    windowEnd, kind, seq, count: a ``first`` firing when the watermark passes
    a window, a ``refire`` for each row within the lateness) and ``late``
    (``late_cols``, default all columns, of the rows past it).

    ``generator``: the user's own watermark instead of the greatest event time
    less ``delay_ms`` (0 then).  Its state and its watermark after an epoch
    are kept with the windows.
    """
    if generator is not None and delay_ms:
        raise ValueError("a generator has its own delay")
    order, seq = list(order), order[-1]

    def run(batch: DataFrame, epoch: int) -> None:
        with stage_scope(batch.sparkSession):
            step(batch, epoch)

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = materialize(batch)
        if rows.isEmpty():
            return
        log = _Log(spark, state_path, epoch, rows.schema[key])
        top, state = log.mark()
        if generator is None:
            seen = with_prev_max(rows, order, ms, "prevmax")
            seen = seen.withColumn("prevmax", F.greatest("prevmax", F.lit(top).cast("long")))
            q = materialize(_classify(seen, ms, size_ms, delay_ms, lateness_ms))
            new_top = q.agg(F.max(F.greatest(F.col(ms), F.col("prevmax")))).first()[0]
        else:
            # a watermark w has passed all times up to w + 1, without a delay
            seen = materialize(generated(rows, order, generator, None, state, None if top is None else top - 1))
            q = materialize(_classify(seen.withColumn("prevmax", F.col("_before") + 1), ms, size_ms, 0,
                                      lateness_ms))
            last = seen.agg(F.max("_emit").alias("w"), F.max_by(
                F.struct(*generator.fold.lift), F.struct(*order)).alias("s")).first()
            state = last["s"].asDict()
            new_top = max((t for t in (top, None if last["w"] is None else last["w"] + 1) if t is not None),
                          default=LONG_MIN + 1)
        passed = new_top - delay_ms
        before = None if top is None else top - delay_ms

        win = F.struct(F.col(key), F.col("windowStart"))
        end = F.col("windowStart") + size_ms
        added = materialize(q.where("cls <> 'late'").groupBy(key, "windowStart").agg(
            F.sum(F.when(F.col("cls") == "on_time", 1).otherwise(0)).alias("on_time"),
            F.count(F.lit(1)).alias("kept")))
        # windows within the lateness that have rows: few, whatever the batch
        hit = {r[0] for r in q.where("cls = 'refire'").select("windowStart").distinct().collect()}
        closing = {ws for ws in log.windows() if ws + size_ms <= passed
                   and (before is None or ws + size_ms > before)}
        held = log.read(hit | closing).groupBy(key, "windowStart").agg(F.sum("n").alias("n"))
        closed = added.where(end <= passed)
        both = materialize(held.withColumn("_win", win).drop(key, "windowStart").join(
            closed.withColumn("_win", win).drop(key, "windowStart"), "_win", "full").select(
            "_win", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("on_time", F.lit(0)).alias("on_time"),
            (F.col("_win.windowStart") + size_ms).alias("windowEnd")))

        # a window whose only rows came within the lateness has re-firings alone
        fires = (F.col("windowEnd") <= passed) & (F.col("n") + F.col("on_time") > 0)
        if before is not None:
            fires = fires & (F.col("windowEnd") > before)
        first = both.where(fires).select(
            F.col(f"_win.{key}").alias(key), F.col("_win.windowStart").alias("windowStart"), "windowEnd",
            F.lit("first").alias("kind"), F.lit(None).cast("long").alias(seq),
            (F.col("n") + F.col("on_time")).alias("count"))
        ranked = running(q.where("cls = 'refire'"), [key, "windowStart"], order,
                         {"_rank": ("count", F.lit(1))}).withColumn("_win", win)
        refire = ranked.join(both.select("_win", "n", "on_time"), "_win", "left").select(
            key, "windowStart", "windowEnd", F.lit("refire").alias("kind"), F.col(seq),
            (F.col("n") + F.col("on_time") + F.col("_rank")).alias("count"))
        write(first.unionByName(refire), "result", epoch)
        write(q.where("cls = 'late'").select(*(late_cols or rows.columns)), "late", epoch)

        log.append(added.where(end + lateness_ms > passed)
                   .select(key, F.col("kept").alias("n"), "windowStart"), new_top,
                   None if generator is None else seen.schema, state)
        # windows that had expired before this epoch: a repeat reads the others
        log.tidy(lambda ws: before is not None and ws + size_ms + lateness_ms <= before)
    return run


class _Log:
    """The deltas under ``base`` as an epoch sees them."""

    def __init__(self, spark: SparkSession, base: str, epoch: int, key: T.StructField):
        self.spark, self.base, self.epoch = spark, base, epoch
        self.fs, self.path = _fs(spark, base)
        self.schema = T.StructType([key, T.StructField("n", T.LongType()),
                                    T.StructField("windowStart", T.LongType())])

    def _names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def _delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)

    def folders(self) -> list[tuple[int, int, int, str]]:
        """(lo, hi, level, path) of the complete folders of epochs before this
        one, in order; parts of a merged folder that were not yet deleted do
        not count."""
        found = []
        for name in self._names(self.base):
            if name.startswith("r=") and self.fs.exists(self.path(f"{self.base}/{name}/_SUCCESS")):
                lo, hi, level = map(int, name[2:].split("-"))
                if hi < self.epoch:
                    found.append((lo, hi, level, f"{self.base}/{name}"))
        return sorted(f for f in found if not any(
            o is not f and o[2] > f[2] and o[0] <= f[0] and f[1] <= o[1] for o in found))

    def _parts(self, folder: str) -> dict[int, str]:
        return {int(n[12:]): f"{folder}/{n}" for n in self._names(folder) if n.startswith("windowStart=")}

    def windows(self) -> set[int]:
        return {ws for f in self.folders() for ws in self._parts(f[3])}

    def read(self, windows: Iterable[int] | None = None, folders=None) -> DataFrame:
        """``key, n, windowStart`` of the given windows (default all)."""
        wanted = None if windows is None else set(windows)
        out = self.spark.createDataFrame([], self.schema)
        for *_, folder in self.folders() if folders is None else folders:
            parts = [p for ws, p in self._parts(folder).items() if wanted is None or ws in wanted]
            if parts:
                out = out.unionByName(self.spark.read.schema(self.schema).option("basePath", folder)
                                      .parquet(*parts))
        return out

    def _write(self, rows: DataFrame, lo: int, hi: int, level: int) -> None:
        (rows.select(*self.schema.names).hint("rebalance", "windowStart").write.mode("overwrite")
         .partitionBy("windowStart").parquet(f"{self.base}/r={lo:012d}-{hi:012d}-{level}"))

    def append(self, rows: DataFrame, top: int, schema: T.StructType | None, state: dict | None) -> None:
        self._write(rows, self.epoch, self.epoch, 0)
        # written last: it marks the epoch complete
        held = T.StructType([schema[n] for n in state]) if state else T.StructType()
        fields = T.StructType([T.StructField("top", T.LongType()), *held.fields])
        self.spark.createDataFrame([(top, *(state or {}).values())], fields).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.base}/max={self.epoch:012d}")

    def mark(self) -> tuple[int | None, dict | None]:
        """The greatest event time (or the watermark and one) of the epochs
        before, and the generator's state."""
        done = [n for n in self._names(self.base) if n.startswith("max=") and int(n[4:]) < self.epoch
                and self.fs.exists(self.path(f"{self.base}/{n}/_SUCCESS"))]
        if not done:
            return None, None
        row = self.spark.read.parquet(f"{self.base}/{done[-1]}").first().asDict()
        return row.pop("top"), row or None

    def tidy(self, expired: Callable[[int], bool]) -> None:
        """Delete expired windows and merge full levels, in folders of epochs
        before this one."""
        for f in self.folders():
            parts = self._parts(f[3])
            for ws in filter(expired, parts):
                self._delete(parts[ws])
            if all(map(expired, parts)):
                self._delete(f[3])
        level = 0
        while any(f[2] >= level for f in self.folders()):
            same = [f for f in self.folders() if f[2] == level]
            if len(same) >= MERGE:
                merged = self.read(folders=same).groupBy(self.schema.names[0], "windowStart").agg(
                    F.sum("n").alias("n"))
                self._write(merged, same[0][0], same[-1][1], level + 1)
            level += 1
        kept = {f[3] for f in self.folders()}
        for name in self._names(self.base):
            if name.startswith("r=") and int(name[2:].split("-")[1]) < self.epoch \
                    and f"{self.base}/{name}" not in kept:
                self._delete(f"{self.base}/{name}")
        tops = [n for n in self._names(self.base) if n.startswith("max=") and int(n[4:]) < self.epoch]
        for n in tops[:-1]:
            self._delete(f"{self.base}/{n}")


def _classify(seen: DataFrame, ms: str, size_ms: int, delay_ms: int, lateness_ms: int) -> DataFrame:
    """Rows with their window and fate, by what the watermark had reached
    (``prevmax`` less the delay) when they came."""
    q = seen.withColumn("windowStart", window_start(ms, size_ms))
    q = q.withColumn("windowEnd", F.col("windowStart") + size_ms)
    passed = F.col("prevmax") - delay_ms
    return q.withColumn("cls", F.when(F.col("prevmax").isNull() | (passed < F.col("windowEnd")), "on_time")
                        .when(passed < F.col("windowEnd") + lateness_ms, "refire").otherwise("late"))
