"""Custom stateful streaming operators (``transformWithStateInPandas``).

Streaming twins of the replays in :mod:`clickspark.operators.late`,
:mod:`clickspark.operators.triggers` and :mod:`clickspark.operators.timers`.

Watermark mapping.  The reference watermark before a row is
``max(event time so far) - d - 1``.  Spark's watermark in a micro-batch is
``max(event time of earlier batches) - D``, and Spark drops rows older than
it before they reach the processor.  The late-data processor therefore
declares ``D = d + size + lateness`` (so every row the reference still
accepts gets through), derives the reference watermark as
``spark_wm + D - d - 1`` and does the window-level late test itself.
Timers are registered on Spark's clock: a window fires when
``spark_wm >= end - size - lateness`` and its state is dropped when
``spark_wm >= start``.

Within a micro-batch rows are handled before timers, and a batch's rows
have no order, so the twins equal the replays exactly with one row per
batch and up to batch granularity otherwise.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processors are also unpickled by the driver-side Python runner of
# transformWithState, which does not see files added with addPyFile: ship
# this module's classes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_WIN_STATE = T.StructType([T.StructField("count", T.LongType()),
                           T.StructField("fired", T.BooleanType())])
_LONG = T.StructType([T.StructField("v", T.LongType())])

LATE_SCHEMA = ("key string, windowStart long, windowEnd long, kind string, count long, "
               "ms long, watermark long")
EARLY_SCHEMA = "key string, windowStart long, windowEnd long, timer long, count long"
TIMER_SCHEMA = "key string, kind string, at_ms long"


def enable_state_store(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def ship_by_value(obj) -> None:
    """Pickle the module of a user's class or function by value, too."""
    module = sys.modules.get(getattr(obj, "__module__", None) or type(obj).__module__)
    if module is not None and module.__name__ != "__main__":
        cloudpickle.register_pickle_by_value(module)


def _spark_wm(timer_values) -> int | None:
    wm = timer_values.getCurrentWatermarkInMs()
    # 0 (or less) means "no watermark yet"; keep event times away from epoch 0
    return wm if wm and wm > 0 else None


class LatenessProcessor(StatefulProcessor):
    """W5/W7 twin: tumbling count per key with bounded delay ``d``, allowed
    lateness and a late side output (``kind`` = first / refire / late)."""

    def __init__(self, size_ms: int, delay_ms: int, lateness_ms: int = 0):
        self.size, self.d, self.late = size_ms, delay_ms, lateness_ms
        self.spark_delay = delay_ms + size_ms + lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.wins = handle.getMapState("windows", _LONG, _WIN_STATE)

    def _ref_wm(self, tv) -> int | None:
        wm = _spark_wm(tv)
        return None if wm is None else wm + self.spark_delay - self.d - 1

    def _first(self, key, ws: int, count: int, wm) -> tuple:
        return (key, ws, ws + self.size, "first", count, None, wm)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        k = key[0]
        ref = self._ref_wm(timerValues)
        # one pass over the key's window state, rows handled in memory, only
        # changed windows written back (state calls per batch, not per row)
        wins = {ws: (count, fired) for (ws,), (count, fired) in self.wins.iterator()}
        changed: set[int] = set()
        out = []
        if ref is not None:
            # windows the watermark already closed fire before new rows count
            for ws, (count, fired) in wins.items():
                if not fired and ref >= ws + self.size - 1:
                    out.append(self._first(k, ws, count, ref))
                    wins[ws] = (count, True)
                    changed.add(ws)
        for pdf in rows:
            for ms in pdf["ms"].tolist():
                ms = int(ms)
                ws = ms - ms % self.size
                we = ws + self.size
                if ref is not None and ref >= we - 1 + self.late:
                    out.append((k, ws, we, "late", None, ms, ref))
                    continue
                if ws in wins:
                    count, fired = wins[ws]
                else:
                    count, fired = 0, False
                    self.handle.registerTimer(we - self.size - self.late)   # fire
                    self.handle.registerTimer(ws)                          # clean up
                count += 1
                if not fired and ref is not None and ref >= we - 1:
                    fired = True                       # first firing happens now
                    out.append(self._first(k, ws, count, ref))
                elif fired:
                    out.append((k, ws, we, "refire", count, ms, ref))
                wins[ws] = (count, fired)
                changed.add(ws)
        for ws in changed:
            self.wins.updateValue((ws,), wins[ws])
        yield pd.DataFrame(out, columns=["key", "windowStart", "windowEnd", "kind", "count",
                                         "ms", "watermark"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        k = key[0]
        t = expiredTimerInfo.getExpiryTimeInMs()
        ref = self._ref_wm(timerValues)
        out = []
        fire_ws = t + self.late               # window whose fire timer this is
        if self.wins.containsKey((fire_ws,)):
            count, fired = self.wins.getValue((fire_ws,))
            if not fired:
                out.append(self._first(k, fire_ws, count, ref))
                self.wins.updateValue((fire_ws,), (count, True))
        if self.wins.containsKey((t,)):        # window whose clean-up timer this is
            count, fired = self.wins.getValue((t,))
            if not fired:
                out.append(self._first(k, t, count, ref))
            self.wins.removeKey((t,))
        yield pd.DataFrame(out, columns=["key", "windowStart", "windowEnd", "kind", "count",
                                         "ms", "watermark"])

    def close(self) -> None:
        pass


def lateness_stream(clicks: DataFrame, key: str, size_ms: int, delay_ms: int,
                    lateness_ms: int = 0, ts: str = "ts") -> DataFrame:
    """W5 (``lateness_ms=0``) / W7 streaming: rows of ``LATE_SCHEMA``."""
    enable_state_store(clicks.sparkSession)
    proc = LatenessProcessor(size_ms, delay_ms, lateness_ms)
    src = clicks.withWatermark(ts, f"{proc.spark_delay} milliseconds")
    return (src.groupBy(key).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=LATE_SCHEMA, outputMode="Append",
        timeMode="EventTime"))


class EarlyFiringProcessor(StatefulProcessor):
    """W6 twin, grouped by (key, window) so state is window-scoped like the
    reference's trigger state (value / update / clear, ST1): the window's
    count and the next timer to fire.

    The query declares ``D = delay + size``, so no row of an open window is
    removed before it gets here; rows of a closed window are dropped here.
    The reference watermark is ``spark_wm + D - delay - 1``.  Timers are set
    for every ``step`` and for ``end - 1``; those that the watermark has
    passed fire before a batch's rows count, and those passed when the window
    opens fire right after its first rows.  The close timer clears the state.
    """

    def __init__(self, size_ms: int, step_ms: int, purge: bool = False, delay_ms: int = 0):
        self.size, self.step, self.purge, self.d = size_ms, step_ms, purge, delay_ms
        self.spark_delay = delay_ms + size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", T.StructType([
            T.StructField("count", T.LongType()), T.StructField("next", T.LongType())]))

    def _ref_wm(self, tv) -> int | None:
        wm = _spark_wm(tv)
        return None if wm is None else wm + self.size - 1

    def _timers(self, ws: int) -> list[int]:
        return [*range(ws, ws + self.size, self.step), ws + self.size - 1]

    def _fire(self, key, ws: int, count: int, nxt: int, ref: int | None) -> tuple[list, int, int]:
        """Fire the timers from the ``nxt``-th on that ``ref`` has passed."""
        out, timers = [], self._timers(ws)
        while ref is not None and nxt < len(timers) and timers[nxt] <= ref:
            if count or not self.purge:
                out.append((key, ws, ws + self.size, timers[nxt], count))
            if self.purge:
                count = 0
            nxt += 1
        return out, count, nxt

    def _keep(self, ws: int, count: int, nxt: int) -> None:
        if nxt < len(self._timers(ws)):
            self.window.update((count, nxt))
        else:
            self.window.clear()

    def _frame(self, out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["key", "windowStart", "windowEnd", "timer", "count"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        k, ws = key[0], int(key[1])
        ref, n = self._ref_wm(timerValues), sum(len(pdf) for pdf in rows)
        out: list = []
        known = self.window.exists()
        if known:
            count, nxt = self.window.get()
            out, count, nxt = self._fire(k, ws, count, nxt, ref)
        else:
            count, nxt = 0, 0
        if ref is None or ref < ws + self.size - 1:      # the window is open
            if not known:
                for t in self._timers(ws):
                    self.handle.registerTimer(t + 1 - self.size)
                more, count, nxt = self._fire(k, ws, n, 0, ref)
                out += more
            else:
                count += n
            self._keep(ws, count, nxt)
        elif known:
            self._keep(ws, count, nxt)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        k, ws = key[0], int(key[1])
        out: list = []
        if self.window.exists():
            count, nxt = self.window.get()
            upto = expiredTimerInfo.getExpiryTimeInMs() - 1 + self.size
            out, count, nxt = self._fire(k, ws, count, nxt, upto)
            self._keep(ws, count, nxt)
        yield self._frame(out)

    def close(self) -> None:
        pass


def early_firings_stream(clicks: DataFrame, key: str, size_ms: int, step_ms: int,
                         purge: bool = False, ts: str = "ts", ms: str = "ms",
                         delay_ms: int = 0) -> DataFrame:
    from pyspark.sql import functions as F
    enable_state_store(clicks.sparkSession)
    proc = EarlyFiringProcessor(size_ms, step_ms, purge, delay_ms)
    src = (clicks.withWatermark(ts, f"{proc.spark_delay} milliseconds")
           .withColumn("_ws", F.col(ms) - F.pmod(F.col(ms), F.lit(size_ms))))
    return src.groupBy(key, "_ws").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=EARLY_SCHEMA, outputMode="Append",
        timeMode="EventTime")


class ProcessingTimerProcessor(StatefulProcessor):
    """PF2 twin: each arrival emits its processing time and registers a
    processing-time timer ``delay`` later; each timer emits its time."""

    def __init__(self, delay_ms: int):
        self.delay = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        out = []
        for pdf in rows:
            for _ in range(len(pdf)):
                out.append((key[0], "arrival", now))
        if out:
            self.handle.registerTimer(now + self.delay)
        yield pd.DataFrame(out, columns=["key", "kind", "at_ms"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame([(key[0], "timer", expiredTimerInfo.getExpiryTimeInMs())],
                           columns=["key", "kind", "at_ms"])

    def close(self) -> None:
        pass


def processing_timers_stream(clicks: DataFrame, delay_ms: int, key: str | None = None
                             ) -> DataFrame:
    from pyspark.sql import functions as F
    enable_state_store(clicks.sparkSession)
    k = F.col(key).cast("string") if key else F.lit("true")
    return clicks.withColumn("key", k).groupBy("key").transformWithStateInPandas(
        statefulProcessor=ProcessingTimerProcessor(delay_ms), outputStructType=TIMER_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime")
