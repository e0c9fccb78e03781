"""W6 / ST2 on streams: window triggers given by the user.

A :class:`Trigger` decides, for one (key, window), what happens on a row, on a
timer of event or processing time, and at the end.  Its answers are CONTINUE,
FIRE (report the window), PURGE (forget its rows) or both, FIRE_AND_PURGE.  It
sees the window, the watermark and a state scoped to the key and window, and
registers timers through its :class:`Context`; timers of one time are one
timer.

:class:`TriggerProcessor` runs it on ``transformWithStateInPandas``, grouped by
(key, window), so windows of a hot key are apart.  The window's count, the
trigger's state and its pending timers are one value, read and written once a
batch.  The watermark is the reference's, ``max(event time) - delay - 1``: the
query declares ``delay + size`` to Spark, so that no row of an open window is
removed, and shifts timers accordingly.  Timers that the watermark has passed
fire at once, in order.  The window's own end (``end - 1``) is a timer that
every event-time trigger has; after it the window is cleared.

Rows of a batch are handled in order of ``ms``; as in all stateful streams,
order is exact up to one micro-batch.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickspark.streaming.stateful import _spark_wm, enable_state_store, ship_by_value

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CONTINUE, FIRE, PURGE, FIRE_AND_PURGE = 0, 1, 2, 3  # bits: fire, purge

#: ``timer``: the time that fired, null when a row did.
SCHEMA = "key string, windowStart long, windowEnd long, timer long, count long"


class Context:
    """What a trigger sees of its window.  ``state`` is a dictionary of plain
    values (JSON) that lives as long as the window."""

    def __init__(self, start: int, end: int, watermark: int | None, now: int | None, state: dict,
                 event_timers: set[int], processing_timers: set[int]):
        self.start, self.end = start, end
        self.watermark, self.processing_time = watermark, now
        self.state = state
        self._event, self._processing = event_timers, processing_timers

    def register_event_timer(self, at: int) -> None:
        self._event.add(int(at))

    def delete_event_timer(self, at: int) -> None:
        self._event.discard(int(at))

    def register_processing_timer(self, at: int) -> None:
        self._processing.add(int(at))


class Trigger:
    """The default never fires before the window's end, and then once."""

    def on_element(self, ms: int, ctx: Context) -> int:
        return CONTINUE

    def on_event_time(self, at: int, ctx: Context) -> int:
        return FIRE if at == ctx.end - 1 else CONTINUE

    def on_processing_time(self, at: int, ctx: Context) -> int:
        return CONTINUE

    def clear(self, ctx: Context) -> None:
        ctx.state.clear()


class EveryStep(Trigger):
    """The reference's trigger: on the window's first row a timer for every
    ``step`` of the window; each timer fires, with ``purge`` it also purges."""

    def __init__(self, step_ms: int, purge: bool = False):
        self.step, self.answer = step_ms, FIRE_AND_PURGE if purge else FIRE

    def on_element(self, ms: int, ctx: Context) -> int:
        if not ctx.state.get("set"):
            ctx.state["set"] = True
            for at in range(ctx.start, ctx.end, self.step):
                ctx.register_event_timer(at)
        return CONTINUE

    def on_event_time(self, at: int, ctx: Context) -> int:
        return self.answer


class EveryCount(Trigger):
    """Fires, or fires and purges, with every ``n``-th row; what is left fires
    at the window's end."""

    def __init__(self, n: int, purge: bool = True):
        self.n, self.answer = n, FIRE_AND_PURGE if purge else FIRE

    def on_element(self, ms: int, ctx: Context) -> int:
        seen = ctx.state.get("seen", 0) + 1
        ctx.state["seen"] = seen % self.n
        return self.answer if seen == self.n else CONTINUE

    def on_event_time(self, at: int, ctx: Context) -> int:
        return FIRE if ctx.state.get("seen") else CONTINUE


class AfterProcessingTime(Trigger):
    """Fires ``wait_ms`` of processing time after a window's first row since
    the last firing; for ``clock='processing'``."""

    def __init__(self, wait_ms: int, purge: bool = True):
        self.wait, self.answer = wait_ms, FIRE_AND_PURGE if purge else FIRE

    def on_element(self, ms: int, ctx: Context) -> int:
        if not ctx.state.get("due"):
            ctx.state["due"] = ctx.processing_time + self.wait
            ctx.register_processing_timer(ctx.state["due"])
        return CONTINUE

    def on_processing_time(self, at: int, ctx: Context) -> int:
        ctx.state["due"] = None
        return self.answer


_KEPT = T.StructType([T.StructField("count", T.LongType()), T.StructField("state", T.StringType()),
                      T.StructField("timers", T.ArrayType(T.LongType()))])


class TriggerProcessor(StatefulProcessor):
    """Runs a trigger over tumbling windows of ``size_ms``, grouped by (key,
    window start)."""

    def __init__(self, trigger: Trigger, size_ms: int, delay_ms: int = 0, clock: str = "event"):
        if clock not in ("event", "processing"):
            raise ValueError(clock)
        self.trigger, self.size, self.delay, self.clock = trigger, size_ms, delay_ms, clock
        self.spark_delay = delay_ms + size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("window", _KEPT)

    # -- the window of one call -------------------------------------------------

    def _open(self, key, values) -> None:
        self.key, self.start = key[0], int(key[1])
        self.end = self.start + self.size
        wm = _spark_wm(values) if self.clock == "event" else None
        self.watermark = None if wm is None else wm + self.size - 1
        self.known = self.kept.exists()
        count, state, timers = self.kept.get() if self.known else (0, "{}", [])
        self.count, self.out = count, []
        self.timers, self.before = set(timers), set(timers)
        now = values.getCurrentProcessingTimeInMs() if self.clock == "processing" else None
        other: set[int] = set()
        event, processing = (self.timers, other) if self.clock == "event" else (other, self.timers)
        self.ctx = Context(self.start, self.end, self.watermark, now, json.loads(state), event, processing)

    def _answered(self, answer: int, at: int | None) -> None:
        # a purged window has nothing to report
        if answer & FIRE and (self.count or not answer & PURGE):
            self.out.append((self.key, self.start, self.end, at, self.count))
        if answer & PURGE:
            self.count = 0

    def _due(self, upto: int | None) -> bool:
        """Fire the timers up to ``upto`` in order; whether the window ended."""
        ask = self.trigger.on_event_time if self.clock == "event" else self.trigger.on_processing_time
        while upto is not None and self.timers and min(self.timers) <= upto:
            at = min(self.timers)
            self.timers.discard(at)
            if self.clock == "event" and at == self.end - 1:
                return self._ended()
            self._answered(ask(at, self.ctx), at)
        return False

    def _ended(self) -> bool:
        for at in sorted(t for t in self.timers if t < self.end - 1):
            self.timers.discard(at)
            self._answered(self.trigger.on_event_time(at, self.ctx), at)
        self._answered(self.trigger.on_event_time(self.end - 1, self.ctx), self.end - 1)
        self.trigger.clear(self.ctx)
        return True

    def _close(self, ended: bool) -> Iterator[pd.DataFrame]:
        if ended:
            self.kept.clear()
        else:
            shift = 1 - self.size if self.clock == "event" else 0
            for at in sorted(self.timers - self.before):
                self.handle.registerTimer(at + shift)
            self.kept.update((self.count, json.dumps(self.ctx.state), sorted(self.timers)))
        yield pd.DataFrame(self.out, columns=["key", "windowStart", "windowEnd", "timer", "count"])

    # -- calls by Spark -----------------------------------------------------------

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._open(key, timerValues)
        event = self.clock == "event"
        ended = self.known and self._due(self.watermark if event else self.ctx.processing_time)
        late = event and self.watermark is not None and self.watermark >= self.end - 1
        if ended or late:
            yield from self._close(True)
            return
        if event:
            self.timers.add(self.end - 1)
        for ms in sorted(int(v) for pdf in rows for v in pdf["ms"]):
            self.count += 1
            self._answered(self.trigger.on_element(ms, self.ctx), None)
            ended = self._due(self.watermark if event else self.ctx.processing_time)
        yield from self._close(ended)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._open(key, timerValues)
        if not self.known:
            yield pd.DataFrame([], columns=["key", "windowStart", "windowEnd", "timer", "count"])
            return
        at = expiredTimerInfo.getExpiryTimeInMs() + (self.size - 1 if self.clock == "event" else 0)
        yield from self._close(self._due(at))

    def close(self) -> None:
        pass


def triggered(clicks: DataFrame, key: str, size_ms: int, trigger: Trigger, delay_ms: int = 0,
              ts: str = "ts", ms: str = "ms", clock: str = "event") -> DataFrame:
    """Rows of ``SCHEMA``, one a firing, of tumbling windows under a trigger.
    Under ``clock='processing'`` windows stay until their trigger purges them
    (there is no watermark to end them)."""
    enable_state_store(clicks.sparkSession)
    ship_by_value(type(trigger))
    proc = TriggerProcessor(trigger, size_ms, delay_ms, clock)
    src = clicks.withWatermark(ts, f"{proc.spark_delay} milliseconds") if clock == "event" else clicks
    src = src.withColumn("_ws", F.col(ms) - F.pmod(F.col(ms), F.lit(size_ms)))
    if ms != "ms":
        src = src.withColumn("ms", F.col(ms))
    return src.groupBy(key, "_ws").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=SCHEMA, outputMode="Append",
        timeMode="EventTime" if clock == "event" else "ProcessingTime")
