"""Triggers given by the user, on streams of one row per micro-batch."""

import json

import pytest

from clickspark.operators.triggers import early_firings
from clickspark.streaming import triggers as TG
from clickspark.streaming import twins as TW
from helpers import clicks, ms_of
from test_replay import TRIGGER
from test_streaming import BASE, _feed, _run

TIMES = [1000, 5000, 2000, 5000, 9000, 12_500, 3000, 14_000, 11_000, 31_000, 12_000, 45_000]


@pytest.mark.parametrize("delay, purge", [(0, False), (3000, False), (0, True)])
def test_the_references_trigger_is_the_replay(spark, delay, purge):
    rows = [("a", "./x", BASE + t) for t in TIMES]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    out = _run(TG.triggered(src, "url", 10000, TG.EveryStep(1000, purge), delay), f"tg_{delay}_{purge}")
    batch = early_firings(clicks(spark, rows), "url", "seq", 10000, 1000, delay, purge=purge).collect()
    want = sorted((r.url, r.timer, r["count"]) for r in batch if r.fired_at is not None)
    assert sorted((r.key, r.timer, r["count"]) for r in out) == want and len(want) > 5


def test_the_references_transcript(spark):
    rows = [(u, l, ms_of(f"2022-05-12 {t}")) for u, l, t in TRIGGER]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    out = _run(TG.triggered(src, "url", 10000, TG.EveryStep(1000)), "tg_transcript")
    batch = early_firings(clicks(spark, rows), "url", "seq", 10000, 1000, width=2).collect()
    want = sorted((r.url, r.timer, r["count"]) for r in batch if r.fired_at is not None)
    assert sorted((r.key, r.timer, r["count"]) for r in out) == want


class Loop:
    """A trigger run row by row over (url, ms), by the reference's rules."""

    def __init__(self, trigger, size, delay=0):
        self.trigger, self.size, self.delay, self.out = trigger, size, delay, []
        self.windows = {}

    def answer(self, w, what, at):
        if what & TG.FIRE and (w["n"] or not what & TG.PURGE):
            self.out.append((w["url"], w["ctx"].start, at, w["n"]))
        if what & TG.PURGE:
            w["n"] = 0

    def due(self, wm):
        for k in sorted(self.windows):
            w = self.windows[k]
            while w["timers"] and min(w["timers"]) <= wm:
                at = min(w["timers"])
                w["timers"].discard(at)
                self.answer(w, self.trigger.on_event_time(at, w["ctx"]), at)
        self.windows = {k: w for k, w in self.windows.items() if wm < w["ctx"].end - 1}

    def run(self, rows):
        top = None
        for url, ms in rows:
            start = ms - ms % self.size
            wm = -1 if top is None else top - self.delay - 1
            if wm < start + self.size - 1:
                w = self.windows.get((url, start))
                if w is None:
                    timers = {start + self.size - 1}
                    ctx = TG.Context(start, start + self.size, wm, None, {}, timers, set())
                    w = self.windows[url, start] = {"url": url, "n": 0, "timers": timers, "ctx": ctx}
                w["n"] += 1
                self.answer(w, self.trigger.on_element(ms, w["ctx"]), None)
            top = ms if top is None else max(top, ms)
            self.due(top - self.delay - 1)
        return sorted(self.out, key=repr)


@pytest.mark.parametrize("n, purge", [(2, True), (3, False)])
def test_count_trigger(spark, n, purge):
    rows = [("a", f"./{'xy'[i % 3 == 0]}", BASE + t) for i, t in enumerate(TIMES)]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    out = _run(TG.triggered(src, "url", 10000, TG.EveryCount(n, purge)), f"tg_count_{n}")
    want = Loop(TG.EveryCount(n, purge), 10000).run([(u, ms) for _, u, ms in rows])
    assert sorted(((r.key, r.windowStart, r.timer, r["count"]) for r in out), key=repr) == want
    assert any(t is None for _, _, t, _ in want) and any(t is not None for _, _, t, _ in want)


class FirstAndLast(TG.Trigger):
    """A user's own: fires with the first row and purges at the half."""

    def on_element(self, ms, ctx):
        ctx.register_event_timer((ctx.start + ctx.end) // 2)
        ctx.state["rows"] = ctx.state.get("rows", 0) + 1
        return TG.FIRE if ctx.state["rows"] == 1 else TG.CONTINUE

    def on_event_time(self, at, ctx):
        return TG.FIRE if at == ctx.end - 1 else TG.PURGE


def test_a_trigger_of_the_users_own(spark):
    rows = [("a", "./x", BASE + t) for t in [1000, 2000, 7000, 8000, 9000, 21_000, 22_000, 27_000, 41_000]]
    src = TW.click_lines_stream(spark, _feed(rows), files_per_trigger=1)
    out = _run(TG.triggered(src, "url", 10000, FirstAndLast()), "tg_own")
    want = Loop(FirstAndLast(), 10000).run([(u, ms) for _, u, ms in rows])
    assert sorted(((r.key, r.windowStart, r.timer, r["count"]) for r in out), key=repr) == want


def test_processing_time_trigger_fires_and_purges():
    """The processor's own calls, with a clock that the test holds."""
    class Values:
        now = 1000

        def getCurrentProcessingTimeInMs(self):
            return self.now

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, v):
            self.value = v

        def clear(self):
            self.value = None

    class Handle:
        def __init__(self):
            self.timers, self.state = [], State()

        def getValueState(self, name, schema):
            return self.state

        def registerTimer(self, at):
            self.timers.append(at)

    class Info:
        def getExpiryTimeInMs(self):
            return 1500
    import pandas as pd
    proc, handle, values = TG.TriggerProcessor(TG.AfterProcessingTime(500), 10000, clock="processing"), \
        Handle(), Values()
    proc.init(handle)

    def rows(*ms):
        return iter([pd.DataFrame({"ms": list(ms)})])

    def fired(frames):
        return [tuple(r) for f in frames for r in f.itertuples(index=False)]
    assert fired(proc.handleInputRows(("k", 0), rows(1, 2), values)) == [] and handle.timers == [1500]
    values.now = 1200
    assert fired(proc.handleInputRows(("k", 0), rows(3), values)) == []
    values.now = 1600
    assert fired(proc.handleExpiredTimer(("k", 0), values, Info())) == [("k", 0, 10000, 1500, 3)]
    assert handle.state.value[0] == 0 and json.loads(handle.state.value[1])["due"] is None
    assert fired(proc.handleInputRows(("k", 0), rows(4), values)) == [] and handle.timers == [1500, 2100]
