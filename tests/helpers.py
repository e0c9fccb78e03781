"""Fixture builders for the golden-transcript tests."""

from __future__ import annotations

import datetime as dt

UTC8 = dt.timezone(dt.timedelta(hours=8))


def ms_of(text: str) -> int:
    """Epoch ms of a transcript timestamp printed in UTC+8."""
    base, _, frac = text.partition(".")
    t = dt.datetime.strptime(base, "%Y-%m-%d %H:%M:%S").replace(tzinfo=UTC8)
    return int(t.timestamp()) * 1000 + int((frac + "000")[:3])


def clicks(spark, rows):
    """rows: (user, url, ms); seq = position (arrival order)."""
    data = [(i, u, l, m) for i, (u, l, m) in enumerate(rows)]
    return spark.createDataFrame(data, "seq long, user string, url string, ms long")


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
