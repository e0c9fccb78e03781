"""The keyed table as a merge-on-read log."""

import os
import random
import tempfile

import pytest

from clickspark.sinks import upserts as UP

SCHEMA = "user string, url string, seq long"


def table(spark):
    path = tempfile.mkdtemp(prefix="clickspark-upserts-", dir="/tmp") + "/clicks"
    return UP.Upserts(spark, path, "user", "url", "seq")


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(t):
    return {r.user: (r.url, r.seq) for r in t.read().collect()}


def test_last_write_wins_over_many_merges(spark, monkeypatch):
    monkeypatch.setattr(UP, "MERGE", 3)
    monkeypatch.setattr(UP, "ROWS_PER_BUCKET", 2)
    t, r, want, seq = table(spark), random.Random(6), {}, 0
    assert t.read() is None and t.lookup(["a"]) is None
    for epoch in range(11):
        rows = []
        for _ in range(r.randrange(1, 40)):
            rows.append((f"u{r.randrange(60)}" if r.random() < 0.9 else None, f"./{seq}", seq))
            seq += 1
        r.shuffle(rows)
        assert t.upsert(batch(spark, rows), epoch)
        for u, url, s in sorted(rows, key=lambda x: x[2]):
            want[u] = (url, s)
    assert content(t) == want
    now = t.version()
    assert now["bits"] > UP.BITS and max(x["level"] for x in now["runs"]) == 2
    assert all(sum(x["level"] == k for x in now["runs"]) < 3 for k in range(3))
    assert len(os.listdir(f"{t.path}/versions")) <= 6 and len(t._versions()) == 2
    asked = [u for u in want if u][:5]
    assert {x.user: (x.url, x.seq) for x in t.lookup(asked).collect()} == {u: want[u] for u in asked}
    # a repeated epoch changes nothing
    assert not t.upsert(batch(spark, [("u1", "./again", 10**6)]), 10)
    assert content(t) == want


def test_a_batch_of_one_key_writes_that_key(spark):
    t = table(spark)
    t.upsert(batch(spark, [(f"u{i}", "./x", i) for i in range(500)]), 0)
    t.upsert(batch(spark, [("u7", "./y", 1000)]), 1)
    assert [x["rows"] for x in t.version()["runs"]] == [500, 1]
    assert content(t)["u7"] == ("./y", 1000) and len(content(t)) == 500


def test_a_failed_publish_leaves_the_last_version(spark, monkeypatch):
    t = table(spark)
    t.upsert(batch(spark, [("a", "./1", 1), ("b", "./2", 2)]), 0)
    with monkeypatch.context() as m:
        def fail(self, manifest):
            raise OSError("lost")
        m.setattr(UP.Upserts, "_publish", fail)
        with pytest.raises(OSError):
            t.upsert(batch(spark, [("a", "./3", 3), ("c", "./4", 4)]), 1)
    assert content(t) == {"a": ("./1", 1), "b": ("./2", 2)}
    t.upsert(batch(spark, [("a", "./3", 3), ("c", "./4", 4)]), 1)  # the epoch again
    assert content(t) == {"a": ("./3", 3), "b": ("./2", 2), "c": ("./4", 4)}
    # the runs of the failed attempt are gone
    named = {x["name"] for n in t._versions() for x in t._manifest(n)["runs"]}
    assert set(os.listdir(f"{t.path}/runs")) == named


def test_upserts_in_a_stream(spark):
    source = tempfile.mkdtemp(prefix="clickspark-upserts-", dir="/tmp")
    for i in range(3):
        batch(spark, [("a", f"./{i}", i), (f"u{i}", "./x", i)]).coalesce(1).write.parquet(f"{source}/in{i}")
    t = table(spark)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{source}/in*")
    q = (stream.writeStream.foreachBatch(UP.upsert_log(spark, t.path, "user", "url", "seq"))
         .option("checkpointLocation", f"{source}/ck").trigger(availableNow=True).start())
    q.awaitTermination(200)
    assert content(t) == {"a": ("./2", 2), "u0": ("./x", 0), "u1": ("./x", 1), "u2": ("./x", 2)}
