"""Rolling aggregates on streams: a row per row, for any cut into batches."""

import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickspark.operators import folds
from clickspark.operators import rolling as R
from clickspark.operators.folds import Fold, rolling_reduce
from clickspark.streaming.rolling import rolling_rows, running_top


def rows_of(n, seed):
    r = random.Random(seed)
    return [(i, "hot" if i % 3 == 0 else r.choice(["a", "b", "c", None]), "u" * r.randrange(1, 9),
             None if r.random() < 0.1 else r.randrange(20)) for i in range(n)]


SCHEMA = "seq long, user string, url string, v long"


def stream_of(spark, rows, cuts):
    """Rows as one Parquet file per micro-batch."""
    import os
    d = tempfile.mkdtemp(prefix="clickspark-roll-", dir="/tmp")
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        part = rows[a:b]
        random.Random(n).shuffle(part)     # order inside a batch is that of seq
        pd.DataFrame(part, columns=["seq", "user", "url", "v"]).astype({"v": "Int64"}).to_parquet(
            f"{d}/b{n:03d}.parquet")
        os.utime(f"{d}/b{n:03d}.parquet", (1_600_000_000 + n, 1_600_000_000 + n))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(d)


def collected(stream, each=None):
    out = []

    def take(batch, epoch):
        if each:
            each(batch, epoch)
        else:
            out.extend(batch.collect())
    ck = tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp")
    q = (stream.writeStream.foreachBatch(take).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    return out


def longest():
    def merge(a, b):
        later = b["best"].str.len() > a["best"].str.len()
        return pd.DataFrame({"best": a["best"].where(~later, b["best"]),
                             "at": a["at"].where(~later, b["at"])})
    return Fold({"best": F.col("url"), "at": F.col("seq")}, merge)


@pytest.mark.parametrize("cuts", [[], [1, 2, 40], [30, 31, 60, 61]])
def test_stream_rows_equal_the_batch_rows(spark, cuts):
    rows = rows_of(90, 3)
    df = spark.createDataFrame(rows, SCHEMA)
    for fold in (longest(), folds.extreme_row_fold("max", "v", ["url", "seq"]), folds.sum_fold("v", "s")):
        got = collected(rolling_rows(stream_of(spark, rows, cuts), "user", "seq", fold))
        want = rolling_reduce(df, ["user"], ["seq"], fold, 16).collect()
        assert len(got) == len(rows)
        assert sorted(map(tuple, got), key=repr) == sorted(
            (tuple(r[c] for c in got[0].__fields__) for r in want), key=repr)


def test_running_top_follows_every_update(spark):
    rows = rows_of(80, 5)
    top, folder = [], tempfile.mkdtemp(prefix="clickspark-top-", dir="/tmp") + "/best"
    step = running_top(folder, lambda frame, epoch: top.extend(frame.collect()), "user", "seq")

    def twice(batch, epoch):
        """A repeated epoch gives the same rows."""
        before = len(top)
        step(batch, epoch)
        once = sorted(map(tuple, top[before:]))
        del top[before:]
        step(batch, epoch)
        assert sorted(map(tuple, top[before:])) == once
    counts = rolling_rows(stream_of(spark, rows, [7, 8, 50]), "user", "seq", folds.count_fold())
    collected(counts, each=twice)
    batch = R.rolling_count(spark.createDataFrame(rows, SCHEMA), "user", "seq", width=16)
    want = R.running_top(batch.select("user", "seq", "count"), "user", "seq", width=16).collect()
    assert sorted(map(tuple, top)) == sorted(map(tuple, want))
