"""Text files that roll by size, age and idle time."""

import os
import tempfile

from pyspark.sql import functions as F

from clickspark.sinks import rolling as RF


def target():
    return tempfile.mkdtemp(prefix="clickspark-files-", dir="/tmp")


def put(path, lines, limits=RF.Limits()):
    """One task's pieces."""
    return RF.RollingTextWriter(path, limits).write(iter([(x,) for x in lines]))


def published(path):
    return sorted(f for f in os.listdir(path) if f.startswith("part-"))


def entered(path, limits, batch, pieces, at):
    ledger = RF.Ledger(RF.Folder(path), limits)
    if ledger.add(batch, pieces, at):
        ledger.save()


def test_a_file_rolls_at_its_size():
    path, limits = target(), RF.Limits(max_bytes=20)
    for batch in range(4):
        entered(path, limits, batch, put(path, ["12345"], limits).pieces, 100.0 + batch)
        assert published(path) == (["part-000000-0000.txt", "part-000000-0001.txt", "part-000000-0002.txt",
                                    "part-000000-0003.txt"] if batch == 3 else [])
    # one large batch: a task starts a new piece at the size, each is a file
    entered(path, limits, 4, put(path, ["x" * 9] * 5, limits).pieces, 105.0)
    assert [f for f in published(path) if f.startswith("part-000001")] == ["part-000001-0000.txt"]
    assert [f for f in published(path) if f.startswith("part-000002")] == ["part-000002-0000.txt"]


def test_a_file_rolls_at_its_age_and_when_idle():
    for limits, times, rolls in ((RF.Limits(max_age_s=10, max_idle_s=99), (0, 4, 8, 11), [0, 0, 0, 3]),
                                 (RF.Limits(max_age_s=99, max_idle_s=5), (0, 4, 8, 14), [0, 0, 0, 3])):
        path, seen = target(), []
        for batch, at in enumerate(times):
            entered(path, limits, batch, put(path, [f"{batch}"]).pieces, 1000.0 + at)
            seen.append(len(published(path)))
        assert seen == rolls
        # the rest by housekeeping, without a row
        assert not RF.publish_due(path, limits, 1000.0 + times[-1] + 1)
        assert RF.publish_due(path, limits, 1000.0 + times[-1] + 20)
        lines = sorted(open(f"{path}/{f}").read() for f in published(path))
        assert lines == ["0\n", "1\n", "2\n", "3\n"]


def test_aborted_and_repeated_epochs_leave_nothing():
    path, limits = target(), RF.Limits(max_bytes=1)
    writer = RF.RollingTextWriter(path, limits)
    writer.abort([put(path, ["lost"]), None], 0)
    assert os.listdir(f"{path}/{RF.PENDING}") == [] and published(path) == []
    first = put(path, ["once"])
    writer.commit([first, None], 1)
    writer.commit([put(path, ["once"])], 1)
    assert [open(f"{path}/{f}").read() for f in published(path)] == ["once\n"]
    assert os.listdir(f"{path}/{RF.PENDING}") == []


def test_renames_left_by_a_crash_are_made_by_the_next_commit(monkeypatch):
    path, limits = target(), RF.Limits(max_bytes=1)
    ledger = RF.Ledger(RF.Folder(path), limits)
    ledger.add(0, put(path, ["kept"]).pieces, 1.0)
    with monkeypatch.context() as m:
        m.setattr(RF.Ledger, "_rename", lambda self: None)
        ledger.save()
    assert published(path) == []
    entered(path, limits, 1, [], 2.0)
    assert [open(f"{path}/{f}").read() for f in published(path)] == ["kept\n"]


def test_stream_of_clicks_to_rolling_files(spark):
    source, path = target(), target()
    for i in range(3):
        with open(f"{source}/in-{i}.txt", "w") as f:
            f.write("".join(f"line {i} {j}\n" for j in range(20)))
        os.utime(f"{source}/in-{i}.txt", (1_600_000_000 + i, 1_600_000_000 + i))
    RF.register(spark)
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(source)
    q = (lines.select(F.upper("value").alias("value")).writeStream.format("rolling_text")
         .option("path", path).option("max_bytes", 300).option("checkpointLocation", target())
         .trigger(availableNow=True).start())
    q.awaitTermination(200)
    assert q.exception() is None
    RF.publish_due(path, RF.Limits(max_idle_s=0))
    got = sorted(r.value for r in spark.read.text(path).collect())
    assert got == sorted(f"LINE {i} {j}" for i in range(3) for j in range(20))
