"""K2-K6: file roundtrip, payloads, routing, bulk writes with retries, JDBC checks."""

import glob
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from clickspark.sinks import failures as FP
from clickspark.sinks import writers as K
from clickspark.streaming import twins as TW
from helpers import clicks

NINE = [("Ann", "/a", 1000), ("Ben", "/b", 2000), ("Cid", "/c?i=1", 3000), ("Cid", "/c?i=2", 3500),
        ("Ben", "/c?i=3", 2500), ("Cid", "/c?i=4", 3600), ("Ben", "/a", 3000), ("Ben", "/c?i=5", 2300),
        ("Ben", "/c?i=6", 3300)]


def test_text_file_sink_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="clickspark-text-", dir="/tmp") + "/out"
    K.write_text(K.event_lines(clicks(spark, NINE), "Asia/Shanghai").repartition(4), out,
                 max_records_per_file=3)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert len(lines) == 9
    assert "Event{user='Ann', url='/a', ts=1970-01-01 08:00:01.0}" in lines
    assert all(len(open(p).read().splitlines()) <= 3 for p in glob.glob(f"{out}/part-*"))


def test_text_file_sink_stream(spark):
    src_dir = tempfile.mkdtemp(prefix="clickspark-src-", dir="/tmp")
    for i, (u, url, ms) in enumerate(NINE):
        with open(f"{src_dir}/f{i:03d}.txt", "w") as f:
            f.write(f"{u},{url},{ms}\n")
    src = TW.click_lines_stream(spark, src_dir)
    out = tempfile.mkdtemp(prefix="clickspark-sink-", dir="/tmp")
    ck = tempfile.mkdtemp(prefix="clickspark-ck-", dir="/tmp")
    q = (K.event_lines(src).writeStream.format("text").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.read.text(out).count() == 9


def test_kafka_payload_and_options(spark):
    lines = spark.createDataFrame([("Mary,./home,1000",)], "value string")
    p = K.kafka_payload(lines, "clicks")
    assert [tuple(r) for r in p.collect()] == [("clicks", "Mary,./home,1000")]
    assert K.kafka_options("host:9092") == {"kafka.bootstrap.servers": "host:9092"}


def test_upsert_latest_per_key(spark):
    res = K.latest_per_key(clicks(spark, NINE), "user", "url", "seq")
    assert {r.user: r.url for r in res.collect()} == {
        "Ann": "/a", "Cid": "/c?i=4", "Ben": "/c?i=6"}


def test_routed_documents(spark):
    now = 1_706_000_000_000
    c = clicks(spark, [("Mary", "./home", now), ("Bob", "./cart", now + 3_600_001)])
    got = [(r.index_name, r.doc) for r in K.routed_documents(c, "clicks", now, "UTC").collect()]
    assert got == [("clicks-20240123", '{"user":"Mary","url":"./home","ts":1706000000000}'),
                   ("clicks-19700101", '{"user":"Bob","url":"./cart","ts":1706003600001}')]


def test_routed_documents_are_written_by_index(spark):
    now = 1_706_000_000_000
    c = clicks(spark, [("Ann", "/a", now), ("Ben", "/b", now + 3_600_001), ("Cid", "/c", now - 1)])
    out = tempfile.mkdtemp(prefix="clickspark-index-", dir="/tmp") + "/out"
    K.write_index(K.routed_documents(c, "clicks", now, "UTC"), out)
    back = {r.index_name: r.value for r in spark.read.text(out).where("value like '%Ben%'").collect()}
    assert back == {"clicks-19700101": '{"user":"Ben","url":"/b","ts":1706003600001}'}
    assert sorted(os.path.basename(p) for p in glob.glob(f"{out}/index_name=*")) == [
        "index_name=clicks-19700101", "index_name=clicks-20240123"]


def test_text_files_roll_by_bytes(spark):
    lines = spark.range(1000).select(F.format_string("%099d", "id").alias("value")).coalesce(1)
    out = tempfile.mkdtemp(prefix="clickspark-roll-", dir="/tmp") + "/out"
    K.write_text(lines, out, max_bytes=20_000)
    files = glob.glob(f"{out}/part-*")
    assert len(files) == 5 and all(os.path.getsize(p) == 20_000 for p in files)


REJECTED = K.Failure(["EsException"], ["EsException", "x.EsRejectedExecutionException"], "queue full")
MAPPING = K.Failure(["org.ElasticsearchException"], ["ElasticsearchException"],
                    "[type=mapper_parsing_exception]")
TIMEOUT = K.Failure(["IOException"], ["IOException", "SocketTimeoutException"], "slow")


def _docs(spark, n):
    rows = [("Ann", f"/p{i}", 1000 + i) for i in range(n)]
    return K.routed_documents(clicks(spark, rows), "clicks", 10_000, "UTC").coalesce(1)


def test_one_bad_document_is_the_only_one_lost(spark):
    def send(bulk):
        return {i: MAPPING for i, d in enumerate(bulk) if '"/p500"' in d["doc"]}
    counts, dead = K.bulk_write(_docs(spark, 1000), send, backoff_ms=1)
    assert counts == {"sent": 999, "drop": 1}
    row = dead.collect()[0]
    assert '"/p500"' in row.doc and (row.outcome, row.reason) == ("drop", "mapper_parsing")


def test_bulk_bounds_and_flush_interval(spark):
    log = tempfile.mkdtemp(prefix="clickspark-bulk-", dir="/tmp")

    def send(bulk):
        with open(f"{log}/{uuid.uuid4().hex}-{len(bulk)}", "w"):
            pass

    def sizes():
        return sorted(int(p.rsplit("-", 1)[1]) for p in glob.glob(f"{log}/*-*"))
    K.bulk_write(_docs(spark, 9), send, max_actions=4)
    assert sizes() == [1, 4, 4]
    size = len('{"user":"Ann","url":"/p0","ts":1000}')
    K.bulk_write(_docs(spark, 9), send, max_bytes=3 * size)
    assert sizes() == [1, 3, 3, 3, 4, 4]
    K.bulk_write(_docs(spark, 3), send, flush_interval_ms=0)
    assert sizes() == [1, 1, 1, 1, 3, 3, 3, 4, 4]


def test_only_refused_documents_are_sent_again():
    calls = []

    def send(bulk):
        calls.append(list(bulk))
        if len(calls) == 1:
            return {0: REJECTED, 2: TIMEOUT, 3: MAPPING}
        if len(calls) == 2:
            raise ConnectionResetError("gone")
        return None
    rule = lambda f: FP.decide(f.supers, f.causes, f.message)
    taken, lost = K.send_with_retry(send, list("abcde"), 3, 1, rule)
    assert taken == 3 and calls == [list("abcde"), ["a"], ["a"]]
    assert lost == [("c", "log", "socket_timeout"), ("d", "drop", "mapper_parsing")]


def test_documents_refused_to_the_end_fail_the_task(spark):
    with pytest.raises(K.BulkFailed):
        K.send_with_retry(lambda b: {0: REJECTED}, ["a", "b"], 1, 1,
                          lambda f: FP.decide(f.supers, f.causes, f.message))
    with pytest.raises(Exception, match="refused"):
        K.bulk_write(_docs(spark, 2), lambda b: {0: REJECTED}, retries=1, backoff_ms=1)


def test_jdbc_rows_keep_every_row(spark):
    rows = [("Mary", "./home", 1), ("x" * 21, "./cart", 2), ("Bob", "u" * 101, 3), (None, "./a", 4)]
    out = K.jdbc_rows(clicks(spark, rows))
    assert [r.reject_reason for r in out.collect()] == [
        None, "user is longer than 20", "url is longer than 100", "user is null"]
    with pytest.raises(ValueError):
        K.split_rejects(out, None)
    fits, bad = K.split_rejects(out, "/somewhere")
    assert [tuple(r) for r in fits.collect()] == [("Mary", "./home")] and bad.count() == 3
