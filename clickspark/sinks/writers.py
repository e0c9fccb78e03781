"""Sinks: files, message queue, keyed upsert, day-routed index, JDBC.

Each sink is split in two: a pure DataFrame projection that computes
exactly what would be written (testable, oracle-checked, runs on the
executors) and a thin writer that hands it to a Spark data source or to a
user-supplied client inside ``foreachPartition`` (executor side, batched,
never through the driver).  Streaming jobs call the same writer from
``foreachBatch``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.functions.scalars import event_json, event_string, index_name
from clickspark.operators.scan import materialize
from clickspark.sinks import failures

# ---- fixed values: bulk and retry policy of the reference's index sink ----
BULK_MAX_ACTIONS = 100_000
BULK_MAX_BYTES = 15 * 1024 * 1024
BULK_FLUSH_INTERVAL_MS = 10_000
BULK_RETRIES = 3
BULK_BACKOFF_MS = 10
# file sink roll policy: 15 min age, 5 min idle, 1 GiB
ROLL_INTERVAL_MS = 15 * 60 * 1000
ROLL_IDLE_MS = 5 * 60 * 1000
ROLL_MAX_BYTES = 1024 ** 3
# JDBC target: user varchar(20) not null, url varchar(100) not null
JDBC_USER_LEN = 20
JDBC_URL_LEN = 100
# ---------------------------------------------------------------------------


# K2 ------------------------------------------------------------------------
def event_lines(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Rows as ``Event.toString`` text (the file sink's encoder)."""
    return df.select(event_string("user", "url", "ms", zone).alias("value"))


def records_for(lines: DataFrame, max_bytes: int = ROLL_MAX_BYTES) -> int:
    """Rows that fill a file of ``max_bytes`` at the mean line length (one
    aggregate over the lines)."""
    mean = lines.agg(F.avg(F.octet_length("value") + 1)).first()[0]
    return max(1, int(max_bytes // max(1.0, mean or 1.0)))


def write_text(lines: DataFrame, path: str, max_records_per_file: int | None = None,
               mode: str = "append", max_bytes: int | None = None) -> None:
    """K2 batch: UTF-8 text files, one line per row; files roll at
    ``max_records_per_file`` rows, or at about ``max_bytes``."""
    if max_bytes and not max_records_per_file:
        max_records_per_file = records_for(lines, max_bytes)
    w = lines.write.mode(mode).option("encoding", "UTF-8")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.text(path)


def stream_text(lines: DataFrame, path: str, checkpoint: str,
                roll_ms: int = ROLL_INTERVAL_MS, max_records_per_file: int | None = None):
    """K2 streaming: a text file per micro-batch and task; the roll interval
    becomes the processing-time trigger."""
    w = (lines.writeStream.format("text").option("path", path)
         .option("checkpointLocation", checkpoint)
         .trigger(processingTime=f"{roll_ms} milliseconds"))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w.start()


# K3 ------------------------------------------------------------------------
def kafka_payload(lines: DataFrame, topic: str, value: str = "value") -> DataFrame:
    """K3: the frame handed to Spark's Kafka sink (string value, no key)."""
    return lines.select(F.lit(topic).alias("topic"), F.col(value).cast("string").alias("value"))


def kafka_options(bootstrap_servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers}


def write_kafka(payload: DataFrame, bootstrap_servers: str) -> None:
    """K3 batch write (needs the spark-sql-kafka package on the cluster)."""
    payload.write.format("kafka").options(**kafka_options(bootstrap_servers)).save()


# K4 ------------------------------------------------------------------------
def latest_per_key(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """K4: ``HSET <hash> <key> <value>`` in arrival order: the last write per
    key wins.  ``max_by`` aggregates map-side, so a hot key is reduced on
    every task before the shuffle."""
    return df.groupBy(key).agg(F.max_by(F.col(value), F.col(seq)).alias(value))


def merge_upserts(current: DataFrame, batch: DataFrame, key: str, value: str,
                  seq: str) -> DataFrame:
    """Streaming form of K4 for ``foreachBatch``: fold a micro-batch into the
    kept table (``current`` has ``key, value, seq``)."""
    latest = batch.groupBy(key).agg(F.max_by(F.struct(value, seq), F.col(seq)).alias("_l"))
    latest = latest.select(key, F.col(f"_l.{value}").alias(value), F.col(f"_l.{seq}").alias(seq))
    both = current.unionByName(latest)
    return both.groupBy(key).agg(F.max_by(F.struct(value, seq), F.col(seq)).alias("_l")).select(
        key, F.col(f"_l.{value}").alias(value), F.col(f"_l.{seq}").alias(seq))


# K5 ------------------------------------------------------------------------
def routed_documents(df: DataFrame, index: str, now_ms: int | Column, zone: str) -> DataFrame:
    """K5: ``(index_name, doc)`` per row: JSON doc, index ``<index>-yyyyMMdd``
    of its time, or ``-19700101`` when unknown or over an hour ahead."""
    return df.select(index_name(index, "ms", now_ms, zone).alias("index_name"),
                     event_json("user", "url", "ms").alias("doc"))


@dataclass(frozen=True)
class Failure:
    """Why one document of a bulk was not taken."""
    supers: list[str]
    causes: list[str]
    message: str | None = None


class BulkFailed(RuntimeError):
    """Documents were still refused after the last retry: the task fails and
    Spark runs it again (delivery is at least once)."""


#: A bulk client: takes the documents and returns the failures by position.
#: An exception means that no document of the bulk was taken.
Send = Callable[[list[dict]], "dict[int, Failure] | None"]


def write_index(routed: DataFrame, path: str, mode: str = "append") -> None:
    """K5: the routed documents as text files, one folder per index.  Rows of
    an index stay spread over the tasks that hold them, so a hot day is not
    one task; file sizes are the writer's (``maxRecordsPerFile`` is unset)."""
    (routed.select("index_name", F.col("doc").alias("value")).write.mode(mode)
     .option("encoding", "UTF-8").partitionBy("index_name").text(path))


def bulk_write(docs: DataFrame, send: Send, max_actions: int = BULK_MAX_ACTIONS,
               max_bytes: int = BULK_MAX_BYTES, retries: int = BULK_RETRIES,
               backoff_ms: int = BULK_BACKOFF_MS,
               flush_interval_ms: int = BULK_FLUSH_INTERVAL_MS,
               decide: Callable[[Failure], tuple[str, str]] | None = None,
               ) -> tuple[dict[str, int], DataFrame]:
    """Executor-side bulk writes, decided document by document.

    A bulk is sent when it holds ``max_actions`` documents or ``max_bytes``
    UTF-8 bytes of ``doc``, or when its first document has waited
    ``flush_interval_ms``.  Of the failures the client returns, the rule
    (:func:`clickspark.sinks.failures.decide`) says which documents are sent
    again (``retry``, up to ``retries`` times with doubling delay; then the
    task fails), which are dropped, and which only logged.

    Returns counts by outcome (``sent`` / ``drop`` / ``log``) and the dead
    letters: the columns of ``docs`` with ``outcome`` and ``reason``.
    """
    rule = decide or (lambda f: failures.decide(f.supers, f.causes, f.message))
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("outcome", T.StringType()),
                           T.StructField("reason", T.StringType()),
                           T.StructField("n", T.LongType())])

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        buf, size, since = [], 0, time.monotonic()
        for pdf in batches:
            for row in pdf.itertuples(index=False, name=None):
                d = dict(zip(columns, row))
                if not buf:
                    since = time.monotonic()
                buf.append(d)
                size += len(str(d.get("doc") or "").encode())
                if (len(buf) >= max_actions or size >= max_bytes
                        or (time.monotonic() - since) * 1000 >= flush_interval_ms):
                    yield flush(buf)
                    buf, size = [], 0
        if buf:
            yield flush(buf)

    def flush(bulk: list[dict]) -> pd.DataFrame:
        sent, lost = send_with_retry(send, bulk, retries, backoff_ms, rule)
        rows = [(*[d[c] for c in columns], outcome, reason, 1) for d, outcome, reason in lost]
        rows.append((*[None] * len(columns), "sent", None, sent))
        return pd.DataFrame(rows, columns=schema.names, dtype=object)

    done = materialize(docs.mapInPandas(run, schema))
    counts = {r["outcome"]: r["n"] for r in
              done.groupBy("outcome").agg(F.sum("n").alias("n")).collect()}
    return counts, done.where(F.col("outcome") != "sent").drop("n")


def send_with_retry(send: Send, bulk: list[dict], retries: int, backoff_ms: int,
                    rule: Callable[[Failure], tuple[str, str]]) -> tuple[int, list[tuple]]:
    """Send one bulk: ``(documents taken, [(document, outcome, reason)])``.
    Only documents whose failure says ``retry`` are sent again."""
    delay, lost, todo, taken = backoff_ms / 1000.0, [], list(bulk), 0
    for attempt in range(retries + 1):
        try:
            failed = send(todo) or {}
        except Exception as exc:  # noqa: BLE001 - the rule decides
            failed = dict.fromkeys(range(len(todo)), of_exception(exc))
        taken += len(todo) - len(failed)
        again = []
        for i, failure in sorted(failed.items()):
            reason, action = rule(failure)
            if action == "retry":
                again.append(todo[i])
            else:
                lost.append((todo[i], action, reason))
        todo = again
        if not todo:
            return taken, lost
        if attempt < retries:
            time.sleep(delay)
            delay *= 2
    raise BulkFailed(f"{len(todo)} of {len(bulk)} documents refused after {retries} retries")


def of_exception(exc: BaseException) -> Failure:
    """A Python exception as a failure: its class, bases and cause chain.  A
    lost connection is taken for a rejected request, so it is sent again."""
    chain, now = [], exc
    while now is not None:
        chain.append(type(now).__name__)
        now = now.__cause__ or now.__context__
    if isinstance(exc, (ConnectionError, TimeoutError)):
        chain.append(failures.REJECTED)
    return Failure([c.__name__ for c in type(exc).__mro__], chain, str(exc))


# K6 ------------------------------------------------------------------------
JDBC_COLUMNS = (("user", JDBC_USER_LEN), ("url", JDBC_URL_LEN))


def jdbc_rows(df: DataFrame, cols: Sequence[tuple[str, int]] = JDBC_COLUMNS) -> DataFrame:
    """K6: every row as the target's columns, with ``reject_reason`` (NULL: it
    fits NOT NULL and VARCHAR(n) by length).  No row is left out."""
    reason = F.lit(None).cast("string")
    for c, n in reversed(cols):
        reason = (F.when(F.col(c).isNull(), F.lit(f"{c} is null"))
                  .when(F.length(F.col(c)) > n, F.lit(f"{c} is longer than {n}"))
                  .otherwise(reason))
    return df.select(*[c for c, _ in cols], reason.alias("reject_reason"))


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str],
               batch_size: int = 1000, rejects: str | None = None) -> None:
    """K6 append through Spark's JDBC data source (``INSERT`` per batch).
    ``rows`` as :func:`jdbc_rows` gives them.  Rows that do not fit go to the
    Parquet folder ``rejects``; without one, their presence is an error."""
    fits, bad = split_rejects(rows, rejects)
    if bad is not None:
        bad.write.mode("append").parquet(rejects)
    (fits.write.mode("append").option("batchsize", batch_size)
     .jdbc(url, table, properties=properties))


def split_rejects(rows: DataFrame, rejects: str | None) -> tuple[DataFrame, DataFrame | None]:
    bad = rows.where("reject_reason is not null")
    if rejects is None and not bad.isEmpty():
        raise ValueError("rows do not fit the target table; name a folder for rejects")
    return (rows.where("reject_reason is null").drop("reject_reason"),
            bad if rejects is not None else None)
