"""Structured Streaming twins of the batch operators.

The window operators of :mod:`clickspark.operators.windows` take a TIMESTAMP
column, so the same functions run on a ``readStream`` frame after
``withWatermark``.  Results equal the batch ones once the watermark has
passed every window (append mode emits a window when it closes).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.model import event_time
from clickspark.operators import windows as W
from clickspark.operators.transforms import parse_lines, parse_or_reject
from clickspark.sinks.writers import merge_upserts


def _dur(ms: int) -> str:
    return f"{int(ms)} milliseconds"


def click_lines_stream(spark: SparkSession, path: str, sep: str = ",",
                       files_per_trigger: int | None = None, rejects: bool = False) -> DataFrame:
    """Text lines from files landing in ``path`` -> clicks with ``ts``.

    A line that does not parse fails the query.  With ``rejects`` it passes
    with its text in ``bad_line`` (NULL for good lines); split the frame with
    :func:`split_lines` in ``foreachBatch``, or filter it, before windows.
    """
    r = spark.readStream.format("text")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    lines = r.load(path)
    clicks = (parse_or_reject(lines, sep) if rejects else parse_lines(lines, sep))
    return clicks.withColumn("ts", event_time("ms"))


def split_lines(clicks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clicks and rejected lines of a frame with ``bad_line``."""
    return (clicks.where("bad_line is null").drop("bad_line"),
            clicks.where("bad_line is not null").select("bad_line"))


def fan_out(outputs: dict[str, Callable[[DataFrame], DataFrame]],
            write: Callable[[DataFrame, str, int], None]) -> Callable[[DataFrame, int], None]:
    """K7: one job to several outputs, for ``foreachBatch``.  Each micro-batch
    is written once to the shared folder; every named output is derived from
    it and handed to ``write(frame, name, epoch)``."""
    from clickspark.operators.scan import materialize

    def run(batch: DataFrame, epoch: int) -> None:
        rows = materialize(batch)
        for name, derive in outputs.items():
            write(derive(rows), name, epoch)
    return run


def watermarked(clicks: DataFrame, delay_ms: int, ts: str = "ts") -> DataFrame:
    """M1/M2: ``withWatermark`` (``delay_ms = 0`` is the monotonous case)."""
    return clicks.withWatermark(ts, _dur(delay_ms))


def url_view_count_stream(clicks: DataFrame, size_ms: int, slide_ms: int,
                          delay_ms: int = 0) -> DataFrame:
    """W4 streaming: sliding count per url, append mode."""
    return W.url_view_count(watermarked(clicks, delay_ms), size_ms, slide_ms, ts_col="ts")


def tumbling_count_stream(clicks: DataFrame, key: str, size_ms: int,
                          delay_ms: int = 0) -> DataFrame:
    """W1 streaming."""
    return W.tumbling_count(watermarked(clicks, delay_ms), key, size_ms, ts_col="ts")


def pv_uv_stream(clicks: DataFrame, size_ms: int, slide_ms: int, delay_ms: int = 0) -> DataFrame:
    """W2 streaming: two chained aggregations (``count(distinct)`` is not
    supported on streams); exact, and distributed by user."""
    return W.pv_uv_two_stage(watermarked(clicks, delay_ms), size_ms, slide_ms, ts_col="ts")


def unique_visitors_stream(clicks: DataFrame, size_ms: int, delay_ms: int = 0) -> DataFrame:
    """W3 streaming, exact: one row per (window, user) first, then a count
    per window, so a window's users are spread over the cluster."""
    res = W.pv_uv_two_stage(watermarked(clicks, delay_ms), size_ms, ts_col="ts")
    return res.select("uv", "windowStart", "windowEnd")


def upsert_batches(spark: SparkSession, table_path: str, key: str, value: str, seq: str,
                   buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """K4 streaming: a ``foreachBatch`` function folding each micro-batch
    into a keyed table (last write per key wins).

    The table is cut into ``buckets`` by key hash.  A batch rewrites only the
    buckets it touches, as a new version of each, and deletes the versions
    before the previous one, so the table stays bounded and a reader of the
    previous version is not disturbed.  A repeated epoch writes the same rows.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        part = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rows = batch.select(key, value, seq)
        touched = sorted(r[0] for r in rows.select(part.alias("b")).distinct().collect())
        if not touched:
            return
        old = _bucket_files(session, table_path, touched, before=epoch)
        current = session.createDataFrame([], rows.schema)
        if old:
            current = session.read.schema(rows.schema).parquet(*[v[-1] for v in old.values()])
        merged = merge_upserts(current, rows, key, value, seq).withColumn("b", part)
        staging = f"{table_path}/_staging/{epoch:012d}"
        merged.repartition("b").write.mode("overwrite").partitionBy("b").parquet(staging)
        fs, path = _fs(session, table_path)
        for b in touched:
            target = path(f"{table_path}/bucket={b}/v={epoch:012d}")
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(path(f"{staging}/b={b}"), target):
                raise OSError(f"cannot publish bucket {b}")
            for stale in old.get(b, [])[:-1]:
                fs.delete(path(stale), True)
        fs.delete(path(staging), True)
    return run


def _fs(spark: SparkSession, base: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _bucket_files(spark: SparkSession, table_path: str, only: list[int] | None = None,
                  before: int | None = None) -> dict[int, list[str]]:
    """Versions of each bucket, oldest first (two a bucket at most, besides
    one being written)."""
    fs, path = _fs(spark, table_path)
    out: dict[int, list[str]] = {}
    if not fs.exists(path(table_path)):
        return out
    if only is None:
        names = [s.getPath().getName() for s in fs.listStatus(path(table_path))]
        only = [int(n[7:]) for n in names if n.startswith("bucket=")]
    for b in only:
        folder = path(f"{table_path}/bucket={b}")
        if fs.exists(folder):
            found = sorted(s.getPath().getName() for s in fs.listStatus(folder))
            kept = [f"{table_path}/bucket={b}/{v}" for v in found
                    if before is None or int(v[2:]) < before]
            if kept:
                out[b] = kept
    return out


def read_upserts(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The latest version of every bucket (None if nothing was written)."""
    found = _bucket_files(spark, table_path)
    return spark.read.parquet(*[v[-1] for v in found.values()]) if found else None


def console(df: DataFrame, prefix: str | None = None):
    """K1: print a stream, optionally with a label column like ``print(tag)``."""
    if prefix is not None:
        df = df.select(F.lit(prefix).alias("tag"), "*")
    return df.writeStream.format("console").option("truncate", "false")


def rolling_stream(clicks: DataFrame, key: str, seq: str, kind: str, field: str,
                   others: tuple[str, ...] = ()) -> DataFrame:
    """A1-A6 streaming: the keyed final form (``groupBy(key).agg``) in update
    mode emits the key's running value after every micro-batch (one row per
    batch = the batch rolling output)."""
    from clickspark.operators.rolling import keyed_final
    return keyed_final(clicks, key, seq, kind, field, others)
