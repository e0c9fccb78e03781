"""K4 on streams: a keyed table (last write per key wins) as a merge-on-read log.

A micro-batch is reduced to its last row per key and written as one run, a
folder of that batch's rows only, dealt into buckets by key hash.  A version of
the table is a manifest: the names of its runs, a few for each level.  It is
published by one rename, so a reader sees all buckets of a version or none, and
a failure before it leaves the version before readable.  MERGE runs of a level
become one run of the next, so bytes written follow the batches and the table
is rewritten in part only; runs that neither this nor the last version names
are deleted.

Reading keeps the row with the greatest sequence of a key over all runs (a
partial aggregation).  The number of buckets is a run's own and doubles when a
merged run holds more than ROWS_PER_BUCKET rows a bucket, so nothing is ever
re-dealt but by a merge; :meth:`Upserts.lookup` reads the buckets of its keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MERGE = 8
BITS = 4  # buckets of a run: two to this power, at first
ROWS_PER_BUCKET = 2_000_000


class Upserts:
    """The table at ``path`` with columns ``key, value, seq``."""

    def __init__(self, spark: SparkSession, path: str, key: str, value: str, seq: str):
        self.spark, self.path = spark, path
        self.key, self.value, self.seq = key, value, seq
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self.fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- versions -------------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        at = self._at(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def _manifest(self, name: str) -> dict:
        stream = self.fs.open(self._at(f"{self.path}/versions/{name}"))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _versions(self) -> list[str]:
        return [n for n in self._names("versions") if n.startswith("v=")]

    def version(self) -> dict:
        """The manifest of the latest version."""
        names = self._versions()
        return self._manifest(names[-1]) if names else {
            "number": 0, "epoch": -1, "bits": BITS, "schema": None, "runs": []}

    def _publish(self, manifest: dict) -> None:
        temp = self._at(f"{self.path}/versions/_{uuid.uuid4().hex}")
        out = self.fs.create(temp, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        target = self._at(f"{self.path}/versions/v={manifest['number']:012d}.json")
        if not self.fs.rename(temp, target):
            raise OSError(f"cannot publish {target}")

    # -- runs -----------------------------------------------------------------------

    def _bucket(self, bits: int):
        return F.pmod(F.xxhash64(self.key), F.lit(1 << bits)).cast("int")

    def _latest(self, rows: DataFrame) -> DataFrame:
        """The row with the greatest sequence of every key, combined map-side."""
        last = F.max_by(F.struct(self.value, self.seq), F.col(self.seq)).alias("_l")
        return rows.groupBy(self.key).agg(last).select(
            self.key, F.col(f"_l.{self.value}").alias(self.value), F.col(f"_l.{self.seq}").alias(self.seq))

    def _write(self, rows: DataFrame, level: int, bits: int) -> dict:
        name = f"run-{uuid.uuid4().hex}"
        (rows.select(self.key, self.value, self.seq, self._bucket(bits).alias("_bucket"))
         .hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/runs/{name}"))
        kept = self.spark.read.schema(rows.select(self.key, self.value, self.seq).schema).parquet(
            f"{self.path}/runs/{name}").count()
        return {"name": name, "level": level, "bits": bits, "rows": kept}

    def _read(self, runs: Sequence[dict], schema: T.StructType, only=None) -> DataFrame:
        out = self.spark.createDataFrame([], schema)
        for run in runs:
            if not run["rows"]:
                continue
            rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])
                                          ).parquet(f"{self.path}/runs/{run['name']}")
            out = out.unionByName((rows if only is None else only(rows, run["bits"])).drop("_bucket"))
        return out

    # -- the table --------------------------------------------------------------------

    def upsert(self, batch: DataFrame, epoch: int) -> bool:
        """Fold a micro-batch in; False if its epoch is in the table already."""
        now = self.version()
        if epoch <= now["epoch"]:
            return False
        rows = batch.select(self.key, self.value, self.seq)
        schema = T.StructType.fromJson(json.loads(now["schema"])) if now["schema"] else rows.schema
        runs = [*now["runs"], self._write(self._latest(rows), 0, now["bits"])]
        bits, level = now["bits"], 0
        while sum(r["level"] == level for r in runs) >= MERGE:
            same = [r for r in runs if r["level"] == level]
            while sum(r["rows"] for r in same) > ROWS_PER_BUCKET << bits:
                bits += 1
            merged = self._write(self._latest(self._read(same, schema)), level + 1, bits)
            runs = [merged, *[r for r in runs if r["level"] != level]]
            level += 1
        self._publish({"number": now["number"] + 1, "epoch": epoch, "bits": bits, "schema": schema.json(),
                       "runs": runs})
        self._tidy()
        return True

    def _tidy(self) -> None:
        """Keep two versions and their runs."""
        names = self._versions()
        for n in names[:-2]:
            self.fs.delete(self._at(f"{self.path}/versions/{n}"), True)
        used = {r["name"] for n in names[-2:] for r in self._manifest(n)["runs"]}
        for n in self._names("runs"):
            if n not in used:
                self.fs.delete(self._at(f"{self.path}/runs/{n}"), True)

    def read(self) -> DataFrame | None:
        """The latest version: a row per key (None if nothing was written)."""
        now = self.version()
        if not now["schema"]:
            return None
        schema = T.StructType.fromJson(json.loads(now["schema"]))
        return self._latest(self._read(now["runs"], schema))

    def lookup(self, keys: Sequence) -> DataFrame | None:
        """The rows of a few keys, from their buckets alone."""
        now = self.version()
        if not now["schema"]:
            return None
        schema = T.StructType.fromJson(json.loads(now["schema"]))
        asked = self.spark.createDataFrame([(k,) for k in keys], T.StructType([schema[self.key]]))
        buckets: dict[int, list[int]] = {}

        def only(rows: DataFrame, bits: int) -> DataFrame:
            if bits not in buckets:
                buckets[bits] = [r[0] for r in asked.select(self._bucket(bits)).distinct().collect()]
            return rows.where(F.col("_bucket").isin(buckets[bits]) & F.col(self.key).isin(list(keys)))
        return self._latest(self._read(now["runs"], schema, only))


def upsert_log(spark: SparkSession, path: str, key: str, value: str, seq: str
               ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over an :class:`Upserts` table."""
    def run(batch: DataFrame, epoch: int) -> None:
        Upserts(batch.sparkSession, path, key, value, seq).upsert(batch, epoch)
    return run
