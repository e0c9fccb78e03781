"""Helpers shared by the operators: column picking, stage tables, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Select ``cols`` (new name -> exact source name) by position, so extra
    columns whose names clash (also by case only) never make a reference
    ambiguous.  The first column of an exact name counts."""
    names = df.columns
    by_pos = df.toDF(*[f"_p{i}" for i in range(len(names))])
    return by_pos.select(*[F.col(f"_p{names.index(src)}").alias(new)
                           for new, src in cols.items()])


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns renamed ``_p0, _p1, ...`` and the old names, for
    operators that return all columns of their input."""
    names = df.columns
    return df.toDF(*[f"_p{i}" for i in range(len(names))]), names


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read
    it back: cuts the lineage and pins rows that several branches read."""
    path = shared_dir(df.sparkSession, "clickspark", "llm")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_text(df: DataFrame, fn: Callable[[str], tuple], fields: list[T.StructField],
             make: Callable[[], object] | None = None, text: str = "text") -> DataFrame:
    """Replace column ``text`` by ``fields``, computed row by row from the
    whole text (null: empty) inside Arrow batches; other columns pass.

    ``fn(state, text)`` returns one value per field; ``make()`` builds the
    state once per task.  Memory is that of one Arrow batch.
    """
    keep = [f for f in df.schema.fields if f.name != text]
    out = T.StructType(keep + fields)
    names, types = [f.name for f in keep], [f.dataType for f in fields]
    new = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make() if make else None
        kinds = [_arrow_type(t) for t in types]
        for b in batches:
            rows = [fn(state, t or "") for t in b.column(text).to_pylist()]
            cols = list(zip(*rows)) if rows else [[] for _ in new]
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in names] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=names + new)
    return df.mapInArrow(run, out)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in t.fields])
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
            T.StringType: pa.string(), T.BinaryType: pa.binary(),
            T.BooleanType: pa.bool_()}[type(t)]


class TwoGenerations:
    """A bounded memo: when the young dictionary is full it becomes the old
    one and the old one is dropped, so a worker's memory stays bounded."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        v = self.young.get(key)
        if v is None and self.old:
            v = self.old.get(key)
            if v is not None:
                self.put(key, v)
        return v

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
