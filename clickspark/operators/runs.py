"""W9 without a set in memory: accumulators over sorted distinct elements.

A user's aggregate that depends on distinct values (an exact user set) is told
as a fold over the group's distinct elements in order, each with its number of
rows, and a merge of two states.  Spark counts (group, element) pairs map-side,
deals them by group and hash bucket of the element, and sorts them (spilling
to disk); a task then streams its runs, holding one Arrow batch and one state.
A hot group is spread over the buckets, whose states, one row of declared
columns each, are merged by a second small pass.  Nothing is pickled, and no
state grows with the elements.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickspark.session import shuffle_partitions


class RunAggregate:
    """``state``: schema of the state (DDL).  Results are its columns."""

    state: str

    def fold(self, elements: pd.Series, counts: pd.Series) -> dict:
        """The state of a run of distinct elements (sorted, null first) and
        their numbers of rows; a group is folded in several runs."""
        raise NotImplementedError

    def merge(self, a: dict, b: dict) -> dict:
        """The state of two disjoint runs."""
        raise NotImplementedError


class PvUvRuns(RunAggregate):
    """Page views and distinct users; rows without a user are views only."""

    state = "pv long, uv long"

    def fold(self, elements, counts):
        return {"pv": int(counts.sum()), "uv": int(elements.notna().sum())}

    def merge(self, a, b):
        return {k: a[k] + b[k] for k in a}


def _streamed(keys: Sequence[str], states: Callable[[pa.RecordBatch, int, int], dict],
              merge: Callable[[dict, dict], dict], schema: pa.Schema) -> Callable:
    """Batches sorted by ``keys`` -> a row per key, one state held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for b in batches:
            if not b.num_rows:
                continue
            at = list(zip(*[b.column(k).to_pylist() for k in keys]))
            cuts = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1]), len(at)]
            done = []
            for lo, hi in zip(cuts, cuts[1:]):
                state = states(b, lo, hi)
                if at[lo] == last:
                    held = merge(held, state)
                    continue
                if held is not None:
                    done.append(dict(zip(keys, last)) | held)
                last, held = at[lo], state
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(keys, last)) | held], schema=schema)
    return run


def aggregate_runs(df: DataFrame, keys: Sequence[str], element: str, agg: RunAggregate,
                   buckets: int | None = None) -> DataFrame:
    """``keys`` and the state's columns, a row per group.  ``buckets``: how
    many parts a group may be spread over (default: the shuffle partitions)."""
    keys = list(keys)
    n = buckets or shuffle_partitions(df.sparkSession)
    pairs = df.groupBy(*keys, F.col(element).alias("_element")).agg(F.count(F.lit(1)).alias("_n"))
    dealt = pairs.withColumn("_bucket", F.pmod(F.xxhash64("_element"), F.lit(n)))
    out = T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL(agg.state).fields])
    schema, names = to_arrow_schema(out), T.StructType.fromDDL(agg.state).names

    def fold(b: pa.RecordBatch, lo: int, hi: int) -> dict:
        part = b.slice(lo, hi - lo)
        return agg.fold(part.column("_element").to_pandas(types_mapper=pd.ArrowDtype),
                        part.column("_n").to_pandas())

    def kept(b: pa.RecordBatch, lo: int, hi: int) -> dict:
        rows = b.slice(lo, hi - lo).select(names).to_pylist()
        state = rows[0]
        for r in rows[1:]:
            state = agg.merge(state, r)
        return state
    parts = (dealt.repartition(*keys, "_bucket").drop("_bucket").sortWithinPartitions(*keys, "_element")
             .mapInArrow(_streamed(keys, fold, agg.merge, schema), out))
    return (parts.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_streamed(keys, kept, agg.merge, schema), out))
