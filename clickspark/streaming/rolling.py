"""Rolling aggregates on streams: one output row per input row.

:func:`rolling_rows` keeps one state per key (``transformWithStateInPandas``)
and folds a micro-batch's rows of a key in order of ``seq`` by the same
vectorised prefix as the batch operator, so the rows that come out equal those
of :func:`clickspark.operators.folds.rolling_reduce` for any cut of the input
into micro-batches, as long as a later batch holds later rows.

:func:`running_top` is A7's second stage, for ``foreachBatch`` on the rows of
the first: each micro-batch runs the batch operator (blocks of the arrival
order, no single task) and the best of the batches before, one row, is merged
in.  That row is kept per epoch in a folder, so a repeated epoch starts from
the same one.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickspark.operators import folds
from clickspark.operators.folds import Fold, Merge, running_states, to_frame
from clickspark.operators.rolling import running_top as running_top_rows
from clickspark.streaming.stateful import enable_state_store, ship_by_value

# the driver-side runner of transformWithState does not see added files
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(folds)


class RollingProcessor(StatefulProcessor):
    """Running merge per key; the state after the key's last row is kept."""

    def __init__(self, merge: Merge, state: T.StructType, columns: Sequence[str], seq: Sequence[str]):
        self.merge, self.schema, self.columns, self.seq = merge, state, list(columns), list(seq)

    def init(self, handle: StatefulProcessorHandle) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema
        self.state = handle.getValueState("state", self.schema)
        self.arrow = to_arrow_schema(self.schema)

    def _frame(self, rows: pd.DataFrame) -> pd.DataFrame:
        return to_frame(pa.Table.from_pandas(rows, schema=self.arrow, preserve_index=False))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = self.schema.names
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(self.seq, kind="stable",
                                                                   ignore_index=True)
        states = self._frame(pdf[names])
        first = np.zeros(len(states), bool)
        first[:1] = True
        states = running_states(states, first, self.merge)
        if self.state.exists():
            before = self._frame(pd.DataFrame([tuple(self.state.get())], columns=names, dtype=object))
            before = before.take(np.zeros(len(states), np.int64)).reset_index(drop=True)
            states = self.merge(before, states)[names].astype(states.dtypes.to_dict())
        done = pa.Table.from_pandas(states, schema=self.arrow, preserve_index=False)
        self.state.update(tuple(done.slice(len(states) - 1).to_pylist()[0].values()))
        out = pdf[self.columns].copy()
        for n in names:
            out[n] = done.column(n).to_pandas()
        yield out

    def close(self) -> None:
        pass


def rolling_rows(rows: DataFrame, key: str, seq: str | Sequence[str], fold: Fold) -> DataFrame:
    """All columns of the stream and the running states, one row per row."""
    enable_state_store(rows.sparkSession)
    ship_by_value(fold.merge)
    seq = [seq] if isinstance(seq, str) else list(seq)
    lifted = fold.lifted(rows)
    state = T.StructType([lifted.schema[n] for n in fold.lift])
    out = T.StructType([*rows.schema.fields, *state.fields])
    return lifted.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RollingProcessor(fold.merge, state, rows.columns, seq),
        outputStructType=out, outputMode="Append", timeMode="None")


def running_top(path: str, write: Callable[[DataFrame, int], None], key: str, seq: str,
                count: str = "count") -> Callable[[DataFrame, int], None]:
    """A7 on a stream of ``(key, count)`` updates: a ``foreachBatch`` function
    that hands ``(seq, top_<key>, top_count)``, a row per update, to ``write``.
    ``path``: folder of the kept best, two epochs at most."""
    from clickspark.streaming.twins import _fs

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fs, to_path = _fs(spark, path)
        kept = sorted(s.getPath().getName() for s in fs.listStatus(to_path(path))) if fs.exists(
            to_path(path)) else []
        before = [n for n in kept if n.startswith("epoch=") and int(n[6:]) < epoch]
        last = spark.read.parquet(f"{path}/{before[-1]}").first() if before else None
        old = last["best"] if last else None
        rows = running_top_rows(batch.select(key, seq, count), key, seq, count)
        top = f"top_{key}"
        if old is not None:
            # the kept best stays until a row of the batch counts as much
            stays = F.col("top_count") < F.lit(old["c"])
            rows = rows.select(seq, F.when(stays, F.lit(old["k"])).otherwise(F.col(top)).alias(top),
                               F.when(stays, F.lit(old["c"])).otherwise(F.col("top_count")).alias("top_count"))
        write(rows, epoch)
        now = batch.agg(F.max(F.struct(F.col(count).alias("c"), F.col(seq).alias("s"),
                                       F.col(key).alias("k"))).alias("best"))
        if old is not None:
            was = F.struct(*[F.lit(old[f]).cast(now.schema["best"].dataType[f].dataType).alias(f)
                             for f in ("c", "s", "k")])
            now = now.select(F.greatest("best", was).alias("best"))
        now.coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch:012d}")
        for stale in before[:-1]:
            fs.delete(to_path(f"{path}/{stale}"), True)
    return run
