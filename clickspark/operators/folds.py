"""A6 with a function of the user: rolling ``reduce`` by an associative merge.

A :class:`Fold` lifts every row to a state (Column expressions, on the JVM)
and merges two states, an earlier and a later one, column by column on whole
pandas frames.  ``merge`` must be associative; it need not be commutative, and
nulls are its own matter.

:func:`rolling_reduce` is a blocked segmented scan.  Rows are cut into arrival
blocks as in :mod:`clickspark.operators.scan` and folded inside their
``(key, block)``, so a key that holds a third of the rows is spread over all
blocks.  The last states of the blocks are folded per key (one row a block),
and a second pass merges that carry into the block's rows.  Inside an Arrow
batch a running fold takes log2(n) merges of frames (recursive doubling);
nothing runs row by row, and a task holds one batch and one state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickspark.operators.scan import BLOCK, KEY, Cuts, add_blocks, materialize

Merge = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]


@dataclass(frozen=True)
class Fold:
    """``lift``: state column -> expression over a row (its type is the
    state's).  ``merge``: (earlier, later) states -> states, row by row of the
    frames, whose columns are Arrow-typed pandas columns."""

    lift: Mapping[str, Column]
    merge: Merge

    def lifted(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[c.alias(n) for n, c in self.lift.items()])


def to_frame(table: pa.Table | pa.RecordBatch) -> pd.DataFrame:
    table = pa.Table.from_batches([table]) if isinstance(table, pa.RecordBatch) else table
    return table.to_pandas(types_mapper=pd.ArrowDtype)


def running_states(states: pd.DataFrame, first: np.ndarray, merge: Merge) -> pd.DataFrame:
    """Inclusive running merge; a row where ``first`` holds starts anew."""
    n = len(states)
    starts = np.flatnonzero(first)
    begin = np.zeros(n, np.int64)
    begin[starts] = starts
    begin = np.maximum.accumulate(begin)
    at, step = np.arange(n), 1
    reach = int((at - begin).max()) if n else 0
    while step <= reach:
        right = at[at - begin >= step]
        merged = merge(states.take(right - step).reset_index(drop=True),
                       states.take(right).reset_index(drop=True))[list(states.columns)]
        rest = at[at - begin < step]
        both = pd.concat([states.take(rest), merged.set_axis(right)])
        states = both.sort_index().astype(states.dtypes.to_dict()).reset_index(drop=True)
        step *= 2
    return states


def _runner(fold: Fold, names: Sequence[str], out: T.StructType) -> Callable:
    """Arrow batches sorted by segment, ``_first`` marking a segment's first
    row -> the same with the states folded within each segment."""
    schema, merge = to_arrow_schema(out), fold.merge

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None
        for b in batches:
            if not b.num_rows:
                continue
            first = b.column("_first").to_numpy(zero_copy_only=False).astype(bool)
            states = to_frame(b.select(list(names)))
            head = int(np.argmax(first)) if first.any() else len(first)
            own = first.copy()
            own[0] = True
            states = running_states(states, own, merge)
            if head and carry is not None:   # the batch continues a segment
                upto = states.iloc[:head].reset_index(drop=True)
                before = carry.take(np.zeros(head, np.int64)).reset_index(drop=True)
                joined = merge(before, upto)[list(names)].astype(states.dtypes.to_dict())
                states = pd.concat([joined, states.iloc[head:]], ignore_index=True)
            carry = states.iloc[-1:].reset_index(drop=True)
            yield _with_states(b, states, names, schema)
    return run


def _with_states(b: pa.RecordBatch, states: pd.DataFrame, names: Sequence[str],
                 schema: pa.Schema) -> pa.RecordBatch:
    folded = pa.Table.from_pandas(states, schema=pa.schema([schema.field(n) for n in names]),
                                  preserve_index=False)
    return pa.RecordBatch.from_arrays(
        [_one(folded.column(f.name)) if f.name in names else b.column(f.name) for f in schema],
        schema=schema)


def _folded(df: DataFrame, fold: Fold, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Running states of ``df`` inside ``by`` in ``order``; ``_last`` marks the
    last row of a group."""
    w = Window.partitionBy(*by).orderBy(*order)
    marked = df.withColumn("_first", F.row_number().over(w) == 1).withColumn(
        "_last", F.lead(F.lit(1)).over(w).isNull())
    return marked.mapInArrow(_runner(fold, list(fold.lift), marked.schema), marked.schema)


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold,
                   width: int | Cuts | None = None, initial: Mapping | None = None) -> DataFrame:
    """All columns of ``df`` and the states: for every row the merge of the
    key's rows up to it, in ``order`` (unique within a key).  ``keys`` may be
    empty.  Null keys are a key.  The names of the states must be new.
    ``initial``: a state that comes before the first row of every key."""
    clash = set(fold.lift) & set(df.columns)
    if clash:
        raise ValueError(f"states would replace columns: {sorted(clash)}")
    names = list(fold.lift)
    rows = fold.lifted(df if BLOCK in df.columns else add_blocks(df, order, width))
    rows = rows.withColumn(KEY, F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0))
    rows = materialize(_folded(rows, fold, [KEY, BLOCK], order))
    totals = rows.where("_last").select(KEY, BLOCK, *names)
    upto = _folded(totals, fold, [KEY], [BLOCK])
    after = F.lead(BLOCK).over(Window.partitionBy(KEY).orderBy(BLOCK))
    carry = (upto.withColumn("_for", after).where("_for is not null")
             .select(KEY, F.col("_for").alias(BLOCK), *[F.col(n).alias(f"_pre_{n}") for n in names],
                     F.lit(True).alias("_has")))
    joined = rows.join(carry, [KEY, BLOCK], "left")
    kept = [f for f in joined.schema.fields if f.name in df.columns and f.name != BLOCK]
    out = T.StructType(kept + [joined.schema[n] for n in names])
    schema, merge = to_arrow_schema(out), fold.merge
    start = None if initial is None else pa.Table.from_pylist(
        [dict(initial)], schema=pa.schema([schema.field(n) for n in names]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            states = to_frame(b.select(names))
            has = np.flatnonzero(b.column("_has").to_pylist())
            if len(has):
                before = to_frame(b.select([f"_pre_{n}" for n in names])).set_axis(names, axis=1)
                merged = merge(before.take(has).reset_index(drop=True),
                               states.take(has).reset_index(drop=True))[names]
                rest = np.setdiff1d(np.arange(b.num_rows), has)
                states = pd.concat([states.take(rest), merged.set_axis(has)]).sort_index().astype(
                    states.dtypes.to_dict())
            if start is not None and len(states):
                before = to_frame(start).take(np.zeros(len(states), np.int64)).reset_index(drop=True)
                states = merge(before, states.reset_index(drop=True))[names].astype(states.dtypes.to_dict())
            yield _with_states(b, states, names, schema)
    return joined.mapInArrow(apply, out)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


# ---- the reference's own reducers as folds (A1-A6) ---------------------------


def sum_fold(field: str, out: str) -> Fold:
    """A1; a null field adds nothing."""
    def merge(a, b):
        total = a[out].fillna(0) + b[out].fillna(0)
        return pd.DataFrame({out: total.where(a[out].notna() | b[out].notna())})
    return Fold({out: F.col(field)}, merge)


def count_fold(out: str = "count") -> Fold:
    """A6's running count."""
    return Fold({out: F.lit(1).cast("long")}, lambda a, b: pd.DataFrame({out: a[out] + b[out]}))


def extreme_fold(kind: str, field: str, others: Sequence[str], prefix: str = "r_") -> Fold:
    """A2 / A3: only the field moves, the others stay from the first row."""
    names = {prefix + c: F.col(c) for c in [field, *others]}
    f = prefix + field

    def merge(a, b):
        out = a.copy()
        take = b[f].notna() & (a[f].isna() | ((b[f] > a[f]) if kind == "max" else (b[f] < a[f])).fillna(False))
        out[f] = a[f].where(~take, b[f])
        return out
    return Fold(names, merge)


def extreme_row_fold(kind: str, field: str, others: Sequence[str], prefix: str = "r_") -> Fold:
    """A4 / A5: the whole row of the extreme, the first on ties; a row without
    the field never is one."""
    f = prefix + field
    names = {f: F.col(field)} | {prefix + c: F.when(F.col(field).isNotNull(), F.col(c)) for c in others}

    def merge(a, b):
        take = b[f].notna() & (a[f].isna() | ((b[f] > a[f]) if kind == "max" else (b[f] < a[f])).fillna(False))
        return a.where(~take, b)
    return Fold(names, merge)


def best_fold(better: Callable[[pd.DataFrame, pd.DataFrame], pd.Series],
              lift: Mapping[str, Column]) -> Fold:
    """The row that no later one beats: ``better(earlier, later)`` says where
    the later row is to be kept."""
    return Fold(dict(lift), lambda a, b: a.where(~better(a, b), b))
