"""User-defined aggregate functions with the reference's contract
(create accumulator / add / merge / result).

Two forms:

* :class:`ColumnAggregate` - the accumulator is a set of built-in
  aggregate columns and ``result`` a column expression over them.  Spark
  merges partial aggregates natively; this is the scalable default.
* :class:`Accumulator` + :func:`aggregate_with` - arbitrary Python state.
  Phase 1 (``mapInPandas``) folds every input partition into one
  accumulator per key (map-side combine) and hands its states on whenever
  they hold more than ``max_rows`` rows' worth; merging makes that exact.
  Phase 2 hash-partitions the partial states by key, sorts them, and merges
  key after key, holding one state at a time.  So a hot key costs small
  states, never its rows.  A state
  that grows with distinct values (an exact user set) is salted first:
  :func:`salted` splits each group by ``hash(value) mod B`` into disjoint
  sub-groups whose results add up exactly.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnAggregate:
    """``parts`` are built-in aggregates (merged partially by Spark);
    ``result`` builds the output from the finished parts."""
    parts: Mapping[str, Column]
    result: Callable[[Mapping[str, Column]], Column]

    def apply(self, grouped_df: DataFrame, keys: Sequence, out: str) -> DataFrame:
        agg = grouped_df.groupBy(*keys).agg(*[c.alias(n) for n, c in self.parts.items()])
        cols = {n: F.col(n) for n in self.parts}
        return agg.withColumn(out, self.result(cols))


class Accumulator:
    """The reference's ``AggregateFunction`` contract in Python."""

    def create(self):
        raise NotImplementedError

    def add(self, acc, row: Mapping):
        raise NotImplementedError

    def add_batch(self, acc, pdf: pd.DataFrame):
        """Fold a pandas batch (default: row by row through ``add``)."""
        for row in pdf.to_dict("records"):
            acc = self.add(acc, row)
        return acc

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc):
        raise NotImplementedError


#: Rows folded into a task's states before they are handed on.
MAX_ROWS = 1_000_000


def aggregate_with(df: DataFrame, keys: Sequence[str], acc: Accumulator,
                   out: Mapping[str, str] | str, out_type: str | None = None,
                   max_rows: int = MAX_ROWS) -> DataFrame:
    """Group by ``keys`` and aggregate with a Python :class:`Accumulator`.

    ``out`` is one output column (``out``, ``out_type``) or a mapping
    name -> type; with a mapping ``acc.result`` returns a dict.
    ``max_rows`` bounds a task's states: they hold what that many rows add.
    -> (keys..., outputs...)
    """
    keys = list(keys)
    outs = {out: out_type} if isinstance(out, str) else dict(out)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                           for f in df.schema.fields if f.name in keys)
    out_schema = ", ".join(f"`{n}` {t}" for n, t in outs.items())

    def partial(batches):
        states: dict[tuple, object] = {}
        held = 0
        for pdf in batches:
            for at in range(0, len(pdf), max_rows):
                part = pdf.iloc[at:at + max_rows]
                if held + len(part) > max_rows and states:
                    yield packed(states)
                    states, held = {}, 0
                held += len(part)
                for k, g in part.groupby(keys, sort=False, dropna=False):
                    k = k if isinstance(k, tuple) else (k,)
                    states[k] = acc.add_batch(states.get(k, acc.create()), g)
        if states:
            yield packed(states)

    def packed(states):
        rows = [(*k, pickle.dumps(s)) for k, s in states.items()]
        return pd.DataFrame(rows, columns=[*keys, "_state"])

    def final(batches):
        # every partial state of a key is in this task, one after the other
        last, state, rows = None, None, []
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                k, s = tuple(row[:-1]), pickle.loads(row[-1])
                # a missing key may arrive as NaN, which differs from itself
                same = last is not None and all(a == b or (a != a and b != b) for a, b in zip(k, last))
                if same:
                    state = acc.merge(state, s)
                    continue
                if last is not None:
                    rows.append(finished(last, state))
                last, state = k, s
            if rows:
                yield pd.DataFrame(rows, columns=[*keys, *outs])
                rows = []
        if last is not None:
            yield pd.DataFrame([finished(last, state)], columns=[*keys, *outs])

    def finished(k, s):
        res = acc.result(s)
        return [*k, *([res[n] for n in outs] if isinstance(out, Mapping) else [res])]

    partials = df.mapInPandas(partial, f"{key_schema}, _state binary")
    return (partials.repartition(*keys).sortWithinPartitions(*keys)
                    .mapInPandas(final, f"{key_schema}, {out_schema}"))


def salted(df: DataFrame, col: str, buckets: int, name: str = "_salt") -> DataFrame:
    """Add a salt ``hash(col) mod buckets``: a hot group becomes ``buckets``
    disjoint sub-groups (exact for distinct counts, sums and counts, which
    add up across salts)."""
    return df.withColumn(name, F.pmod(F.hash(F.col(col)), F.lit(buckets)))


class PvUv(Accumulator):
    """PV / UV: accumulator (set of users, click count), reporting its parts so
    that salted partial results can be added up: -> {"pv": clicks, "uv":
    distinct users}."""

    def __init__(self, user: str = "user"):
        self.user = user

    def create(self):
        return (set(), 0)

    def add(self, acc, row):
        users, n = acc
        users.add(row[self.user])
        return (users, n + 1)

    def add_batch(self, acc, pdf):
        users, n = acc
        users.update(pdf[self.user].tolist())
        return (users, n + len(pdf))

    def merge(self, a, b):
        return (a[0] | b[0], a[1] + b[1])

    def result(self, acc):
        users, n = acc
        return {"pv": int(n), "uv": len(users)}


def avg_pv(user: str = "user") -> ColumnAggregate:
    """PV / UV as built-in aggregates (the scalable form)."""
    return ColumnAggregate(
        parts={"pv": F.count(F.lit(1)), "uv": F.count_distinct(F.col(user))},
        result=lambda p: p["pv"].cast("double") / p["uv"].cast("double"))
