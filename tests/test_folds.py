"""Rolling reduce with a function of the user against a sequential loop."""

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickspark.operators import folds
from clickspark.operators import rolling as R
from clickspark.operators.folds import Fold, rolling_reduce


def join_text(sep=""):
    """Concatenation: associative, not commutative."""
    return Fold({"all": F.col("t")}, lambda a, b: pd.DataFrame({"all": a["all"] + sep + b["all"]}))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None, "hot", "hot", "hot"]),
                               st.text("xyz", min_size=1, max_size=2)), min_size=1, max_size=50),
       width=st.integers(1, 9), seed=st.integers(0, 10**6))
def test_reduce_is_a_loop_in_arrival_order(spark, rows, width, seed):
    order = list(range(len(rows)))
    random.Random(seed).shuffle(order)
    data = [(order[i], k, t) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, k string, t string")
    got = {r.seq: r["all"] for r in rolling_reduce(df, ["k"], ["seq"], join_text(), width).collect()}
    state, want = {}, {}
    for seq, k, t in sorted(data):
        state[k] = state.get(k, "") + t
        want[seq] = state[k]
    assert got == want


def test_hot_key_is_split_and_batches_carry(spark):
    """A key of a third of the rows over many blocks, in Arrow batches that
    are shorter than a block."""
    n = 3000
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}", str(i % 10)) for i in range(n)]
    df = spark.createDataFrame(rows, "seq long, k string, t string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = {r.seq: r["all"] for r in rolling_reduce(df, ["k"], ["seq"], join_text()).collect()}
        whole = {r.seq: r["all"] for r in rolling_reduce(df, [], ["seq"], join_text()).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    state, every = {}, ""
    for seq, k, t in rows:
        state[k] = state.get(k, "") + t
        every += t
        assert got[seq] == state[k] and whole[seq] == every


def test_reduce_of_no_rows_and_clashing_names(spark):
    df = spark.createDataFrame([], "seq long, k string, t string")
    assert rolling_reduce(df, ["k"], ["seq"], join_text()).count() == 0
    with pytest.raises(ValueError):
        rolling_reduce(df, ["k"], ["seq"], Fold({"t": F.col("t")}, lambda a, b: a))


def test_the_references_reducers_as_folds(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice("abc"), f"u{i % 5}", None if rnd.random() < 0.15 else rnd.randrange(9))
            for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, k string, url string, v long")

    def states(fold, *cols):
        return {r.seq: tuple(r[c] for c in cols) for r in rolling_reduce(df, ["k"], ["seq"], fold, 40).collect()}
    assert states(folds.count_fold(), "count") == {
        r.seq: (r["count"],) for r in R.rolling_count(df, "k", "seq", width=40).collect()}
    assert states(folds.sum_fold("v", "s"), "s") == {
        r.seq: (r.s,) for r in R.rolling_sum(df, "k", "seq", "v", "s", width=40).collect()}
    for kind, of in (("max", R.rolling_max), ("min", R.rolling_min)):
        assert states(folds.extreme_fold(kind, "v", ["url"]), "r_v", "r_url") == {
            r.seq: (r.v, r.url) for r in of(df, "k", "seq", "v", ["url"], width=40).collect()}
    for kind, of in (("max", R.rolling_max_by), ("min", R.rolling_min_by)):
        assert states(folds.extreme_row_fold(kind, "v", ["url", "seq"]), "r_v", "r_url", "r_seq") == {
            r.at_seq: (r.v, r.url, r.seq)
            for r in of(df, "k", "seq", "v", ["url"], width=40).collect()}
