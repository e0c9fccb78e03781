"""Property test: the two-level scan equals a sequential loop for random
keys, values (with nulls), arrival orders and block widths."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickspark.operators.scan import add_blocks, running

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot"]),
                             st.one_of(st.none(), st.integers(-20, 20))),
                   min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st, width=st.integers(1, 9), seed=st.integers(0, 10**6),
       exclusive=st.booleans())
def test_running_matches_loop(spark, rows, width, seed, exclusive):
    import random
    order = list(range(len(rows)))
    random.Random(seed).shuffle(order)
    data = [(i, k, v, order[i]) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k string, v long, arr long")
    got = running(add_blocks(df, ["arr"], width=width), ["k"], ["arr"],
                  {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "c": ("count", F.col("v"))},
                  exclusive=exclusive)
    got = {r.id: (r.s, r.m, r.c) for r in got.collect()}
    state, exp = {}, {}
    for i, k, v, _ in sorted(data, key=lambda r: r[3]):
        s, m, c = state.get(k, (None, None, 0))
        if exclusive:
            exp[i] = (s, m, c)
        if v is not None:
            s = v if s is None else s + v
            m = v if m is None else max(m, v)
            c += 1
        state[k] = (s, m, c)
        if not exclusive:
            exp[i] = (s, m, c)
    assert got == exp
