"""Rolling keyed aggregates A1-A7 (in-order arrival: seq = event_id)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickspark.operators import rolling as R
from clickspark.plans import params as P
from clickspark.plans.catalog.common import click_view, event_cuts, with_clicks
from clickspark.plans.registry import register

AMOUNT_SQL = "a AS (SELECT seq, \"user\", url, ms, CAST(round(value * 100) AS BIGINT) AS amount " \
             "FROM c JOIN (SELECT event_id AS seq, value FROM events) USING (seq))"
W_USER = "(PARTITION BY \"user\" ORDER BY seq)"


def amounts(spark, sf_dir):
    """Clicks with an integral field (``value`` in cents) to aggregate."""
    from clickspark.model import epoch_ms, load
    ev = load(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("user"),
                     F.col("event_type").alias("url"), epoch_ms("ts").alias("ms"),
                     F.round(F.col("value") * 100).cast("long").alias("amount"))


@register("rolling_sum", with_clicks(
    f'SELECT seq, "user", CAST(sum(amount) OVER {W_USER} AS BIGINT) AS amount FROM a', AMOUNT_SQL))
def rolling_sum(spark, sf_dir):
    """A1: keyBy(user).sum(amount)."""
    a = amounts(spark, sf_dir).select("seq", "user", "amount")
    return R.rolling_sum(a, "user", "seq", "amount", width=event_cuts(spark, sf_dir))


@register("rolling_max", with_clicks(
    f'SELECT "user", seq, first_value(url) OVER {W_USER} AS url, '
    f"max(amount) OVER {W_USER} AS amount FROM a", AMOUNT_SQL))
def rolling_max(spark, sf_dir):
    """A2: keyBy(user).max(amount): other fields stay from the first row."""
    return R.rolling_max(amounts(spark, sf_dir), "user", "seq", "amount", ["url"],
                         width=event_cuts(spark, sf_dir))


@register("rolling_min", with_clicks(
    f'SELECT "user", seq, first_value(url) OVER {W_USER} AS url, '
    f"min(amount) OVER {W_USER} AS amount FROM a", AMOUNT_SQL))
def rolling_min(spark, sf_dir):
    """A3: keyBy(user).min(amount): other fields stay from the first row."""
    return R.rolling_min(amounts(spark, sf_dir), "user", "seq", "amount", ["url"],
                         width=event_cuts(spark, sf_dir))


def _by_sql(fn: str, tie: str) -> str:
    return with_clicks(
        'SELECT "user", seq AS at_seq, b.url AS url, b.ms AS ms, b.f AS amount, b.s AS seq FROM '
        f"(SELECT \"user\", seq, {fn}({{'f': amount, 't': {tie}, 'url': url, 'ms': ms, 's': seq}}) "
        f"OVER {W_USER} AS b FROM a)", AMOUNT_SQL)


@register("rolling_max_by", _by_sql("max", "-seq"))
def rolling_max_by(spark, sf_dir):
    """A4: keyBy(user).maxBy(amount): the whole row of the max, first wins ties."""
    return R.rolling_max_by(amounts(spark, sf_dir), "user", "seq", "amount", ["url", "ms"],
                            width=event_cuts(spark, sf_dir))


@register("rolling_min_by", _by_sql("min", "seq"))
def rolling_min_by(spark, sf_dir):
    """A5: keyBy(user).minBy(amount): the whole row of the min, first wins ties."""
    return R.rolling_min_by(amounts(spark, sf_dir), "user", "seq", "amount", ["url", "ms"],
                            width=event_cuts(spark, sf_dir))


@register("rolling_count_user", with_clicks(
    f'SELECT seq, "user", count(*) OVER {W_USER} AS "count" FROM c'))
def rolling_count_user(spark, sf_dir):
    """Map to (user, 1L), keyBy(user).reduce(sum): running clicks per user."""
    c = click_view(spark, sf_dir).select("seq", "user")
    return R.rolling_count(c, "user", "seq", width=event_cuts(spark, sf_dir))


@register("rolling_top_user", with_clicks(
    "SELECT seq, t.k AS top_user, t.c AS top_count FROM (SELECT seq, "
    "max({'c': cnt, 's': seq, 'k': \"user\"}) OVER (ORDER BY seq) AS t FROM "
    f'(SELECT seq, "user", count(*) OVER {W_USER} AS cnt FROM c))'))
def rolling_top_user(spark, sf_dir):
    """Running top user over A6's updates; ties go to the newer update."""
    c = click_view(spark, sf_dir).select("seq", "user")
    w = event_cuts(spark, sf_dir)
    return R.running_top(R.rolling_count(c, "user", "seq", width=w), "user", "seq", width=w)


@register("top_user_final", with_clicks(
    'SELECT t.k AS "user", t.n AS "count" FROM (SELECT max({\'n\': n, \'l\': l, \'k\': "user"}) AS t '
    'FROM (SELECT "user", count(*) AS n, max(seq) AS l FROM c GROUP BY 1))'))
def top_user_final(spark, sf_dir):
    """A7 final: the top user once the input is exhausted."""
    return R.final_top(click_view(spark, sf_dir), "user", "seq")


@register("rolling_reduce_user", with_clicks(
    'SELECT "user", seq, b.url AS longest, -b.t AS since, n FROM (SELECT "user", seq, '
    f"max({{'len': length(url), 't': -seq, 'url': url}}) OVER {W_USER} AS b, "
    f"count(*) OVER {W_USER} AS n FROM c)"))
def rolling_reduce_user(spark, sf_dir):
    """A6 with a function of the user: the longest url so far, the earliest of
    equal length, and how many rows it was chosen from."""
    import pandas as pd

    from clickspark.operators.folds import Fold, rolling_reduce

    def merge(a, b):
        later = (b["longest"].str.len() > a["longest"].str.len()).fillna(False)
        return pd.DataFrame({"longest": a["longest"].where(~later, b["longest"]),
                             "since": a["since"].where(~later, b["since"]), "n": a["n"] + b["n"]})
    fold = Fold({"longest": F.col("url"), "since": F.col("seq"), "n": F.lit(1).cast("long")}, merge)
    rows = click_view(spark, sf_dir).select("user", "seq", "url")
    return rolling_reduce(rows, ["user"], ["seq"], fold, event_cuts(spark, sf_dir)).drop("url")
