"""Click sources: generator, inline rows, text lines, socket, rate stream.

The generator picks user and url from fixed lists with a seeded,
stateless integer hash of a row id, so a batch run and any re-run (or a
retried task) give the same rows, and DuckDB can reproduce them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.model import CLICK_SCHEMA

# ---- fixed values: the reference generator's domains ----------------------
USERS = ["Mary", "Alice", "Bob", "Cary"]
URLS = ["./home", "./cart", "./fav", "./prod?id=1", "./prod?id=2"]
USERS_3 = ["Mary", "Bob", "Alice"]
URLS_3 = ["./home", "./cart", "./prod?id=1"]
# ---------------------------------------------------------------------------

_M = 2147483647      # 2^31 - 1 (MINSTD modulus)
_A = 48271           # MINSTD multiplier; products stay below 2^47


def minstd(x: Column, rounds: int = 1) -> Column:
    """A Park-Miller step on ``x`` (non-negative BIGINT), overflow free."""
    for _ in range(rounds):
        x = F.pmod(F.pmod(x, F.lit(_M)) * F.lit(_A) + F.lit(1), F.lit(_M))
    return x


def pick(values: Sequence[str], r: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(r, F.lit(len(values))) + 1).cast("int"))


def clicks_from_ids(df: DataFrame, id_col: str, ms: Column, users: Sequence[str] = USERS,
                    urls: Sequence[str] = URLS, seed: int = 42) -> DataFrame:
    """One generated click per input row id."""
    r1 = minstd(F.col(id_col) + F.lit(seed), 2)
    r2 = minstd(r1)
    return df.select(F.col(id_col).alias("seq"), pick(users, r1).alias("user"),
                     pick(urls, r2).alias("url"), ms.alias("ms"))


def generator_sql(id_expr: str, ms_expr: str, src: str, users: Sequence[str] = USERS,
                  urls: Sequence[str] = URLS, seed: int = 42) -> str:
    """The same generator in DuckDB SQL (for oracles)."""
    def step(x: str) -> str:
        return f"(((({x}) % {_M}) * {_A} + 1) % {_M})"
    r1 = step(step(f"{id_expr} + {seed}"))
    r2 = step(r1)
    ul = ", ".join(f"'{u}'" for u in users)
    vl = ", ".join(f"'{u}'" for u in urls)
    return (f"SELECT {id_expr} AS seq, [{ul}][({r1}) % {len(users)} + 1] AS \"user\", "
            f"[{vl}][({r2}) % {len(urls)} + 1] AS url, {ms_expr} AS ms FROM {src}")


def click_stream(spark: SparkSession, rows_per_second: int = 1, start_ms: int | None = None,
                 users: Sequence[str] = USERS, urls: Sequence[str] = URLS) -> DataFrame:
    """S1 streaming: a rate source turned into clicks (``query.stop()`` is
    the reference's ``cancel()``).  Event time is the rate source's
    timestamp, or ``start_ms + value * 1000 / rows_per_second``."""
    rate = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load())
    ms = (F.unix_millis(F.col("timestamp")) if start_ms is None
          else F.lit(start_ms) + F.floor(F.col("value") * 1000 / max(rows_per_second, 1)))
    return clicks_from_ids(rate, "value", ms, users, urls)


def inline(spark: SparkSession, rows: Iterable[tuple], schema=CLICK_SCHEMA) -> DataFrame:
    """``fromElements``."""
    return spark.createDataFrame(list(rows), schema)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3: a text file (or folder) line by line -> ``value``."""
    return spark.read.text(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Newline-delimited text from a socket (Spark's socket source)."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", port).load())
