"""M3 / M4 with a watermark generator of the user.

A :class:`Generator` is a :class:`clickspark.operators.folds.Fold` over the
rows in arrival order and an expression that says which watermark the state
emits after a row (null: none).  A watermark never moves back, so the current
one is the greatest emitted so far.  Both steps are blocked scans, so a
generator runs distributed although it is told row by row.

The reference's periodic generator keeps the greatest event time and emits it
less the delay at every period; its punctuated one emits with every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.operators.folds import Fold, rolling_reduce
from clickspark.operators.scan import Cuts, add_blocks, materialize, order_cuts, running


@dataclass(frozen=True)
class Generator:
    """``emit``: the watermark after a row, over its columns and the states."""

    fold: Fold
    emit: Column


def _later(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    keep = a["max_ms"].notna() & (b["max_ms"].isna() | (a["max_ms"] >= b["max_ms"]).fillna(False))
    return pd.DataFrame({"max_ms": a["max_ms"].where(keep, b["max_ms"])})


def periodic(delay_ms: int, at: Column | None = None, ms: str = "ms") -> Generator:
    """M1-M3: the greatest event time less the delay and one, emitted on the
    rows where ``at`` holds (the period; default: every row)."""
    mark = F.col("max_ms") - F.lit(delay_ms + 1)
    return Generator(Fold({"max_ms": F.col(ms)}, _later), mark if at is None else F.when(at, mark))


def punctuated(mark: Column) -> Generator:
    """M4: a row's own mark, null where it carries none."""
    return Generator(Fold({"max_ms": mark}, _later), F.col("max_ms"))


def generated(df: DataFrame, order: Sequence[str], generator: Generator, width: int | Cuts | None = None,
              state: dict | None = None, watermark: int | None = None) -> DataFrame:
    """``df`` with ``_emit``, the watermark that the generator emits after a
    row, and ``_before``, the current one when the row is processed (null: none
    yet).  ``state`` and ``watermark``: what earlier batches left."""
    cuts = order_cuts(df, order) if width is None else width
    told = rolling_reduce(add_blocks(df, order, cuts), [], order, generator.fold, initial=state)
    told = told.withColumn("_emit", generator.emit.cast("long"))
    again = materialize(add_blocks(told, order, cuts))
    out = running(again, [], order, {"_before": ("max", F.col("_emit"))}, exclusive=True)
    before = F.greatest(F.col("_before"), F.lit(watermark).cast("long"))
    return out.withColumn("_before", before)


def watermark_by(df: DataFrame, order: Sequence[str], generator: Generator, out: str = "watermark",
                 width: int | Cuts | None = None) -> DataFrame:
    """All columns of ``df`` and the watermark that each row sees
    (``Long.MIN`` before the first)."""
    from clickspark.model import LONG_MIN
    rows = generated(df, order, generator, width)
    return rows.select(*df.columns, F.coalesce("_before", F.lit(LONG_MIN)).alias(out))
