"""Joining rows with a table of one row a key when few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it meets more than this part of all rows, so there are
#: fewer hot keys than this number whatever the input.
PART = 1000


def join_split(rows: DataFrame, table: DataFrame, on: str, weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``table`` on the non-null key ``on``.

    ``table`` holds a key once; its column ``weight`` (kept) says how many
    rows meet the key.  The keys that meet more than one row in PART, fewer
    than PART by that sum, are broadcast, so their rows stay where they are;
    the rows of the other keys are shuffled.  Both inputs are read twice and
    should be written tables.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * F.lit(PART) > F.lit(total)
    hot = F.broadcast(table.where(is_hot))
    rest = rows.join(F.broadcast(table.where(is_hot).select(on)), on, "left_anti")
    cold = table.where(~is_hot)
    return rows.join(hot, on).unionByName(rest.join(cold, on))
