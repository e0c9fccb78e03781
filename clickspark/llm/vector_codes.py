"""Vector code compression: product quantisation by equal-average search.

Vectors are cut into equal consecutive parts, and each part is written as the
index of its nearest codebook entry (squared Euclidean distance, ties to the
lower index).  Everything is integer arithmetic on ``floor(scale * x)``, so
results do not depend on the order of sums or on the cluster.

Nearest entries are found by equal-average search: the entries of a codebook
are sorted by the sum of their components.  For vectors of d components
``(sum x - sum y)^2 / d <= |x - y|^2``, so a search that expands outward from
the part's own sum can stop once the squared gap of the sums over d strictly
exceeds the best distance; entries at the same distance are still seen, so
ties are exact.

Vectors that are null or hold null or non-finite components have no code.
Shorter vectors are padded with zeros to the greatest length, rounded up to a
multiple of the number of parts.  An integer component is held within
``2^28 / d`` (d components a part), so that no sum overflows: with 64
components in 16 parts that is exact below 262,144.  Rows that repeat a
vec_id are vectors of their own; rows without one come last when the first
entries are chosen.  An empty table has empty codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import pick, stage
from clickspark.llm.skew import join_split

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
STEP = 1 << 14  # parts searched at once
FAR = np.int64(1) << 40  # more than any gap between sums


class Codebooks:
    """``entries``: integers by (part, entry, component)."""

    def __init__(self, entries: np.ndarray, scale: int = SCALE):
        self.entries, self.scale = entries.astype(np.int64), scale
        self.parts, self.size, self.width = entries.shape
        sums = self.entries.sum(2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, 1)

    def integers(self, x: np.ndarray) -> np.ndarray:
        """Rows of doubles -> integers by (row, part, component)."""
        limit = (1 << 28) // self.width
        v = np.floor(np.clip(x * self.scale, -limit, limit)).astype(np.int64)
        return v.reshape(len(x), self.parts, self.width)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance by (row, part)."""
        flat = v.reshape(-1, self.width)
        part = np.tile(np.arange(self.parts), len(v))
        entry, dist = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
        for at in range(0, len(flat), STEP):
            cut = slice(at, at + STEP)
            entry[cut], dist[cut] = self._search(flat[cut], part[cut])
        shape = (len(v), self.parts)
        return entry.reshape(shape), dist.reshape(shape)

    def _search(self, x: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = x.sum(1)
        right = np.empty(len(x), np.int64)  # first entry in order with a sum not below
        for p in np.unique(part):
            rows = part == p
            right[rows] = np.searchsorted(self.sums[p], total[rows])
        left = right - 1
        best = np.full(len(x), np.iinfo(np.int64).max)
        found = np.full(len(x), -1)
        live = np.arange(len(x))
        while len(live):
            p, lo, hi = part[live], left[live], right[live]
            below = np.where(lo >= 0, total[live] - self.sums[p, np.maximum(lo, 0)], FAR)
            above = np.where(hi < self.size,
                             self.sums[p, np.minimum(hi, self.size - 1)] - total[live], FAR)
            gap = np.minimum(below, above)
            some = gap < FAR
            square = np.where(some, gap, 0) ** 2
            # the gap only grows on either side: past the bound nothing is nearer
            go = some & ((found[live] < 0) | (square <= self.width * np.where(
                found[live] < 0, 0, best[live])))
            live, p, lo, hi = live[go], p[go], lo[go], hi[go]
            down = below[go] <= above[go]
            e = self.order[p, np.where(down, lo, hi)]
            diff = x[live] - self.entries[p, e]
            d = (diff * diff).sum(1)
            better = (d < best[live]) | ((d == best[live]) & (e < found[live]))
            at = live[better]
            best[at], found[at] = d[better], e[better]
            left[live[down]] -= 1
            right[live[~down]] += 1
        return found, best

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Entries by (row, part) -> rows of doubles, in the middle of the
        integers' cells."""
        parts = self.entries[np.arange(self.parts)[None, :], codes]
        return (parts.reshape(len(codes), -1) + 0.5) / self.scale

    def text(self) -> str:
        """All components by part, entry and position, joined by commas."""
        return ",".join(map(str, self.entries.ravel().tolist()))

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def _codable(vector: Column) -> Column:
    """Whether a vector has a code."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` doubles, short ones padded."""
    starts = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(starts)
    out = np.zeros((len(sizes), width))
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        out[at, :n] = values[starts[at][:, None] + np.arange(n)[None, :]]
    return out


def _source(df: DataFrame, **cols: str) -> DataFrame:
    src = pick(df, **cols).withColumn("vector", F.col("vector").cast("array<double>"))
    return src.where(_codable(F.col("vector")))


def fit(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
        entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of ``df``: those of the ``entries`` smallest ids, then
    ``rounds`` times every entry is replaced by the floored mean of the parts
    assigned to it (unused entries stay).

    A round is one pass over the table.  A task returns the sums and counts
    of its entries, so what is shuffled and what reaches the driver has the
    size of the codebooks.
    """
    src = _source(df, vec_id=id_col, vector=vector_col)
    longest = src.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    first = src.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    seed = np.zeros((len(first), parts * width))
    for i, r in enumerate(first):
        seed[i, :len(r["vector"])] = r["vector"]
    empty = Codebooks(np.zeros((parts, 0, width)), scale)
    books = Codebooks(empty.integers(seed).transpose(1, 0, 2), scale)
    for _ in range(rounds if len(first) else 0):
        books = _moved(src.select("vector"), books)
    return books


def _moved(src: DataFrame, books: Codebooks) -> Codebooks:
    shape = books.entries.shape
    cells = shape[0] * shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((cells, shape[2]), np.int64), np.zeros(cells, np.int64)
        for b in batches:
            v = books.integers(_rows(b.column("vector"), shape[0] * shape[2]))
            cell = books.nearest(v)[0] + np.arange(shape[0]) * shape[1]
            np.add.at(total, cell.ravel(), v.reshape(-1, shape[2]))
            count += np.bincount(cell.ravel(), minlength=cells)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, shape[2])), pa.array(np.tile(np.arange(shape[2]), len(used))),
             pa.array(total[used].ravel()), pa.array(np.repeat(count[used], shape[2]))],
            names=["cell", "pos", "total", "n"])
    got = (src.mapInArrow(sums, "cell long, pos long, total long, n long")
           .groupBy("cell", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
    entries = books.entries.reshape(cells, shape[2]).copy()
    for r in got:
        entries[r["cell"], r["pos"]] = r["total"] // r["n"]
    return Codebooks(entries.reshape(shape), books.scale)


def encode(df: DataFrame, books: Codebooks, id_col: str = "vec_id",
           vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, code, error`` of every row that has a code: one byte a
    part (two, high one first, for more than 256 entries) and the squared
    distance of the integers from their entries.  One pass, no shuffle."""
    src = _source(df, vec_id=id_col, label=label_col, vector=vector_col)
    kind = np.dtype(np.uint8 if books.size <= 256 else ">u2")
    schema = T.StructType([src.schema["vec_id"], src.schema["label"],
                           T.StructField("code", T.BinaryType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = books.integers(_rows(b.column("vector"), books.parts * books.width))
            entry, dist = books.nearest(v)
            codes = entry.astype(kind)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(dist.sum(1))],
                names=["vec_id", "label", "code", "error"])
    return src.mapInArrow(run, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """Codes with ``label_error``: the error summed over equal labels, nulls
    together (held at the greatest long).  A label may hold any share of the
    rows: sums are partial, and few hot labels are joined by broadcast."""
    coded = stage(coded.withColumn("_label", F.struct("label")))
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = stage(coded.groupBy("_label").agg(
        F.least(F.sum(F.col("error").cast("decimal(20,0)")).cast("decimal(38,0)"), most)
        .cast("long").alias("label_error"), F.count(F.lit(1)).alias("_n")))
    return join_split(coded, sums, "_label", "_n").drop("_label", "_n")


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           scale: int = SCALE) -> str:
    """DuckDB SQL of the codes, by comparing every part with every entry.
    For vectors of one length, a multiple of ``parts``."""
    gap = ("list_sum(list_transform(range(1, len(a) + 1), "
           "lambda i: (a[i] - c[i]) * (a[i] - c[i])))::BIGINT")
    steps = ""
    for r in range(rounds + 1):
        steps += f""",
at{r} AS (SELECT rid, p, min({gap} * {entries} + e) AS m FROM part JOIN book{r} USING (p) GROUP BY rid, p)"""
        if r < rounds:
            steps += f""",
mean{r} AS (SELECT p, e, list(v ORDER BY i) AS c FROM (
  SELECT p, m % {entries} AS e, i, floor(sum(a[i])::BIGINT / count(*))::BIGINT AS v
  FROM at{r} JOIN part USING (rid, p), range(1, (SELECT max(len(a)) FROM part) + 1) t(i)
  GROUP BY ALL) GROUP BY p, e),
book{r + 1} AS (SELECT p, e, coalesce(mean{r}.c, book{r}.c) AS c FROM book{r} LEFT JOIN mean{r} USING (p, e))"""
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (SELECT rid, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS a
  FROM kept, range({parts}) t(p)),
book0 AS (SELECT p, rid AS e, a AS c FROM part WHERE rid < {entries}){steps},
coded AS (SELECT rid, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code,
    sum(m // {entries})::BIGINT AS error FROM at{rounds} GROUP BY rid),
books AS (SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) AS h
  FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       h AS codebooks_sha256
FROM kept JOIN coded USING (rid), books"""
