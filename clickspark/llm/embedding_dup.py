"""Embedding near-duplicates by int8 quantised tile products.

Each vector x is scaled to length one and written as ``s q + e`` with int8
codes q, and the exact length of the error e is kept.  For two vectors the
cosine differs from ``s_x s_y q_x . q_y`` by at most
``|s_x q_x| |e_y| + |e_x| |s_y q_y| + |e_x| |e_y|``.  So a product of code tiles decides
most pairs; only those that may reach the threshold are computed again in
double precision.  The code product is exact: it runs as a float matrix
product whose sums stay below the integers that type holds.

Vectors are compared when their labels are equal and not null (and their
dimensions too).  Equal vectors of a label are one class, so copies are never
expanded.  The classes of a label are cut into blocks and each pair of blocks
is one task; a task returns a link count and a root per class, not its pairs.

Vectors that are null, empty, zero, or hold null or non-finite components,
and those without a label, link with nothing.  Rows that repeat a vec_id are
vectors of their own that share its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import pick, stage
from clickspark.llm.components import components
from clickspark.llm.near_dup import grouped
from clickspark.llm.skew import join_split

THRESHOLD = 0.93
SLACK = 1e-6  # over the rounding of the bound itself
TILE = 2048  # most classes of a block; labels of fewer get eight blocks
MIN_TILE = 128


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales and error lengths of unit rows."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None])
    back = q * scale[:, None]
    return (q.astype(np.int8), scale, np.linalg.norm(x - back, axis=1))


def link_pairs(x: np.ndarray, y: np.ndarray, qx, qy, threshold: float):
    """Indices (i, j) with cosine >= threshold of raw rows x and y."""
    (cx, sx, ex), (cy, sy, ey) = qx, qy
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    dots = cx.astype(exact) @ cy.astype(exact).T
    near = dots * (sx[:, None] * sy[None, :])
    lx = sx * np.linalg.norm(cx.astype(np.float64), axis=1)
    ly = sy * np.linalg.norm(cy.astype(np.float64), axis=1)
    bound = lx[:, None] * ey[None, :] + ex[:, None] * (ly + ey)[None, :]
    i, j = np.nonzero(near + bound >= threshold - SLACK)
    keep = np.zeros(len(i), bool)
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    step = max(1, (1 << 22) // max(1, x.shape[1]))
    for at in range(0, len(i), step):
        a, b = i[at:at + step], j[at:at + step]
        keep[at:at + step] = (x[a] * y[b]).sum(1) / (nx[a] * ny[b]) >= threshold
    return i[keep], j[keep]


def _codes(df: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` -> with ``digest`` (null if the vector
    links with nothing), ``raw`` (doubles)."""
    keep = [df.schema["vec_id"], df.schema["label"]]
    out = T.StructType([*keep, T.StructField("digest", T.BinaryType()),
                        T.StructField("dim", T.IntegerType()),
                        T.StructField("raw", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            digests, dims, raws = [], [], []
            for v, lab in zip(b.column("embedding").to_pylist(), b.column("label").to_pylist()):
                x = (np.array([np.nan if c is None else c for c in v], np.float64)
                     if v is not None and lab is not None else np.zeros(0))
                with np.errstate(over="ignore", invalid="ignore"):
                    ok = len(x) and np.isfinite(x).all() and x.any()
                    if ok:  # tiny or huge components must not lose the length
                        x = x / np.abs(x).max() if not 1e-100 < np.abs(x).max() < 1e100 else x
                raw = x.tobytes() if ok else None
                raws.append(raw)
                dims.append(len(x) if ok else None)
                digests.append(xxhash.xxh3_128_digest(raw) if ok else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(digests, pa.binary()),
                 pa.array(dims, pa.int32()), pa.array(raws, pa.binary())], names=out.names)
    return df.mapInArrow(run, out)


def _tiled(classes: DataFrame) -> DataFrame:
    """A row per class and pair of blocks that it belongs to."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    rows = F.least(F.lit(TILE), F.greatest(F.lit(MIN_TILE), F.ceil(F.col("n") / 8)))
    sizes = sizes.select("label", "dim", F.ceil(F.col("n") / rows).cast("int").alias("blocks"))
    cut = classes.join(sizes, ["label", "dim"]).withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.select(
        F.xxhash64("label", "dim", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
        "label", "dim", "cid", "copies", "raw", (F.col("block") <= F.col("other")).alias("first"),
        (F.col("block") >= F.col("other")).alias("second"))


def _linked(tiles: DataFrame, threshold: float) -> DataFrame:
    """``cid, links, root`` per tile: linked copies in it, least class of its
    component in the tile."""
    def search(rows: pa.Table) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(rows.column("raw").to_pylist()), np.float64).reshape(rows.num_rows, -1)
        unit = x / np.sqrt((x * x).sum(1))[:, None]
        cid, copies = rows.column("cid").to_numpy(), rows.column("copies").to_numpy()
        left = np.flatnonzero(rows.column("first").to_numpy())
        right = np.flatnonzero(rows.column("second").to_numpy())
        q = quantise(unit)
        root, count = np.arange(len(cid)), np.zeros(len(cid), np.int64)
        same = np.array_equal(left, right)
        for at in range(0, len(left), 256):
            part = left[at:at + 256]
            i, j = link_pairs(x[part], x[right], [a[part] for a in q], [a[right] for a in q], threshold)
            i, j = part[i], right[j]
            if same:
                i, j = i[i < j], j[i < j]
            np.add.at(count, i, copies[j])
            np.add.at(count, j, copies[i])
            while len(i):  # union by least row
                low = np.minimum(root[i], root[j])
                before = root.copy()
                np.minimum.at(root, root[i], low)
                np.minimum.at(root, root[j], low)
                root = root[root]
                if np.array_equal(root, before):
                    apart = root[i] != root[j]
                    i, j = i[apart], j[apart]
        while not np.array_equal(root, root[root]):
            root = root[root]
        hit = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(cid[hit]), pa.array(count[hit]),
                                           pa.array(cid[root[hit]])], names=["cid", "links", "root"])

    def run(batches):
        for rows in grouped(batches, "tile"):
            owners = list(zip(rows.column("label").to_pylist(), rows.column("dim").to_pylist()))
            for owner in sorted(set(owners)):  # one, unless tile ids collide
                part = rows.filter(pa.array([o == owner for o in owners]))
                if part.num_rows > 1:
                    yield search(part)
    return (tiles.repartition("tile").sortWithinPartitions("tile", "cid")
            .mapInArrow(run, "cid long, links long, root long"))


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    coded = stage(_codes(pick(df, vec_id=id_col, embedding=vector_col, label=label_col)))
    # the class number only has to be unique: equal vectors share it
    classes = stage(coded.where("digest is not null").groupBy("label", "digest").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"),
        F.first("dim").alias("dim"), F.first("raw").alias("raw"))
        .withColumn("cid", F.xxhash64("label", "digest")))
    found = stage(_linked(_tiled(classes), threshold))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left").select(
        "cid", "label", "digest", "copies", "least", F.coalesce("component", "cid").alias("group"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = stage(named.join(least, "group").join(counts, "cid", "left").select(
        F.struct("label", "digest").alias("class"), "component_id", "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    # vectors that link with nothing join nothing; many copies stay where they are
    narrow = coded.select("vec_id", F.struct("label", "digest").alias("class"))
    some = join_split(narrow.where("class.digest is not null"), named, "class", "copies")
    none = narrow.where("class.digest is null").select(
        "*", F.col("vec_id").alias("component_id"), F.lit(1).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("n_links"))
    out, component = some.unionByName(none), F.col("component_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


#: All pairs of a label in DuckDB, components by recursion.
ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: c::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id,
       e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.a = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""
