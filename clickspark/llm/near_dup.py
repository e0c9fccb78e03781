"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes its set of 5-word shingles.  Texts with equal sets form
   a class; only classes go on.
2. Bands of MinHash rows give candidates: classes that share a band bucket.
   The number of bands follows from the threshold and the miss probability.
3. Candidates are compared on longer signatures, batch by batch.  After n
   hashes with m matches the similarity has a Beta(m + 1, n - m + 1)
   posterior (uniform prior); a pair is dropped as soon as the probability
   that it reaches the threshold is below the miss probability.
4. Survivors are verified on the full sets.

No bucket's pairs are emitted.  First each bucket's members are compared with
its least member (a star), and links are joined to components.  Then only
buckets that still hold several components are searched, for pairs of
different components: members are cut into blocks, pairs of blocks are the
tasks, the largest component of a bucket is never compared with itself, and a
pair is looked at in its first common band only.  Pairs stay inside a task: a
member gets its signature before it is dealt to the tasks, a bucket has at most
2 BLOCKS blocks, which grow with it, what leaves a task is a row per member
with its posterior survivors, and what leaves the verification a spanning
forest of the links.  So rows grow with a bucket, not with its square.  That
search is exact: nothing is capped, and links lost are those of the chosen miss
probability.

Results: texts without words link with nothing and are their own component.
Rows that repeat a doc_id are one document for linking.  A row without doc_id
gets the component of the documents with an equal set, else null (it is not
linked by similarity).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import pick, positional, stage
from clickspark.llm.components import components
from clickspark.llm.shingles import U, common, mix, shingle_set
from clickspark.llm.skew import join_split

ROWS = 5  # MinHash rows of a band
MISS = 1e-6  # chosen miss probability: of the bands, and of each batch
HASHES, BATCH = 512, 32  # of the verification signature
TILE = 128  # classes of a block, in buckets of up to BLOCKS blocks
BLOCKS = 16  # of a bucket's largest component, and of its others
CELLS = 1 << 16  # pairs looked at at a time


def bands_for(percent: int) -> int:
    """Bands such that a pair at the threshold shares none with probability
    MISS at most."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


def _multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) | U(1)


def _minima(s: np.ndarray, mult: np.ndarray) -> np.ndarray:
    out = np.full(len(mult), 2**64 - 1, U)
    for i in range(0, len(s), 1024):
        np.minimum(out, (s[i:i + 1024, None] * mult[None, :]).min(0), out=out)
    return out


def _band_keys(s: np.ndarray, mult: np.ndarray) -> list[int]:
    rows = _minima(s, mult).reshape(-1, ROWS)
    key = np.arange(len(rows), dtype=U) * U(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        key = mix(key ^ rows[:, i]) + U(i)
    return key.view(np.int64).tolist()


def _signature(s: np.ndarray) -> bytes:
    """HASHES minima, cut to 16 bits (equal minima stay equal)."""
    return mix(_minima(s, _multipliers(HASHES, 2))).astype(np.uint16).tobytes()


def least_matches(percent: int) -> list[int]:
    """For n = BATCH, 2 BATCH, ...: the least number of matches at which
    P(similarity >= threshold) reaches MISS.  For the uniform prior this
    posterior is P(Binomial(n + 1, threshold) <= matches)."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, -1
        while total < MISS:
            m += 1
            total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n - m + 2)
                              + m * math.log(t) + (n + 1 - m) * math.log1p(-t))
        out.append(m)
    return out


def survivors(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray,
              least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i into a, j into b) of signatures that no batch drops."""
    matches = np.zeros(len(i), np.int32)
    for k, need in enumerate(least):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        for at in range(0, len(i), 4096):
            part = slice(at, at + 4096)
            matches[part] += (a[i[part], cut] == b[j[part], cut]).sum(1)
        keep = matches >= need
        i, j, matches = i[keep], j[keep], matches[keep]
        if not len(i):
            break
    return i, j


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, HASHES)


def fingerprints(df: DataFrame, percent: int) -> DataFrame:
    """``doc_id, text`` -> ``text`` replaced by ``fp`` (digest of the set,
    null if empty), ``n_shingles`` and ``bands`` (a key per band)."""
    mult = _multipliers(bands_for(percent) * ROWS, 1)
    keep = [f for f in df.schema.fields if f.name != "text"]
    out = T.StructType([*keep, T.StructField("fp", T.BinaryType()),
                        T.StructField("n_shingles", T.LongType()),
                        T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            fps, sizes, bands = [], [], []
            for t in b.column("text").to_pylist():
                s = shingle_set(t or "")
                sizes.append(len(s))
                fps.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bands.append(_band_keys(s, mult) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in keep]
                + [pa.array(fps, pa.binary()), pa.array(sizes, pa.int64()),
                   pa.array(bands, pa.list_(pa.int64()))], names=out.names)
    return df.mapInArrow(run, out)


def _profiles(texts: DataFrame, percent: int) -> DataFrame:
    """``cid, text`` -> ``cid, bands, signature, shingles`` of the texts with words."""
    mult = _multipliers(bands_for(percent) * ROWS, 1)
    out = T.StructType([texts.schema["cid"], T.StructField("bands", T.ArrayType(T.LongType())),
                        T.StructField("signature", T.BinaryType()), T.StructField("shingles", T.BinaryType())])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sets = [shingle_set(t or "") for t in part.column("text").to_pylist()]
                part = part.filter(pa.array([len(s) > 0 for s in sets], pa.bool_()))
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid"),
                     pa.array([_band_keys(s, mult) for s in sets], pa.list_(pa.int64())),
                     pa.array([_signature(s) for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=out.names)
    return texts.mapInArrow(run, out)


def _with_both(pairs: DataFrame, profiles: DataFrame, column: str) -> DataFrame:
    for end in ("a", "b"):
        pairs = pairs.join(profiles.select(F.col("cid").alias(end), F.col(column).alias(f"{column}_{end}")),
                           end)
    return pairs


def _pruned(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the sequential test."""
    least = least_matches(percent)

    def run(batches):
        for b in batches:
            if b.num_rows:
                n = np.arange(b.num_rows)
                i, _ = survivors(_signatures(b.column("signature_a")),
                                 _signatures(b.column("signature_b")), n, n, least)
                yield b.select(["a", "b"]).take(pa.array(i))
    return _with_both(pairs, profiles, "signature").mapInArrow(run, "a long, b long")


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two full sets reach the threshold."""
    both = 0 if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) else common(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    def run(batches):
        for b in batches:
            keep = [_alike(np.frombuffer(x, U), np.frombuffer(y, U), percent)
                    for x, y in zip(b.column("shingles_a").to_pylist(), b.column("shingles_b").to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return _with_both(pairs, profiles, "shingles").mapInArrow(run, "a long, b long")


def _tiles(entries: DataFrame, profiles: DataFrame) -> DataFrame:
    """Cut buckets that hold several components into pairs of blocks.

    ``entries(key, cid, comp)`` -> ``(tile, key, cid, comp, first, second,
    bands, signature)``; every pair of different components of a bucket meets
    in one tile.  The bucket's largest component is cut into blocks of its own,
    which are only paired with blocks of the others.
    """
    by_comp = entries.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))

    def blocks(n):
        return F.least(F.ceil(n / TILE), F.lit(BLOCKS)).cast("int")
    buckets = (by_comp.groupBy("key").agg(
        F.count(F.lit(1)).alias("comps"), F.sum("n").alias("n"),
        F.max(F.struct("n", "comp")).alias("top")).where("comps > 1")
        .select("key", F.col("top.comp").alias("major"), blocks(F.col("top.n")).alias("majors"),
                blocks(F.col("n") - F.col("top.n")).alias("minors")))
    rows = entries.join(buckets, "key").join(profiles.select("cid", "bands", "signature"), "cid")
    is_major = F.col("comp") == F.col("major")
    spread = F.xxhash64("cid", "key")
    block = F.when(is_major, F.col("minors") + F.pmod(spread, "majors")).otherwise(
        F.pmod(spread, "minors")).cast("int")
    rows = rows.withColumn("block", block)
    # a minor block meets all blocks, a major block the minor ones
    others = F.when(is_major, F.sequence(F.lit(0), F.col("minors") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("minors") + F.col("majors") - 1))
    rows = rows.select("key", "cid", "comp", "block", "bands", "signature", F.explode(others).alias("other"))
    return rows.select(
        F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
        "key", "cid", "comp", (F.col("block") <= F.col("other")).alias("first"),
        (F.col("block") >= F.col("other")).alias("second"), "bands", "signature")


def _by_tile(rows: DataFrame, fn: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` of all rows of a tile."""
    def run(batches):
        for tile in grouped(batches, "tile"):
            if tile.num_rows > 1:
                yield fn(tile)
    return rows.repartition("tile").sortWithinPartitions("tile", "cid").mapInArrow(run, schema)


def _searched(tiles: DataFrame, percent: int) -> DataFrame:
    """``tile, cid, partners``: the candidate pairs of different components
    within each tile that pass the sequential test, as the greater ids beside
    the least one.  Every id of a pair has a row."""
    least = least_matches(percent)

    def search(rows: pa.Table) -> pa.RecordBatch:
        sig = _signatures(rows.column("signature").combine_chunks())
        cid = rows.column("cid").to_numpy()
        comp = rows.column("comp").to_numpy()
        key = rows.column("key").to_numpy()
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(cid), -1)
        mine = bands == key[:, None]
        band, own = mine.argmax(1), mine.any(1)  # a repeated id has the buckets of other texts too
        left = np.flatnonzero(rows.column("first").to_numpy() & own)
        right = np.flatnonzero(rows.column("second").to_numpy() & own)
        same = np.array_equal(left, right)  # within one block every pair appears in both orders
        found = [(left[:0], left[:0])]
        step = max(1, CELLS // max(1, len(right)))
        for at in range(0, len(left), step):
            some = left[at:at + step]
            apart = comp[some][:, None] != comp[right][None, :]
            apart &= key[some][:, None] == key[right][None, :]  # tile ids may collide
            if same:
                apart &= some[:, None] < right[None, :]
            i, j = np.nonzero(apart)
            i, j = survivors(sig, sig, some[i], right[j], least)
            first = (bands[i] == bands[j]).argmax(1) == band[i]
            found.append((i[first], j[first]))
        i, j = (cid[np.concatenate(side)] for side in zip(*found))
        low, high = np.minimum(i, j), np.maximum(i, j)
        order = np.argsort(low, kind="stable")
        members = np.unique(np.concatenate([low, high]))
        ends = np.append(np.searchsorted(low[order], members), len(low)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(members), rows.column("tile")[0].as_py(), np.int64)), pa.array(members),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(high[order]))], names=["tile", "cid", "partners"])
    return _by_tile(tiles, search, "tile long, cid long, partners array<long>")


def _confirmed(found: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join within each tile of ``found`` what its pairs
    whose full sets reach the threshold join."""
    def confirm(rows: pa.Table) -> pa.RecordBatch:
        ids = rows.column("cid").to_pylist()
        partners = rows.column("partners").combine_chunks()
        ends, others = partners.offsets.to_numpy(), partners.values.to_numpy()
        sets: dict[int, list[np.ndarray]] = {}  # a repeated id has several
        for c, raw in zip(ids, rows.column("shingles").to_pylist()):
            sets.setdefault(c, []).append(np.frombuffer(raw, U))
        root = {c: c for c in sets}

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c
        links = []
        for a, lo, hi in zip(ids, ends, ends[1:]):
            for b in others[lo:hi].tolist():
                x, y = top(a), top(b)
                if x != y and any(_alike(s, t, percent) for s in sets[a] for t in sets[b]):
                    root[x] = y
                    links.append((a, b))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)],
                                          names=["a", "b"])
    return _by_tile(found.join(profiles.select("cid", "shingles"), "cid"), confirm, "a long, b long")


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in sorted batches, one table each."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and held[-1].column(key)[0].as_py() != k[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def links(docs: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """``node, component`` of the classes that link with another one.

    ``docs(doc_id, text)``; ``prints`` as :func:`fingerprints` gives them,
    staged.  A class is named by its least doc_id.
    """
    classes = stage(prints.where("fp is not null and doc_id is not null").groupBy("fp").agg(
        F.min("doc_id").alias("cid"), F.first("bands").alias("bands")))
    entries = classes.select("cid", F.explode("bands").alias("key"))
    buckets = (entries.groupBy("key").agg(F.min("cid").alias("rep"), F.max("cid").alias("last"))
               .where("rep <> last").select("key", "rep"))
    entries = stage(entries.join(buckets, "key"))
    members = entries.select("cid").distinct()
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("cid"), "text").join(
        members.hint("shuffle_hash"), "cid", "left_semi")
    profiles = stage(_profiles(texts, percent))

    star = entries.where("cid <> rep").select(F.col("rep").alias("a"), F.col("cid").alias("b")).distinct()
    found = stage(_verified(_pruned(star, profiles, percent), profiles, percent))
    joined = stage(components(found))

    labelled = entries.join(joined.withColumnRenamed("node", "cid"), "cid", "left").select(
        "key", "cid", F.coalesce("component", "cid").alias("comp"))
    more = _confirmed(stage(_searched(_tiles(stage(labelled), profiles), percent)), profiles, percent)
    return components(found.union(more))


def near_duplicates(df: DataFrame, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    docs = pick(df, doc_id=id_col, text=text_col)
    prints = stage(fingerprints(docs, percent))
    labelled = _labelled(docs, prints, percent)
    return labelled.select("doc_id", "n_shingles", "component_id",
                           F.coalesce(F.col("doc_id") == F.col("component_id"),
                                      F.lit(False)).alias("kept"))


def _labelled(docs: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    linked = links(docs, prints, percent)
    classes = prints.where("fp is not null").groupBy("fp").agg(
        F.min("doc_id").alias("cid"), F.count(F.lit(1)).alias("copies"))
    named = stage(classes.join(linked.withColumnRenamed("node", "cid"), "cid", "left").select(
        "fp", "copies", F.coalesce("component", "cid").alias("component_id")))
    # large groups of copies stay where they are; texts without a set join nothing
    narrow = prints.drop("bands")
    some = join_split(narrow.where("fp is not null"), named, "fp", "copies").drop("copies")
    none = narrow.where("fp is null").withColumn("component_id", F.col("doc_id"))
    return some.unionByName(none)


def keep_one(df: DataFrame, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """All columns of one row per component: the one whose doc_id names it.

    Texts without words are kept.  Rows that repeat a doc_id are reduced to
    one.  Of the rows without doc_id, one per set is kept, if no row with a
    doc_id has that set.  Decisions are made on narrow tables; the rows
    themselves are shuffled once, by doc_id.
    """
    flat, names = positional(df)
    ids, text = f"_p{names.index(id_col)}", f"_p{names.index(text_col)}"
    docs = flat.where(F.col(ids).isNotNull()).select(F.col(ids).alias("doc_id"), F.col(text).alias("text"))
    prints = stage(fingerprints(docs, percent))
    heads = stage(_labelled(docs, prints, percent).where("doc_id = component_id").select(
        F.col("doc_id").alias("_head")).distinct())
    named = (flat.withColumn("_head", F.col(ids)).join(heads.hint("shuffle_hash"), "_head", "left_semi")
             .dropDuplicates(["_head"]).drop("_head"))
    rest = stage(fingerprints(flat.where(F.col(ids).isNull()).withColumn("text", F.col(text)), percent)
                 .drop("bands", "n_shingles"))
    alone = rest.where("fp is not null").join(prints.select("fp").distinct(), "fp", "left_anti")
    columns = [f"_p{i}" for i in range(len(names))]
    out = named.select(*columns).union(alone.dropDuplicates(["fp"]).select(*columns)).union(
        rest.where("fp is null").select(*columns))
    return out.toDF(*names)


#: Exact set similarity by an inverted index in DuckDB, components by
#: recursion.
ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
      lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                 lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
       d.doc_id = component_id AS kept
FROM documents d JOIN least ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
