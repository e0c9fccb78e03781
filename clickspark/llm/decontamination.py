"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is contaminated by a test item when it holds at least four fifths
of the item's distinct 5-word shingles (the whole word sequence is the one
shingle of shorter texts).  Items are partitioned by the size of their
shingle set, in powers of two.  Each partition's signature length follows
from its largest possible size u: with ``m = u - ceil(0.8 u) + 1`` of an
item's least hashes (its bottom-m MinHash signature) a document that lacks a
fifth of the shingles at most must hold one of them.  A fixed-length
signature of a long document would miss a short item's minima, so documents
are probed by all their shingle hashes; the search loses no item.  Candidates
are verified by exact containment of the shingle sets.

All of it is DataFrame operations.  Signatures are broadcast only while
their counted number stays below MAX_BROADCAST; beyond it they are joined by
a shuffle.

Null or empty texts match nothing.  Rows are matched by content, so repeated
rows and rows without an id each get their own result; an item that repeats
(same id and text) counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.common import pick, positional, stage

K = 5
NUM, DEN = 4, 5  # containment of 0.8
MAX_BROADCAST = 2_000_000  # signature hashes (about 50 MB of rows)


def shingle_hashes(text: Column) -> Column:
    """Distinct hashes of the 5-word shingles of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")

    def of_words(w: Column) -> Column:
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).when(
            F.size(w) < K, F.array(F.xxhash64(w))).otherwise(
            F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - K), lambda i: F.xxhash64(
                *[F.get(w, i + k) for k in range(K)]))))
    # bound as a lambda variable, the words are cut once, not for each shingle
    return F.get(F.transform(F.array(words), of_words), F.lit(0))


def content_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("h"), F.xxhash64(F.reverse(text)).alias("r"),
                    F.length(text).alias("n"))


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, item_id, shingles, n, part``; ``part`` is the size partition."""
    b = pick(benchmark, item_id=id_col, text=text_col).dropDuplicates()
    b = b.select(F.xxhash64("item_id", "text").alias("item"), "item_id",
                 shingle_hashes(F.col("text")).alias("shingles"))
    return b.withColumn("n", F.size("shingles")).where("n > 0").withColumn(
        "part", F.floor(F.log2("n")).cast("int"))


def signatures(items: DataFrame) -> DataFrame:
    """``hash, item``: the bottom-m MinHash signature of each item."""
    largest = F.pow(F.lit(2.0), F.col("part") + 1).cast("int") - 1
    m = largest - F.ceil(largest * NUM / DEN).cast("int") + 1
    return items.select("item", F.explode(F.slice(F.array_sort("shingles"), F.lit(1), m)).alias("hash"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``text`` plus any columns of ``docs`` -> those columns but ``text``,
    with ``item_id, n_item_shingles, n_shared``, one row per match."""
    items = stage(items_of(benchmark))
    sig = stage(signatures(items))
    if sig.count() <= MAX_BROADCAST:
        sig = F.broadcast(sig)
    keyed = docs.where(F.col("text").isNotNull()).withColumn("key", content_key(F.col("text")))
    probes = keyed.select("key", F.explode(shingle_hashes(F.col("text"))).alias("hash"))
    found = stage(probes.join(sig, "hash").select("key", "item").distinct())
    # `found` is on disk, so the planner knows its size when it joins
    held = keyed.join(found.select("key").distinct(), "key", "left_semi")
    pairs = held.withColumn("_mine", shingle_hashes(F.col("text"))).drop("text").join(found, "key")
    both = pairs.join(items, "item").withColumn(
        "n_shared", F.size(F.array_intersect("_mine", "shingles")))
    return both.where(F.col("n_shared") * DEN >= F.col("n") * NUM).withColumnRenamed(
        "n", "n_item_shingles").drop("_mine", "shingles", "part", "item")


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_item_shingles, n_shared, containment``: a row for
    every pair of a document and a test item that it holds."""
    docs = pick(df, doc_id=id_col, text=text_col)
    return matches(docs, benchmark).select(
        "doc_id", "item_id", F.col("n_item_shingles").cast("long").alias("n_item_shingles"),
        F.col("n_shared").cast("long").alias("n_shared"),
        (F.col("n_shared") / F.col("n_item_shingles")).alias("containment"))


def keep_clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of the rows that hold no test item (null texts stay)."""
    flat, names = positional(df)
    col = F.col(f"_p{names.index(text_col)}")
    dirty = stage(matches(flat.select(col.alias("text")), benchmark).select("key").distinct())
    key = F.when(col.isNotNull(), content_key(col))
    return flat.withColumn("key", key).join(dirty, "key", "left_anti").drop("key").toDF(*names)


#: Exact containment of word shingles in DuckDB.
ORACLE = f"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                     lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id,
         list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                     lambda x: x <> '') FROM benchmark),
sets AS (
  SELECT DISTINCT kind, id, unnest(list_transform(range(1, greatest(len(w) - {K - 1}, 1) + 1),
                                   lambda i: array_to_string(w[i:i + {K - 1}], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT id, count(*) AS n FROM sets WHERE kind = 'b' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS k
  FROM sets d JOIN sets b ON d.s = b.s AND d.kind = 'd' AND b.kind = 'b' GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item_shingles, k AS n_shared, k / n AS containment
FROM shared JOIN sizes ON id = item_id WHERE k * {DEN} >= n * {NUM}
"""
