"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

The shard is a function of the stable key and the shard count alone: no ring
table, and with one more shard a row stays or moves into the new shard.
Everything is DataFrame operations.  The generator of the paper multiplies
modulo 2^64; a long would overflow, so its state is held in three limbs of
21, 21 and 22 bits, whose products stay below 2^44.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickspark.llm.common import pick

LCG = 2862933555777941757  # fixed value: the multiplier of the paper
LIMB, MASK, TOP = 21, (1 << 21) - 1, (1 << 22) - 1
#: Slots are numbered inside this many parts of a shard (fixed, so slots do
#: not depend on the cluster).
PARTS = 4096


def _limbs(x: int) -> tuple[int, int, int]:
    return x & MASK, x >> LIMB & MASK, x >> 2 * LIMB & TOP


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a long ``key`` (its bits as an unsigned 64-bit
    integer; null counts as 0)."""
    if shards < 1:
        raise ValueError("shards must be positive")
    c0, c1, c2 = (F.lit(c).cast("long") for c in _limbs(LCG))
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    zero = F.struct(
        key.bitwiseAND(MASK).alias("k0"),
        F.shiftrightunsigned(key, LIMB).bitwiseAND(MASK).alias("k1"),
        F.shiftrightunsigned(key, 2 * LIMB).alias("k2"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        k0, k1, k2 = s["k0"], s["k1"], s["k2"]
        r0 = k0 * c0 + F.lit(1).cast("long")
        r1 = k0 * c1 + k1 * c0 + F.shiftright(r0, LIMB)
        last = (k1 * c2 + k2 * c1).bitwiseAND(1)  # its weight is 2^63
        r2 = k0 * c2 + k1 * c1 + k2 * c0 + F.shiftright(r1, LIMB) + F.shiftleft(last, LIMB)
        n1, n2 = r1.bitwiseAND(MASK), r2.bitwiseAND(TOP)
        # the top 31 of 64 bits: those of n2 and the upper 9 of n1
        high = F.shiftleft(n2, 9).bitwiseOR(F.shiftright(n1, 12))
        jump = F.floor((s["j"] + F.lit(1).cast("long")).cast("double")
                       * (F.lit(float(1 << 31)) / (high + F.lit(1).cast("long")).cast("double")))
        done = s["j"] >= F.lit(shards).cast("long")
        return F.struct(
            F.when(done, k0).otherwise(r0.bitwiseAND(MASK)).alias("k0"),
            F.when(done, k1).otherwise(n1).alias("k1"),
            F.when(done, k2).otherwise(n2).alias("k2"),
            F.when(done, s["b"]).otherwise(s["j"]).alias("b"),
            F.when(done, s["j"]).otherwise(jump).alias("j"))
    # j grows by one at least, so `shards` steps always end the search
    ran = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), zero, step, lambda s: s["b"])
    return ran.cast("int")


def _part(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(PARTS)


def shard(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row to a shard by its key and number the rows of a shard.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.
    ``size`` is the UTF-8 length plus one (null text: 1), ``text_crc32`` of a
    null text is that of the empty one.  A null key counts as 0.  Slots run
    from 0 without gaps in the order of (part, key); rows that repeat a key
    get consecutive slots.  Rows are numbered inside the parts of a shard
    (never a whole shard in one task) and shifted by the counts of the parts
    before; that table has at most ``shards * PARTS`` rows, so it is
    broadcast.
    """
    src = pick(df, doc_id=id_col, text=text_col)
    at = [jump_hash(F.col("doc_id"), shards).alias("shard"), _part(F.col("doc_id")).alias("part")]
    counts = src.select(*at).groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = src.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
                      F.crc32(body).alias("text_crc32"), *at,
                      jump_hash(F.col("doc_id"), shards + 1).alias("grown_shard"))
    within = Window.partitionBy("shard", "part").orderBy(
        F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    return (rows.withColumn("_rn", F.row_number().over(within))
            .join(offsets, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("_rn") - 1).cast("long").alias("slot"),
                    "grown_shard"))


def write_shards(df: DataFrame, path: str, shards: int, id_col: str = "doc_id") -> None:
    """Write all columns of ``df`` as Parquet, one directory per shard.  The
    files of a shard are split by part, so no task holds a whole shard."""
    key = F.col("_shard_key")
    out = df.withColumn("_shard_key", pick_key(df, id_col))
    out = out.withColumn("shard_id", jump_hash(key, shards))
    (out.repartition("shard_id", _part(key) % 64).drop("_shard_key")
     .write.mode("overwrite").partitionBy("shard_id").parquet(path))


def pick_key(df: DataFrame, id_col: str) -> Column:
    return df[f"`{id_col}`"]


def _jump_sql(key: str, shards: int) -> str:
    """The paper's loop, one nested query a step, in 128-bit integers."""
    q = (f"SELECT rid, (CASE WHEN {key} < 0 THEN {key}::HUGEINT + 18446744073709551616::HUGEINT "
         f"ELSE {key}::HUGEINT END) AS k, -1 AS b, 0::BIGINT AS j FROM docs")
    for _ in range(shards):
        # k * LCG modulo 2^64 in two halves, so that no product overflows
        nxt = (f"((((k // 4294967296) * {LCG}::HUGEINT) % 4294967296) * 4294967296 "
               f"+ (k % 4294967296) * {LCG}::HUGEINT + 1) % 18446744073709551616::HUGEINT")
        q = (f"SELECT rid, n AS k, CASE WHEN j < {shards} THEN j ELSE b END AS b, CASE WHEN j < {shards} "
             f"THEN floor((j + 1) * (2147483648.0::DOUBLE / ((n // 8589934592) + 1)::DOUBLE))::BIGINT "
             f"ELSE j END AS j FROM (SELECT *, {nxt} AS n FROM ({q}))")
    return f"SELECT rid, b AS shard FROM ({q})"


def oracle(shards: int) -> str:
    """DuckDB SQL of :func:`shard`; CRC-32 bit by bit over the bytes."""
    body = "encode(coalesce(text, ''))"
    table = ("list_transform(range(256), lambda c: list_reduce(list_prepend(c, range(8)), "
             "lambda r, i: CASE WHEN r % 2 = 1 THEN xor(3988292384, r // 2) ELSE r // 2 END))")
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2), "
           "lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)), "
           "lambda r, v: xor(r // 256, t[(xor(r, v) % 256) + 1])), 4294967295)")
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 0) AS key,
    octet_length({body}) + 1 AS size, lower(hex({body})) AS h FROM documents),
tab AS (SELECT {table} AS t),
crcs AS (SELECT rid, {crc} AS c FROM docs, tab),
now AS ({_jump_sql("key", shards)}),
grown AS ({_jump_sql("key", shards + 1)}),
rows_ AS (
  SELECT doc_id, size, c AS text_crc32, now.shard, grown.shard AS grown_shard,
         ('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT % {PARTS} AS part
  FROM docs JOIN crcs USING (rid) JOIN now USING (rid) JOIN grown USING (rid))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law,
       shard::INTEGER AS shard, row_number() OVER (PARTITION BY shard ORDER BY part,
         doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard::INTEGER AS grown_shard
FROM rows_"""
