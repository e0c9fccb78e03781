"""Document fingerprints by context-triggered piecewise hashing.

A hash rolls over the last WINDOW bytes of a text.  Where its low k bits are
all ones, a chunk ends (block size 2^k), so boundaries follow the content and
an edit moves only those near it.  The block size is the least that expects
at most CHUNKS boundaries in a text of its length and has at most REPEATS
times as many (repetitive texts have more than expected, or none).  A
fingerprint holds k and the signatures of LEVELS block sizes,
``k:s(k):s(k+1):...``; a signature has SYMBOL letters for each chunk, from a
polynomial hash of its bytes.

Two fingerprints are compared at their finest common block size (none: 0) by
edit distance over chunks: ``1 - distance / longer length``.  Equal
fingerprints, those of two empty texts too, are 1.

A text is read in pieces of PIECE bytes, and of a piece only the boundaries
that may still count are kept, so a long or a repetitive text needs no more
memory than its bytes and one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickspark.llm.common import pick, stage
from clickspark.operators.scan import add_blocks, order_cuts
from clickspark.session import shuffle_partitions

WINDOW, CHUNKS, REPEATS, SYMBOL, LEVELS = 7, 64, 4, 2, 3
MOST = 32  # bits of the rolling hash: at block size 2^(MOST + 1) nothing ends
PIECE = 1 << 17
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
WEIGHTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D,
                    0xFD7046C5], np.uint32)  # odd, one a byte of the window
BASE = 0x9E3779B97F4A7C15  # odd, of the chunks' polynomial, modulo 2^64
_POWERS = np.full(PIECE, BASE, np.uint64)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS)
_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 64 << 20  # of texts, about, in a block of the neighbour scan


def _boundaries(body: bytes):
    """Where chunks end (exclusive offsets), the trailing ones of the rolling
    hash there, the polynomial's value so far; the least k; the last value."""
    data = np.frombuffer(body, np.uint8)
    n = len(data)
    k = max(0, -(-n // CHUNKS) - 1).bit_length()
    ends, ones, values = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))
    total, shift = np.uint64(0), 1
    tail = np.zeros(WINDOW - 1, np.uint32)
    for at in range(0, n, PIECE):
        b = data[at:at + PIECE]
        wide = np.concatenate([tail, b.astype(np.uint32)])
        roll = wide[:len(b)] * WEIGHTS[0]
        for i in range(1, WINDOW):
            roll += wide[i:i + len(b)] * WEIGHTS[i]
        roll ^= roll >> np.uint32(15)
        roll *= np.uint32(0x2C1B3C6D)
        roll ^= roll >> np.uint32(12)
        tail = wide[len(b):]
        value = np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _POWERS[:len(b)])
        value = value * np.uint64(shift) + total
        total = value[-1]
        shift = shift * pow(BASE, len(b), 1 << 64) % (1 << 64)
        mask = np.uint32((1 << k) - 1)
        hit = np.flatnonzero((roll & mask) == mask)
        found = roll[hit]
        ends = np.concatenate([ends, hit + at + 1])
        ones = np.concatenate([ones, _trailing_ones(found)])
        values = np.concatenate([values, value[hit]])
        if len(ends) > CHUNKS * REPEATS:
            at_least = np.cumsum(np.bincount(ones, minlength=MOST + 2)[::-1])[::-1]
            k = int(np.argmax(at_least <= CHUNKS * REPEATS))
            keep = ones >= k
            ends, ones, values = ends[keep], ones[keep], values[keep]
    return ends, ones, values, k, total


def _trailing_ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x & ~(x + np.uint32(1))).astype(np.int64)


def fingerprint(text: str) -> str:
    body = text.encode("utf-8", "surrogatepass")
    ends, ones, values, k, total = _boundaries(body)
    parts = [str(k)]
    for level in range(k, k + LEVELS):
        keep = ones >= level
        e, v = ends[keep].tolist(), values[keep].tolist()
        if len(body) and (not e or e[-1] < len(body)):  # the rest is a chunk
            e.append(len(body))
            v.append(int(total))
        letters, start, before = [], 0, 0
        for end, value in zip(e, v):
            # (value - before) / BASE^start: the chunk's own polynomial
            h = (value - before) * pow(_INVERSE, start, 1 << 64) % (1 << 64)
            h = (h ^ (h >> 31)) * 0xBF58476D1CE4E5B9 % (1 << 64)
            letters += [LETTERS[h >> (58 - 6 * i) & 63] for i in range(SYMBOL)]
            start, before = end, value
        parts.append("".join(letters))
    return ":".join(parts)


def edit_distance(a: list, b: list) -> int:
    """Levenshtein distance, a column of the table as one integer's bits."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    a, b = a[lo:], b[lo:]
    hi = 0
    while hi < min(len(a), len(b)) and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[:len(a) - hi], b[:len(b) - hi]
    if not a or not b:
        return len(a) + len(b)
    m = len(a)
    full, top = (1 << m) - 1, 1 << (m - 1)
    at: dict = {}
    for i, s in enumerate(a):
        at[s] = at.get(s, 0) | 1 << i
    plus, minus, score = full, 0, m
    for s in b:
        eq = at.get(s, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(x | plus)), plus & x
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & full, down << 1 & full
        eq |= minus
        plus, minus = down | (full & ~(eq | up)), up & eq
    return score


def likeness(one: str, two: str) -> float:
    """0 to 1 of two fingerprints."""
    if one == two:
        return 1.0
    a, b = one.split(":"), two.split(":")
    level = max(int(a[0]), int(b[0]))
    i, j = level - int(a[0]), level - int(b[0])
    if i >= LEVELS or j >= LEVELS:
        return 0.0
    a, b = ([s[x:x + SYMBOL] for x in range(0, len(s), SYMBOL)] for s in (a[1 + i], b[1 + j]))
    longer = max(len(a), len(b))
    return 1 - edit_distance(a, b) / longer if longer else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row (null text: empty).  One pass, no
    shuffle."""
    src = pick(docs, doc_id=id_col, text=text_col)
    schema = T.StructType([src.schema["doc_id"], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [fingerprint(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(marks, pa.string())],
                                             names=["doc_id", "fingerprint"])
    return src.mapInArrow(run, schema)


def edited(text: str, other: str) -> str:
    """``text`` with its last half (floored) replaced by as many code points
    of ``other``'s beginning, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its neighbour, the next row in descending order of the
    id (nulls last; rows of one id by a hash of the text; after the last the
    first; a single row is its own neighbour): ``doc_id, n_chars``,
    ``edited_sha256`` of the edited text (UTF-8), its fingerprint and the
    row's, and how like the row's fingerprint is to the edited text's and to
    the neighbour's.

    One pass notes (id, hash, size) of every row in a narrow table.  Bounds
    sampled from it cut the order into blocks of about BLOCK_BYTES of text.
    Texts are shuffled once, by block; the first row of a block also goes to
    the block before, so neighbours always meet, and a task streams its sorted
    rows, holding two texts.  Rows equal in id and text are interchangeable.
    """
    src = pick(docs, doc_id=id_col, text=text_col)
    # descending without overflow: the complement of an id is -id - 1
    order = {"_o0": F.col("doc_id").isNull().cast("int"),
             "_o1": F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0).cast("long")),
             "_o2": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))}
    names = list(order)
    src = src.withColumns(order)
    keys = stage(src.select(*names, F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")))
    total = keys.agg(F.sum("size")).first()[0] or 0
    cuts = order_cuts(keys, names, max(2 * shuffle_partitions(docs.sparkSession),
                                       -(-total // BLOCK_BYTES)))
    heads = (add_blocks(keys, names, cuts, name="block").groupBy("block")
             .agg(F.min(F.struct(*names)).alias("head")).orderBy("block").collect())
    # (block, its first row's order): as many as there are blocks
    blocks = [r["block"] for r in heads]
    spark = docs.sparkSession
    firsts = spark.createDataFrame(
        [(*r["head"], r["block"], blocks[i - 1]) for i, r in enumerate(heads)],
        "_o0 int, _o1 long, _o2 long, _of int, _before int")
    firsts = F.broadcast(firsts)
    rows = add_blocks(src, names, cuts, name="block")
    ends = (rows.join(firsts.select(*names, F.col("_before")), names)
            .dropDuplicates(names).withColumn("block", F.col("_before")).drop("_before"))
    both = (rows.withColumn("last", F.lit(0))
            .unionByName(ends.withColumn("last", F.lit(1))))
    dealt = (both.repartitionById(max(1, len(cuts) + 1), F.col("block"))
             .sortWithinPartitions("block", "last", *names)
             .select("doc_id", "text", "block", "last"))
    schema = T.StructType([
        src.schema["doc_id"], T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
    arrow = pa.schema([("doc_id", _arrow(src.schema["doc_id"].dataType)), ("n_chars", pa.int64()),
                       ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                       ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                       ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None  # (block, id, text, fingerprint) that waits for its neighbour
        for b in batches:
            out = []
            for doc, text, block, last in zip(*[c.to_pylist() for c in b.columns]):
                text = text or ""
                mark = now[3] if now and now[2] == text else fingerprint(text)
                if now and now[0] == block:
                    new = edited(now[2], text)
                    new_mark = now[3] if new == now[2] else fingerprint(new)
                    out.append((now[1], len(now[2]), hashlib.sha256(new.encode()).hexdigest(),
                                now[3], new_mark, likeness(now[3], new_mark),
                                likeness(now[3], mark)))
                now = None if last else (block, doc, text, mark)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)] if out
                else [pa.array([], f.type) for f in arrow], schema=arrow)
    return dealt.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)
