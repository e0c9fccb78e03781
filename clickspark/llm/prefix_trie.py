"""Trie of conversation prefixes, by composable fingerprints.

A conversation is rebuilt from the first ``h`` turns of its base conversation
and its own turns after the first ``h``.  No rebuilt text is formed.  A
sequence of turns has the fingerprint ``(sum of t_i B^(i-1) mod p, length)``
over the hashes t_i of its turns, a monoid under
``(x, m) * (y, n) = (x + B^m y, m + n)``.  So the fingerprint of every rebuilt
prefix is the product of a base's head and a piece of the conversation's own
suffix, both computed once from the stored turns: heads of at most HEAD turns,
suffixes by a running sum in blocks.  Four primes near 2^31 give 124 bits.

Rows carry a reference (conversation, position) to the stored turn and 240
bits of the turn's SHA-256.  Prefixes of one depth and fingerprint are one
node; the groups are verified by induction over the depth: all members' last
turns and all their parent prefixes must be equal.  Should a group fail, the
fingerprints are computed again with other bases.

Nothing walks the trie level by level.  The nodes whose least member is r are
a suffix of r's path.  So a node's subtree is summed over the rows of its
members: r counts one leaf if its own last node is childless, and a shared
turn counts once for every member that does not own it.

Turns are ordered by turn (null first), those of one turn by the digest of
their content; a null role or text is empty.  Rows without a conversation id are left out; ``%`` takes the sign
of the id, as in SQL.  No conversations, no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickspark.llm.common import pick, stage
from clickspark.llm.skew import PART, join_split
from clickspark.operators.scan import BLOCK, add_blocks, order_cuts, running
from clickspark.session import shuffle_partitions

HEAD = 4  # a head has fewer turns than this
FAMILY = 20  # a conversation's base is its id less the remainder by this
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)  # fixed values: the largest below 2^31
RADIX, DIGITS = 256, 4  # powers of the bases by digits of the exponent
PIECE = 4096  # consecutive ids whose members are joined as one piece (a power of two)


def _power(k: int, base: int, exponent: Column) -> Column:
    """``base ^ exponent mod PRIMES[k]`` by tables of the exponent's digits."""
    p, out = PRIMES[k], None
    for digit in range(DIGITS):
        step = pow(base, RADIX ** digit, p)
        values = [pow(step, i, p) for i in range(RADIX)]
        table = F.expr("array(" + ",".join(f"{v}L" for v in values) + ")")
        at = F.shiftright(exponent, 8 * digit).bitwiseAND(RADIX - 1).cast("int")
        power = F.get(table, at)
        out = power if out is None else (out * power) % F.lit(p)
    return out


def _bases(seed: int) -> list[int]:
    digest = hashlib.sha256(f"prefix {seed}".encode()).digest()
    return [int.from_bytes(digest[8 * k:8 * k + 8], "big") % (p - 1000) + 500
            for k, p in enumerate(PRIMES)]


def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """Stored turns without their texts: ``conv_id, pos`` (from 1), the
    content's digest ``q0 .. q3`` and its number of ``words``.

    Positions are running counts in blocks.  Conversations that hold more
    than one row in PART are cut into blocks at sampled bounds, so a hot one
    never lands in one task.
    """
    src = pick(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    src = src.where(F.col("conv_id").isNotNull())
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)), 256)
    rows = src.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
        digest.alias("_d"))
    rows = stage(rows.select("conv_id", "turn", "words", *[
        F.conv(F.substring("_d", 1 + 15 * i, 15), 16, 10).cast("long").alias(f"q{i}")
        for i in range(4)]))
    order = ["turn", "q0", "q1", "q2", "q3"]
    total = rows.count()
    size = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(size.where(F.col("_n") * PART > total).select("conv_id", F.lit(True).alias("_hot")))
    rows = rows.join(hot, "conv_id", "left")
    cuts = order_cuts(rows.where("_hot"), order)
    rows = add_blocks(rows, order, cuts).withColumn(
        BLOCK, F.when(F.col("_hot"), F.col(BLOCK)).otherwise(F.lit(-1))).drop("_hot")
    counted = running(rows, ["conv_id"], order, {"pos": ("count", F.lit(1))})
    return stage(counted.select("conv_id", "pos", "q0", "q1", "q2", "q3", "words", BLOCK))


def head_turns(conv: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEAD).cast("long")


def rebuilt(stored: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows and conversations of the rebuilt sequences.

    Rows, one a prefix: ``conv_id, depth``, fingerprint ``f0, f1`` and that of
    its parent ``p0, p1`` (two longs each), the last turn's digest and
    ``words`` and its reference ``src_conv, src_pos``; the root's rows have
    depth 0.  ``cum`` counts the words of all turns up to here.
    Conversations: ``conv_id, n_turns`` rebuilt.
    """
    bases = _bases(seed)
    quads = [f"q{i}" for i in range(4)]

    def term(k: int, quad: Column, exponent: Column) -> Column:
        return (quad % F.lit(PRIMES[k])) * _power(k, bases[k], exponent) % F.lit(PRIMES[k])

    # the own suffix of every conversation, in its own coordinates
    own = stored.withColumn("h", head_turns(F.col("conv_id"))).where(F.col("pos") > F.col("h"))
    own = own.withColumn("j", F.col("pos") - F.col("h") - 1)
    own = own.select("*", *[term(k, F.col(q), F.col("j")).alias(f"t{k}") for k, q in enumerate(quads)])
    own = running(stage(own), ["conv_id"], ["pos"],
                  {f"s{k}": ("sum", F.col(f"t{k}")) for k in range(4)}
                  | {"own_cum": ("sum", F.col("words"))})

    # the heads: at most HEAD - 1 turns of a base, in order
    turn = F.struct("pos", *quads, "words", F.col("conv_id").alias("src"))
    heads = (stored.where((F.col("pos") < HEAD) & (F.col("conv_id") % FAMILY == 0))
             .groupBy(F.col("conv_id").alias("base"))
             .agg(F.array_sort(F.collect_list(turn)).alias("head")))
    convs = stored.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    h = head_turns(F.col("conv_id"))
    convs = (convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
             .join(heads, "base", "left")
             .withColumn("head", F.coalesce(F.slice("head", F.lit(1), h.cast("int")), F.array())))
    none = F.lit(0).cast("long")

    def head_value(k: int, upto: Column) -> Column:
        at = F.filter(F.col("head"), lambda t, i: i < upto)
        return F.aggregate(F.transform(at, lambda t, i: term(k, t[quads[k]], i.cast("long"))), none,
                           lambda a, b: (a + b) % F.lit(PRIMES[k]))
    n_head = F.size("head")
    convs = convs.select(
        "conv_id", "head", n_head.cast("long").alias("n_head"),
        (n_head + F.greatest(F.col("n_own") - h, none)).alias("n_turns"), "n_own",
        *[head_value(k, n_head).alias(f"h{k}") for k in range(4)],
        F.aggregate("head", none, lambda a, t: a + t["words"]).alias("head_cum"))
    convs = stage(convs)

    def packed(values: list[Column], name: str) -> list[Column]:
        pairs = [(values[2 * i] * F.lit(1 << 31) + values[2 * i + 1]) for i in (0, 1)]
        return [c.alias(f"{name}{i}") for i, c in enumerate(pairs)]

    # rows of the heads, the root's among them
    steps = convs.select("*", F.explode(F.sequence(none, F.col("n_head"))).alias("depth"))
    last = F.get(F.col("head"), (F.col("depth") - 1).cast("int"))
    upto = F.col("depth").cast("int")
    front = steps.select(
        "conv_id", "depth", *packed([head_value(k, upto) for k in range(4)], "f"),
        *packed([head_value(k, upto - 1) for k in range(4)], "p"),
        *[F.coalesce(last[q], none).alias(q) for q in quads],
        F.coalesce(last["words"], none).alias("words"), last["src"].alias("src_conv"),
        last["pos"].alias("src_pos"),
        F.aggregate(F.filter("head", lambda t, i: i < upto), none,
                    lambda a, t: a + t["words"]).alias("cum"))
    # rows of the suffixes: head * suffix
    joined = join_split(stage(own), convs.drop("head"), "conv_id", "n_own")

    def composed(k: int, suffix: Column) -> Column:
        p = F.lit(PRIMES[k])
        shift = F.get(F.expr("array(" + ",".join(f"{pow(bases[k], i, PRIMES[k])}L" for i in range(HEAD))
                             + ")"), F.col("n_head").cast("int"))
        return (F.col(f"h{k}") + shift * (suffix % p)) % p
    back = joined.select(
        "conv_id", (F.col("n_head") + F.col("j") + 1).alias("depth"),
        *packed([composed(k, F.col(f"s{k}")) for k in range(4)], "f"),
        *packed([composed(k, F.col(f"s{k}") - F.col(f"t{k}")) for k in range(4)], "p"),
        *quads, "words", F.col("conv_id").alias("src_conv"), F.col("pos").alias("src_pos"),
        (F.col("head_cum") + F.col("own_cum")).alias("cum"))
    return stage(front.unionByName(back)), convs.select("conv_id", "n_turns")


def _nodes(rows: DataFrame) -> DataFrame:
    """One row a (depth, fingerprint), with what verifies it."""
    same = [f"{agg}({c}) AS {agg}_{c}" for c in ("p0", "p1", "q0", "q1", "q2", "q3")
            for agg in ("min", "max")]
    got = rows.groupBy("depth", "f0", "f1").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.first("words").alias("words"), F.first("src_conv").alias("src_conv"),
        F.first("src_pos").alias("src_pos"), *[F.expr(s) for s in same])
    ok = F.lit(True)
    for c in ("p0", "p1", "q0", "q1", "q2", "q3"):
        ok = ok & (F.col(f"min_{c}") == F.col(f"max_{c}"))
    return got.withColumn("equal", ok).withColumnRenamed("min_p0", "p0").withColumnRenamed(
        "min_p1", "p1").select("depth", "f0", "f1", "p0", "p1", "conv_id", "n_convs", "words",
                               "src_conv", "src_pos", "equal")


def _ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of the nodes at which conversations end.

    The ids of PIECE consecutive ones are joined first (at most so many, as
    ids are distinct); the pieces of a node then stream through one hash in
    order, so no group of copies is held in memory.
    """
    last = rows.join(convs.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"])
    at = F.shiftright(F.col("conv_id"), PIECE.bit_length() - 1)
    pieces = last.groupBy(F.struct("depth", "f0", "f1").alias("node"), at.alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")),
                     ",").alias("ids"))
    flat = pieces.select(F.col("node.depth").alias("depth"), F.col("node.f0").alias("f0"),
                         F.col("node.f1").alias("f1"), "piece", "ids")
    ordered = (flat.repartition(2 * shuffle_partitions(rows.sparkSession), "depth", "f0", "f1")
               .sortWithinPartitions("depth", "f0", "f1", "piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def batch(done):
            d, x, y, h = zip(*done) if done else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(x, pa.int64()), pa.array(y, pa.int64()),
                 pa.array(h, pa.string())], names=["depth", "f0", "f1", "ends_sha256"])
        for b in batches:
            done = []
            for *node, _, ids in zip(*[c.to_pylist() for c in b.columns]):
                if node != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield batch(done)
        if now is not None:
            yield batch([(*now, state.hexdigest())])
    return ordered.mapInArrow(run, "depth long, f0 long, f1 long, ends_sha256 string")


def verified(stored: DataFrame, tries: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, conversations and nodes under bases for which every group of
    prefixes proved equal."""
    for seed in range(tries):
        rows, convs = rebuilt(stored, seed)
        nodes = stage(_nodes(rows))
        if nodes.where(~F.col("equal")).isEmpty():
            return rows, convs, nodes.drop("equal")
    raise RuntimeError("fingerprints of different prefixes met under every base")


def trie(df: DataFrame, **cols: str) -> DataFrame:
    """Every node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256`` and the reference ``src_conv,
    src_pos`` to the stored turn that it ends with (null for the root)."""
    rows, convs, nodes = verified(turns(df, **cols))
    key = ["depth", "f0", "f1"]
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p0").alias("f0"), F.col("p1").alias("f1")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, key, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))))

    # per conversation: the depth from which it owns its path, whether its
    # last node is a leaf, its words before what it owns
    owned = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("owns"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    facts = (convs.join(owned, "conv_id", "left")
             .select("conv_id", F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"),
                     (F.col("n_turns") + 1).alias("n_rows"),
                     F.coalesce(F.col("owns"), F.col("n_turns") + 1).alias("owns")))
    rows = stage(join_split(rows, stage(facts), "conv_id", "n_rows"))
    # shared words from here to where r's own nodes begin: a difference of
    # running sums, the upper end being r's last row before them
    until = (rows.where(F.col("depth") == F.col("owns") - 1)
             .select("conv_id", F.col("cum").alias("until"), "n_rows"))
    until = stage(until.unionByName(
        rows.where((F.col("owns") == 0) & (F.col("depth") == 0))
        .select("conv_id", F.lit(0).cast("long").alias("until"), "n_rows")))
    full = join_split(rows.drop("n_rows"), until, "conv_id", "n_rows")
    shared = F.when(F.col("depth") < F.col("owns"),
                    F.col("until") - F.col("cum") + F.col("words")).otherwise(F.lit(0))
    sums = full.groupBy(*key).agg(F.sum("leaf").alias("n_leaves"),
                                  F.sum(shared).cast("long").alias("saved_tokens"))

    # a node's parent's least member: nodes with many children are split off
    named = nodes.withColumn("parent", F.struct((F.col("depth") - 1).alias("depth"),
                                                F.col("p0").alias("f0"), F.col("p1").alias("f1")))
    parents = stage(nodes.where("n_children > 0").select(
        F.struct("depth", "f0", "f1").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
        F.col("n_children").alias("_kids")))
    below = join_split(named.where("depth > 0"), parents, "parent", "_kids").drop("_kids")
    top = named.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    out = (below.unionByName(top).join(sums, key).join(_ends(full, convs), key, "left"))
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
                      "src_conv", "src_pos")


ORACLE = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)),
    lambda r, i: CASE WHEN r % 2 = 1 THEN xor(3988292384, r // 2) ELSE r // 2 END)) AS tab),
conv AS (SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)),
      lambda r, v: xor(r // 256, tab[(xor(r, v) % 256) + 1])), 4294967295) % {HEAD} AS h
  FROM (SELECT DISTINCT c FROM t), tab),
piece AS (SELECT conv.c, 0 AS part, pos, role, text FROM conv JOIN t ON t.c = conv.c - conv.c % {FAMILY} AND pos <= h
  UNION ALL SELECT conv.c, 1, pos, role, text FROM conv JOIN t ON t.c = conv.c AND pos > h),
seq AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY part, pos) AS path FROM piece GROUP BY c),
whole AS (SELECT c, coalesce(path, []) AS path FROM conv LEFT JOIN seq USING (c)),
r AS (SELECT c, d, path[1:d] AS prefix, len(path) AS n FROM whole, range(0, (SELECT max(len(path)) FROM whole) + 1) g(d)
  WHERE d <= len(path)),
node AS (SELECT d, prefix, min(c) AS rep, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(prefix[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM r GROUP BY d, prefix),
kids AS (SELECT d - 1 AS d, prefix[1:d - 1] AS prefix, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (d, prefix)),
up AS (SELECT a AS d, prefix[1:a] AS prefix, sum((n_convs - 1) * words)::BIGINT AS saved,
    count(*) FILTER (n_children = 0) AS n_leaves
  FROM full_, range(0, (SELECT max(d) FROM node) + 1) g(a) WHERE a <= d GROUP BY ALL)
SELECT f.rep AS conv_id, f.d AS depth, p.rep AS parent_conv_id, f.n_convs, f.n_children, up.n_leaves,
       up.saved AS saved_tokens, f.ends AS ends_sha256
FROM full_ f JOIN up USING (d, prefix) LEFT JOIN node p ON p.d = f.d - 1 AND p.prefix = f.prefix[1:f.d - 1]"""
