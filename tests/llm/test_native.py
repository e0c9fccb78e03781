"""Decontamination and sharding against brute force."""

import re
import zlib

from pyspark.sql import functions as F

from clickspark.llm import decontamination, sharding

from tests.llm.conftest import odd_texts, prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jump(key, shards):
    """The published loop."""
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_function(spark):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 10863919174838991, *range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100):
        got = {r.k: r.s for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert all(got[k] == jump(k, n) for k in keys)


def test_shards_of_odd_rows(docs, clashing, no_docs):
    rows = sharding.shard(docs, 8).collect()
    assert len(rows) == docs.count()
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    for r in rows:
        assert r.shard == jump(r.doc_id or 0, 8) and r.grown_shard in (r.shard, 8)
    text = {(i, t) for i, t in odd_texts()}
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                  for i, t in odd_texts())
    assert sorted((r["size"], r.text_crc32) for r in rows) == want and text
    assert sharding.shard(clashing[0], 8).count() == len(rows)
    assert sharding.shard(no_docs, 8).count() == 0


def test_written_shards_hold_every_row(docs, tmp_path, spark):
    sharding.write_shards(docs, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert all(r.shard_id == jump(r.doc_id or 0, 8) for r in back.collect())


def test_containment_against_brute_force(spark, docs):
    items = [(i, prose(500 + i, 8 + 3 * i)) for i in range(12)]
    texts = list(odd_texts())
    for k, (i, t) in enumerate(items):
        w = t.split()
        texts.append((100 + k, prose(900 + k, 3000) + " " + t + " " + prose(950 + k, 50)))
        texts.append((200 + k, prose(900 + k, 40) + " " + " ".join(w[:-max(1, len(w) // 6)])))
        texts.append((300 + k, " ".join(w[:len(w) // 2])))
    items += [(50, None), (51, ""), (52, "three words only"), (52, "three words only"), (None, items[0][1])]
    texts += [(400, "Three  WORDS\nonly"), (401, "three words only indeed")]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t in texts:
        for j, x in set(items):
            s = shingles(x)
            k = len(s & shingles(t))
            if s and 5 * k >= 4 * len(s):
                want.append((i, j, len(s), k))
    got = [(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared)
           for r in decontamination.contaminated(d, b).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key) and len(want) > 20
    dirty = {r[0] for r in want}
    kept = [r.doc_id for r in decontamination.keep_clean(d, b).collect()]
    assert sorted(map(str, kept)) == sorted(str(i) for i, _ in texts if i not in dirty)
    # beyond the broadcast bound the same rows come by a shuffle
    bound, decontamination.MAX_BROADCAST = decontamination.MAX_BROADCAST, 0
    try:
        assert decontamination.contaminated(d, b).count() == len(want)
    finally:
        decontamination.MAX_BROADCAST = bound


def test_signatures_follow_the_size_partition(spark):
    b = spark.createDataFrame([(i, prose(i, n)) for i, n in enumerate((5, 20, 35, 68, 131))],
                              "item_id long, text string")
    items = decontamination.items_of(b)
    n = {r.item: (r.n, r.part) for r in items.collect()}
    m = {r.item: r["count"] for r in decontamination.signatures(items).groupBy("item").count().collect()}
    for item, (size, part) in n.items():
        u = 2 ** (part + 1) - 1
        assert size <= u and m[item] == min(size, u - -(-u * 4 // 5) + 1) >= size - -(-size * 4 // 5) + 1


def test_decontamination_of_odd_tables(spark, clashing, no_docs):
    b = spark.createDataFrame([(1, prose(1, 60))], "item_id long, text string")
    got = decontamination.contaminated(clashing[0], b).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "None"]
    assert decontamination.contaminated(no_docs, b).count() == 0
    assert decontamination.contaminated(clashing[0], b.limit(0)).count() == 0
    kept = decontamination.keep_clean(clashing[0], b)
    assert kept.columns == clashing[0].columns and kept.count() == clashing[0].count() - 4
