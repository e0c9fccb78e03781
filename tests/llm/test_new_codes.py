"""Piecewise fingerprints, the prefix trie and vector codes against brute force."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import types as T

from clickspark.llm import piecewise, prefix_trie, vector_codes

from tests.llm.conftest import odd_texts, prose

# ---- piecewise hashing ------------------------------------------------------


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_is_the_table():
    r = random.Random(1)
    for _ in range(400):
        a, b = ([r.randrange(3) for _ in range(r.randrange(80))] for _ in range(2))
        assert piecewise.edit_distance(a, b) == plain_distance(a, b)


def plain_fingerprint(text):
    """Byte by byte, over plain integers."""
    body = text.encode()
    weights = [int(w) for w in piecewise.WEIGHTS]
    ones = []
    for i in range(len(body)):
        window = [body[i - 6 + j] if i - 6 + j >= 0 else 0 for j in range(7)]
        x = sum(w * c for w, c in zip(weights, window)) % 2**32
        x = (x ^ x >> 15) * 0x2C1B3C6D % 2**32
        x ^= x >> 12
        ones.append((x ^ (x + 1)).bit_length() - 1)
    k = 0
    while len(body) / 2**k > piecewise.CHUNKS:
        k += 1
    while sum(o >= k for o in ones) > piecewise.CHUNKS * piecewise.REPEATS:
        k += 1
    parts = [str(k)]
    for level in range(k, k + piecewise.LEVELS):
        out, start = "", 0
        for i in range(len(body)):
            if ones[i] >= level or i == len(body) - 1:
                h = sum((c + 1) * pow(piecewise.BASE, j, 2**64) for j, c in enumerate(body[start:i + 1]))
                h %= 2**64
                h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 % 2**64
                out += "".join(piecewise.LETTERS[h >> 58 - 6 * s & 63] for s in range(2))
                start = i + 1
        parts.append(out)
    return ":".join(parts)


@pytest.mark.parametrize("text", ["", "a", "short text", prose(1, 300), "ab" * 3000, "é漢字\U0001f600" * 90])
def test_fingerprint_byte_by_byte(text):
    assert piecewise.fingerprint(text) == plain_fingerprint(text)


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    text = prose(4, 4000)
    whole = piecewise.fingerprint(text)
    monkeypatch.setattr(piecewise, "PIECE", 1000)
    assert piecewise.fingerprint(text) == whole


def test_likeness_follows_what_is_shared():
    one, two = prose(7, 1500), prose(8, 1500)
    mark = piecewise.fingerprint(one)
    near = piecewise.likeness(mark, piecewise.fingerprint(one[:4000] + "inserted" + one[4000:]))
    half = piecewise.likeness(mark, piecewise.fingerprint(piecewise.edited(one, two)))
    far = piecewise.likeness(mark, piecewise.fingerprint(two))
    assert piecewise.likeness(mark, mark) == 1.0
    assert near > 0.9 > half > 0.3 > 0.1 > far
    assert piecewise.likeness(mark, piecewise.fingerprint("")) == 0.0


def test_neighbours_of_odd_rows(spark, docs, clashing, no_docs):
    def rank(row):
        return (row[0] is None, -(row[0] or 0))
    got = piecewise.with_next(docs).collect()
    assert len(got) == len(odd_texts())
    assert piecewise.with_next(clashing[0]).count() == len(got)
    assert piecewise.with_next(no_docs).count() == 0
    by_id = sorted(((i, t or "") for i, t in odd_texts()), key=rank)
    ids = [i for i, _ in by_id]
    for n, (i, t) in enumerate(by_id):
        after = by_id[(n + 1) % len(by_id)]
        if ids.count(i) > 1 or ids.count(after[0]) > 1:
            continue  # the order inside one id is that of a hash
        row, = (r for r in got if r.doc_id == i)
        new = piecewise.edited(t, after[1])
        assert row.n_chars == len(t) and row.fingerprint == piecewise.fingerprint(t)
        assert row.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert row.edited_fingerprint == piecewise.fingerprint(new)
        assert row.near_next == piecewise.likeness(row.fingerprint, piecewise.fingerprint(after[1]))
    alone = spark.createDataFrame([(3, "abcd")], "doc_id long, text string")
    row, = piecewise.with_next(alone).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0


def test_op11_against_a_loop(spark, sf_dir):
    from clickspark.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op11_piecewise_fingerprints"](spark, sf_dir).collect()}
    rows = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect(),
                  key=lambda r: -r.doc_id)
    assert len(got) == len(rows)
    for n, r in enumerate(rows):
        text, other = r.text or "", rows[(n + 1) % len(rows)].text or ""
        half = len(text) // 2
        new = text[:len(text) - half] + other[:half]
        q = got[r.doc_id]
        assert q.n_chars == len(text)
        assert q.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert (q.fingerprint, q.edited_fingerprint) == (piecewise.fingerprint(text),
                                                         piecewise.fingerprint(new))
        assert q.near_edited == piecewise.likeness(q.fingerprint, q.edited_fingerprint)
        assert q.near_next == piecewise.likeness(q.fingerprint, piecewise.fingerprint(other))


# ---- prefix trie ------------------------------------------------------------

CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain_trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        whole[c] = own.get(base, [])[:h] + own[c][h:]
    members = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)

    def words(text):
        return len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)])
    out = []
    for node, ids in members.items():
        kids = [m for m in members if len(m) == len(node) + 1 and m[:len(node)] == node]
        below = [m for m in members if m[:len(node)] == node]
        leaves = [m for m in below if not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in members)]
        saved = sum((len(members[m]) - 1) * (words(m[-1][1]) if m else 0) for m in below)
        ends = ",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found_trie(df):
    return sorted((tuple(r) for r in prefix_trie.trie(df).drop("src_conv", "src_pos").collect()), key=repr)


def odd_conversations():
    r = random.Random(5)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(["", None, "yes", "a b c", " \n"]))
            for c in [*range(45), 60, 81, -3, -20] for t in range(r.randrange(1, 6))]
    rows += [(100 + i, t, "user", f"same {t}") for i in range(12) for t in range(4)]     # copies
    rows += [(200, None, "user", "null turn"), (200, 0, "user", "zero"), (200, 0, "user", "zero"),
             (201, 7, "a", "b c"), (202, 7, "ab", " c"), (None, 0, "user", "no conversation")]
    rows += [(300, t, "user", f"long {t % 7} text") for t in range(400)]                  # a third, one key
    return rows


def test_trie_against_brute_force(spark):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, CONV)
    assert found_trie(df) == plain_trie(rows)
    wide = df.selectExpr("*", "1 AS a", "2 AS b").toDF("conv_id", "turn", "role", "text", "TEXT", "Depth")
    assert prefix_trie.trie(wide).count() == len(plain_trie(rows))
    assert prefix_trie.trie(df.limit(0)).count() == 0


def test_groups_of_unequal_prefixes_are_not_accepted(spark, monkeypatch):
    """With fingerprints of a few bits different prefixes meet; the
    verification must see it under every base."""
    stored = prefix_trie.turns(spark.createDataFrame(odd_conversations(), CONV))
    monkeypatch.setattr(prefix_trie, "PRIMES", (2, 2, 2, 2))
    monkeypatch.setattr(prefix_trie, "_bases", lambda seed: [1, 1, 1, 1])
    with pytest.raises(RuntimeError):
        prefix_trie.verified(stored, tries=1)


def test_references_lead_to_the_stored_turns(spark):
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(30) for t in range(4)]
    df = spark.createDataFrame(rows, CONV)
    nodes = prefix_trie.trie(df).where("depth > 0").collect()
    stored = {(c, t + 1): text for c, t, _, text in rows}
    for n in nodes:
        c, h = n.conv_id, zlib.crc32(str(n.conv_id).encode()) % 4
        want = stored[(c - c % 20 if n.depth <= h else c, n.depth)]
        assert stored[(n.src_conv, n.src_pos)] == want


# ---- vector codes -----------------------------------------------------------

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                    T.StructField("label", T.IntegerType())])


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    ints = [[math.floor(256 * x) for x in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for v in ints]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))[:entries]
    books = [[cut[n][p] for n in first] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            got = [[] for _ in books[p]]
            for c in cut:
                got[nearest(p, c[p])[1]].append(c[p])
            new.append([tuple(sum(x) // len(g) for x in zip(*g)) if g else e
                        for g, e in zip(got, books[p])])
        books = new
    out = []
    for (i, _, lab), c in zip(kept, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, bytes(k for _, k in best), sum(d for d, _ in best), lab))
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return sorted(((*r[:3], total[r[3]]) for r in out), key=repr), books


def random_vectors(n, dim, seed=3):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(dim)], r.choice([1, 1, 1, 2, None])) for i in range(n)]
    rows += [(500 + i, rows[i % 7][1], 2) for i in range(40)]               # copies: equal entries tie
    rows += [(None, [0.5] * dim, 1), (None, [-0.5] * dim, None), (3, [0.25] * dim, 2)]
    as_floats = [(i, [float(__import__("numpy").float32(x)) for x in v], lab) for i, v, lab in rows]
    return as_floats + [(900, None, 1), (901, [None] * dim, 1), (902, [float("nan")] * dim, 1),
                        (903, [0.0] * (dim - 1) + [float("inf")], 2)]


@pytest.mark.parametrize("dim, n", [(32, 150), (16, 20), (20, 80)])
def test_codes_against_brute_force(spark, dim, n):
    rows = random_vectors(n, dim)
    df = spark.createDataFrame(rows, VEC)
    books = vector_codes.fit(df)
    want, entries = plain_codes(rows)
    assert [[tuple(e) for e in p] for p in books.entries.tolist()] == entries
    got = vector_codes.with_label_error(vector_codes.encode(df, books)).collect()
    assert sorted(((r.vec_id, bytes(r.code), r.error, r.label_error) for r in got), key=repr) == want


def test_vectors_of_other_lengths_and_sizes(spark):
    rows = [(1, [0.5, 1.5], 1), (2, [], None), (3, [1e30, -1e30, 0.25], 1), (4, [0.5, 1.5], 1)]
    df = spark.createDataFrame(rows, VEC)
    books = vector_codes.fit(df, parts=2, entries=2)
    got = {r.vec_id: r for r in vector_codes.with_label_error(
        vector_codes.encode(df, books)).collect()}
    assert len(got) == 4 and got[1].code == got[4].code and got[1].label_error == got[3].label_error
    back = books.decode(__import__("numpy").frombuffer(bytes(got[1].code), "uint8")[None, :])
    entry = books.entries[0, bytes(got[1].code)[0]]
    assert back[0][:len(entry)].tolist() == [(x + 0.5) / 256 for x in entry]
    none = vector_codes.fit(df.limit(0))
    assert none.text() == "" and vector_codes.with_label_error(
        vector_codes.encode(df.limit(0), none)).count() == 0
