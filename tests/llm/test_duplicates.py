"""Near-duplicates of texts and of embeddings against all pairs."""

import math
import random
import re

import numpy as np

from clickspark.llm import embedding_dup, near_dup
from clickspark.llm.components import components
from clickspark.llm.shingles import shingle_set

from tests.llm.conftest import prose


def shingles(text):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def family(n, words, seed, most):
    """Texts that differ from a base by up to ``most`` replaced words."""
    r, base = random.Random(seed), prose(seed, words).split()
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(r.randrange(most)):
            w[r.randrange(len(w))] = f"edit{seed}x{k}y{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_components_against_union_find(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)]
    edges += [(r.randrange(2000, 2400), r.randrange(2000, 2400)) for _ in range(180)] + [(7, 7)]
    got = {x.node: x.component for x in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = [e for e in edges if e[0] != e[1]]
    want = least_reachable({n for e in linked for n in e}, linked)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_against_all_pairs(spark, docs, clashing, no_docs):
    texts = [t for s in range(12) for t in family(12, 60, s, 5)]
    texts += family(60, 90, 77, 9) + ["same text here"] * 20 + ["a b", "A  B", "", None, "  "]
    r = random.Random(1)
    r.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = least_reachable(sets, links)
    small, near_dup.TILE = near_dup.TILE, 8  # many blocks
    try:
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
        got = {x.doc_id: x for x in got.collect()}
    finally:
        near_dup.TILE = small
    assert {i: got[i].component_id for i in got} == want
    assert all(got[i].n_shingles == len(sets[i]) and got[i].kept == (want[i] == i) for i in got)
    # odd rows: equal sets share a component, also rows without doc_id
    odd = near_dup.near_duplicates(clashing[0], 85).collect()
    assert len(odd) == docs.count()
    by = {(x.doc_id, x.n_shingles): x.component_id for x in odd}
    assert by[(1, 56)] == by[(2, 56)] == by[(None, 56)] == 1 and by[(None, 26)] is None
    assert by[(4, 0)] == 4 and by[(5, 0)] == 5 and by[(7, 1)] == by[(8, 1)] == 7 and by[(None, 0)] is None
    assert near_dup.near_duplicates(no_docs, 85).count() == 0


def test_rows_grow_with_a_group_of_near_copies_not_with_its_square(spark, monkeypatch):
    n, base = 150, prose(4, 310).split()
    rows = []
    for k in range(n):  # pairs share one of four edits at most: alike by 77 or 79 percent
        x, y = k % 15, k // 15
        w = list(base)
        for group, place in enumerate((x, y, (x + y) % 15, (x + 2 * y) % 15)):
            w[75 * group + 5 * place + 7] = f"edit{k}"
        rows.append((k, " ".join(w)))
    rows += [(n + k, rows[7 * k][1] + " tail") for k in range(10)]
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = least_reachable(sets, links)
    assert len(set(want.values())) == n
    staged, sizes = near_dup.stage, []

    def counted(df):
        out = staged(df)
        sizes.append(out.count())
        return out
    monkeypatch.setattr(near_dup, "stage", counted)
    for tile, blocks in ((128, 16), (4, 2)):
        monkeypatch.setattr(near_dup, "TILE", tile)
        monkeypatch.setattr(near_dup, "BLOCKS", blocks, raising=False)
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect()
        assert {x.doc_id: x.component_id for x in got} == want
        if tile == 128:
            assert max(sizes) <= len(rows) * near_dup.bands_for(80)


def test_keep_one_of_each_group(clashing, no_docs):
    kept = near_dup.keep_one(clashing[0], 80)
    assert kept.columns == clashing[0].columns
    ids = sorted(str(r[0]) for r in kept.collect())
    # 9 and 10 are near copies; the two rows without id and equal sets are one
    assert ids == sorted(["1", "None", "4", "5", "6", "7", "None", "9", "11", "12"])
    assert near_dup.keep_one(no_docs, 80).count() == 0


def test_posterior_bound_keeps_what_it_must():
    least = near_dup.least_matches(85)
    assert all(a < b for a, b in zip(least, least[1:]))
    r = np.random.default_rng(0)
    lost = 0
    for _ in range(2000):  # pairs at the threshold
        hits = np.cumsum(r.random(near_dup.HASHES) < 0.85)[near_dup.BATCH - 1::near_dup.BATCH]
        lost += bool((hits < np.array(least)).any())
    assert lost <= 2
    assert 1 - (1 - 0.85 ** near_dup.ROWS) ** near_dup.bands_for(85) >= 1 - near_dup.MISS


def test_shingle_sets_match_words():
    for t in ("", "  ", "a", "A b\tc", prose(3, 400), "é É ß x y z " * 30, "w" * 5000 + " " + prose(1, 9)):
        assert len(shingle_set(t)) == len(shingles(t))
    assert np.array_equal(shingle_set("A B c\nd e f"), shingle_set(" a  b C d E F "))


def cosine(x, y):
    return sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))


def test_embeddings_against_all_pairs(spark):
    r = np.random.default_rng(3)
    rows, n = [], 0
    for lab in (0, 1, None):
        for c in r.normal(size=(12, 24)):
            for _ in range(8):
                rows.append((n, [float(v) for v in np.float32(c + r.normal(size=24) * 0.27)], lab))
                n += 1
    rows += [(n + i, rows[0][1], 0) for i in range(30)]
    rows += [(9001, None, 0), (9002, [0.0] * 24, 0), (9003, [float("nan")] + [1.0] * 23, 0),
             (9004, [None] + [1.0] * 23, 0), (9005, [], 1), (9006, [1.0, 2.0], 1), (9007, [1.0, 2.0], 1),
             (9008, [1e-200, 2e-200], 1), (9007, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")

    def good(v, lab):
        return lab is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    links = {}
    for i, (a, x, p) in enumerate(rows):
        links[i] = [j for j, (b, y, q) in enumerate(rows) if i != j and good(x, p) and good(y, q) and p == q
                    and len(x) == len(y) and cosine([c * 1e100 if abs(x[0]) < 1e-99 else c for c in x],
                                                    [c * 1e100 if abs(y[0]) < 1e-99 else c for c in y]) >= 0.93]
    want = least_reachable(range(len(rows)), [(i, j) for i in links for j in links[i]])
    low = {}
    for i, (a, _, _) in enumerate(rows):
        low[want[i]] = min(low.get(want[i], a), a)
    expect = sorted((a, len(links[i]), low[want[i]]) for i, (a, _, _) in enumerate(rows))
    tile, embedding_dup.MIN_TILE = embedding_dup.MIN_TILE, 16
    try:
        got = embedding_dup.near_duplicates(df).collect()
    finally:
        embedding_dup.MIN_TILE = tile
    assert sorted((x.vec_id, x.n_links, x.component_id) for x in got) == expect
    assert all(x.kept == (x.vec_id == x.component_id) for x in got)
    assert embedding_dup.near_duplicates(df.limit(0)).count() == 0


def test_quantisation_bound_is_rigorous():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 64)) * np.exp(r.normal(size=(200, 1)) * 3)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    q, s, e = embedding_dup.quantise(u)
    near = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    size = s * np.linalg.norm(q.astype(float), axis=1)
    bound = size[:, None] * e[None, :] + e[:, None] * (size + e)[None, :]
    assert (np.abs(near - u @ u.T) <= bound + 1e-12).all()
