"""The pipeline and the registered queries."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickspark.llm import byte_bpe, pii, toxicity
from clickspark.llm.queries import ORACLES, QUERIES

from tests.llm.test_duplicates import least_reachable, shingles


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    ids = sorted(texts)
    score = dict(zip(ids, model.score([texts[i] or "" for i in ids])))
    clean = [i for i in ids if score[i] < 0.3]
    sets = {i: shingles(texts[i]) for i in clean}
    links = [(a, b) for a in clean for b in clean if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = least_reachable(clean, links)
    single = [i for i in clean if root[i] == i]

    def low(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    tests = [low(r.text) for r in items]
    want = [i for i in single if not any(t and 5 * len(t & low(texts[i])) >= 4 * len(t) for t in tests)]
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == want and len(want) < len(ids)
    import public_tokenizers as P
    codec = byte_bpe.ByteBPE(byte_bpe._read(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    for r in got:
        assert codec.decode(bytes(r.ids)).decode() == pii.redact_text(texts[r.doc_id] or "")


def test_stages_keep_the_columns_and_stand_odd_rows(spark, docs, no_docs, sf_dir):
    for source in (docs, no_docs):
        now = source
        for name, fn in corpus_pipeline.STAGES[:-1]:
            now = fn(spark, now, sf_dir)
            assert now.columns == docs.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).count() == now.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, sf_dir).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_return_every_row(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    of = "pages" if "main_text" in name else "documents"
    assert got.count() == spark.read.parquet(f"{sf_dir}/{of}.parquet").count()
    key = got.columns[0]
    assert got.where(F.col(key).isNull()).count() == 0
