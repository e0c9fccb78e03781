"""The registered queries of the operators, with DuckDB SQL where it can
express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}



def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the word-level BPE vocabulary."""
    import public_tokenizers

    from clickspark.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards, with the shard among nine."""
    from clickspark.llm.sharding import shard
    return shard(table(spark, sf_dir, "documents"), 8)


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes decoded from them."""
    import public_tokenizers

    from clickspark.llm.byte_bpe import encode_decode
    out = encode_decode(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; the counts are of base spans,
    ``n_added`` counts what the deobfuscation adds."""
    from clickspark.llm.pii import KINDS, find
    out = find(table(spark, sf_dir, "documents"))

    def count_of(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    ranked = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("rank"),
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return out.select(
        "doc_id",
        *[count_of(k) for k in KINDS],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(ranked).alias("spans"), F.size("added").cast("long").alias("n_added"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by compression distance."""
    from clickspark.llm import toxicity
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a byte-level convolutional network."""
    from clickspark.llm import quality_cnn
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.score(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are 85 percent alike."""
    from clickspark.llm.near_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), 85)


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds."""
    from clickspark.llm.decontamination import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings of one label, cosine 0.93 or more."""
    from clickspark.llm.embedding_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page under its host's wrapper."""
    from clickspark.llm.html_wrapper import main_text
    return main_text(table(spark, sf_dir, "pages"))


@query
def op11_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-triggered piecewise hashes of every document and of its text
    edited with its neighbour's."""
    from clickspark.llm.piecewise import with_next
    return with_next(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    from clickspark.llm.prefix_trie import trie
    return trie(table(spark, sf_dir, "conversations")).drop("src_conv", "src_pos")


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every embedding and their errors."""
    from clickspark.llm import vector_codes
    rows = table(spark, sf_dir, "embeddings")
    books = vector_codes.fit(rows)
    out = vector_codes.with_label_error(vector_codes.encode(rows, books))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                      F.lit(books.sha256()).alias("codebooks_sha256"))


def _oracles() -> dict[str, str]:
    from clickspark.llm import (decontamination, embedding_dup, near_dup, prefix_trie, sharding,
                                vector_codes)
    return {"op12_prefix_trie": prefix_trie.ORACLE, "op13_vector_codes": vector_codes.oracle(),
            "op2_decontamination": decontamination.ORACLE,
            "op3_near_duplicates": near_dup.ORACLE,
            "op6_embedding_duplicates": embedding_dup.ORACLE,
            "op9_jump_shards": sharding.oracle(8)}


ORACLES = _oracles()
