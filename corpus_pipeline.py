"""A corpus pipeline over ``documents``, built from the operators in
``clickspark.llm``.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame.  Every stage but the last returns the
columns of ``documents``.  ``run`` writes each stage's rows as Parquet in the
shared checkpoint folder and reads them back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickspark.llm.common import stage, table
from clickspark.session import ship_package

#: The toxicity, deduplication and encoding decisions are not expressible in
#: SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    from clickspark.llm import toxicity as op
    ship_package(spark)
    model = op.fit(docs, table(spark, sf_dir, "labels"))
    return op.keep_clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingle sets are 80 percent alike."""
    from clickspark.llm.near_dup import keep_one
    ship_package(spark)
    return keep_one(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    from clickspark.llm.decontamination import keep_clean
    ship_package(spark)
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    from clickspark.llm.pii import redact
    ship_package(spark)
    return redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document: ``doc_id, ids, n_tokens``.  The
    ids are decoded again, and a document that came back otherwise would be
    an error."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from clickspark.llm.byte_bpe import encode_decode
    ship_package(spark)
    out = encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN, keep_text=True)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    ids = F.when(F.col("decoded") == text, F.col("ids")).otherwise(
        F.raise_error(F.lit("decoded bytes differ")).cast("binary"))
    return out.select("doc_id", ids.alias("ids"),
                      (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("pii", pii), ("byte_bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir))
    return docs
