"""The registered queries of the operators, over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import (
    ann, bpe, html_extract, jaccard_join, langid, packing, pii, prefix_trie, quality,
    sharding, suffix_dedup, topk, vector_codes,
)
from folio.llm.oracles import ORACLES  # noqa: F401
from folio.session import read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read_table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.join(spark, docs)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.document_rows(read_table(spark, sf_dir, "documents"))
    return sharding.shuffle_shards(spark, rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = langid.detect(docs, langid.fit(docs))
    return found.select("doc_id", F.coalesce(langid.held_out(), F.lit(False)).alias("held_out"),
                        "lang_pred", "score")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages").select(
        "page_id", "url", "html"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark, read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(spark, read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(
        spark, read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(spark, read_table(spark, sf_dir, "embeddings"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark, read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(spark, read_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_sharding": op3_sharding,
    "op4_langid": op4_langid,
    "op5_html": op5_html,
    "op6_ann": op6_ann,
    "op7_quality": op7_quality,
    "op8_pii": op8_pii,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_bpe": op10_bpe,
    "op11_vector_codes": op11_vector_codes,
    "op12_topk": op12_topk,
    "op13_prefix_trie": op13_prefix_trie,
}
