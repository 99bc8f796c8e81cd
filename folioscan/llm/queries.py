"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioscan.llm import oracles
from folioscan.llm.alignment import alignment
from folioscan.llm.decontam import overlaps
from folioscan.llm.licences import licence_scan
from folioscan.llm.line_dedup import line_dedup
from folioscan.llm.ngram_join import link_counts, ngram_join
from folioscan.llm.packing import pack_conversations, pack_documents
from folioscan.llm.quality_model import classify
from folioscan.llm.quality_rules import quality_rules
from folioscan.llm.secrets import secret_scan
from folioscan.llm.sharding import shards
from folioscan.llm.token_counts import token_counts
from folioscan.llm.urls import labels_table, url_filter, url_rules
from folioscan.llm.whitening import whiten

#: The rules of the URL filter by host and path.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).drop("class_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), radius=None, short_repeats=True, blocks=None)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), tokens=2048, end=1)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES, labels_table(spark))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (op1_quality_model, op2_ngram_join, op3_quality_rules, op4_line_dedup, op5_sharding, op6_packing, op7_licences, op8_secrets, op9_decontamination, op10_token_counts, op11_whitening, op12_url_filter, op13_alignment)
}


def link_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To how many other shingle sets each document's is linked."""
    return link_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_links")


def quality_one_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All languages as one stratum and a larger risk, so that a few hundred labels certify cutoffs."""
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), risk=0.25, stratum_col=None)


def shards_of_64k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit that even small tables exceed many times."""
    return shards(table(spark, sf_dir, "documents"), 64 << 10)


def packed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction data: whole conversations under limits on tokens, segments and the assistant's tokens."""
    return pack_conversations(table(spark, sf_dir, "conversations"), public_tokenizers.path("byte_bpe_50k.json"), tokens=4096, segments=5, loss_tokens=3200)


def url_rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and the longest fitting rule of every page; the scorer's part of the filter left out."""
    return url_rules(table(spark, sf_dir, "pages"), URL_RULES)


#: The operators with other parameters or outputs than the contracts fix.
MORE = {f.__name__: f for f in (link_numbers, quality_one_stratum, shards_of_64k, packed_conversations, url_rule_verdicts)}
ORACLE_SQL: dict[str, str] = {
    "op2_ngram_join": oracles.NGRAMS,
    "op3_quality_rules": oracles.quality(0.05, 0.05),
    "op5_sharding": oracles.shards(16 << 20),
    "op7_licences": oracles.LICENCES,
    "link_numbers": oracles.LINK_COUNTS,
    "quality_one_stratum": oracles.quality(0.25, 0.05, "''"),
    "shards_of_64k": oracles.shards(64 << 10),
    "url_rule_verdicts": oracles.url_rules(URL_RULES),
}
