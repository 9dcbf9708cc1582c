"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, html_text, licences, neardup, neighbours, packing, pieces, pii, quality, sharding
from .common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their near-duplicate components."""
    return neardup.group(table(spark, sf_dir, "documents"), percent=75)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with begin and end ids, and decoded."""
    return pieces.digest(pieces.encode_and_decode(table(spark, sf_dir, "documents")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their measures, posterior and verdict."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose vec_id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the licences of their whole texts and of their lines."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their personal data."""
    return pii.report(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7, whose texts imitate control strings."""
    own = spark.sql("SELECT -7L AS conv_id, t AS turn, r AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_chats(chat.format_chats(rows))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards under the law ``key``."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), width=1024, end_id=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality_rules": op3_quality_rules,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_licences": op5_licences,
    "op6_html_extraction": op6_html_extraction,
    "op7_pii": op7_pii,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_sharding": op9_sharding,
    "op10_best_fit_packing": op10_best_fit_packing,
}
