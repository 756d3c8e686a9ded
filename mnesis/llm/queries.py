"""The queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnesis.llm import coalescence, dartminhash, divergence, mixing, multi_index, packing, private, quality, repair, telephony, tokencount, toxicity, warc
from mnesis.llm.common import crc32_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where the public tokenizer's file is, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(crc32_of(F.col("doc_id")), F.lit(3))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=fold != 1)
    return toxicity.score(docs, model).select("doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = multi_index.codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return multi_index.search(codes, codes.where(F.pmod("id", F.lit(100)) == 0), k=10)


def op4_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end=2)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
a AS (SELECT payload_digest, max(page_id) AS answer FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN answer <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN answer <> page_id THEN answer END AS refers_to
FROM p LEFT JOIN a ON p.payload_digest = a.payload_digest AND payload_bytes >= 1000
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(crc32_of(F.col("doc_id")), F.lit(5))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), keep=fold != 0)
    return quality.score(docs, model).select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op7_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telephony.round_trip(table(spark, sf_dir, "documents"), rate=telephony.RATE // 2)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.classes(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_coalescence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, lost = coalescence.damaged(table(spark, sf_dir, "conversations"))
    edits = coalescence.repaired(rows, lost=lost)
    return coalescence.digests(edits).select(F.col("conv").alias("conv_id"), *coalescence.COUNTS[:-1], "audit", "repaired_sha256")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = private.fit(private.examples(spark))
    return private.digest(private.find(table(spark, sf_dir, "documents"), field, ["doc_id"]), ["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_multi_index": op3_multi_index,
    "op4_repair": op4_repair,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_telephony": op7_telephony,
    "op8_mixing": op8_mixing,
    "op9_dartminhash": op9_dartminhash,
    "op10_packing": op10_packing,
    "op11_coalescence": op11_coalescence,
    "op12_divergence": op12_divergence,
    "op13_private": op13_private,
}

ORACLE_SQL: dict[str, str] = {
    "op3_multi_index": multi_index.SQL,
    "op5_warc": OP5_SQL,
    "op8_mixing": mixing.SQL,
    "op11_coalescence": coalescence.SQL,
    "op12_divergence": divergence.SQL,
}
