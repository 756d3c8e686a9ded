"""The corpus pipeline: five stages over ``documents``, each working on all that the one before it kept.

Toxic documents go, then documents of low quality; of each class of near copies the one with the least doc_id stays; the
rest is mixed to the sources' target weights, which repeats or leaves out documents, and packed into sequences. All
stages but the last return the columns of documents.

Defined results: each stage treats nulls, empty and repeated rows as its operator does. The near-copy stage keeps one row
of each class, of a doc_id with texts of several classes one for each class that it names, and every row without a doc_id.
Of rows that share doc_id and text the one with the least hash of its other columns stays, in every run. An empty table
passes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnesis.llm import dartminhash, mixing, packing, quality, toxicity
from mnesis.llm.common import settled

TOXIC = 0.7


def free_name(docs: DataFrame, name: str) -> str:
    """name, lengthened until no column of docs has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, score = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), free_name(docs, "score")
    return toxicity.score(docs, model, keep=docs.columns, name=score).where(F.col(score) < TOXIC).select(*docs.columns)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, score = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), free_name(docs, "score")
    return quality.score(docs, model, keep=docs.columns, name=score).where(F.col(score) >= quality.CUT).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text, row, copies = free_name(docs, "text_hash"), free_name(docs, "row_hash"), free_name(docs, "copies")
    first = dartminhash.rows_with_classes(docs).where(F.col("doc_id") == F.col("class_id"))
    first = first.groupBy("doc_id", F.coalesce("comp", "text_hash").alias("of")).agg(F.min("text_hash").alias(text)).select("doc_id", text).distinct()
    # of the rows of a doc_id and text the least by a hash of all other columns; rows equal in that, too, are one row's copies
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]), {"ignoreNullFields": "false"})
    hashed = docs.withColumns({text: dartminhash.text_hash(), row: F.md5(others.cast("binary"))})
    found = hashed.select("doc_id", text, row).join(first, ["doc_id", text], "left_semi").groupBy("doc_id", text, row).agg(F.count("*").alias(copies))
    chosen = found.groupBy("doc_id", text).agg(F.min(F.struct(row, copies)).alias(row)).select("doc_id", text, f"{row}.*")
    kept = hashed.join(chosen, ["doc_id", text, row])
    kept = kept.where(F.col(copies) == 1).unionByName(kept.where(F.col(copies) > 1).dropDuplicates(["doc_id", text, row]))
    return kept.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", without_toxic),
    ("quality classifier", of_quality),
    ("minhash near-dedup", without_near_copies),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]

#: SQL can't express the learnt stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
