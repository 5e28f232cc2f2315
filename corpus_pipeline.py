"""The corpus pipeline: quality rules, toxicity, near duplicates, packing. Each stage is written and read again by the next.

Rows of documents in, pieces of packed sequences out. The first three stages return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.llm import near_dups, packing, quality, queries, toxicity
from isochron.session import stored

SEQUENCE_TOKENS = 1024
END_TOKEN = 2
TOXIC_FROM = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; null and empty texts fail. Repeated rows stay repeated."""
    own = docs.columns
    marked = docs.select(F.struct(*own).alias("_row"), F.col("text"))
    return quality.judge(marked).filter("kept").select("_row.*").select(*own)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under TOXIC_FROM by a model learnt from labelled rows among them (its held-out third excepted).

    The score is computed beside the row, so no join is needed and repeated rows fare alike.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return docs.filter(toxicity.score_column(F.col("text"), model) < TOXIC_FROM)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts alike at 0.8 in five-word shingles: that with the smallest doc_id, and where unlike texts of a
    component share it, that with the smallest digest.

    Rows are told apart by doc_id and words, so of rows that repeat a doc_id those stay whose texts are no duplicates; of rows that repeat both
    one stays. Rows without doc_id, and rows without words, all stay.
    """
    found = near_dups.near_duplicates(docs.select("doc_id", "text")).filter("doc_id IS NOT NULL AND n_shingles > 0")
    found = stored(found.select("doc_id", F.col("digest").alias("_digest"), "first"), "judged-documents")
    dropped = found.filter("NOT first").select("doc_id", "_digest").distinct()
    repeated = found.filter("first").groupBy("doc_id", "_digest").count().filter("count > 1").select("doc_id", "_digest")
    own, key = docs.columns, ["doc_id", "_digest"]
    row = F.struct(*own).alias("_row")
    apart = F.col("doc_id").isNull() | F.col("text").isNull() | ~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    named = docs.filter(~apart).select(row, F.col("doc_id").cast("long").alias("doc_id"), near_dups.digest(F.col("text")).alias("_digest"))
    rest = named.join(near_dups.small(dropped, dropped.count()), key, "left_anti")
    n = repeated.count()
    if n:
        copies = near_dups.small(repeated, n)
        rest = rest.join(copies, key, "left_anti").unionByName(rest.join(copies, key, "left_semi").dropDuplicates(key))
    return rest.select("_row.*").select(*own).unionByName(docs.filter(apart))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most SEQUENCE_TOKENS; null texts are empty."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(docs.select("doc_id", "text"), path, END_TOKEN, SEQUENCE_TOKENS)
    pieces = stored(pieces, "pipeline-pieces", compression="zstd")
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests, SEQUENCE_TOKENS)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

# Learnt scores and packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


@queries.prepared
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each result but the last is written to the shared folder and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
