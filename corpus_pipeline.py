"""Documents to packed training batches: five stages, each by one operator of questlog.llm.

Every stage takes (spark, docs, sf_dir); each but the last returns the columns of documents. The
rows between two stages are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.llm import langid, packing, secrets, simhash, winnow
from questlog.llm.common import crc_is, cut, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what no language is found for: texts that are null, empty or without a letter. No rows, no rows."""
    model = langid.fit(docs.where(~crc_is("doc_id", 4, 2)))
    return langid.detect_language(docs, model).where(F.col("lang_pred") != "und").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of texts that share 0.8 or more of their shingles of five
    words, the one with the smallest doc_id; one row of repeated rows.

    Rows without a doc_id cannot be told apart and stay. Of rows of one id whose texts differ only
    in case or spaces any one stays; null and empty texts are alike. No rows, no rows.
    """
    known = docs.where(F.col("doc_id").isNotNull()).withColumn("copy", simhash.copy_key("text"))
    least = known.groupBy("copy").agg(F.min("doc_id").alias("doc_id")).join(simhash.similar_groups(known), "copy")
    kept = cut(least.groupBy("group").agg(F.min(F.struct("doc_id", "copy")).alias("kept")).select("kept.*"))
    return known.join(kept, ["doc_id", "copy"], "left_semi").dropDuplicates(["doc_id", "copy"]).unionByName(docs.where(F.col("doc_id").isNull()), allowMissingColumns=True).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item; others of the same or no doc_id stay.
    Null and empty texts hold none; an empty benchmark drops nothing."""
    text = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    keyed = docs.withColumn("row", F.concat(F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")), F.lit("/"), text))
    rows, hits, _ = winnow.contamination(keyed, table(spark, sf_dir, "benchmark"), doc_id="row")
    bad = rows.join(hits.select("row_id").distinct(), "row_id").select(F.col("doc_id").alias("row")).distinct()
    return keyed.join(bad, "row", "left_anti").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mask in place of every secret; no document goes. Null texts stay null; n_chars changes
    only where a text does."""
    masked = secrets.redact(secrets.scan_secrets(docs), "secrets")
    return masked.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left: pieces of text with bucket, batch and slot. Null and empty texts
    are pieces of no tokens; no rows, no pieces."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("packing", pack_batches),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs)
    return docs


#: Language identification and the near-dedup's bands have no form in SQL.
ORACLE_SQL = None
