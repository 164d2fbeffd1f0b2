"""Base relations of the queries, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.sources import latest_records, read_table

#: The same relations for SQL twins: each record, each filing once.
SQL_CHUNKS = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC NULLS LAST) AS rn
 FROM chunks WHERE record_id IS NOT NULL) WHERE rn = 1)"""
SQL_FILINGS = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY loaded_at DESC NULLS LAST) AS rn
 FROM filings WHERE document_id IS NOT NULL) WHERE rn = 1)"""


def chunks(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return latest_records(read_table(spark, sf_dir, "chunks"), *columns)


def filings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per document_id, the one loaded last."""
    newest = Window.partitionBy("document_id").orderBy(F.col("__loaded").desc_nulls_last())
    table = read_table(spark, sf_dir, "filings").where("document_id IS NOT NULL")
    keep = list(dict.fromkeys(["document_id", *columns]))
    ranked = table.select(*keep, F.col("loaded_at").alias("__loaded")).withColumn("__n", F.row_number().over(newest))
    return ranked.where("__n = 1").select(*keep)


def filing_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document_id, source_path, raw_text): a filing's opening followed by its chunks under their headings, in order."""
    part = F.struct(F.col("chunk_index").alias("at"), F.col("record_id").alias("id"), F.concat_ws("\n", "heading", "chunk_text").alias("text"))
    bodies = chunks(spark, sf_dir, "document_id", "chunk_index", "heading", "chunk_text").groupBy("document_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    opened = filings(spark, sf_dir, "source_path", "raw_text").join(bodies, "document_id", "left")
    body = F.array_join(F.transform("parts", lambda p: p["text"]), "\n")
    return opened.select("document_id", "source_path", F.concat_ws("\n", "raw_text", body).alias("raw_text"))
