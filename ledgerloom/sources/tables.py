"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the directory; pruning and pushdown are left to Catalyst."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest_records(chunks: DataFrame, *columns: str) -> DataFrame:
    """One row per record_id: the delivery loaded last.

    Only `columns` are shuffled, once, by record_id. Deliveries of one record
    have the same content, so ties may fall either way; rows without a
    record_id are left out, since nothing can refer to them.
    """
    keep = list(dict.fromkeys(["record_id", *columns]))
    newest = Window.partitionBy("record_id").orderBy(F.col("__loaded").desc_nulls_last())
    return (
        chunks.where(F.col("record_id").isNotNull())
        .select(*keep, F.col("loaded_at").alias("__loaded"))
        .withColumn("__n", F.row_number().over(newest))
        .where("__n = 1")
        .select(*keep)
    )
