"""Calls to a model, once per content: lookup in a cache, calls for what is missing, log of both."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sinks import merge_cache

CACHE = "cache_key string, reply string, model string"


def cache_key(payload: str, model: str, version: str):
    """SHA-256 of version, model and the payload's own hash."""
    return F.sha2(F.to_json(F.struct(F.lit(model).alias("model"), F.sha2(payload, 256).alias("payload"), F.lit(version).alias("version"))), 256)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a cache on disk, each key once, the one written last; none where nothing can be read."""
    kept = "cache_key string, reply string, model string, written_at timestamp"
    try:
        rows = spark.read.schema(kept).option("ignoreCorruptFiles", True).parquet(path)
    except AnalysisException:
        rows = spark.createDataFrame([], kept)
    return rows.groupBy("cache_key").agg(F.max_by(F.struct("reply", "model"), "written_at").alias("e")).select("cache_key", "e.reply", "e.model")


def append_cache(entries: DataFrame, path: str) -> None:
    """Entries added to a cache on disk. A run that fails midway leaves the older entries as they are."""
    entries.withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(path)


def enrich(records: DataFrame, key: str, payload: str, cache: DataFrame, call: Callable[[str], str | None], model: str = "offline", version: str = "1", callers: int = 10) -> tuple[DataFrame, DataFrame]:
    """(records with reply and status 'hit', 'miss' or 'failed', the cache with the new replies).

    Each distinct payload is called once, by at most `callers` tasks at a time.
    A failed or empty reply isn't cached, so it is tried again. Null payloads
    are left out.
    """
    asked = records.where(F.col(payload).isNotNull()).select(key, F.col(payload).alias("p")).withColumn("cache_key", cache_key("p", model, version))
    missing = asked.join(cache.select("cache_key"), "cache_key", "left_anti").groupBy("cache_key").agg(F.min("p").alias("p"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            replies = []
            for p in pdf["p"]:
                try:
                    replies.append(call(p) or None)
                except Exception:  # a provider's failure is a result here, not the job's
                    replies.append(None)
            yield pd.DataFrame({"cache_key": pdf["cache_key"], "reply": replies, "model": model})

    new = missing.repartition(callers).mapInPandas(run, CACHE)
    fresh = new.where("reply IS NOT NULL")
    hits = asked.join(cache.select("cache_key", "reply"), "cache_key").select(key, "reply", F.lit("hit").alias("status"))
    made = asked.join(new.select("cache_key", "reply"), "cache_key").select(key, "reply", F.when(F.col("reply").isNull(), "failed").otherwise("miss").alias("status"))
    return hits.unionByName(made), merge_cache(cache, fresh, "cache_key")
