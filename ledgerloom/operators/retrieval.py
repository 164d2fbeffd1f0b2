"""Embedding, index, search and prompt, with providers that the caller may replace.

The offline embedder hashes words to a fixed number of dimensions; any callable
from texts to a matrix takes its place. Vectors are kept by record and by the
hash of their text, so only new or changed texts are embedded again.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Embedder = Callable[[list[str]], np.ndarray]
METADATA = ["record_id", "document_id", "company_name", "filing_year", "heading", "section_category", "chunk_text"]
SYSTEM = "Answer from the numbered excerpts only and name them; say so if they don't hold the answer."


def hashed_words(texts: list[str], dims: int = 64) -> np.ndarray:
    """The offline embedder: signed counts of hashed words at length one."""
    out = np.zeros((len(texts), dims), dtype=np.float32)
    for i, text in enumerate(texts):
        for w in re.findall(r"\w+", text.lower()):
            h = zlib.crc32(w.encode("utf-8", "surrogatepass"))
            out[i, h % dims] += 1 if h >> 31 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def embed(records: DataFrame, text: str = "retrieval_text", known: DataFrame | None = None, embedder: Embedder = hashed_words) -> DataFrame:
    """(record_id, text_hash, embedding): known vectors of unchanged texts, new ones for the rest. Null texts count as empty."""
    hashed = records.select("record_id", F.coalesce(text, F.lit("")).alias("t")).withColumn("text_hash", F.sha2("t", 256))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                yield pd.DataFrame({"record_id": pdf["record_id"], "text_hash": pdf["text_hash"], "embedding": list(embedder(pdf["t"].tolist()))})

    missing = hashed if known is None else hashed.join(known.select("record_id", "text_hash"), ["record_id", "text_hash"], "left_anti")
    new = missing.mapInPandas(run, "record_id string, text_hash string, embedding array<float>")
    if known is None:
        return new
    return new.unionByName(known.join(hashed.select("record_id", "text_hash"), ["record_id", "text_hash"], "left_semi"))


def search(spark: SparkSession, question: str, vectors: DataFrame, metadata: DataFrame, k: int = 5, embedder: Embedder = hashed_words, least: float | None = None) -> DataFrame:
    """The k records of highest inner product with the question, with rank and score; fewer if there are fewer.

    The question is a literal, so every task keeps only its k best before the
    final top-k.
    """
    q = F.array(*(F.lit(float(x)) for x in embedder([question])[0]))
    score = F.aggregate(F.zip_with(q, "embedding", lambda a, b: a * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    scored = vectors.select("record_id", F.round(score, 6).alias("score"))
    if least is not None:
        scored = scored.where(F.col("score") >= least)
    best = scored.orderBy(F.desc("score"), "record_id").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("score"), "record_id"))
    return best.withColumn("rank", rank).join(metadata.select(*METADATA), "record_id").orderBy("rank")


def prompt(question: str, context: str) -> list[dict[str, str]]:
    """The chat messages for a generator."""
    return [{"role": "system", "content": SYSTEM}, {"role": "user", "content": f"{context}\n\nQuestion: {question}"}]


def answer(question: str, context: str, generator: Callable[[list[dict[str, str]]], str] | None = None) -> str:
    """The generator's reply, or without one the context itself."""
    return generator(prompt(question, context)) if generator else context
