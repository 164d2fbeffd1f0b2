"""Documents from folders of text files, page tables, JSON lines, caches and logs."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C

DOCUMENT = "document_id string, source_path string, file_type string, raw_text string, metadata map<string,string>"
METRICS = (
    "timestamp_utc string, model string, status string, snippet_source string, prompt_chars bigint, prompt_tokens bigint, completion_tokens bigint, "
    "total_tokens bigint, latency_ms double, response_chars bigint, items_returned bigint, finish_reason string, estimated_cost_usd double, error string"
)


def decoded(content: Column) -> Column:
    """Bytes as text: malformed UTF-8 replaced, any line end as a newline."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), r"\r\n?", "\n")


def local_path(uri: Column) -> Column:
    """A file's path without the scheme, as the ids are made of it."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), r"^file:(?://)?", "")


def path_of(folder: str) -> str:
    """A folder's path without the scheme, as local_path gives it."""
    return re.sub(r"^file:(?://)?", "", folder)


def _described(files: DataFrame) -> DataFrame:
    path = F.col("source_path")
    return files.select(
        C.short_md5(path).alias("document_id"),
        path,
        F.lit("txt").alias("file_type"),
        "raw_text",
        F.create_map(F.lit("filename"), C.file_name(path)).alias("metadata"),
    )


def read_text_documents(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """One row per .txt file (any case of the suffix), each read whole; with a limit, the first by path.

    Unreadable files are skipped by Spark's own setting
    (spark.sql.files.ignoreCorruptFiles); empty files and an empty folder give no
    rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[tT][xX][tT]").load(folder)
    out = _described(files.select(local_path(F.col("path")).alias("source_path"), decoded(F.col("content")).alias("raw_text")))
    return out.orderBy("source_path").limit(limit) if limit is not None else out


def read_text_legacy(spark: SparkSession, folder: str) -> DataFrame:
    """(text, filepath) of files whose suffix is .txt exactly, in no order."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    return files.select(F.col("value").alias("text"), local_path(F.col("_metadata.file_path")).alias("filepath"))


def documents_from_pages(pages: DataFrame) -> DataFrame:
    """Documents from (source_path, page_number, text), pages joined in order by newlines.

    Page texts come from whichever extractor the caller has; each page gets its
    quality, and a document as many pages as its file has. Null texts count as
    empty pages.
    """
    q = C.page_quality(F.col("text"))
    page = F.struct("page_number", F.coalesce("text", F.lit("")).alias("text"), q["score"].alias("quality_score"), q["warnings"].alias("warnings"))
    grouped = pages.groupBy("source_path").agg(F.sort_array(F.collect_list(page)).alias("pages"))
    text = F.array_join(F.transform("pages", lambda p: p["text"]), "\n")
    return grouped.select(C.short_md5("source_path").alias("document_id"), "source_path", F.lit("pdf").alias("file_type"), text.alias("raw_text"), F.size("pages").alias("page_count"), "pages")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a known schema; blank lines are skipped, malformed ones give nulls."""
    return spark.read.schema(schema).json(path)


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """A call log with a header."""
    return spark.read.option("header", True).schema(METRICS).csv(path)


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vectors, metadata) of an index as `write_index` wrote it."""
    return spark.read.parquet(f"{path}/vectors"), spark.read.parquet(f"{path}/metadata")


PAGES = "source_path string, page_number int, text string"


def pdf_pages(content: bytes) -> list[str]:
    """The texts of a PDF's pages by the PyMuPDF library, where it is installed."""
    import pymupdf

    with pymupdf.open(stream=content, filetype="pdf") as pdf:
        return [page.get_text() for page in pdf]


def read_pdf_documents(spark: SparkSession, folder: str, extract: Callable[[bytes], list[str]] = pdf_pages) -> DataFrame:
    """One row per .pdf file (any case of the suffix), its pages by `extract`; files that it fails on, or all where its library is missing, are left out.

    The pages go through `documents_from_pages`, so each has its quality.
    """

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for path, content in zip(pdf["source_path"], pdf["content"]):
                try:
                    out += [(path, i + 1, text) for i, text in enumerate(extract(content))]
                except Exception as failure:  # one file's failure isn't the job's
                    warnings.warn(f"{path}: {failure}", stacklevel=1)
            yield pd.DataFrame(out, columns=["source_path", "page_number", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return documents_from_pages(files.select(local_path(F.col("path")).alias("source_path"), "content").mapInPandas(batches, PAGES))
