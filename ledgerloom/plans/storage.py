"""Queries that write and read again: sinks, scans, caches, streams, retrieval."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.functions import columns as C
from ledgerloom.operators import enrich, retrieval
from ledgerloom.plans.base import SQL_CHUNKS, SQL_FILINGS, chunks, filings
from ledgerloom.plans.relational import context
from ledgerloom.session import cut, scratch
from ledgerloom.sources import documents, read_table
from ledgerloom.streaming import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_folder = scratch


@query(f"SELECT record_id, heading, chunk_index, chunk_text FROM {SQL_CHUNKS}")
def scan_jsonl(spark, sf_dir):
    """Records written as JSON lines and read with a schema."""
    sinks.write_jsonl(chunks(spark, sf_dir, "heading", "chunk_index", "chunk_text"), path := _folder(spark, "jsonl"))
    return documents.read_jsonl(spark, path, "record_id string, heading string, chunk_index bigint, chunk_text string")


@query(f"SELECT record_id, section_category, chunk_text FROM {SQL_CHUNKS} WHERE section_category IS NOT NULL AND section_category <> ''")
def sink_chunks_parquet(spark, sf_dir):
    """Records written by category and read back."""
    c = chunks(spark, sf_dir, "section_category", "chunk_text").where("section_category IS NOT NULL AND section_category <> ''")
    sinks.write_parquet(c.repartition("section_category"), path := _folder(spark, "chunks"), "section_category")
    return spark.read.schema("record_id string, chunk_text string, section_category string").parquet(path)


@query(f"""SELECT document_id, CAST(len(map_keys(metadata)) AS BIGINT) AS n_keys, metadata['filename'] AS filename FROM {SQL_FILINGS}""")
def sink_parquet_nested(spark, sf_dir):
    """Maps kept as JSON texts and read from them."""
    sinks.write_nested_as_json(filings(spark, sf_dir, "metadata"), path := _folder(spark, "nested"))
    m = F.from_json("metadata", "map<string,string>")
    return spark.read.parquet(path).select("document_id", F.coalesce(F.size(F.map_keys(m)).cast("bigint"), F.lit(None)).alias("n_keys"), F.try_element_at(m, F.lit("filename")).alias("filename"))


@query("SELECT DISTINCT timestamp_utc, model, status, prompt_tokens, total_tokens FROM toc_llm_metrics")
def scan_cost_csv(spark, sf_dir):
    """The call log appended to as CSV and read with a schema; repeated rows once."""
    sinks.append_log(read_table(spark, sf_dir, "toc_llm_metrics").select(*[c.split()[0] for c in documents.METRICS.split(", ")]), path := _folder(spark, "log"))
    return documents.read_metrics_csv(spark, path).select("timestamp_utc", "model", "status", "prompt_tokens", "total_tokens").distinct()


@query(f"SELECT document_id, CAST(length(raw_text) AS BIGINT) AS n_chars FROM {SQL_FILINGS} WHERE raw_text IS NOT NULL")
def sink_documents(spark, sf_dir):
    """Filings' openings cut from their table, written and read whole."""
    f = cut(filings(spark, sf_dir, "raw_text").where("raw_text IS NOT NULL"), "openings")
    return f.select("document_id", F.length("raw_text").cast("bigint").alias("n_chars"))


@query(f"SELECT record_id, CASE WHEN heading IS NULL THEN NULL ELSE 'about ' || heading END AS reply FROM {SQL_CHUNKS} WHERE heading IS NOT NULL")
def tables_batch(spark, sf_dir):
    """Replies to headings, each distinct one called once."""
    empty = spark.createDataFrame([], enrich.CACHE)
    c = chunks(spark, sf_dir, "heading")
    replies, _ = enrich.enrich(c, "record_id", "heading", empty, lambda p: f"about {p}")
    return replies.select("record_id", "reply")


@query(f"SELECT v.record_id, CAST(len(embedding) AS BIGINT) AS dims FROM index_vectors v JOIN {SQL_CHUNKS} c USING (record_id) WHERE embedding IS NOT NULL")
def scan_vectors(spark, sf_dir):
    """Stored vectors of known records."""
    v = read_table(spark, sf_dir, "index_vectors").where("embedding IS NOT NULL").select("record_id", F.size("embedding").cast("bigint").alias("dims"))
    return v.join(chunks(spark, sf_dir), "record_id", "left_semi")


@query(f"SELECT record_id, sha256(coalesce(retrieval_text, '')) AS text_hash, CAST(64 AS BIGINT) AS dims FROM {SQL_CHUNKS}")
def build_index(spark, sf_dir):
    """A vector of every record's text by the offline embedder."""
    v = retrieval.embed(chunks(spark, sf_dir, "retrieval_text"))
    return v.select("record_id", "text_hash", F.size("embedding").cast("bigint").alias("dims"))


@query()
def search(spark, sf_dir):
    """The five records nearest to a question, with their context ready for a prompt."""
    c = cut(chunks(spark, sf_dir, *retrieval.METADATA[1:], "retrieval_text"), "records")
    hits = retrieval.search(spark, "What legal proceedings and claims are pending?", retrieval.embed(c), c)
    return hits.select("rank", "record_id", "score", "heading")


@query()
def answer_context(spark, sf_dir):
    """The context of a question's hits."""
    c = cut(chunks(spark, sf_dir, *retrieval.METADATA[1:], "retrieval_text"), "records")
    hits = retrieval.search(spark, "Which risks did the company name?", retrieval.embed(c), c)
    return context(hits.withColumnRenamed("rank", "at"), "at")


@query()
def stream_sections(spark, sf_dir):
    """Sections of the filings' openings, as a stream of files."""
    folder = _folder(spark, "incoming")
    f = filings(spark, sf_dir, "raw_text").where("raw_text IS NOT NULL")
    f.foreachPartition(sinks.text_files(folder, "document_id", "raw_text"))
    q = files.start_sections(spark, folder, out := _folder(spark, "streamed"), _folder(spark, "progress"))
    q.awaitTermination()
    # The stream's ids are those of paths; the path is known of every filing.
    path = F.concat(F.lit(f"{documents.path_of(folder)}/"), "document_id", F.lit(".txt"))
    known = f.select("document_id", C.short_md5(path).alias("file_id"))
    found = spark.read.parquet(out).withColumnRenamed("document_id", "file_id").join(known, "file_id")
    return found.select("document_id", "section_no", "heading", "section_category")


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS starts, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def event_windows(spark, sf_dir):
    """Hourly counts and sums of events, as the stream gives them once all is read."""
    e = read_table(spark, sf_dir, "events")
    return files.event_windows(e).withColumn("total", F.round("total", 4))
