"""Queries on scans, projections, predicates, aggregates, windows and top-k, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyarrow import dataset, fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions import rules as R
from ledgerloom.plans.base import SQL_CHUNKS, SQL_FILINGS, chunks, filings
from ledgerloom.session import scratch
from ledgerloom.sources import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as the query of its name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _in(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


N = "CAST(count(*) AS BIGINT)"
_TEXT_LEN = "CAST(length(chunk_text) AS BIGINT)"

# ---- scans and projections ------------------------------------------------------------------------------------------


@query(f"""SELECT document_id, source_path, CASE WHEN ltrim(lower(file_type), '.') IN ('txt', 'pdf') THEN ltrim(lower(file_type), '.')
 ELSE lower(regexp_extract(source_path, '[.]([A-Za-z]+)$', 1)) END AS file_type, CAST(length(raw_text) AS BIGINT) AS n_chars
 FROM {SQL_FILINGS} WHERE raw_text IS NOT NULL""")
def scan_documents(spark, sf_dir):
    """Loaded documents with a text; the type from its label or the path's suffix."""
    kind = F.ltrim(F.lower("file_type"), F.lit("."))
    suffix = F.lower(F.regexp_extract("source_path", r"[.]([A-Za-z]+)$", 1))
    return filings(spark, sf_dir, "source_path", "file_type", "raw_text").where("raw_text IS NOT NULL").select(
        "document_id", "source_path", F.when(kind.isin("txt", "pdf"), kind).otherwise(suffix).alias("file_type"), F.length("raw_text").cast("bigint").alias("n_chars")
    )


@query(f"""SELECT document_id, substr(md5(source_path), 1, 12) AS path_id, regexp_extract(source_path, '([^/]*)$', 1) AS filename,
 CAST(CASE WHEN raw_text IS NULL THEN NULL ELSE length(raw_text) END AS BIGINT) AS n_chars FROM {SQL_FILINGS}""")
def proj_document(spark, sf_dir):
    """Ids from paths and file names."""
    return filings(spark, sf_dir, "source_path", "raw_text").select(
        "document_id", C.short_md5("source_path").alias("path_id"), C.file_name(F.col("source_path")).alias("filename"), F.length("raw_text").cast("bigint").alias("n_chars")
    )


@query(f"""SELECT record_id, trim(regexp_replace(split_part(source_filename, '__CIK', 1), '_+', ' ', 'g')) AS company,
 ltrim(regexp_extract(source_filename, 'CIK([0-9]+)', 1), '0') AS cik,
 CASE WHEN regexp_extract(source_filename, '(?i)([0-9]{{4}})[0-9]{{6}}10[xk]', 1) <> '' THEN regexp_extract(source_filename, '(?i)([0-9]{{4}})[0-9]{{6}}10[xk]', 1)
 WHEN regexp_extract(source_filename, '__[0-9]{{10}}([0-9]{{2}})', 1) <> '' THEN '20' || regexp_extract(source_filename, '__[0-9]{{10}}([0-9]{{2}})', 1) ELSE '' END AS filing_year
 FROM {SQL_CHUNKS} WHERE source_filename IS NOT NULL""")
def parse_source_path(spark, sf_dir):
    """Company, CIK and year of the file names."""
    name = F.col("source_filename")
    return chunks(spark, sf_dir, "source_filename").where("source_filename IS NOT NULL").select("record_id", C.company_of(name).alias("company"), C.cik_of(name).alias("cik"), C.year_of(name).alias("filing_year"))


@query(f"SELECT record_id, substr(md5(concat_ws('|', source_filename, heading)), 1, 12) AS section_id FROM {SQL_CHUNKS}")
def md5_id(spark, sf_dir):
    """Section ids."""
    return chunks(spark, sf_dir, "source_filename", "heading").select("record_id", C.short_md5("source_filename", "heading").alias("section_id"))


@query("""SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count, CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS line_count
 FROM documents WHERE text IS NOT NULL""")
def doc_inventory(spark, sf_dir):
    """Characters and newlines of each document."""
    docs = read_table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.length("text").cast("bigint").alias("char_count"), C.newline_count(F.col("text")).cast("bigint").alias("line_count"))


@query("SELECT doc_id, CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '…' ELSE text END AS preview FROM documents WHERE text IS NOT NULL")
def preview(spark, sf_dir):
    """The first 80 characters."""
    return read_table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", C.preview(F.col("text"), 80).alias("preview"))


def labelled_text(text: Column) -> Column:
    """The labelled parts that are embedded: 'none' where no names are resolved or tables summed up, other nulls as empty, text to 4,000 characters as the format says."""
    none = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("none"))
    plain = lambda c: F.coalesce(F.col(c), F.lit(""))
    labels = [("Company", plain("company_name")), ("Section", plain("heading")), ("Category", plain("section_category")), ("Resolved entities", none("resolved_entity_names")), ("Table summaries", none("table_summaries"))]
    return F.concat_ws("\n\n", *(F.concat(F.lit(f"{k}: "), v) for k, v in labels), F.concat(F.lit("Text: "), F.coalesce(F.substring(text, 1, 4000), F.lit(""))))


@query(f"""SELECT record_id, 'Company: ' || coalesce(company_name, '') || chr(10) || chr(10) || 'Section: ' || coalesce(heading, '')
 || chr(10) || chr(10) || 'Category: ' || coalesce(section_category, '') || chr(10) || chr(10) || 'Resolved entities: ' || coalesce(nullif(resolved_entity_names, ''), 'none')
 || chr(10) || chr(10) || 'Table summaries: ' || coalesce(nullif(table_summaries, ''), 'none') || chr(10) || chr(10) || 'Text: ' || coalesce(substr(chunk_text, 1, 4000), '') AS retrieval_text
 FROM {SQL_CHUNKS}""")
def retrieval_text(spark, sf_dir):
    """The labelled parts of each record."""
    c = chunks(spark, sf_dir, "company_name", "heading", "section_category", "resolved_entity_names", "table_summaries", "chunk_text")
    return c.select("record_id", labelled_text(F.col("chunk_text")).alias("retrieval_text"))


@query(f"""SELECT record_id, coalesce(entity_names, '') <> '' AS has_entities, coalesce(table_count, 0) > 0 AS has_tables, coalesce(warning_count, 0) AS warning_count,
 {_TEXT_LEN} AS text_char_count FROM {SQL_CHUNKS}""")
def flags_counts(spark, sf_dir):
    """Flags and true lengths."""
    c = chunks(spark, sf_dir, "entity_names", "table_count", "warning_count", "chunk_text")
    return c.select(
        "record_id",
        (F.coalesce("entity_names", F.lit("")) != "").alias("has_entities"),
        (F.coalesce("table_count", F.lit(0)) > 0).alias("has_tables"),
        F.coalesce("warning_count", F.lit(0)).alias("warning_count"),
        F.length("chunk_text").cast("bigint").alias("text_char_count"),
    )


@query(f"""SELECT record_id, regexp_replace(regexp_replace(coalesce(filename, ''), '[.][A-Za-z]+$', ''), '^(.{{0,50}}).*$', '\\1') || ' [' || document_id || ']' AS doc_label
 FROM (SELECT record_id, document_id, source_filename AS filename FROM {SQL_CHUNKS})""")
def doc_label(spark, sf_dir):
    """The first 50 characters of the file's stem, and the document."""
    stem = F.regexp_replace(F.coalesce("source_filename", F.lit("")), r"[.][A-Za-z]+$", "")
    return chunks(spark, sf_dir, "source_filename", "document_id").select("record_id", F.concat(F.left(stem, F.lit(50)), F.lit(" ["), "document_id", F.lit("]")).alias("doc_label"))


@query(f"""SELECT record_id, replace(replace(replace(replace(chunk_text, chr(160), ' '), '—', '--'), '–', '-'), '−', '-') AS table_text FROM {SQL_CHUNKS} WHERE table_count > 0""")
def normalize_table_text(spark, sf_dir):
    """Dashes and no-break spaces of texts with tables."""
    return chunks(spark, sf_dir, "chunk_text", "table_count").where("table_count > 0").select("record_id", C.normalize_table_text(F.col("chunk_text")).alias("table_text"))


@query(f"""SELECT record_id, regexp_replace(regexp_replace(heading, '[ \\t]+', ' ', 'g'), '^[\\s\\x{{00A0}}\\x{{2002}}\\x{{2007}}\\x{{2009}}\\x{{202F}}\\x{{3000}}]+|[\\s\\x{{00A0}}\\x{{2002}}\\x{{2007}}\\x{{2009}}\\x{{202F}}\\x{{3000}}]+$', '', 'g') AS heading
 FROM {SQL_CHUNKS} WHERE heading IS NOT NULL""")
def normalize_ws(spark, sf_dir):
    """Headings with single blanks."""
    return chunks(spark, sf_dir, "heading").where("heading IS NOT NULL").select("record_id", C.normalize_ws(F.col("heading")).alias("heading"))


@query(f"SELECT record_id, regexp_replace(coalesce(company_name, ''), '[^A-Za-z0-9]', '_', 'g') AS file_name FROM {SQL_CHUNKS}")
def safe_filename(spark, sf_dir):
    """Company names as file names."""
    return chunks(spark, sf_dir, "company_name").select("record_id", F.regexp_replace(F.coalesce("company_name", F.lit("")), "[^A-Za-z0-9]", "_").alias("file_name"))


# ---- predicates -----------------------------------------------------------------------------------------------------


@query(f"SELECT record_id FROM {SQL_CHUNKS} WHERE document_id IS NOT NULL AND chunk_text IS NOT NULL AND heading IS NOT NULL AND company_name IS NOT NULL")
def filter_required(spark, sf_dir):
    """Records that have all required fields."""
    return chunks(spark, sf_dir, "document_id", "chunk_text", "heading", "company_name").dropna().select("record_id")


_ITEM_SQL = "upper(regexp_extract(heading, '(?i)item[\\s\\x{00A0}]+([0-9]+[A-Za-z]?)', 1))"


@query(f"SELECT record_id, {_ITEM_SQL} AS item_key FROM {SQL_CHUNKS} WHERE regexp_matches({_ITEM_SQL}, '^[0-9]{{1,2}}[A-Za-z]?$')")
def valid_item_key(spark, sf_dir):
    """Headings that name a valid item."""
    item = C.heading_item(F.col("heading"))
    return chunks(spark, sf_dir, "heading").select("record_id", item.alias("item_key")).where(F.col("item_key").rlike(r"^\d{1,2}[A-Za-z]?$"))


def _sql_category() -> str:
    number = "upper(regexp_extract(heading, '([0-9]+[A-Za-z]?)', 1))"
    items = " ".join(f"WHEN {number} = '{k}' THEN '{v}'" for k, v in R.ITEM_CATEGORIES.items())
    rules = " ".join(f"WHEN regexp_matches(lower(heading), '{p}') THEN '{c}'" for p, c in R.HEADING_RULES)
    return f"CASE {items} {rules} ELSE 'other' END"


@query(f"SELECT record_id, {_sql_category()} AS category FROM {SQL_CHUNKS}")
def categorize(spark, sf_dir):
    """Category of each heading: by item, else by title."""
    return chunks(spark, sf_dir, "heading").select("record_id", C.categorize_heading(F.col("heading")).alias("category"))


_RULES_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(heading), '{p}') THEN '{c}'" for p, c in R.HEADING_RULES) + " ELSE 'other' END"


@query(f"SELECT record_id, {_RULES_SQL} AS category FROM {SQL_CHUNKS}")
def heading_rules(spark, sf_dir):
    """Category by title alone."""
    return chunks(spark, sf_dir, "heading").select("record_id", C.title_category(F.col("heading")).alias("category"))


_LINES_SQL = f"""(SELECT document_id, CAST(i AS BIGINT) AS line_no, lines[i] AS line FROM (SELECT document_id, string_split(raw_text, chr(10)) AS lines FROM {SQL_FILINGS} WHERE raw_text IS NOT NULL)
 , unnest(generate_series(1, len(lines))) r(i))"""


def _lines(spark, sf_dir):
    lines = filings(spark, sf_dir, "raw_text").where("raw_text IS NOT NULL").select("document_id", F.posexplode(F.split("raw_text", "\n")).alias("i", "line"))
    return lines.select("document_id", (F.col("i") + 1).cast("bigint").alias("line_no"), "line")


@query(f"SELECT document_id, line_no, line FROM {_LINES_SQL} WHERE regexp_matches(line, '[\\s\\x{{00A0}}]+[0-9]+\\s*$')")
def is_toc_entry(spark, sf_dir):
    """Lines that end in a page number."""
    return _lines(spark, sf_dir).where(C.is_toc_entry(F.col("line")))


@query(f"""SELECT record_id, CAST(line_no AS BIGINT) AS line_no, line FROM (SELECT record_id, unnest(string_split(chunk_text, chr(10))) AS line, generate_subscripts(string_split(chunk_text, chr(10)), 1) AS line_no FROM {SQL_CHUNKS} WHERE table_count > 0)
 WHERE regexp_matches(line, '^[\\s\\x{{00A0}}$%().,\\-—–]*[0-9][0-9\\s$%().,\\-—–]*$')""")
def value_only_line(spark, sf_dir):
    """Lines of figures only, in texts with tables."""
    lines = chunks(spark, sf_dir, "chunk_text", "table_count").where("table_count > 0").select("record_id", F.posexplode(F.split("chunk_text", "\n")).alias("i", "line"))
    return lines.where(F.col("line").rlike(R.VALUE_LINE)).select("record_id", (F.col("i") + 1).cast("bigint").alias("line_no"), "line")


@query(f"SELECT document_id, line_no FROM {_LINES_SQL} WHERE regexp_matches(line, '(?i)^\\s*(?:item|exhibit)\\s+[0-9]')")
def is_heading_line(spark, sf_dir):
    """Lines that open with an item or exhibit."""
    return _lines(spark, sf_dir).where(C.is_heading_line(F.col("line"))).select("document_id", "line_no")


@query(f"""SELECT document_id, list_aggregate(list_filter(string_split(raw_text, chr(10)), lambda x: NOT regexp_matches(x, '^-{{20,}}\\s*$')), 'string_agg', chr(10)) AS body
 FROM {SQL_FILINGS} WHERE raw_text IS NOT NULL AND raw_text <> ''""")
def drop_page_sep(spark, sf_dir):
    """Openings without page rules."""
    return filings(spark, sf_dir, "raw_text").where("raw_text <> ''").select("document_id", C.without_page_rules(F.col("raw_text")).alias("body"))


_ORG_SQL = "lower(trim(regexp_replace(name, '[^\\p{L}\\p{N}_]+', ' ', 'g')))"


_NAMES_SQL = f"(SELECT DISTINCT trim(unnest(string_split(entity_names, ', '))) AS name FROM {SQL_CHUNKS} WHERE entity_names IS NOT NULL)"


def _names(spark, sf_dir):
    return chunks(spark, sf_dir, "entity_names").where("entity_names IS NOT NULL").select(F.explode(F.transform(F.split("entity_names", ", "), lambda x: F.trim(x))).alias("name")).distinct()


@query(f"""SELECT name FROM {_NAMES_SQL} WHERE {_ORG_SQL} <> '' AND {_ORG_SQL} NOT IN ({_in(R.ORG_STOPWORDS + R.ORG_STOP_PHRASES)})
 AND NOT regexp_matches(name, '(?i){R.ORG_BOILERPLATE}')""")
def keep_org(spark, sf_dir):
    """Names that may be organisations."""
    return _names(spark, sf_dir).where(C.keep_org(F.col("name")))


_CLEAN_SQL = "lower(trim(regexp_replace(regexp_replace(replace(regexp_replace(trim(name), '(?i)(?:''s|’s)\\s*$', ''), chr(160), ' '), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')))"
_COMPANY_SQL = f"regexp_replace(regexp_replace({_CLEAN_SQL}, '^(?:(?:the|an) )+(\\S)', '\\1'), '(\\S)(?: (?:{'|'.join(R.LEGAL_SUFFIXES)}))+$', '\\1')"


@query(f"SELECT name, {_CLEAN_SQL} AS clean, {_COMPANY_SQL} AS company FROM {_NAMES_SQL}")
def normalize_company(spark, sf_dir):
    """Names cleaned, and without articles and legal forms."""
    return _names(spark, sf_dir).select("name", C.clean_name(F.col("name")).alias("clean"), C.normalize_company(F.col("name")).alias("company"))


@query(f"""SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, round(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) / greatest(length(text), 1), 6) AS alpha_ratio,
 length(text) < {R.PAGE_MIN_CHARS} AS very_short FROM documents WHERE text IS NOT NULL""")
def pdf_quality(spark, sf_dir):
    """The measures of page quality, on document texts."""
    t = F.col("text")
    docs = read_table(spark, sf_dir, "documents").where("text IS NOT NULL")
    alpha = F.length(F.regexp_replace(t, r"[^\p{L}]", "")) / F.greatest(F.length(t), F.lit(1))
    return docs.select("doc_id", F.length(t).cast("bigint").alias("n_chars"), F.round(alpha, 6).alias("alpha_ratio"), (F.length(t) < R.PAGE_MIN_CHARS).alias("very_short"))


# ---- joins and set operations ---------------------------------------------------------------------------------------


@query(f"""SELECT {_ITEM_SQL} AS item_key, m.category, {N} AS n FROM {SQL_CHUNKS} c JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in R.ITEM_CATEGORIES.items())}) m(item_key, category)
 ON {_ITEM_SQL} = m.item_key GROUP BY 1, 2""")
def join_item_category(spark, sf_dir):
    """Items joined to their categories."""
    table = spark.createDataFrame(list(R.ITEM_CATEGORIES.items()), "item_key string, category string")
    items = chunks(spark, sf_dir, "heading").select(C.heading_item(F.col("heading")).alias("item_key"))
    return items.join(F.broadcast(table), "item_key").groupBy("item_key", "category").agg(F.count("*").alias("n"))  # the table has 22 rows


@query(f"SELECT c.record_id, f.source_path FROM {SQL_CHUNKS} c JOIN {SQL_FILINGS} f USING (document_id)")
def join_label_lookup(spark, sf_dir):
    """Records with their filing's path."""
    return chunks(spark, sf_dir, "document_id").join(filings(spark, sf_dir, "source_path"), "document_id").select("record_id", "source_path")


@query(f"SELECT v.faiss_id, c.record_id, c.heading, c.filing_year FROM index_vectors v JOIN {SQL_CHUNKS} c USING (record_id)")
def join_search_metadata(spark, sf_dir):
    """Index positions with their record's metadata."""
    return read_table(spark, sf_dir, "index_vectors").select("faiss_id", "record_id").join(chunks(spark, sf_dir, "heading", "filing_year"), "record_id").select("faiss_id", "record_id", "heading", "filing_year")


@query(f"SELECT c.record_id FROM {SQL_CHUNKS} c WHERE NOT EXISTS (SELECT 1 FROM index_vectors v WHERE v.record_id = c.record_id)")
def anti_cache_miss(spark, sf_dir):
    """Records that have no vector yet."""
    return chunks(spark, sf_dir).join(read_table(spark, sf_dir, "index_vectors").select("record_id"), "record_id", "left_anti")


@query(f"SELECT c.record_id, v.faiss_id FROM {SQL_CHUNKS} c JOIN index_vectors v USING (record_id)")
def join_cache_hit(spark, sf_dir):
    """Records whose vector is known."""
    return chunks(spark, sf_dir).join(read_table(spark, sf_dir, "index_vectors").select("record_id", "faiss_id"), "record_id")


@query(f"SELECT DISTINCT section_category FROM {SQL_CHUNKS} WHERE section_category IS NOT NULL AND section_category NOT IN ({_in(R.CATEGORIES)})")
def set_unknown_category(spark, sf_dir):
    """Categories outside the taxonomy."""
    return chunks(spark, sf_dir, "section_category").where(F.col("section_category").isNotNull() & ~F.col("section_category").isin(*R.CATEGORIES)).select("section_category").distinct()


@query(f"SELECT DISTINCT heading, section_category FROM {SQL_CHUNKS}")
def distinct_sections(spark, sf_dir):
    """Distinct headings and categories."""
    return chunks(spark, sf_dir, "heading", "section_category").select("heading", "section_category").distinct()


# ---- aggregates -----------------------------------------------------------------------------------------------------


@query(f"""SELECT count(DISTINCT document_id) AS documents, {N} AS chunks, round(count(*) / count(DISTINCT document_id), 1) AS chunks_per_document,
 CAST(count(*) FILTER (WHERE has_entities) AS BIGINT) AS with_entities, CAST(sum(table_count) AS BIGINT) AS tables, CAST(sum(warning_count) AS BIGINT) AS warnings,
 median(length(chunk_text)) AS median_chars FROM {SQL_CHUNKS}""")
def agg_summary(spark, sf_dir):
    """The data set in one row."""
    c = chunks(spark, sf_dir, "document_id", "has_entities", "table_count", "warning_count", "chunk_text")
    return c.agg(
        F.countDistinct("document_id").alias("documents"),
        F.count("*").alias("chunks"),
        F.round(F.count("*") / F.countDistinct("document_id"), 1).alias("chunks_per_document"),
        F.count_if("has_entities").alias("with_entities"),
        F.sum("table_count").alias("tables"),
        F.sum("warning_count").alias("warnings"),
        F.median(F.length("chunk_text")).alias("median_chars"),
    )


@query(f"""SELECT t.category, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (VALUES {", ".join(f"('{c}')" for c in R.CATEGORIES)}) t(category)
 LEFT JOIN (SELECT section_category AS category, count(*) AS n FROM {SQL_CHUNKS} GROUP BY 1) USING (category)""")
def agg_category_dist(spark, sf_dir):
    """Records per category of the taxonomy, empty ones too."""
    taxonomy = spark.createDataFrame([(c,) for c in R.CATEGORIES], "category string")
    counts = chunks(spark, sf_dir, "section_category").groupBy(F.col("section_category").alias("category")).agg(F.count("*").alias("n"))
    return taxonomy.join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"SELECT document_id, {N} AS n FROM {SQL_CHUNKS} GROUP BY 1")
def agg_chunks_per_doc(spark, sf_dir):
    """Records per document."""
    return chunks(spark, sf_dir, "document_id").groupBy("document_id").agg(F.count("*").alias("n"))


@query(f"""SELECT count(DISTINCT document_id) AS documents, count(DISTINCT document_id) FILTER (WHERE chunk_index = 0) AS with_first FROM {SQL_CHUNKS}""")
def agg_preamble_cov(spark, sf_dir):
    """Documents whose first section is there."""
    c = chunks(spark, sf_dir, "document_id", "chunk_index")
    return c.agg(F.countDistinct("document_id").alias("documents"), F.countDistinct(F.when(F.col("chunk_index") == 0, F.col("document_id"))).alias("with_first"))


@query(f"""SELECT CAST(count(*) FILTER (WHERE coalesce(chunk_text, '') = '') AS BIGINT) AS empty, CAST(count(*) FILTER (WHERE length(chunk_text) > 0 AND length(chunk_text) < 100) AS BIGINT) AS tiny FROM {SQL_CHUNKS}""")
def agg_empty_tiny(spark, sf_dir):
    """Empty and tiny texts."""
    c = chunks(spark, sf_dir, "chunk_text")
    n = F.length("chunk_text")
    return c.agg(F.count_if(F.coalesce("chunk_text", F.lit("")) == "").alias("empty"), F.count_if((n > 0) & (n < 100)).alias("tiny"))


def _stats_sql(value: str, source: str, group: str = "") -> str:
    pick = lambda q: f"s[CAST(floor(len(s) * {q}) AS INTEGER) + 1]"
    keys = f"{group}, " if group else ""
    return f"""SELECT {keys}CAST(len(s) AS BIGINT) AS n, s[1] AS least, s[len(s)] AS most, round(list_avg(s), 6) AS mean, {pick(.25)} AS p25, {pick(.5)} AS p50, {pick(.75)} AS p75, {pick(.95)} AS p95
 FROM (SELECT {keys}list_sort(list({value})) AS s FROM {source} WHERE {value} IS NOT NULL {f"GROUP BY {group}" if group else ""})"""


def _stats(df: DataFrame, value: str, *groups: str) -> DataFrame:
    """Exact statistics by position without gathering a group: counts per value, then running counts.

    The value at floor(n * q) is the least whose running count exceeds it; the
    shuffle carries one row per distinct value.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("c"))
    order = Window.partitionBy(*groups).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*groups)
    run = counts.withColumn("upto", F.sum("c").over(order)).withColumn("n", F.sum("c").over(whole))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor(F.col("n") * q), F.col(value)))
    out = run.groupBy(*groups).agg(
        F.max("n").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), F.round(F.sum(F.col(value) * F.col("c")) / F.max("n"), 6).alias("mean"),
        at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"), at(0.95).alias("p95"),
    )
    return out


@query(_stats_sql("n", f"(SELECT {_TEXT_LEN} AS n FROM {SQL_CHUNKS})"))
def agg_stats(spark, sf_dir):
    """Length statistics of all texts."""
    return _stats(chunks(spark, sf_dir, "chunk_text").select(F.length("chunk_text").cast("bigint").alias("n_chars")), "n_chars")


@query(_stats_sql("n", f"(SELECT section_category, {_TEXT_LEN} AS n FROM {SQL_CHUNKS})", "section_category"))
def agg_len_by_category(spark, sf_dir):
    """Length statistics per category."""
    return _stats(chunks(spark, sf_dir, "section_category", "chunk_text").select("section_category", F.length("chunk_text").cast("bigint").alias("n_chars")), "n_chars", "section_category")


_BOUNDS_SQL = f"""(SELECT s[CAST(floor(len(s) * 0.25) AS INTEGER) + 1] AS q1, s[CAST(floor(len(s) * 0.75) AS INTEGER) + 1] AS q3
 FROM (SELECT list_sort(list({_TEXT_LEN})) AS s FROM {SQL_CHUNKS} WHERE chunk_text IS NOT NULL))"""


@query(f"SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM {_BOUNDS_SQL}")
def agg_iqr_bounds(spark, sf_dir):
    """Outlier bounds of text lengths; null for no texts."""
    s = agg_stats(spark, sf_dir)
    q1, q3 = F.col("p25"), F.col("p75")
    return s.select(q1.alias("q1"), q3.alias("q3"), (q1 - 1.5 * (q3 - q1)).cast("double").alias("low"), (q3 + 1.5 * (q3 - q1)).cast("double").alias("high"))


@query(f"""SELECT record_id, {_TEXT_LEN} AS n_chars FROM {SQL_CHUNKS}, {_BOUNDS_SQL} WHERE length(chunk_text) > q3 + 1.5 * (q3 - q1) ORDER BY 2 DESC, 1 LIMIT 10""")
def topk_outliers(spark, sf_dir):
    """The ten longest texts beyond the bound."""
    c = chunks(spark, sf_dir, "chunk_text").select("record_id", F.length("chunk_text").cast("bigint").alias("n_chars"))
    bound = F.broadcast(agg_iqr_bounds(spark, sf_dir).select("high"))  # one row
    return c.join(bound, F.col("n_chars") > F.col("high")).select("record_id", "n_chars").orderBy(F.desc("n_chars"), "record_id").limit(10)


@query(f"SELECT record_id, {_TEXT_LEN} AS n_chars FROM {SQL_CHUNKS} WHERE chunk_text IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 10")
def topk_longest(spark, sf_dir):
    """The ten longest texts."""
    c = chunks(spark, sf_dir, "chunk_text").where("chunk_text IS NOT NULL").select("record_id", F.length("chunk_text").cast("bigint").alias("n_chars"))
    return c.orderBy(F.desc("n_chars"), "record_id").limit(10)


@query(f"SELECT document_id, {N} AS n FROM {SQL_CHUNKS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def rank_docs(spark, sf_dir):
    """The twenty documents with most records."""
    return agg_chunks_per_doc(spark, sf_dir).orderBy(F.desc("n"), "document_id").limit(20)


@query(f"""SELECT CAST(floor(least(length(chunk_text), 9999) / 250) AS BIGINT) AS bin, {N} AS n FROM {SQL_CHUNKS} WHERE chunk_text IS NOT NULL GROUP BY 1""")
def agg_histograms(spark, sf_dir):
    """Forty bins of text length."""
    c = chunks(spark, sf_dir, "chunk_text").where("chunk_text IS NOT NULL")
    return c.groupBy(F.floor(F.least(F.length("chunk_text"), F.lit(9999)) / 250).alias("bin")).agg(F.count("*").alias("n"))


@query(f"""SELECT section_category, CAST(sum(table_count) AS BIGINT) AS tables, CAST(count(*) FILTER (WHERE table_count > 0) AS BIGINT) AS chunks_with_table, round(100.0 * count(*) FILTER (WHERE table_count > 0) / count(*), 1) AS pct
 FROM {SQL_CHUNKS} GROUP BY 1""")
def agg_table_by_category(spark, sf_dir):
    """Tables per category."""
    c = chunks(spark, sf_dir, "section_category", "table_count")
    has = F.count_if(F.col("table_count") > 0)
    return c.groupBy("section_category").agg(F.sum("table_count").alias("tables"), has.alias("chunks_with_table"), F.round(100.0 * has / F.count("*"), 1).alias("pct"))


@query(f"SELECT CAST(count(DISTINCT document_id) FILTER (WHERE table_count > 0) AS BIGINT) AS with_tables, CAST(count(DISTINCT document_id) AS BIGINT) AS documents FROM {SQL_CHUNKS}")
def agg_docs_with_tables(spark, sf_dir):
    """Documents with a table."""
    c = chunks(spark, sf_dir, "document_id", "table_count")
    return c.agg(F.countDistinct(F.when(F.col("table_count") > 0, F.col("document_id"))).alias("with_tables"), F.countDistinct("document_id").alias("documents"))


@query(f"SELECT CAST(count(DISTINCT document_id) AS BIGINT) AS documents, CAST(count(DISTINCT cik) AS BIGINT) AS companies FROM {SQL_CHUNKS}")
def agg_nunique(spark, sf_dir):
    """Distinct documents and companies."""
    return chunks(spark, sf_dir, "document_id", "cik").agg(F.countDistinct("document_id").alias("documents"), F.countDistinct("cik").alias("companies"))


@query(f"""SELECT CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS repeated_ids, CAST(sum(no_text) AS BIGINT) AS null_texts, CAST(sum(no_retrieval) AS BIGINT) AS null_retrieval FROM (SELECT record_id, count(*) AS n,
 max(CASE WHEN chunk_text IS NULL THEN 1 ELSE 0 END) AS no_text, max(CASE WHEN retrieval_text IS NULL THEN 1 ELSE 0 END) AS no_retrieval FROM chunks WHERE record_id IS NOT NULL GROUP BY 1)""")
def data_constraints(spark, sf_dir):
    """How far the constraints on records hold."""
    flag = lambda c: F.max(F.col(c).isNull().cast("int"))
    ids = read_table(spark, sf_dir, "chunks").where("record_id IS NOT NULL").groupBy("record_id").agg(F.count("*").alias("n"), flag("chunk_text").alias("no_text"), flag("retrieval_text").alias("no_retrieval"))
    return ids.agg(F.count_if(F.col("n") > 1).alias("repeated_ids"), F.sum("no_text").alias("null_texts"), F.sum("no_retrieval").alias("null_retrieval"))


_CALLS = "(SELECT DISTINCT * FROM toc_llm_metrics)"


@query(f"""SELECT model, {N} AS calls, CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) AS ok, CAST(count(*) FILTER (WHERE status IN ('error', 'timeout')) AS BIGINT) AS failed,
 CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, round(avg(latency_ms), 3) AS mean_latency FROM {_CALLS} GROUP BY 1""")
def agg_llm_cost(spark, sf_dir):
    """Calls, failures, tokens and latency per model, repeated rows counted once."""
    m = read_table(spark, sf_dir, "toc_llm_metrics").distinct()
    return m.groupBy("model").agg(
        F.count("*").alias("calls"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status").isin("error", "timeout")).alias("failed"),
        F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.round(F.avg("latency_ms"), 3).alias("mean_latency"),
    )


@query(_stats_sql("ms", f"(SELECT status, CAST(round(latency_ms) AS BIGINT) AS ms FROM {_CALLS})", "status"))
def llm_latency_stats(spark, sf_dir):
    """Latency statistics per status."""
    m = read_table(spark, sf_dir, "toc_llm_metrics").distinct().select("status", F.round("latency_ms").cast("bigint").alias("ms"))
    return _stats(m, "ms", "status")


# ---- windows, samples -----------------------------------------------------------------------------------------------


@query(f"""SELECT record_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY chunk_index, record_id) - 1 AS BIGINT) AS position FROM {SQL_CHUNKS}""")
def win_chunk_index(spark, sf_dir):
    """Position of each record in its document."""
    w = Window.partitionBy("document_id").orderBy("chunk_index", "record_id")
    return chunks(spark, sf_dir, "document_id", "chunk_index").select("record_id", (F.row_number().over(w) - 1).cast("bigint").alias("position"))


_TOC_SQL = f"(SELECT document_id, line_no, upper(regexp_extract(line, '(?i)\\bitem[\\s\\x{{00A0}}]+([0-9]+[A-Za-z]?)\\b', 1)) AS item_key FROM {_LINES_SQL} WHERE regexp_matches(line, '(?i)\\bitem[\\s\\x{{00A0}}]+[0-9]+[A-Za-z]?\\b'))"


def _toc_lines(spark, sf_dir):
    item = F.upper(F.regexp_extract("line", r"(?i)\bitem[\s ]+(\d+[A-Za-z]?)\b", 1))
    return _lines(spark, sf_dir).select("document_id", "line_no", item.alias("item_key")).where("item_key <> ''")


@query(f"SELECT document_id, item_key, min(line_no) AS line_no FROM {_TOC_SQL} GROUP BY 1, 2")
def win_first_seen(spark, sf_dir):
    """First line of each item."""
    return _toc_lines(spark, sf_dir).groupBy("document_id", "item_key").agg(F.min("line_no").alias("line_no"))


@query(f"""SELECT document_id, item_key, line_no, CAST(line_no - lag(line_no) OVER (PARTITION BY document_id ORDER BY line_no) AS BIGINT) AS gap FROM (SELECT document_id, item_key, min(line_no) AS line_no FROM {_TOC_SQL} GROUP BY 1, 2)""")
def win_toc_gaps(spark, sf_dir):
    """Gaps between items first seen."""
    w = Window.partitionBy("document_id").orderBy("line_no")
    return win_first_seen(spark, sf_dir).withColumn("gap", F.col("line_no") - F.lag("line_no").over(w))


@query(f"SELECT document_id, CAST(count(DISTINCT item_key) AS BIGINT) AS n FROM {_TOC_SQL} GROUP BY 1 HAVING count(DISTINCT item_key) >= {R.TOC_MIN_ITEMS}")
def toc_min_items(spark, sf_dir):
    """Documents whose contents list is long enough."""
    return _toc_lines(spark, sf_dir).groupBy("document_id").agg(F.countDistinct("item_key").alias("n")).where(F.col("n") >= R.TOC_MIN_ITEMS)


@query(f"""SELECT document_id, line_no, CAST(line_no AS BIGINT) AS starts, CAST(coalesce(lead(line_no) OVER (PARTITION BY document_id ORDER BY line_no), 1000000) AS BIGINT) AS ends FROM {_TOC_SQL}""")
def win_section_bounds(spark, sf_dir):
    """Each item's lines, up to the next item."""
    w = Window.partitionBy("document_id").orderBy("line_no")
    return _toc_lines(spark, sf_dir).select("document_id", "line_no", F.col("line_no").alias("starts"), F.coalesce(F.lead("line_no").over(w), F.lit(1_000_000)).cast("bigint").alias("ends"))


@query(f"""SELECT document_id, CAST(count(*) AS BIGINT) AS n, min(line_no) AS first_line, max(line_no) AS last_line FROM (SELECT *, sum(CASE WHEN gap >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY line_no) AS cluster
 FROM (SELECT *, line_no - lag(line_no) OVER (PARTITION BY document_id ORDER BY line_no) AS gap FROM {_TOC_SQL})) GROUP BY document_id, cluster""")
def win_toc_cluster(spark, sf_dir):
    """Runs of item lines with less than three lines between them."""
    w = Window.partitionBy("document_id").orderBy("line_no")
    gaps = _toc_lines(spark, sf_dir).withColumn("gap", F.col("line_no") - F.lag("line_no").over(w))
    runs = gaps.withColumn("cluster", F.sum(F.when(F.col("gap") >= 3, 1).otherwise(0)).over(w))
    return runs.groupBy("document_id", "cluster").agg(F.count("*").alias("n"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line")).drop("cluster")


_PIPES = f"(SELECT record_id, CAST(line_no AS BIGINT) AS line_no FROM (SELECT record_id, unnest(string_split(chunk_text, chr(10))) AS line, generate_subscripts(string_split(chunk_text, chr(10)), 1) AS line_no FROM {SQL_CHUNKS} WHERE chunk_text LIKE '%|%') WHERE regexp_matches(line, '\\|[^|\\n]+\\|'))"


@query(f"""SELECT record_id, CAST(count(*) AS BIGINT) AS n_lines, min(line_no) AS first_line FROM (SELECT *, line_no - row_number() OVER (PARTITION BY record_id ORDER BY line_no) AS island FROM {_PIPES}) GROUP BY record_id, island HAVING count(*) >= 2""")
def win_pipe_islands(spark, sf_dir):
    """Runs of two and more pipe lines."""
    lines = chunks(spark, sf_dir, "chunk_text").where(F.col("chunk_text").contains("|")).select("record_id", F.posexplode(F.split("chunk_text", "\n")).alias("i", "line"))
    piped = lines.where(F.col("line").rlike(R.PIPE_ROW)).select("record_id", (F.col("i") + 1).cast("bigint").alias("line_no"))
    island = F.col("line_no") - F.row_number().over(Window.partitionBy("record_id").orderBy("line_no"))
    return piped.withColumn("island", island).groupBy("record_id", "island").agg(F.count("*").alias("n_lines"), F.min("line_no").alias("first_line")).where("n_lines >= 2").drop("island")


_SEED = "md5('42' || record_id)"


@query(f"""SELECT record_id, section_category FROM (SELECT record_id, section_category, row_number() OVER (PARTITION BY section_category ORDER BY {_SEED}, record_id) AS n FROM {SQL_CHUNKS} WHERE section_category IS NOT NULL) WHERE n <= 2""")
def sample_stratified(spark, sf_dir):
    """Two records of each category by a seeded hash; the top-up draws from the rest in the same order."""
    w = Window.partitionBy("section_category").orderBy(F.md5(F.concat(F.lit("42"), "record_id").cast("binary")), "record_id")
    c = chunks(spark, sf_dir, "section_category").where("section_category IS NOT NULL")
    return c.withColumn("n", F.row_number().over(w)).where("n <= 2").select("record_id", "section_category")


@query(f"""SELECT record_id FROM {SQL_CHUNKS} WHERE record_id NOT IN (SELECT record_id FROM (SELECT record_id, row_number() OVER (PARTITION BY section_category ORDER BY {_SEED}, record_id) AS n FROM {SQL_CHUNKS} WHERE section_category IS NOT NULL) WHERE n <= 2)""")
def except_sample(spark, sf_dir):
    """Records outside the sample."""
    return chunks(spark, sf_dir).join(sample_stratified(spark, sf_dir).select("record_id"), "record_id", "left_anti")


@query(f"SELECT record_id, heading FROM {SQL_CHUNKS} WHERE section_category = 'risk_factors' ORDER BY {_SEED}, record_id LIMIT 5")
def sample_show(spark, sf_dir):
    """Five records of a category by a seeded hash."""
    c = chunks(spark, sf_dir, "heading", "section_category").where("section_category = 'risk_factors'")
    return c.orderBy(F.md5(F.concat(F.lit("42"), "record_id").cast("binary")), "record_id").limit(5).select("record_id", "heading")


@query(f"SELECT record_id, warning_count FROM {SQL_CHUNKS} WHERE warning_count > 0")
def show_filters(spark, sf_dir):
    """Records with warnings."""
    return chunks(spark, sf_dir, "warning_count").where("warning_count > 0").select("record_id", "warning_count")


@query(f"SELECT document_id, source_path FROM {SQL_FILINGS} ORDER BY source_path, document_id LIMIT 25")
def limit_docs(spark, sf_dir):
    """The first 25 documents by path."""
    return filings(spark, sf_dir, "source_path").orderBy("source_path", "document_id").limit(25)


# ---- vectors --------------------------------------------------------------------------------------------------------

_NORM = "sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"


@query(f"SELECT vec_id, round({_NORM}, 6) AS norm, round(CAST(embedding[1] AS DOUBLE) / {_NORM}, 6) AS first FROM embeddings")
def l2_normalize(spark, sf_dir):
    """Vectors at length one: the length before and the first number after."""
    e = read_table(spark, sf_dir, "embeddings")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return e.select("vec_id", F.round(norm, 6).alias("norm"), F.round(F.get("embedding", F.lit(0)).cast("double") / norm, 6).alias("first"))


def _knn(spark, sf_dir, wanted, k):
    """The k nearest of each wanted vector by exact inner product, ties by the smaller id; null and empty vectors take no part.

    One scan: each task reads its own rows, then the query table from the shared
    folder block by block, and passes on its k best of each query. The last
    ranking thus sees k rows a query and task.
    """
    e = read_table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).select("vec_id", "embedding")
    e.where(wanted).write.parquet(asked := scratch(spark, "asked"))

    def nearest(frames):
        parts = [(pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"].to_numpy()).astype(np.float64)) for pdf in frames if len(pdf)]
        if parts:
            ids, x = np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts])
            system, root = fs.FileSystem.from_uri(asked)
            for batch in dataset.dataset(root, filesystem=system, format="parquet").to_batches(batch_size=QUERY_BLOCK):
                if batch.num_rows:
                    asking = batch.column("vec_id").to_numpy()
                    yield best_products(asking, np.stack(batch.column("embedding").to_numpy(zero_copy_only=False)).astype(np.float64), ids, x, k)

    found = e.mapInPandas(nearest, "query_id bigint, neighbour_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "neighbour_id"))
    return found.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k)


#: Queries and rows of a block whose products are held at a time.
QUERY_BLOCK, ROW_BLOCK = 1_024, 8_192


def best_products(asking: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """query_id, neighbour_id, score: the k rows of highest inner product of each query, block of rows by block."""
    out = []
    for at in range(0, len(ids), ROW_BLOCK):
        s = np.round(q @ x[at : at + ROW_BLOCK].T, 6)
        least = -np.partition(-s, min(k, s.shape[1]) - 1, axis=1)[:, min(k, s.shape[1]) - 1]
        # All that tie with the last of the k stay, so the ids decide.
        row, column = np.nonzero(s >= least[:, None])
        out.append(pd.DataFrame({"query_id": asking[row], "neighbour_id": ids[at : at + ROW_BLOCK][column], "score": s[row, column]}))
    every = pd.concat(out).sort_values(["query_id", "score", "neighbour_id"], ascending=[True, False, True])
    return every.groupby("query_id").head(k)


_KNN_SQL = """SELECT query_id, neighbour_id, score, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbour_id) AS rank FROM
 (SELECT q.vec_id AS query_id, e.vec_id AS neighbour_id, round(list_sum(list_transform(list_zip(q.embedding, e.embedding), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE))), 6) AS score
 FROM embeddings q, embeddings e WHERE {w})) WHERE rank <= 5"""


@query(_KNN_SQL.format(w="q.vec_id % 100 = 0"))
def knn_topk(spark, sf_dir):
    """The five nearest of every hundredth vector by exact inner product."""
    return _knn(spark, sf_dir, "vec_id % 100 = 0", 5)


@query(f"""SELECT string_agg(block, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY i) AS context FROM (SELECT i, '[' || i || '] ' || coalesce(company_name, 'Unknown') || ' (' || coalesce(filing_year, '?') || ') — ' || coalesce(heading, '') || chr(10) || substr(chunk_text, 1, 2000) AS block
 FROM (SELECT *, row_number() OVER (ORDER BY record_id) AS i FROM {SQL_CHUNKS} WHERE section_category = 'legal_proceedings' ORDER BY record_id LIMIT 5))""")
def rag_context(spark, sf_dir):
    """The prompt's context of five hits, in order."""
    hits = chunks(spark, sf_dir, "company_name", "filing_year", "heading", "chunk_text", "section_category").where("section_category = 'legal_proceedings'").orderBy("record_id").limit(5)
    return context(hits, "record_id")


def context(hits: DataFrame, order: str) -> DataFrame:
    """Numbered blocks of the hits, joined; the hits are a top-k, so one task holds them."""
    body = F.concat(
        F.coalesce("company_name", F.lit("Unknown")), F.lit(" ("), F.coalesce("filing_year", F.lit("?")), F.lit(") — "), F.coalesce("heading", F.lit("")), F.lit("\n"), F.substring("chunk_text", 1, 2000)
    )
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), body.alias("body"))))
    blocks = F.transform(ordered, lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), x["body"]))
    return hits.agg(F.array_join(blocks, "\n\n---\n\n").alias("context"))
