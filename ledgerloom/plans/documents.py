"""Queries on filings' texts: contents lists, sections, mentions, tables, resolved names, standardised records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions import fuzzy
from ledgerloom.functions import rules as R
from ledgerloom.operators import enrich, nested, resolve, sections, table_enrich, text_tables
from ledgerloom.plans.base import SQL_CHUNKS, chunks, filing_texts, filings
from ledgerloom.plans.relational import labelled_text
from ledgerloom.session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_B = "[\\s\\x{00A0}\\x{2002}\\x{2007}\\x{2009}\\x{202F}\\x{3000}]"
_NUM = "\\p{Nd}[\\p{Nd},]*(?:\\.\\p{Nd}+)?"
_MAG = f"(?:{_B}*(?:thousand|million|billion|trillion)s?)"
_MONEY_SQL = f"(?i)((?:\\$|€|£|¥|CHF|USD|EUR|GBP|JPY){_B}*{_NUM}{_MAG}?|{_NUM}{_MAG}{_B}+(?:dollars?|euros?|pounds?))"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def extract_toc(spark, sf_dir):
    """Contents list of every filing: items, end and how it was found."""
    return sections.extract_toc(filing_texts(spark, sf_dir))


@query()
def parse_sections(spark, sf_dir):
    """Sections of every filing."""
    return sections.parse_sections(filing_texts(spark, sf_dir))


@query()
def sections_fallback(spark, sf_dir):
    """Sections of the filings' openings alone, most of which have no body headings."""
    return sections.parse_sections(filings(spark, sf_dir, "raw_text"))


@query()
def coverage_gate(spark, sf_dir):
    """Sections and covered characters per filing and method."""
    s = parse_sections(spark, sf_dir)
    return s.groupBy("document_id", "parse_method").agg(F.count("*").alias("n_sections"), F.sum(F.length("section_text")).alias("n_chars"))


def money(spark, sf_dir):
    c = chunks(spark, sf_dir, "chunk_text").where("chunk_text IS NOT NULL")
    return c.select("record_id", F.inline(C.money_mentions(F.col("chunk_text"))))


@query(f"""SELECT record_id, m AS match, CAST(count(*) AS BIGINT) AS n FROM (SELECT record_id, unnest(regexp_extract_all(chunk_text, '{_MONEY_SQL}', 1)) AS m FROM {SQL_CHUNKS}) GROUP BY 1, 2""")
def money_extract(spark, sf_dir):
    """Money as written, how often in each record."""
    return money(spark, sf_dir).groupBy("record_id", "match").agg(F.count("*").alias("n"))


def mentions(spark, sf_dir):
    """(document_id, record_id, entity_type, name, position, start_char) of the stored company and person mentions."""
    c = chunks(spark, sf_dir, "document_id", "chunk_index", "entities_json")
    parsed = nested.with_parsed(c, "entities_json", keep=["chunk_index"])
    one = F.transform(
        "entities_json",
        lambda m, i: F.struct(
            F.try_variant_get(m, "$.entity_type", "string").alias("entity_type"),
            F.try_variant_get(m, "$.text", "string").alias("name"),
            i.alias("i"),
            F.try_variant_get(m, "$.start_char", "int").alias("start_char"),
        ),
    )
    rows = parsed.select("document_id", "record_id", "chunk_index", F.inline(one))
    return rows.select("document_id", "record_id", "entity_type", "name", (F.col("chunk_index") * 100_000 + F.col("i")).alias("position"), "start_char")


_MENTIONS_SQL = f"""(SELECT record_id, document_id, json_extract_string(m, '$.entity_type') AS entity_type, json_extract_string(m, '$.text') AS name FROM (SELECT record_id, document_id,
 unnest(CASE json_type(j) WHEN 'ARRAY' THEN CAST(j AS JSON[]) WHEN 'OBJECT' THEN coalesce(CASE json_type(j, '$.entities') WHEN 'ARRAY' THEN CAST(json_extract(j, '$.entities') AS JSON[]) END, [j]) ELSE [] END) AS m
 FROM (SELECT record_id, document_id, CASE WHEN json_valid(entities_json) THEN CASE WHEN json_type(entities_json) = 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(entities_json, '$')) THEN CAST(json_extract_string(entities_json, '$') AS JSON) END
 ELSE CAST(entities_json AS JSON) END END AS j FROM {SQL_CHUNKS})))"""


@query(f"SELECT document_id, entity_type, name, CAST(count(*) AS BIGINT) AS n FROM {_MENTIONS_SQL} WHERE entity_type IN ('company', 'person') GROUP BY 1, 2, 3")
def agg_mention_counts(spark, sf_dir):
    """Mentions of each name in each document."""
    m = mentions(spark, sf_dir).where(F.col("entity_type").isin("company", "person"))
    return m.groupBy("document_id", "entity_type", "name").agg(F.count("*").alias("n"))


@query(f"SELECT entity_type, CAST(count(*) AS BIGINT) AS n FROM {_MENTIONS_SQL} WHERE entity_type IS NOT NULL GROUP BY 1")
def agg_entity_types(spark, sf_dir):
    """Mentions per type."""
    return mentions(spark, sf_dir).where("entity_type IS NOT NULL").groupBy("entity_type").agg(F.count("*").alias("n"))


@query(f"SELECT round(count(*) FILTER (WHERE entity_type = 'monetary_value') / count(*), 6) AS share FROM {_MENTIONS_SQL} WHERE entity_type IS NOT NULL")
def agg_monetary_share(spark, sf_dir):
    """Share of money among the mentions."""
    m = mentions(spark, sf_dir).where("entity_type IS NOT NULL")
    return m.agg(F.round(F.count_if(F.col("entity_type") == "monetary_value") / F.count("*"), 6).alias("share"))


@query(f"""SELECT entity_type, name, n FROM (SELECT *, row_number() OVER (PARTITION BY entity_type ORDER BY n DESC, name) AS k FROM (SELECT entity_type, name, CAST(count(*) AS BIGINT) AS n FROM {_MENTIONS_SQL} WHERE entity_type IS NOT NULL AND name IS NOT NULL GROUP BY 1, 2)) WHERE k <= 10""")
def topk_per_type(spark, sf_dir):
    """The ten names most mentioned of each type."""
    counts = mentions(spark, sf_dir).dropna(subset=["entity_type", "name"]).groupBy("entity_type", "name").agg(F.count("*").alias("n"))
    k = F.row_number().over(Window.partitionBy("entity_type").orderBy(F.desc("n"), "name"))
    return counts.withColumn("k", k).where("k <= 10").drop("k")


@query(f"""SELECT entity_type, name, CAST(count(*) AS BIGINT) AS n FROM {_MENTIONS_SQL} WHERE entity_type IS NOT NULL AND name IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""")
def topk_entities(spark, sf_dir):
    """The twenty names most mentioned."""
    counts = mentions(spark, sf_dir).dropna(subset=["entity_type", "name"]).groupBy("entity_type", "name").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "entity_type", "name").limit(20)


@query()
def keep_person(spark, sf_dir):
    """Person mentions that pass the filters on words, line and title."""
    m = mentions(spark, sf_dir).where("entity_type = 'person' AND start_char >= 0")
    texts = chunks(spark, sf_dir, "chunk_text")
    kept = m.join(texts, "record_id").where(C.keep_person(F.col("name"), F.col("chunk_text"), F.col("start_char")))
    return kept.select("record_id", "name", "start_char")


def _resolved(spark, sf_dir):
    return resolve.resolve(mentions(spark, sf_dir))


@query()
def resolve_entities(spark, sf_dir):
    """Groups of name variants per document and type."""
    return _resolved(spark, sf_dir)[0]


@query()
def variant_evidence(spark, sf_dir):
    """How each variant is tied to its canonical name."""
    return _resolved(spark, sf_dir)[1]


@query()
def join_attach_resolved(spark, sf_dir):
    """Resolved names of every record."""
    m = cut(mentions(spark, sf_dir), "mentions")
    return resolve.attach(m, resolve.resolve(m)[1])


@query()
def agg_method_breakdown(spark, sf_dir):
    """Variants per method and their share."""
    e = variant_evidence(spark, sf_dir).groupBy("resolution_method").agg(F.count("*").alias("n"))
    return e.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query()
def topk_suspicious_merges(spark, sf_dir):
    """The twenty pairs of variants of one stored group that are least alike."""

    @F.pandas_udf("double")
    def score(a, b):
        return a.str.lower().combine(b.str.lower(), fuzzy.token_sort)

    e = nested.evidence(nested.with_parsed(chunks(spark, sf_dir, "document_id", "resolved_entities_json"), "resolved_entities_json")).select("record_id", "entity_no", "variant").distinct()
    a, b = e.withColumnRenamed("variant", "variant_a"), e.withColumnRenamed("variant", "variant_b")
    pairs = a.join(b, ["record_id", "entity_no"]).where("variant_a < variant_b").select("variant_a", "variant_b").distinct()
    return pairs.withColumn("score", F.round(score("variant_a", "variant_b"), 4)).where("score < 70").orderBy("score", "variant_a", "variant_b").limit(20)


@query()
def detect_tables(spark, sf_dir):
    """Tables found in the records' texts, columns and rows as JSON texts."""
    t = text_tables.detect_tables(chunks(spark, sf_dir, "chunk_text"))
    return t.withColumn("columns", F.to_json("columns")).withColumn("rows", F.to_json("rows")).drop("raw_text")


@query()
def agg_table_quality(spark, sf_dir):
    """Rows, columns and named columns of the tables found."""
    t = text_tables.detect_tables(chunks(spark, sf_dir, "chunk_text"))
    named = F.exists("columns", lambda c: (c != "Item") & ~c.startswith("Col"))
    return t.groupBy("table_type").agg(F.count("*").alias("n"), F.round(F.avg("n_rows"), 4).alias("mean_rows"), F.round(F.avg("n_columns"), 4).alias("mean_columns"), F.count_if(named).alias("named"))


_TABLES_SQL = f"""(SELECT record_id, CAST(i - 1 AS BIGINT) AS table_no, tt[i] AS t FROM (SELECT record_id, CASE json_type(j) WHEN 'ARRAY' THEN CAST(j AS JSON[])
 WHEN 'OBJECT' THEN CASE json_type(j, '$.tables') WHEN 'ARRAY' THEN CAST(json_extract(j, '$.tables') AS JSON[]) WHEN 'OBJECT' THEN [json_extract(j, '$.tables')] ELSE [j] END ELSE [] END AS tt
 FROM (SELECT record_id, CASE WHEN json_valid(tables_json) THEN CASE WHEN json_type(tables_json) = 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(tables_json, '$')) THEN CAST(json_extract_string(tables_json, '$') AS JSON) END
 ELSE CAST(tables_json AS JSON) END END AS j FROM {SQL_CHUNKS})), unnest(generate_series(1, len(tt))) r(i))"""


@query(f"SELECT record_id, table_no, json_extract_string(t, '$.table_type') AS table_type, json_extract_string(t, '$.units') AS units FROM {_TABLES_SQL}")
def stored_tables(spark, sf_dir):
    """Type and units of the stored tables."""
    p = nested.with_parsed(chunks(spark, sf_dir, "document_id", "tables_json"), "tables_json")
    return nested.tables(p).select("record_id", "table_no", "table_type", "units")


@query(f"SELECT json_extract_string(t, '$.table_type') AS table_type, json_extract_string(t, '$.summary_source') AS source, CAST(count(*) AS BIGINT) AS n FROM {_TABLES_SQL} GROUP BY 1, 2")
def agg_table_overview(spark, sf_dir):
    """Stored tables by type and origin of the summary."""
    p = nested.with_parsed(chunks(spark, sf_dir, "document_id", "tables_json"), "tables_json")
    t = p.select(F.explode("tables_json").alias("t"))
    return t.select(F.try_variant_get("t", "$.table_type", "string").alias("table_type"), F.try_variant_get("t", "$.summary_source", "string").alias("source")).groupBy("table_type", "source").agg(F.count("*").alias("n"))


def identified(found: DataFrame, documents: DataFrame) -> DataFrame:
    """The sections with source_path, record_id and repeat_no.

    The record_id is that of path and heading; where a heading repeats, the
    second section's ends in -2, the third's in -3: no section is left out.
    """
    s = found.join(documents.select("document_id", "source_path"), "document_id")
    s = s.withColumn("record_id", C.short_md5("source_path", "heading"))
    s = s.withColumn("repeat_no", F.row_number().over(Window.partitionBy("record_id").orderBy("document_id", "section_no")))
    return s.withColumn("record_id", F.when(F.col("repeat_no") > 1, F.concat_ws("-", "record_id", "repeat_no")).otherwise(F.col("record_id")))


@query()
def data_constraints_sections(spark, sf_dir):
    """How far the pipeline's sections have headings of their own: repeated record_ids of path and heading, and the sections that needed a suffix."""
    texts = filing_texts(spark, sf_dir)
    s = identified(sections.parse_sections(texts), texts)
    return s.agg(F.count_if(F.col("repeat_no") == 2).alias("repeated_ids"), F.count_if(F.col("repeat_no") > 1).alias("suffixed"), F.count("*").alias("sections"))


def standardize(s: DataFrame, entities: DataFrame, tables: DataFrame, resolved: DataFrame) -> DataFrame:
    """The 25 columns of the standardised record, one row per identified section; lists as JSON with keys in order.

    Children are aggregated by record before they are joined, so a record's
    lists are as long as its own content. Lists without entries are '[]'.
    """
    name = C.file_name(F.col("source_path"))
    order = Window.partitionBy("document_id").orderBy("section_no")
    one = lambda c, *cols: F.sort_array(F.collect_list(F.struct(*cols))).alias(c)
    m = entities.groupBy("record_id").agg(one("entities", F.col("start").alias("start_char"), F.col("end").alias("end_char"), "entity_type", F.col("name").alias("text"), "currency", "amount"))
    # Ordered by number alone: rows are maps, which have no order.
    table = F.struct("table_no", "table_type", "units", "columns", "rows", "summary", "summary_used_llm", "summary_source", "summary_cache_status")
    in_order = F.array_sort(F.collect_list(table), lambda a, b: (a["table_no"] - b["table_no"]).cast("int"))
    t = tables.groupBy("record_id").agg(in_order.alias("tables"))
    r = resolved.groupBy("record_id").agg(one("resolved", "canonical_name", "entity_type", "matched_text", "resolution_method", "resolution_score"))
    j = s.join(m, "record_id", "left").join(t, "record_id", "left").join(r, "record_id", "left")
    json = lambda c: F.coalesce(F.to_json(c), F.lit("[]"))
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    joined = lambda c, f, sep: F.coalesce(F.array_join(F.filter(F.transform(c, lambda x: x[f]), lambda x: x != ""), sep), F.lit(""))
    out = j.select(
        "document_id", "record_id", (F.row_number().over(order) - 1).alias("chunk_index"), name.alias("source_filename"), C.company_of(name).alias("company_name"),
        C.cik_of(name).alias("cik"), C.year_of(name).alias("filing_year"), "heading", "section_category", F.lit("[]").alias("page_numbers_json"),
        F.col("section_text").alias("chunk_text"), json("entities").alias("entities_json"), json("resolved").alias("resolved_entities_json"), json("tables").alias("tables_json"),
        joined("tables", "summary", "\n").alias("table_summaries"), joined("entities", "text", ", ").alias("entity_names"), joined("resolved", "canonical_name", ", ").alias("resolved_entity_names"),
        (size("entities") > 0).alias("has_entities"), (size("resolved") > 0).alias("has_resolved_entities"), (size("tables") > 0).alias("has_tables"), size("tables").alias("table_count"),
        F.lit("[]").alias("processing_warnings_json"), F.lit(0).alias("warning_count"), F.length("section_text").alias("text_char_count"),
    )
    return out.withColumn("retrieval_text", labelled_text(F.col("chunk_text")))


def pipeline(documents: DataFrame, extract: Callable[[DataFrame], DataFrame] | None = None, summarize: Callable[[str], str | None] | None = None, cache: DataFrame | None = None, paths: DataFrame | None = None) -> DataFrame:
    """Documents (document_id, source_path, raw_text) to standardised records, end to end.

    `extract` takes records (document_id, record_id, section_no, chunk_text) to
    mentions as `names` does, which is the default. `summarize` is the provider
    of table summaries, `cache` what it has replied before; without one the
    summaries are deterministic. `paths` (document_id, source_path) saves a
    second reading of the texts for their paths alone.
    """
    found = cut(identified(cut(sections.parse_sections(documents), "sections"), documents if paths is None else paths), "identified")
    keyed = found.select("document_id", "record_id", "section_no", F.col("section_text").alias("chunk_text"))
    money = keyed.select("record_id", F.inline(C.money_mentions(F.col("chunk_text"))))
    headed = text_tables.detect_tables(keyed).join(found.select("record_id", "heading"), "record_id")
    known = cache if cache is not None else documents.sparkSession.createDataFrame([], enrich.CACHE)
    tables, _, _ = table_enrich.apply_summaries(headed, known, summarize)
    named = cut((extract or names)(keyed), "named")
    resolved = resolve.attach(named, resolve.resolve(named)[1])
    amounts = money.select("record_id", "start", "end", F.lit("monetary_value").alias("entity_type"), F.col("match").alias("name"), "currency", "amount")
    entities = amounts.unionByName(named.select("record_id", "start", "end", "entity_type", "name"), allowMissingColumns=True)
    return standardize(found, entities, tables, resolved)


#: The offline default for company mentions: capitalised words that end in a legal form.
COMPANY = r"(?:[A-Z][\w&.'-]*,? (?:(?:and|of|&) )?){1,6}(?:Inc|Incorporated|Corp|Corporation|LLC|L\.L\.C|Ltd|Limited|PLC|Co|Company)\b\.?"


#: The offline default for person mentions: two or three capitalised words, initials between them, beside words that announce a person.
PERSON = r"\p{Lu}[\p{L}'’-]+\.?(?: \p{Lu}\.)*(?: \p{Lu}[\p{L}'’-]+){1,2}"
_BEFORE_PERSON = r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\.? |(?i:\b(?:director|officer|president|chairman|chair|treasurer|secretary|counsel|founder|manager)),? |\b(?:granted to|agreement with|led by|succeeded by) )$"
_BEHIND_PERSON = r"^,? (?:joined|resigned|retired|serves|served|has served|reviewed|was (?:appointed|elected|named)|became|age \d)"


def _mentions_of(found: DataFrame, kind: str) -> DataFrame:
    position = (F.col("section_no") * 10_000_000 + F.col("start")).alias("position")
    return found.select("document_id", "record_id", F.lit(kind).alias("entity_type"), F.col("match").alias("name"), position, "start", "end")


def companies(records: DataFrame) -> DataFrame:
    """(document_id, record_id, entity_type, name, position, start, end): company mentions by the offline pattern, boilerplate left out."""
    found = records.select("document_id", "record_id", "section_no", F.inline(C.all_matches(F.col("chunk_text"), COMPANY)))
    return _mentions_of(found.where(C.keep_org(F.col("match"))), "company")


def people(records: DataFrame) -> DataFrame:
    """The same of person mentions by the offline pattern, those that the filters keep and that are no company's name."""
    found = records.select("document_id", "record_id", "section_no", "chunk_text", F.inline(C.all_matches(F.col("chunk_text"), PERSON)))
    before = F.expr("substring(chunk_text, greatest(start - 29, 1), least(start, 30))")
    behind = F.expr("substring(chunk_text, end + 1, 30)")
    announced = before.rlike(_BEFORE_PERSON) | behind.rlike(_BEHIND_PERSON) | F.col("match").rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\b")
    company = F.concat("match", behind).rlike(f"^{COMPANY}")
    return _mentions_of(found.where(announced & ~company & C.keep_person(F.col("match"), F.col("chunk_text"), F.col("start"))), "person")


def names(records: DataFrame) -> DataFrame:
    """Company and person mentions by the offline patterns."""
    return companies(records).union(people(records))


@query()
def proj_standardize(spark, sf_dir):
    """The whole pipeline over the filings' texts."""
    return pipeline(filing_texts(spark, sf_dir), paths=filings(spark, sf_dir, "source_path"))
