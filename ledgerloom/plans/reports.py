"""Validation reports, evaluation sample, viewer, report pages, index and caches on disk; most with SQL twins."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.functions import columns as C
from ledgerloom.functions import rules as R
from ledgerloom.operators import enrich, table_enrich, text_tables
from ledgerloom.plans import parts, relational, training
from ledgerloom.plans.base import SQL_CHUNKS, SQL_FILINGS, chunks, filings
from ledgerloom.plans.documents import _MENTIONS_SQL, companies, mentions, money
from ledgerloom.session import cut, scratch
from ledgerloom.sources import documents, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- validation: one row per check, its value and the issues that it counts -----------------------------------------


def report(one: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """(check, value, issues) of a one-row aggregate; both numbers as double."""
    rows = F.array(*(F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), issues.cast("double").alias("issues")) for name, value, issues in checks))
    return one.select(F.inline(rows))


def _q(values: str, q: float) -> str:
    return f"list_sort(list({values}))[CAST(floor(count({values}) * {q}) AS INTEGER) + 1]"


_ISSUE = "CAST({} AS DOUBLE)"


@query(f"""WITH c AS (SELECT document_id, section_category, heading, coalesce(chunk_text, '') AS t FROM {SQL_CHUNKS}), d AS (SELECT document_id, count(*) AS n, max(CASE WHEN heading = 'Preamble' THEN 1 ELSE 0 END) AS p FROM c GROUP BY 1),
 a AS (SELECT count(*) AS n, count(*) FILTER (WHERE trim(t) = '') AS empty, count(*) FILTER (WHERE length(t) BETWEEN 1 AND 99) AS tiny, count(DISTINCT CASE WHEN section_category NOT IN ({relational._in(R.CATEGORIES)}) THEN section_category END) AS unknown FROM c),
 b AS (SELECT count(*) AS docs, sum(p) AS preambles, count(*) FILTER (WHERE n <= 2) AS few, {_q('n', 0.25)} AS q1, {_q('n', 0.75)} AS q3 FROM d)
 SELECT * FROM (SELECT 'chunks' AS "check", CAST(a.n AS DOUBLE) AS value, 0.0::DOUBLE AS issues FROM a UNION ALL SELECT 'documents', docs, 0 FROM b UNION ALL SELECT 'with preamble', preambles, 0 FROM b UNION ALL SELECT 'unknown categories', unknown, unknown FROM a
 UNION ALL SELECT 'empty texts', empty, empty FROM a UNION ALL SELECT 'tiny texts', tiny, tiny FROM a UNION ALL SELECT 'documents of few chunks', few, few FROM b UNION ALL SELECT 'bound of many chunks', q3 + 1.5 * (q3 - q1), 0 FROM b
 UNION ALL SELECT 'issues', unknown + empty + tiny + few, unknown + empty + tiny + few FROM a, b)""")
def validate_sections(spark, sf_dir):
    """Sections: categories outside the taxonomy, empty and tiny texts, documents of one or two chunks."""
    c = chunks(spark, sf_dir, "document_id", "section_category", "heading", "chunk_text")
    t, zero = F.coalesce("chunk_text", F.lit("")), F.lit(0)
    known = F.col("section_category").isin(R.CATEGORIES)
    of_document = c.groupBy("document_id").agg(F.count("*").alias("n"), F.max((F.col("heading") == "Preamble").cast("int")).alias("p"))
    a = c.agg(F.count("*").alias("chunks"), F.count_if(F.trim(t) == "").alias("empty"), F.count_if(F.length(t).between(1, 99)).alias("tiny"), F.countDistinct(F.when(~known, F.col("section_category"))).alias("unknown"))
    # Counts of documents by their number of chunks: as many rows as there are numbers.
    sizes = of_document.groupBy("n").agg(F.count("*").alias("c"), F.sum(F.coalesce("p", zero)).alias("p"))
    listed = F.sort_array(F.collect_list(F.struct("n", "c")))
    b = sizes.agg(F.sum("c").alias("documents"), F.sum("p").alias("preambles"), F.coalesce(F.sum(F.when(F.col("n") <= 2, F.col("c"))), zero).alias("few"), listed.alias("sizes"))

    def at(q: float) -> Column:
        place = F.floor(F.col("documents") * q)
        walked = F.aggregate("sizes", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("found")), lambda s, x: F.struct((s["seen"] + x["c"]).alias("seen"), F.coalesce(s["found"], F.when(s["seen"] + x["c"] > place, x["n"])).alias("found")))
        return walked["found"]

    one = a.join(F.broadcast(b))  # one row each
    q1, q3 = at(0.25), at(0.75)
    total = F.col("unknown") + F.col("empty") + F.col("tiny") + F.col("few")
    return report(one, [
        ("chunks", F.col("chunks"), zero), ("documents", F.col("documents"), zero), ("with preamble", F.col("preambles"), zero), ("unknown categories", F.col("unknown"), F.col("unknown")), ("empty texts", F.col("empty"), F.col("empty")),
        ("tiny texts", F.col("tiny"), F.col("tiny")), ("documents of few chunks", F.col("few"), F.col("few")), ("bound of many chunks", q3 + 1.5 * (q3 - q1), zero), ("issues", total, total),
    ])


@query(f"""WITH m AS (SELECT record_id, count(*) AS n, count(*) FILTER (WHERE lower(entity_type) IN ('monetary', 'money', 'monetary_value')) AS money FROM {_MENTIONS_SQL} GROUP BY 1),
 b AS (SELECT sum(n) AS mentions, count(*) AS records, sum(money) AS money, {_q('n', 0.25)} AS q1, {_q('n', 0.75)} AS q3 FROM m), x AS (SELECT least(count(*), 5) AS noisy FROM m, b WHERE n > q3 + 1.5 * (q3 - q1))
 SELECT * FROM (SELECT 'mentions' AS "check", CAST(mentions AS DOUBLE) AS value, CASE WHEN mentions > 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS issues FROM b UNION ALL SELECT 'records with mentions', records, 0 FROM b UNION ALL SELECT 'money', money, CASE WHEN money > 0 THEN 0 ELSE 1 END FROM b
 UNION ALL SELECT 'bound of many mentions', q3 + 1.5 * (q3 - q1), 0 FROM b UNION ALL SELECT 'outliers shown', noisy, noisy FROM x)""")
def validate_entities(spark, sf_dir):
    """Mentions: none at all, no money, records of unusually many (at most five are shown and count)."""
    kind = F.lower("entity_type")
    n = mentions(spark, sf_dir).groupBy("record_id").agg(F.count("*").alias("n"), F.count_if(kind.isin("monetary", "money", "monetary_value")).alias("money"))
    n = cut(n, "mentions")
    bounds = relational._stats(n.select(F.col("n").alias("mentions")), "mentions").select(F.col("p25").alias("q1"), F.col("p75").alias("q3"))
    high = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    one = n.join(F.broadcast(bounds)).agg(F.sum("n").alias("mentions"), F.count("*").alias("records"), F.sum("money").alias("money"), F.max(high).alias("high"), F.least(F.count_if(F.col("n") > high), F.lit(5)).alias("noisy"))
    zero = F.lit(0)
    return report(one, [
        ("mentions", F.col("mentions"), F.when(F.col("mentions") > 0, 0).otherwise(1)), ("records with mentions", F.col("records"), zero), ("money", F.col("money"), F.when(F.col("money") > 0, 0).otherwise(1)),
        ("bound of many mentions", F.col("high"), zero), ("outliers shown", F.col("noisy"), F.col("noisy")),
    ])


_E = "json_extract_string(e, '$.{}')"


@query(f"""WITH e AS (SELECT {_E.format('canonical_name')} AS canonical, {_E.format('resolution_method')} AS method, CAST({_E.format('resolution_score')} AS BIGINT) AS score FROM {training._ENTITIES}),
 r AS (SELECT count(*) AS resolvable FROM {_MENTIONS_SQL} WHERE lower(entity_type) IN ('company', 'person')), k AS (SELECT count(*) AS names, count(*) FILTER (WHERE n = 1) AS single FROM (SELECT canonical, count(*) AS n FROM e WHERE canonical <> '' GROUP BY 1)),
 a AS (SELECT count(*) AS resolved, count(*) FILTER (WHERE method = 'cluster_link' AND coalesce(nullif(score, 0), 100) < 50) AS suspicious, count(*) FILTER (WHERE score < 50) AS low FROM e)
 SELECT * FROM (SELECT 'resolved' AS "check", CAST(resolved AS DOUBLE) AS value, 0.0::DOUBLE AS issues FROM a UNION ALL SELECT 'coverage', round(resolved / greatest(resolvable, 1), 6), CASE WHEN resolved < 0.5 * resolvable THEN 1 ELSE 0 END FROM a, r
 UNION ALL SELECT 'singletons pct', round(100.0 * single / greatest(names, 1), 4), CASE WHEN 100.0 * single / greatest(names, 1) > 70 THEN 1 ELSE 0 END FROM k UNION ALL SELECT 'suspicious links', suspicious, CASE WHEN suspicious > 0 THEN 1 ELSE 0 END FROM a
 UNION ALL SELECT 'low scores', low, CASE WHEN low > 0 THEN 1 ELSE 0 END FROM a)""")
def validate_resolution(spark, sf_dir):
    """Resolution: coverage (resolved names to mentions that could be), names seen once, weak links, low scores."""
    e = training.p1_entities(spark, sf_dir)
    a = e.agg(F.count("*").alias("resolved"), F.count_if((F.col("resolution_method") == "cluster_link") & (F.coalesce(F.nullif("resolution_score", F.lit(0)), F.lit(100)) < 50)).alias("suspicious"), F.count_if(F.col("resolution_score") < 50).alias("low"))
    names = e.where("canonical_name <> ''").groupBy("canonical_name").agg(F.count("*").alias("n"))
    k = names.agg(F.count("*").alias("names"), F.count_if(F.col("n") == 1).alias("single"))
    r = mentions(spark, sf_dir).agg(F.count_if(F.lower("entity_type").isin("company", "person")).alias("resolvable"))
    one = a.join(F.broadcast(k)).join(F.broadcast(r))  # one row each
    flag = lambda c: F.when(c, 1).otherwise(0)
    single = 100.0 * F.col("single") / F.greatest("names", F.lit(1))
    return report(one, [
        ("resolved", F.col("resolved"), F.lit(0)), ("coverage", F.round(F.col("resolved") / F.greatest("resolvable", F.lit(1)), 6), flag(F.col("resolved") < 0.5 * F.col("resolvable"))), ("singletons pct", F.round(single, 4), flag(single > 70)),
        ("suspicious links", F.col("suspicious"), flag(F.col("suspicious") > 0)), ("low scores", F.col("low"), flag(F.col("low") > 0)),
    ])


@query(f"""WITH t AS (SELECT record_id, document_id, e, len({training._list('e', '$.columns')}) AS n_columns, {_E.format('summary')} AS summary FROM {training._TABLES}),
 n AS (SELECT count(DISTINCT document_id) AS documents FROM {SQL_CHUNKS}), a AS (SELECT count(*) AS tables, count(*) FILTER (WHERE n_columns > 0) AS with_columns, count(*) FILTER (WHERE trim(summary) <> '') AS with_summary, count(DISTINCT document_id) AS docs FROM t)
 SELECT * FROM (SELECT 'tables' AS "check", CAST(tables AS DOUBLE) AS value, CASE WHEN tables > 0 THEN 0.0 ELSE 1.0 END::DOUBLE AS issues FROM a UNION ALL SELECT 'with columns', with_columns, CASE WHEN with_columns < 0.5 * tables THEN 1 ELSE 0 END FROM a
 UNION ALL SELECT 'with summary', with_summary, 0 FROM a UNION ALL SELECT 'documents with tables', docs, CASE WHEN docs < 0.5 * documents THEN 1 ELSE 0 END FROM a, n)""")
def validate_tables(spark, sf_dir):
    """Tables: none at all, half of them without columns, half of the documents without any."""
    t = training.p1_tables(spark, sf_dir)
    a = t.agg(F.count("*").alias("tables"), F.count_if(F.col("n_columns") > 0).alias("with_columns"), F.count_if(F.trim("summary") != "").alias("with_summary"), F.countDistinct("document_id").alias("docs"))
    one = a.join(F.broadcast(chunks(spark, sf_dir, "document_id").agg(F.countDistinct("document_id").alias("documents"))))  # one row each
    flag = lambda c: F.when(c, 1).otherwise(0)
    return report(one, [
        ("tables", F.col("tables"), flag(F.col("tables") == 0)), ("with columns", F.col("with_columns"), flag(F.col("with_columns") < 0.5 * F.col("tables"))), ("with summary", F.col("with_summary"), F.lit(0)),
        ("documents with tables", F.col("docs"), flag(F.col("docs") < 0.5 * F.col("documents"))),
    ])


# ---- evaluation sample, summary, viewer -----------------------------------------------------------------------------

_FIRST = "string_agg({v}, '; ' ORDER BY no) FILTER (WHERE no <= {n})"


@query(f"""SELECT c.record_id, document_id, section_category, substr(coalesce(source_filename, ''), 1, 50) AS filename, substr(coalesce(heading, ''), 1, 80) AS heading, substr(coalesce(chunk_text, ''), 1, 300) AS preview, coalesce(m.s, '') AS entities, coalesce(e.s, '') AS resolved,
 '' AS section_correct, '' AS entities_correct, '' AS entity_resolution_correct, '' AS table_parse_correct, '' AS review_notes
 FROM (SELECT *, row_number() OVER (PARTITION BY section_category ORDER BY md5('42' || record_id), record_id) AS k FROM {SQL_CHUNKS} WHERE section_category IS NOT NULL) c
 LEFT JOIN (SELECT record_id, {_FIRST.format(v="name || ' (' || entity_type || ')'", n=5)} AS s FROM {parts._MENTIONS_SQL} GROUP BY 1) m ON m.record_id = c.record_id
 LEFT JOIN (SELECT record_id, {_FIRST.format(v=_E.format('canonical_name'), n=2)} AS s FROM {training._ENTITIES} GROUP BY 1) e ON e.record_id = c.record_id WHERE k <= 2""")
def eval_sample(spark, sf_dir):
    """Two records of each category by a seeded hash, with previews and blank columns for a reviewer."""
    order = Window.partitionBy("section_category").orderBy(F.md5(F.concat(F.lit("42"), "record_id").cast("binary")), "record_id")
    c = chunks(spark, sf_dir, "document_id", "section_category", "source_filename", "heading", "chunk_text").where("section_category IS NOT NULL")
    c = c.withColumn("k", F.row_number().over(order)).where("k <= 2")
    first = lambda df, at, text: df.groupBy("record_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(at, text.alias("t")))), lambda x: x["t"]), "; ").alias("s"))
    m = first(parts._mentions(spark, sf_dir).where("no <= 5"), "no", F.concat("name", F.lit(" ("), "entity_type", F.lit(")"))).withColumnRenamed("s", "entities")
    e = first(training.p1_entities(spark, sf_dir).where("entity_no <= 2"), "entity_no", F.col("canonical_name")).withColumnRenamed("s", "resolved")
    cutoff = lambda name, n: F.left(F.coalesce(name, F.lit("")), F.lit(n))
    j = c.join(m, "record_id", "left").join(e, "record_id", "left")
    blank = [F.lit("").alias(b) for b in ("section_correct", "entities_correct", "entity_resolution_correct", "table_parse_correct", "review_notes")]
    return j.select(
        "record_id", "document_id", "section_category", cutoff("source_filename", 50).alias("filename"), cutoff("heading", 80).alias("heading"), cutoff("chunk_text", 300).alias("preview"),
        F.coalesce("entities", F.lit("")).alias("entities"), F.coalesce("resolved", F.lit("")).alias("resolved"), *blank,
    )


@query(f"SELECT record_id, filename, heading, preview, entities FROM ({SQL['eval_sample']})")
def sink_eval_csv(spark, sf_dir):
    """The evaluation sample written as one CSV file and read again."""
    s = eval_sample(spark, sf_dir)
    sinks.write_csv(s, path := scratch(spark, "evaluation"))
    return sinks.read_csv(spark, path, s.schema).select("record_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("filename", "heading", "preview", "entities")))


@query(relational.SQL["agg_summary"])
def sink_summary_json(spark, sf_dir):
    """The summary written as a JSON file and read again."""
    s = relational.agg_summary(spark, sf_dir)
    sinks.write_jsonl(s.coalesce(1), path := scratch(spark, "summary"))
    return documents.read_jsonl(spark, path, s.schema.simpleString()[len("struct<") : -1].replace(":", " ").replace(",", ", "))


_HEAD_SQL = f"(SELECT * FROM {SQL_CHUNKS} ORDER BY record_id LIMIT 20)"


@query(f"SELECT record_id, heading, CASE WHEN length(chunk_text) > 80 THEN substr(chunk_text, 1, 80) || '…' ELSE chunk_text END AS preview FROM {_HEAD_SQL}")
def show_head(spark, sf_dir):
    """The first twenty records by id."""
    c = chunks(spark, sf_dir, "heading", "chunk_text").orderBy("record_id").limit(20)
    return c.select("record_id", "heading", C.preview(F.col("chunk_text"), 80).alias("preview"))


def _esc(col: str) -> str:
    return f"replace(replace(replace(replace(replace(coalesce({col}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query(f"SELECT record_id, '<section><h2>' || {_esc('heading')} || '</h2><p>' || {_esc('document_id')} || ' · ' || {_esc('section_category')} || '</p><pre>' || {_esc('substr(chunk_text, 1, 400)')} || '</pre></section>' AS card FROM {_HEAD_SQL}")
def sink_html(spark, sf_dir):
    """Cards of a page of twenty records."""
    c = chunks(spark, sf_dir, "document_id", "heading", "section_category", "chunk_text").orderBy("record_id").limit(20)
    return c.select("record_id", sinks.card().alias("card"))


@query(f"""SELECT c.record_id, '<section><h2>' || {_esc('heading')} || '</h2><p>' || {_esc('document_id')} || ' · ' || {_esc('section_category')} || '</p><ul><li>' || coalesce(n, 0) || ' mentions</li><li>' || coalesce(table_count, 0) || ' tables</li></ul><pre>' || {_esc('substr(chunk_text, 1, 400)')} || '</pre></section>' AS card
 FROM {_HEAD_SQL} c LEFT JOIN (SELECT record_id, count(*) AS n FROM {_MENTIONS_SQL} GROUP BY 1) m ON m.record_id = c.record_id""")
def sink_html_detailed(spark, sf_dir):
    """The same cards with the number of mentions and tables."""
    c = chunks(spark, sf_dir, "document_id", "heading", "section_category", "table_count", "chunk_text").orderBy("record_id").limit(20)
    n = mentions(spark, sf_dir).groupBy("record_id").agg(F.count("*").alias("n"))
    j = c.join(n, "record_id", "left")
    return j.select("record_id", sinks.card([(F.coalesce("n", F.lit(0)), "mentions"), (F.coalesce("table_count", F.lit(0)), "tables")]).alias("card"))


@query(f"SELECT category, '| ' || category || ' | ' || n || ' |' AS line FROM ({relational.SQL['agg_category_dist']})")
def sink_md_report(spark, sf_dir):
    """The lines of a report's table of categories."""
    return relational.agg_category_dist(spark, sf_dir).select("category", F.concat(F.lit("| "), "category", F.lit(" | "), F.col("n").cast("string"), F.lit(" |")).alias("line"))


@query(f"SELECT category, rpad(category, 30, ' ') || lpad(CAST(n AS VARCHAR), 8, ' ') || '  ' || repeat('█', CAST(floor(30.0 * n / greatest(sum(n) OVER (), 1)) AS INTEGER)) AS line FROM ({relational.SQL['agg_category_dist']})")
def console(spark, sf_dir):
    """Bars of a terminal report."""
    share = F.floor(30.0 * F.col("n") / F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(1))).cast("int")
    bar = F.concat(F.rpad("category", 30, " "), F.lpad(F.col("n").cast("string"), 8, " "), F.lit("  "), F.repeat(F.lit("█"), share))
    return relational.agg_category_dist(spark, sf_dir).select("category", bar.alias("line"))


VIEWS = ("sections", "entities", "tables", "warnings")


def load_view(spark, sf_dir, view: str, document: str | None = None, category: str | None = None) -> DataFrame:
    """(view, record_id, what) of one view, of one document or category where given."""
    c = chunks(spark, sf_dir, "document_id", "section_category", "heading", "warning_count")
    c = c.where(F.col("document_id") == document) if document else c
    c = c.where(F.col("section_category") == category) if category else c
    if view == "sections":
        rows = c.select("record_id", F.col("heading").alias("what"))
    elif view == "warnings":
        rows = c.where("warning_count > 0").select("record_id", F.col("warning_count").cast("string").alias("what"))
    else:
        found = mentions(spark, sf_dir).select("record_id", F.col("name").alias("what")) if view == "entities" else training.p1_tables(spark, sf_dir).select("record_id", F.col("summary").alias("what"))
        rows = found.join(c.select("record_id"), "record_id", "left_semi")
    return rows.select(F.lit(view).alias("view"), "record_id", "what")


@query(f"""WITH c AS (SELECT * FROM {SQL_CHUNKS} WHERE section_category = 'risk_factors') SELECT 'sections' AS view, record_id, heading AS what FROM c UNION ALL SELECT 'warnings', record_id, CAST(warning_count AS VARCHAR) FROM c WHERE warning_count > 0
 UNION ALL SELECT 'entities', record_id, name FROM {_MENTIONS_SQL} WHERE record_id IN (SELECT record_id FROM c) UNION ALL SELECT 'tables', record_id, {_E.format('summary')} FROM {training._TABLES} WHERE record_id IN (SELECT record_id FROM c)""")
def load_and_show(spark, sf_dir):
    """All views of the records of one category."""
    out = load_view(spark, sf_dir, VIEWS[0], category="risk_factors")
    for view in VIEWS[1:]:
        out = out.union(load_view(spark, sf_dir, view, category="risk_factors"))
    return out


# ---- files: legacy scan, JSON lines, logs, caches, index ------------------------------------------------------------


@query(f"SELECT document_id || '.txt' AS name, CAST(length(raw_text) AS BIGINT) AS n_chars FROM {SQL_FILINGS} WHERE raw_text <> ''")
def scan_txt_legacy(spark, sf_dir):
    """Openings written as text files and read whole."""
    f = filings(spark, sf_dir, "raw_text").where("raw_text <> ''")
    f.foreachPartition(sinks.text_files(folder := scratch(spark, "texts"), "document_id", "raw_text"))
    t = documents.read_text_legacy(spark, folder)
    return t.select(C.file_name(F.col("filepath")).alias("name"), F.length("text").cast("bigint").alias("n_chars"))


@query("SELECT doc_id, lang, n_chars FROM documents")
def sink_jsonl(spark, sf_dir):
    """Columns with nulls written as JSON lines and read again."""
    sinks.write_jsonl(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), path := scratch(spark, "jsonl"))
    return documents.read_jsonl(spark, path, "doc_id bigint, lang string, n_chars bigint")


@query("SELECT status, CAST(2 * count(*) AS BIGINT) AS n FROM toc_llm_metrics WHERE status IS NOT NULL GROUP BY 1")
def sink_metrics_csv(spark, sf_dir):
    """A log appended to twice and counted."""
    m = read_table(spark, sf_dir, "toc_llm_metrics").select(*[c.split()[0] for c in documents.METRICS.split(", ")])
    path = scratch(spark, "log")
    for _ in range(2):
        sinks.append_log(m, path)
    return documents.read_metrics_csv(spark, path).where("status IS NOT NULL").groupBy("status").agg(F.count("*").alias("n"))


def _filled_cache(spark, sf_dir, headed: DataFrame, path: str) -> DataFrame:
    """The cache of replies to the headings of records with tables, as it is on disk."""
    _, grown = enrich.enrich(headed.where("table_count > 0"), "record_id", "heading", enrich.read_cache(spark, path), lambda p: f"about {p}")
    enrich.append_cache(grown, path)
    return enrich.read_cache(spark, path)


@query(f"SELECT DISTINCT 'about ' || heading AS reply FROM {SQL_CHUNKS} WHERE heading IS NOT NULL AND table_count > 0")
def sink_cache(spark, sf_dir):
    """A cache written, and read once for each key."""
    return _filled_cache(spark, sf_dir, chunks(spark, sf_dir, "heading", "table_count"), scratch(spark, "cache")).select("reply")


@query(f"SELECT DISTINCT 'about ' || heading AS reply FROM {SQL_CHUNKS} WHERE heading IS NOT NULL")
def scan_llm_cache(spark, sf_dir):
    """The cache after a second run has added the other headings; a folder that isn't there yet is an empty cache."""
    c = cut(chunks(spark, sf_dir, "heading", "table_count"), "headings")
    path = scratch(spark, "cache")
    _, grown = enrich.enrich(c, "record_id", "heading", _filled_cache(spark, sf_dir, c, path), lambda p: f"about {p}")
    enrich.append_cache(cut(grown, "grown"), path)
    return enrich.read_cache(spark, path).select("reply")


@query(f"""SELECT CASE WHEN heading IN (SELECT heading FROM {SQL_CHUNKS} WHERE table_count > 0 AND heading IS NOT NULL) THEN 'cache_hit' ELSE 'ok' END AS status, CAST(count(*) AS BIGINT) AS n FROM {SQL_CHUNKS} WHERE heading IS NOT NULL GROUP BY 1""")
def sink_cache_hit_row(spark, sf_dir):
    """Log rows of a run whose cache knows a part of what it asks: hits and calls."""
    c = cut(chunks(spark, sf_dir, "heading", "table_count"), "headings")
    replies, _ = enrich.enrich(c, "record_id", "heading", _filled_cache(spark, sf_dir, c, scratch(spark, "cache")), lambda p: f"about {p}")
    sinks.append_log(table_enrich.log_rows(replies, "offline"), path := scratch(spark, "log"))
    return spark.read.option("header", True).schema("model string, status string, estimated_cost_usd double").csv(path).groupBy("status").agg(F.count("*").alias("n"))


def _index(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    path = scratch(spark, "index")
    v = read_table(spark, sf_dir, "index_vectors").where(F.size("embedding") > 0).select("record_id", "embedding")
    sinks.write_index(v, chunks(spark, sf_dir, "heading", "section_category"), path)
    return documents.read_index(spark, path)


@query("SELECT record_id, CAST(len(embedding) AS BIGINT) AS dims FROM index_vectors WHERE len(embedding) > 0")
def sink_index(spark, sf_dir):
    """Vectors of an index as written."""
    return _index(spark, sf_dir)[0].select("record_id", F.size("embedding").cast("bigint").alias("dims"))


@query(f"SELECT record_id, heading, section_category FROM {SQL_CHUNKS}")
def sink_meta(spark, sf_dir):
    """Metadata of an index as written."""
    return _index(spark, sf_dir)[1].select("record_id", "heading", "section_category")


@query(f"SELECT record_id, heading FROM index_vectors JOIN {SQL_CHUNKS} USING (record_id) WHERE len(embedding) > 0")
def scan_index(spark, sf_dir):
    """An index read again: vectors with their metadata."""
    vectors, metadata = _index(spark, sf_dir)
    return vectors.join(metadata, "record_id").select("record_id", "heading")


# ---- enrichment of tables -------------------------------------------------------------------------------------------


def _about(payload: str) -> str:
    """An offline provider for tests and these queries: names what it was asked."""
    asked = json.loads(payload)
    if asked["infer"]:
        return json.dumps({"summary": "about " + asked["heading"], "columns": ["Item", *(f"Column {i}" for i in range(1, len(asked["columns"])))]})
    return "about " + asked["heading"]


def _stored(spark, sf_dir, columns: Column) -> DataFrame:
    t = parts._columns(spark, sf_dir).withColumn("columns", columns).join(chunks(spark, sf_dir, "heading"), "record_id")
    row = F.map_from_arrays(F.array_distinct("columns"), F.array_distinct("columns"))
    return t.select("record_id", "table_no", "heading", "columns", F.array(row).alias("rows"), F.lit("raw").alias("raw_text"), F.lit("plain").alias("summary"))


@query(f"""SELECT record_id, table_no, CASE WHEN len(columns) = 0 THEN 'plain' ELSE 'about ' || coalesce(heading, '') END AS summary, CASE WHEN len(columns) = 0 THEN 'deterministic' WHEN generic THEN 'llm_inferred' ELSE 'llm' END AS summary_source
 FROM {parts._COLUMNS_SQL} JOIN {SQL_CHUNKS} USING (record_id) JOIN ({parts.SQL['generic_columns']}) USING (record_id, table_no)""")
def apply_summary(spark, sf_dir):
    """Summaries of the stored tables by a provider, each distinct table asked once."""
    t, _, _ = table_enrich.apply_summaries(_stored(spark, sf_dir, F.col("columns")), enrich.read_cache(spark, scratch(spark, "cache")), _about)
    return t.select("record_id", "table_no", "summary", "summary_source")


@query(f"""SELECT record_id, table_no, array_to_string(CASE WHEN len(columns) > 1 THEN list_prepend('Item', list_transform(range(1, len(columns)), lambda i: 'Column ' || i)) ELSE ['Item'] END, ',') AS columns, CASE WHEN len(columns) > 1 THEN 'llm_inferred' ELSE 'llm' END AS summary_source
 FROM {parts._COLUMNS_SQL} JOIN {SQL_CHUNKS} USING (record_id) WHERE len(columns) > 0""")
def infer_columns_llm(spark, sf_dir):
    """Placeholder columns named by a provider, rows renamed with them."""
    generic = F.transform("columns", lambda c, i: F.when(i == 0, "Item").otherwise(F.concat(F.lit("Col"), i.cast("string"))))
    t, _, _ = table_enrich.apply_summaries(_stored(spark, sf_dir, generic).where(F.size("columns") > 0), enrich.read_cache(spark, scratch(spark, "cache")), _about)
    named = F.array_join(F.map_keys(F.get("rows", F.lit(0))), ",")
    return t.select("record_id", "table_no", F.array_join("columns", ",").alias("columns"), "summary_source").where(named == F.col("columns"))


@query()
def tables_found_enriched(spark, sf_dir):
    """Tables found in the texts, all detected, those that the cache lacks asked, the replies applied."""
    c = chunks(spark, sf_dir, "chunk_text", "heading")
    found = text_tables.detect_tables(c).join(c.select("record_id", "heading"), "record_id")
    t, _, _ = table_enrich.apply_summaries(found, enrich.read_cache(spark, scratch(spark, "cache")), _about)
    return t.select("record_id", "table_no", "table_type", "summary", "summary_source", "summary_cache_status", F.size("rows").alias("n_rows"))


_COMPANY_RE = "(?:[A-Z][\\p{L}\\p{N}_&.''-]*,? (?:(?:and|of|&) )?){1,6}(?:Inc|Incorporated|Corp|Corporation|LLC|L\\.L\\.C|Ltd|Limited|PLC|Co|Company)\\b\\.?"


@query(f"""SELECT record_id, name, CAST(count(*) AS BIGINT) AS n FROM (SELECT record_id, unnest(regexp_extract_all(chunk_text, '{_COMPANY_RE}')) AS name FROM {SQL_CHUNKS}) WHERE {relational._ORG_SQL} <> '' AND {relational._ORG_SQL} NOT IN ({relational._in(R.ORG_STOPWORDS + R.ORG_STOP_PHRASES)})
 AND NOT regexp_matches(name, '(?i){R.ORG_BOILERPLATE}') GROUP BY 1, 2""")
def ner(spark, sf_dir):
    """Company mentions by the offline pattern, which a model's may replace, and how often in each record."""
    c = chunks(spark, sf_dir, "document_id", "chunk_text").where("chunk_text IS NOT NULL").withColumn("section_no", F.lit(0))
    return companies(c).groupBy("record_id", "name").agg(F.count("*").alias("n"))


@query(f"SELECT record_id, kind, name, CAST(sum(n) AS BIGINT) AS n FROM (SELECT record_id, 'company' AS kind, name, n FROM ({SQL['ner']}) UNION ALL SELECT record_id, 'monetary_value', match, 1 FROM {parts._FOUND_MONEY_SQL}) GROUP BY 1, 2, 3")
def extract_entities(spark, sf_dir):
    """Companies by the offline pattern and money, one below the other, and how often in each record."""
    named = ner(spark, sf_dir).select("record_id", F.lit("company").alias("kind"), "name", "n")
    found = money(spark, sf_dir).groupBy("record_id", F.col("match").alias("name")).agg(F.count("*").alias("n"))
    return named.unionByName(found.withColumn("kind", F.lit("monetary_value")))
