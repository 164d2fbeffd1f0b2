"""Queries on the parts of the larger operators: joins with defaults, as-of matches, modal values, islands, evidence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions import fuzzy
from ledgerloom.functions import rules as R
from ledgerloom.operators import resolve
from ledgerloom.plans import relational, training
from ledgerloom.plans.base import SQL_CHUNKS, SQL_FILINGS, chunks, filings
from ledgerloom.plans.documents import _MENTIONS_SQL, mentions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_TABLES, _ROWS, _ENTITIES, _EVIDENCE = training._TABLES, training._ROWS, training._ENTITIES, training._EVIDENCE
_T = "json_extract_string(e, '$.{}')"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _tables(spark, sf_dir):
    return training.p1_tables(spark, sf_dir)


def _entities(spark, sf_dir):
    return training.p1_entities(spark, sf_dir)


def _evidence(spark, sf_dir):
    return training.p1_evidence(spark, sf_dir)


def _ordered(df: DataFrame, key: str, at: str, value: str, sep: str):
    """Values of a record joined in their order; a record's list is as long as its own field."""
    parts = F.sort_array(F.collect_list(F.struct(at, value)))
    return df.where(f"{value} <> ''").groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p[value]), sep).alias("joined"))


@query(f"SELECT record_id, string_agg(s, chr(10) ORDER BY no) AS joined FROM (SELECT record_id, no, {_T.format('summary')} AS s FROM {_TABLES}) WHERE s <> '' GROUP BY 1")
def table_summaries(spark, sf_dir):
    """Summaries of a record's tables, one a line."""
    return _ordered(_tables(spark, sf_dir), "record_id", "table_no", "summary", "\n")


@query(f"SELECT record_id, string_agg(s, ', ' ORDER BY no) AS joined FROM (SELECT record_id, no, {_T.format('canonical_name')} AS s FROM {_ENTITIES}) WHERE s <> '' GROUP BY 1")
def resolved_names(spark, sf_dir):
    """Canonical names of a record."""
    return _ordered(_entities(spark, sf_dir), "record_id", "entity_no", "canonical_name", ", ")


@query(f"SELECT record_id, substr(chunk_text, 1, 300) AS text, substr(source_filename, 1, 50) AS filename, substr(heading, 1, 80) AS heading, '' AS review FROM {SQL_CHUNKS}")
def eval_projection(spark, sf_dir):
    """Preview columns for a reviewer."""
    c = chunks(spark, sf_dir, "chunk_text", "source_filename", "heading")
    return c.select("record_id", F.left("chunk_text", F.lit(300)).alias("text"), F.left("source_filename", F.lit(50)).alias("filename"), F.left("heading", F.lit(80)).alias("heading"), F.lit("").alias("review"))


@query(f"SELECT record_id, no AS table_no, trim(regexp_replace({_T.format('units')}, '(?i),? except(?: for)? per-share amounts', '')) AS units FROM {_TABLES} WHERE {_T.format('units')} <> ''")
def units_strip(spark, sf_dir):
    """Units without their exceptions."""
    return _tables(spark, sf_dir).where("units <> ''").select("record_id", "table_no", F.trim(F.regexp_replace("units", r"(?i),? except(?: for)? per-share amounts", "")).alias("units"))


@query(f"SELECT document_id, source_path FROM {SQL_FILINGS} WHERE lower(source_path) LIKE '%.txt'")
def filter_ext(spark, sf_dir):
    """Filings from text files."""
    return filings(spark, sf_dir, "source_path").where(F.lower("source_path").endswith(".txt")).select("document_id", "source_path")


@query(f"SELECT document_id, round(avg(gap), 6) AS mean_gap FROM ({relational.SQL['win_toc_gaps']}) GROUP BY 1 HAVING avg(gap) > 1.2")
def toc_gap_reject(spark, sf_dir):
    """Contents lists with items far apart."""
    return relational.win_toc_gaps(spark, sf_dir).groupBy("document_id").agg(F.avg("gap").alias("g")).where("g > 1.2").select("document_id", F.round("g", 6).alias("mean_gap"))


@query(f"SELECT document_id, record_id, name FROM {_MENTIONS_SQL} WHERE entity_type IN ('company', 'person')")
def resolvable_type(spark, sf_dir):
    """Mentions that can be resolved."""
    return mentions(spark, sf_dir).where(F.col("entity_type").isin("company", "person")).select("document_id", "record_id", "name")


@query(f"""SELECT record_id, entity_no, json_extract_string(v, '$.variant') AS variant FROM {_EVIDENCE} WHERE json_extract_string(v, '$.resolution_method') <> 'canonical'
 AND coalesce(nullif(CAST(json_extract_string(v, '$.resolution_score') AS BIGINT), 0), 100) < 90""")
def suspicious_cluster_link(spark, sf_dir):
    """Variants tied by a low score; none and zero count as full."""
    e = _evidence(spark, sf_dir).where("resolution_method <> 'canonical'")
    return e.where(F.coalesce(F.nullif("resolution_score", F.lit(0)), F.lit(100)) < 90).select("record_id", "entity_no", "variant")


@query(f"""SELECT n.record_id, n.no AS entity_no, coalesce(v.m, {_T.format('resolution_method')}) AS method, v.s AS score FROM {_ENTITIES} n LEFT JOIN (SELECT record_id, entity_no, json_extract_string(v, '$.variant') AS variant,
 min_by(json_extract_string(v, '$.resolution_method'), evidence_no) AS m, min_by(coalesce(CAST(json_extract_string(v, '$.resolution_score') AS BIGINT), -1), evidence_no) AS s FROM {_EVIDENCE} GROUP BY 1, 2, 3) v
 ON n.record_id = v.record_id AND n.no = v.entity_no AND {_T.format('matched_text')} = v.variant""")
def join_evidence(spark, sf_dir):
    """Each entity's evidence for its matched text, else its own method."""
    first = _evidence(spark, sf_dir).groupBy("record_id", "entity_no", F.col("variant").alias("matched_text")).agg(
        F.min_by("resolution_method", "evidence_no").alias("m"), F.min_by(F.coalesce("resolution_score", F.lit(-1)), "evidence_no").alias("score")
    )
    j = _entities(spark, sf_dir).join(first, ["record_id", "entity_no", "matched_text"], "left")
    return j.select("record_id", "entity_no", F.coalesce("m", "resolution_method").alias("method"), "score")


@query(f"SELECT section_category, CAST(count(DISTINCT document_id) AS BIGINT) AS documents, CAST(count(*) AS BIGINT) AS chunks FROM {SQL_CHUNKS} GROUP BY 1")
def semi_chunks_by_category(spark, sf_dir):
    """Documents and records per category, in one pass."""
    return chunks(spark, sf_dir, "section_category", "document_id").groupBy("section_category").agg(F.countDistinct("document_id").alias("documents"), F.count("*").alias("chunks"))


@query(f"SELECT section_category, median(length(chunk_text)) AS median_chars FROM {SQL_CHUNKS} GROUP BY 1")
def agg_median(spark, sf_dir):
    """Median length per category."""
    return chunks(spark, sf_dir, "section_category", "chunk_text").groupBy("section_category").agg(F.median(F.length("chunk_text")).alias("median_chars"))


@query(f"SELECT section_category, round(count(*) FILTER (WHERE has_entities) / count(*), 6) AS share FROM {SQL_CHUNKS} GROUP BY 1")
def agg_pct(spark, sf_dir):
    """Share of records with entities per category."""
    return chunks(spark, sf_dir, "section_category", "has_entities").groupBy("section_category").agg(F.round(F.count_if("has_entities") / F.count("*"), 6).alias("share"))


@query(f"""SELECT CAST(count(*) AS BIGINT) AS resolved, CAST(count(DISTINCT {_T.format('canonical_name')}) AS BIGINT) AS canonicals,
 CAST((SELECT count(*) FROM {_MENTIONS_SQL} WHERE entity_type IN ('company', 'person')) AS BIGINT) AS resolvable FROM {_ENTITIES}""")
def agg_resolution_cov(spark, sf_dir):
    """Resolved entities, canonical names and mentions that could be resolved."""
    n = _entities(spark, sf_dir).agg(F.count("*").alias("resolved"), F.countDistinct("canonical_name").alias("canonicals"))
    return n.join(F.broadcast(resolvable_type(spark, sf_dir).agg(F.count("*").alias("resolvable"))))  # one row each


@query(f"SELECT method, canonical_name, record_id FROM (SELECT {_T.format('resolution_method')} AS method, {_T.format('canonical_name')} AS canonical_name, record_id, row_number() OVER (PARTITION BY {_T.format('resolution_method')} ORDER BY record_id, no) AS k FROM {_ENTITIES}) WHERE k = 1")
def agg_first_example(spark, sf_dir):
    """The first entity of each method."""
    first = F.min_by(F.struct("canonical_name", "record_id"), F.struct("record_id", "entity_no")).alias("f")
    return _entities(spark, sf_dir).groupBy(F.col("resolution_method").alias("method")).agg(first).select("method", "f.canonical_name", "f.record_id")


@query(f"SELECT {_T.format('table_type')} AS table_type, CAST(count(*) FILTER (WHERE {_T.format('summary')} <> '') AS BIGINT) AS with_summary, round(avg(length({_T.format('summary')})), 6) AS mean_chars FROM {_TABLES} GROUP BY 1")
def agg_summary_quality(spark, sf_dir):
    """Summaries per table type."""
    return _tables(spark, sf_dir).groupBy("table_type").agg(F.count_if(F.col("summary") != "").alias("with_summary"), F.round(F.avg(F.length("summary")), 6).alias("mean_chars"))


@query(f"""SELECT record_id, table_no, n_cells FROM (SELECT *, row_number() OVER (PARTITION BY record_id, table_no ORDER BY c DESC, first_row) AS k FROM (SELECT record_id, table_no, n_cells, count(*) AS c, min(row_no) AS first_row FROM ({training.SQL['p1_rows']}) GROUP BY 1, 2, 3)) WHERE k = 1""")
def agg_most_common_len(spark, sf_dir):
    """The most common number of cells in each table's rows, ties to the first row."""
    c = training.p1_rows(spark, sf_dir).groupBy("record_id", "table_no", "n_cells").agg(F.count("*").alias("c"), F.min("row_no").alias("first_row"))
    k = F.row_number().over(Window.partitionBy("record_id", "table_no").orderBy(F.desc("c"), "first_row"))
    return c.withColumn("k", k).where("k = 1").select("record_id", "table_no", "n_cells")


@query(f"SELECT {_T.format('canonical_name')} AS canonical_name, CAST(count(DISTINCT record_id) AS BIGINT) AS n FROM {_ENTITIES} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def topk_canonical(spark, sf_dir):
    """The ten canonical names in most records."""
    return _entities(spark, sf_dir).groupBy("canonical_name").agg(F.countDistinct("record_id").alias("n")).orderBy(F.desc("n"), "canonical_name").limit(10)


@query(f"SELECT document_id, n, first_line FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY n DESC, first_line) AS k FROM ({relational.SQL['win_toc_cluster']})) WHERE k = 1")
def win_best_toc(spark, sf_dir):
    """Each document's run with most items, the earliest of equals."""
    k = F.row_number().over(Window.partitionBy("document_id").orderBy(F.desc("n"), "first_line"))
    return relational.win_toc_cluster(spark, sf_dir).withColumn("k", k).where("k = 1").select("document_id", "n", "first_line")


_STANDARD = ", ".join(f"('{k}', {i})" for i, k in enumerate(R.STANDARD_ITEMS))
_FOUND_SQL = f"(SELECT d.document_id, s.item_key, s.nth, f.line_no FROM (SELECT DISTINCT document_id FROM ({relational.SQL['win_first_seen']})) d CROSS JOIN (VALUES {_STANDARD}) s(item_key, nth) LEFT JOIN ({relational.SQL['win_first_seen']}) f ON f.document_id = d.document_id AND f.item_key = s.item_key)"


def _standard(spark, sf_dir):
    """Every document with every standard item (a fixed list) and the line where it is first seen, or null."""
    seen = relational.win_first_seen(spark, sf_dir)
    items = F.explode(F.array(*(F.struct(F.lit(k).alias("item_key"), F.lit(i).alias("at")) for i, k in enumerate(R.STANDARD_ITEMS)))).alias("s")
    return seen.select("document_id").distinct().select("document_id", items).select("document_id", "s.*").join(seen, ["document_id", "item_key"], "left")


@query(f"""SELECT document_id, item_key, last_value(line_no IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
 first_value(line_no IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY nth ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM {_FOUND_SQL}""")
def win_prev_next_found(spark, sf_dir):
    """The nearest items found before and after each standard item."""
    w = Window.partitionBy("document_id").orderBy("at")
    before = F.last("line_no", True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("line_no", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return _standard(spark, sf_dir).select("document_id", "item_key", before.alias("before"), after.alias("after"))


@query(f"SELECT document_id, item_key FROM {_FOUND_SQL} WHERE line_no IS NULL")
def except_missing(spark, sf_dir):
    """Standard items that a document doesn't list."""
    return _standard(spark, sf_dir).where("line_no IS NULL").select("document_id", "item_key")


@query(f"SELECT record_id, s AS summary, min(no) AS table_no FROM (SELECT record_id, no, {_T.format('summary')} AS s FROM {_TABLES}) WHERE s IS NOT NULL GROUP BY 1, 2")
def win_raw_dedup(spark, sf_dir):
    """The first table of each summary in a record."""
    return _tables(spark, sf_dir).where("summary IS NOT NULL").groupBy("record_id", "summary").agg(F.min("table_no").alias("table_no"))


@query(f"SELECT {_T.format('canonical_name')} AS canonical_name, CAST(sum(CAST({_T.format('mention_count')} AS BIGINT)) AS BIGINT) AS mentions FROM {_ENTITIES} WHERE {_T.format('mention_count')} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def sort_groups(spark, sf_dir):
    """The groups most mentioned."""
    e = _entities(spark, sf_dir).where("mention_count IS NOT NULL").groupBy("canonical_name").agg(F.sum("mention_count").alias("mentions"))
    return e.orderBy(F.desc("mentions"), "canonical_name").limit(25)


_WORDS_SQL = "string_split(clean, ' ')"


@query(f"SELECT name FROM ({relational.SQL['normalize_company']}) WHERE list_has_any({_WORDS_SQL}, [{relational._in(R.CONTAINMENT_TOKENS)}])")
def intersect_tokens(spark, sf_dir):
    """Names with a word that sets a unit apart."""
    n = relational.normalize_company(spark, sf_dir)
    return n.where(F.arrays_overlap(F.split("clean", " "), F.array(*map(F.lit, R.CONTAINMENT_TOKENS)))).select("name")


@query(f"""SELECT record_id, CAST(len(regexp_extract_all(line, '\\(?\\$?\\s*[0-9,]+(?:\\.[0-9]+)?\\s*%?\\)?')) AS BIGINT) AS cells, CAST(line_no AS BIGINT) AS line_no FROM (SELECT record_id, unnest(string_split(chunk_text, chr(10))) AS line, generate_subscripts(string_split(chunk_text, chr(10)), 1) AS line_no
 FROM {SQL_CHUNKS} WHERE table_count > 0) WHERE line LIKE '%   %'""")
def extract_cells(spark, sf_dir):
    """Figures of the spaced lines of texts with tables."""
    lines = chunks(spark, sf_dir, "chunk_text", "table_count").where("table_count > 0").select("record_id", F.posexplode(F.split("chunk_text", "\n")).alias("i", "line"))
    cells = F.size(F.regexp_extract_all("line", F.lit(f"({R.CELL})"), F.lit(1)))
    return lines.where(F.col("line").contains("   ")).select("record_id", cells.cast("bigint").alias("cells"), (F.col("i") + 1).cast("bigint").alias("line_no"))


_LINES_SQL = f"(SELECT record_id, unnest(string_split(chunk_text, chr(10))) AS line, CAST(generate_subscripts(string_split(chunk_text, chr(10)), 1) AS BIGINT) AS line_no FROM {SQL_CHUNKS} WHERE table_count > 0)"


@query(f"""SELECT record_id, line_no, CAST(len(list_filter(list_transform(string_split_regex(trim(line), '\\s{{2,}}|\\t'), lambda x: trim(x)), lambda x: x <> '')) AS BIGINT) AS labels FROM {_LINES_SQL} WHERE regexp_matches(line, '\\b(?:19|20)[0-9]{{2}}\\b') AND line LIKE '%   %'""")
def column_header(spark, sf_dir):
    """Spaced lines that name years, and how many labels they have."""
    lines = chunks(spark, sf_dir, "chunk_text", "table_count").where("table_count > 0").select("record_id", F.posexplode(F.split("chunk_text", "\n")).alias("i", "line"))
    labels = F.size(F.filter(F.transform(F.split(F.trim("line"), r"\s{2,}|\t"), lambda x: F.trim(x)), lambda x: x != ""))
    return lines.where(F.col("line").rlike(R.YEAR) & F.col("line").contains("   ")).select("record_id", (F.col("i") + 1).cast("bigint").alias("line_no"), labels.cast("bigint").alias("labels"))


_UNIT_LINE = "(?i)\\((?:in|dollars in|amounts in)\\s+(?:millions?|thousands?|billions?)[^)]*\\)"


@query(f"""SELECT record_id, anchor, header FROM (SELECT a.record_id, a.line_no AS anchor, h.line_no AS header, row_number() OVER (PARTITION BY a.record_id, a.line_no ORDER BY abs(h.line_no - a.line_no), h.line_no) AS k
 FROM (SELECT * FROM {_LINES_SQL} WHERE regexp_matches(line, '{_UNIT_LINE}')) a JOIN (SELECT * FROM {_LINES_SQL} WHERE regexp_matches(line, '\\b(?:19|20)[0-9]{{2}}\\b')) h ON a.record_id = h.record_id AND abs(h.line_no - a.line_no) <= 8) WHERE k = 1""")
def nearest_header(spark, sf_dir):
    """The line with years nearest to each units line, within eight lines."""
    lines = chunks(spark, sf_dir, "chunk_text", "table_count").where("table_count > 0").select("record_id", F.posexplode(F.split("chunk_text", "\n")).alias("i", "line"))
    a = lines.where(F.col("line").rlike(f"(?i){R.UNITS_ANCHOR}")).select("record_id", (F.col("i") + 1).cast("bigint").alias("anchor"))
    h = lines.where(F.col("line").rlike(R.YEAR)).select("record_id", (F.col("i") + 1).cast("bigint").alias("header"))
    far = F.abs(F.col("header") - F.col("anchor"))
    near = a.join(h, "record_id").where(far <= 8)
    return near.groupBy("record_id", "anchor").agg(F.min(F.struct(far, "header")).alias("m")).select("record_id", "anchor", "m.header")


@query(f"SELECT record_id, line_no, string_agg(c, '~' ORDER BY i) AS cells FROM (SELECT record_id, line_no, unnest(list_transform(string_split(line, '|'), lambda x: trim(x))) AS c, generate_subscripts(string_split(line, '|'), 1) AS i FROM {_LINES_SQL} WHERE regexp_matches(line, '\\|[^|\\n]+\\|') AND NOT regexp_matches(line, '^[|\\-\\s]+$')) WHERE c <> '' GROUP BY 1, 2")
def pipe_split(spark, sf_dir):
    """Cells of pipe lines."""
    lines = chunks(spark, sf_dir, "chunk_text", "table_count").where("table_count > 0").select("record_id", F.posexplode(F.split("chunk_text", "\n")).alias("i", "line"))
    cells = F.filter(F.transform(F.split("line", "[|]"), lambda x: F.trim(x)), lambda x: x != "")
    return lines.where(F.col("line").rlike(R.PIPE_ROW) & ~F.col("line").rlike(r"^[|\-\s]+$")).select("record_id", (F.col("i") + 1).cast("bigint").alias("line_no"), F.array_join(cells, "~").alias("cells")).where("cells <> ''")


@query(f"SELECT record_id, sha256(chunk_text) AS cache_key FROM {SQL_CHUNKS} WHERE chunk_text IS NOT NULL")
def cache_key(spark, sf_dir):
    """Content keys."""
    return chunks(spark, sf_dir, "chunk_text").where("chunk_text IS NOT NULL").select("record_id", F.sha2("chunk_text", 256).alias("cache_key"))


@query()
def fuzzy_scores(spark, sf_dir):
    """Ratio, sorted, set and partial scores of the names that share a block key in a document."""

    @F.pandas_udf("ratio double, token_sort double, token_set double, partial double")
    def score(a, b):
        import pandas as pd

        return pd.DataFrame([fuzzy.scores(x, y) for x, y in zip(a, b)], columns=["ratio", "token_sort", "token_set", "partial"]).round(4)

    n = mentions(spark, sf_dir).where("entity_type = 'company'").select("document_id", "name", C.normalize_company(F.col("name")).alias("norm")).distinct()
    k = n.select("document_id", "name", "norm", F.explode(resolve.block_keys(F.col("norm"), F.col("name"), F.lit("company"))).alias("key"))
    a, b = k.selectExpr("document_id", "key", "name AS name_a", "norm AS norm_a"), k.selectExpr("document_id", "key", "name AS name_b", "norm AS norm_b")
    pairs = a.join(b, ["document_id", "key"]).where("name_a < name_b").drop("key").distinct()
    return pairs.select("document_id", "name_a", "name_b", score("norm_a", "norm_b").alias("s")).select("document_id", "name_a", "name_b", "s.*")
