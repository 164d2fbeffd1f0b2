"""Queries on single rules: lines, names, pairs of names, cells, columns, replies, costs; each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions import rules as R
from ledgerloom.operators import graph, nested, resolve, table_enrich
from ledgerloom.operators.sections import toc_snippet as snippet_of
from ledgerloom.plans import relational, training
from ledgerloom.plans.base import SQL_CHUNKS, SQL_FILINGS, chunks, filings
from ledgerloom.plans.documents import _MONEY_SQL, money
from ledgerloom.session import cut
from ledgerloom.sources import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_in = relational._in


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- lines ----------------------------------------------------------------------------------------------------------

_LINES_SQL = f"(SELECT record_id, unnest(string_split(chunk_text, chr(10))) AS line, CAST(generate_subscripts(string_split(chunk_text, chr(10)), 1) AS BIGINT) AS line_no FROM {SQL_CHUNKS} WHERE chunk_text IS NOT NULL)"
_OPENINGS_SQL = f"(SELECT document_id, unnest(string_split(raw_text, chr(10))) AS line, CAST(generate_subscripts(string_split(raw_text, chr(10)), 1) AS BIGINT) AS line_no FROM {SQL_FILINGS} WHERE raw_text IS NOT NULL)"


def _lines(spark, sf_dir) -> DataFrame:
    lines = chunks(spark, sf_dir, "chunk_text").where("chunk_text IS NOT NULL").select("record_id", F.posexplode(F.split("chunk_text", "\n")).alias("i", "line"))
    return lines.select("record_id", (F.col("i") + 1).cast("bigint").alias("line_no"), "line")


def _openings(spark, sf_dir) -> DataFrame:
    return relational._lines(spark, sf_dir)


@query(f"SELECT record_id, line_no FROM {_LINES_SQL} WHERE regexp_matches(line, '(?i){R.SKIP_LINE}')")
def skip_line(spark, sf_dir):
    """Lines that tables pass over: page numbers, contents headers, rules."""
    return _lines(spark, sf_dir).where(F.col("line").rlike(f"(?i){R.SKIP_LINE}")).select("record_id", "line_no")


@query(f"SELECT record_id, line_no FROM {_LINES_SQL} WHERE regexp_matches(line, '{R.FOOTNOTE_LINE}')")
def footnote_line(spark, sf_dir):
    """Lines that open a footnote."""
    return _lines(spark, sf_dir).where(F.col("line").rlike(R.FOOTNOTE_LINE)).select("record_id", "line_no")


@query(f"SELECT document_id, line_no FROM {_OPENINGS_SQL} WHERE regexp_matches(trim(line), '(?i){R.STOP_LINE}')")
def stop_line(spark, sf_dir):
    """Lines at which a table ends."""
    return _openings(spark, sf_dir).where(F.trim("line").rlike(f"(?i){R.STOP_LINE}")).select("document_id", "line_no")


@query(f"SELECT record_id, line_no, coalesce(nullif(trim(regexp_extract(line, '^([^$0-9(]+)', 1)), ''), line) AS label FROM {_LINES_SQL} WHERE line LIKE '%   %'")
def extract_label(spark, sf_dir):
    """The label of each spaced line: what precedes the first figure, else the line."""
    label = F.trim(F.regexp_extract("line", r"^([^$\d(]+)", 1))
    return _lines(spark, sf_dir).where(F.col("line").contains("   ")).select("record_id", "line_no", F.coalesce(F.nullif(label, F.lit("")), "line").alias("label"))


_VALUE = "regexp_matches(line, '^[\\s\\x{00A0}$%().,\\-—–]*[0-9][0-9\\s$%().,\\-—–]*$')"


@query(f"""SELECT record_id, min(line_no) AS line_no, CAST(sum(cells) AS BIGINT) AS cells FROM (SELECT *, sum(CASE WHEN is_value THEN 0 ELSE 1 END) OVER (PARTITION BY record_id ORDER BY line_no) AS row_no
 FROM (SELECT record_id, line_no, {_VALUE} AS is_value, len(regexp_extract_all(line, '\\(?\\$?\\s*[0-9,]+(?:\\.[0-9]+)?\\s*%?\\)?')) AS cells FROM {_LINES_SQL}
 WHERE trim(line) <> '' AND NOT regexp_matches(line, '(?i){R.SKIP_LINE}') AND NOT regexp_matches(line, '{R.FOOTNOTE_LINE}'))) WHERE row_no > 0 GROUP BY record_id, row_no HAVING sum(cells) > 0""")
def win_row_machine(spark, sf_dir):
    """Rows of figures: a labelled line opens a row, lines of figures alone extend it; a running count of labels numbers the rows."""
    lines = _lines(spark, sf_dir).where((F.trim("line") != "") & ~F.col("line").rlike(f"(?i){R.SKIP_LINE}") & ~F.col("line").rlike(R.FOOTNOTE_LINE))
    cells = F.size(F.regexp_extract_all("line", F.lit(f"({R.CELL})"), F.lit(1)))
    in_order = Window.partitionBy("record_id").orderBy("line_no")
    rows = lines.select("record_id", "line_no", cells.alias("cells"), F.sum((~F.col("line").rlike(R.VALUE_LINE)).cast("int")).over(in_order).alias("row_no"))
    return rows.where("row_no > 0").groupBy("record_id", "row_no").agg(F.min("line_no").alias("line_no"), F.sum("cells").alias("cells")).where("cells > 0").drop("row_no")


_ONLY_NUMBER = "(?i)^\\s*item\\s+[0-9]+[a-z]?[.\\s]*$"


@query(f"""SELECT document_id, line_no, trim(line) || CASE WHEN regexp_matches(line, '{_ONLY_NUMBER}') THEN coalesce(' ' || trim(next_line), '') ELSE '' END AS heading
 FROM (SELECT *, lead(line) OVER (PARTITION BY document_id ORDER BY line_no) AS next_line FROM {_OPENINGS_SQL} WHERE trim(line) <> '') WHERE regexp_matches(line, '(?i)^\\s*item\\s+[0-9]')""")
def heading_text(spark, sf_dir):
    """The text of each item's line; of a bare number, with the next line that isn't blank."""
    following = F.lead("line").over(Window.partitionBy("document_id").orderBy("line_no"))
    lines = _openings(spark, sf_dir).where(F.trim("line") != "").withColumn("following", following).where(F.col("line").rlike(r"(?i)^\s*item\s+[0-9]"))
    more = F.when(F.col("line").rlike(r"(?i)^\s*item\s+[0-9]+[a-z]?[.\s]*$"), F.concat(F.lit(" "), F.trim("following")))
    return lines.select("document_id", "line_no", F.concat(F.trim("line"), F.coalesce(more, F.lit(""))).alias("heading"))


_BODY = "(?i)^[ \\t\\x{00A0}]*(?:part[\\s\\x{00A0}]+[^\\s\\x{00A0}]+[\\s\\x{00A0}]+)?item[\\s\\x{00A0}]+([0-9]+[A-Za-z]?)[.:\\s\\x{00A0}–—](?:[^0-9]|$)"
_BODY_JAVA = r"(?i)^[ \t\xa0]*(?:part[\s\xa0]+[^\s\xa0]+[\s\xa0]+)?item[\s\xa0]+([0-9]+[A-Za-z]?)[.:\s\xa0–—](?!\d)"


@query(f"SELECT document_id, line_no, upper(regexp_extract(line, '{_BODY}', 1)) AS item_key FROM {_OPENINGS_SQL} WHERE regexp_matches(line, '{_BODY}')")
def item_body_re(spark, sf_dir):
    """Lines that open with an item as a heading does, whatever its number."""
    lines = _openings(spark, sf_dir).where(F.col("line").rlike(_BODY_JAVA))
    return lines.select("document_id", "line_no", F.upper(F.regexp_extract("line", _BODY_JAVA, 1)).alias("item_key"))


_LOOSE = "(?i)\\bitem[\\s\\x{00A0}]+([0-9]+[A-Za-z]?)[.:\\s\\x{00A0}–—](?:[^0-9]|$)"


@query(f"SELECT document_id, line_no, upper(regexp_extract(line, '{_LOOSE}', 1)) AS item_key FROM {_OPENINGS_SQL} WHERE regexp_matches(line, '{_LOOSE}')")
def item_loose_re(spark, sf_dir):
    """Lines that hold an item anywhere."""
    loose = r"(?i)\bitem[\s\xa0]+([0-9]+[A-Za-z]?)[.:\s\xa0–—](?!\d)"
    lines = _openings(spark, sf_dir).where(F.col("line").rlike(loose))
    return lines.select("document_id", "line_no", F.upper(F.regexp_extract("line", loose, 1)).alias("item_key"))


@query(f"""SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY line_no) AS BIGINT) AS nth, item_key FROM ({SQL['item_body_re']})""")
def sort_headings(spark, sf_dir):
    """Headings of each opening by position."""
    nth = F.row_number().over(Window.partitionBy("document_id").orderBy("line_no")).cast("bigint")
    return item_body_re(spark, sf_dir).select("document_id", nth.alias("nth"), "item_key")


@query(f"SELECT DISTINCT document_id, item_key FROM ({relational.SQL['win_first_seen']}) UNION SELECT document_id, k FROM (SELECT DISTINCT document_id FROM ({relational.SQL['win_first_seen']})), (VALUES {', '.join(f'({k!r})' for k in R.STANDARD_ITEMS)}) t(k)")
def union_distinct_items(spark, sf_dir):
    """The items of each list and the standard ones, each once."""
    seen = relational.win_first_seen(spark, sf_dir).select("document_id", "item_key")
    standard = seen.select("document_id").distinct().select("document_id", F.explode(F.array(*map(F.lit, R.STANDARD_ITEMS))).alias("item_key"))
    return seen.union(standard).distinct()


@query(f"""SELECT document_id, source, CAST(length(CASE source WHEN 'toc_header' THEN substr(raw_text, strpos(raw_text, h), 5000) ELSE substr(raw_text, 1, 8000) END) AS BIGINT) AS n_chars
 FROM (SELECT document_id, raw_text, h, CASE WHEN h <> '' THEN 'toc_header' ELSE 'document_start' END AS source FROM (SELECT document_id, raw_text, regexp_extract(substr(raw_text, 1, {R.TOC_SEARCH}), '(?i)table[\\s\\x{{00A0}}]+of[\\s\\x{{00A0}}]+contents') AS h FROM {SQL_FILINGS} WHERE raw_text IS NOT NULL))""")
def toc_snippet(spark, sf_dir):
    """What a provider of contents lists is shown: the stretch from the contents header, else the start."""
    s = snippet_of(F.col("raw_text"))
    return filings(spark, sf_dir, "raw_text").where("raw_text IS NOT NULL").select("document_id", s["source"].alias("source"), F.length(s["snippet"]).cast("bigint").alias("n_chars"))


@query(f"SELECT record_id, preview FROM (SELECT record_id, CASE WHEN length(heading) > 20 THEN substr(heading, 1, 20) || '…' ELSE heading END AS preview FROM {SQL_CHUNKS} WHERE heading IS NOT NULL)")
def truncate(spark, sf_dir):
    """Headings cut to 20 characters with an ellipsis."""
    return chunks(spark, sf_dir, "heading").where("heading IS NOT NULL").select("record_id", C.preview(F.col("heading"), 20).alias("preview"))


# ---- money ----------------------------------------------------------------------------------------------------------

_AT = "CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INTEGER)"
_SPLIT_SQL = f"(SELECT record_id, regexp_extract_all(chunk_text, '{_MONEY_SQL}', 1) AS m, string_split_regex(chunk_text, '{_MONEY_SQL}') AS g FROM {SQL_CHUNKS} WHERE chunk_text IS NOT NULL)"
_FOUND_MONEY_SQL = f"(SELECT record_id, {_AT} AS start, m[i] AS match, lower(m[i]) AS low FROM (SELECT record_id, m, g, unnest(generate_series(1, len(m))) AS i FROM {_SPLIT_SQL}))"
_NUMBER_SQL = "CAST(replace(regexp_extract(low, '([0-9][0-9,]*(?:\\.[0-9]+)?)', 1), ',', '') AS DOUBLE)"


@query(f"""SELECT record_id, start, CAST(start + length(match) AS INTEGER) AS "end", match,
 CASE {' '.join(f"WHEN starts_with(low, '{k}') THEN '{v}'" for k, v in R.MONEY_SYMBOLS.items())} {' '.join(f"WHEN regexp_matches(low, '{k}s?$') THEN '{v}'" for k, v in R.MONEY_WORDS.items())} ELSE 'USD' END AS currency,
 round({_NUMBER_SQL} * CASE {' '.join(f"WHEN contains(low, '{k}') THEN {v:.0f}" for k, v in R.MAGNITUDES.items())} ELSE 1 END, 2) AS amount FROM {_FOUND_MONEY_SQL}""")
def money_amounts(spark, sf_dir):
    """Money with offsets, currency and amount; the text at the offsets is the match."""
    return money(spark, sf_dir).select("record_id", "start", "end", "match", "currency", F.round("amount", 2).alias("amount"))


@query(f"SELECT record_id, start, {_NUMBER_SQL} AS number FROM {_FOUND_MONEY_SQL}")
def parse_number(spark, sf_dir):
    """The number of each amount, without its separators."""
    number = F.regexp_extract(F.lower("match"), f"({R.MONEY_NUMBER})", 1)
    return money(spark, sf_dir).select("record_id", "start", F.replace(number, F.lit(","), F.lit("")).try_cast("double").alias("number"))


@query(f"SELECT record_id, bucket, min(start) AS start FROM (SELECT record_id, start, CAST(floor(start / 200) AS BIGINT) AS bucket FROM {_FOUND_MONEY_SQL}) GROUP BY 1, 2")
def win_anchor_dedup(spark, sf_dir):
    """The first anchor of every stretch of 200 characters."""
    return money(spark, sf_dir).groupBy("record_id", F.floor(F.col("start") / 200).alias("bucket")).agg(F.min("start").alias("start"))


# ---- mentions and names ---------------------------------------------------------------------------------------------

_MENTIONS_SQL = f"""(SELECT record_id, document_id, chunk_index, i AS no, json_extract_string(ee[i], '$.entity_type') AS entity_type, json_extract_string(ee[i], '$.text') AS name, CAST(json_extract_string(ee[i], '$.start_char') AS BIGINT) AS start_char FROM (SELECT *, unnest(generate_series(1, len(ee))) AS i FROM (SELECT record_id, document_id, chunk_index,
 CASE json_type(j) WHEN 'ARRAY' THEN CAST(j AS JSON[]) WHEN 'OBJECT' THEN coalesce(CASE json_type(j, '$.entities') WHEN 'ARRAY' THEN CAST(json_extract(j, '$.entities') AS JSON[]) END, [j]) ELSE [] END AS ee
 FROM (SELECT record_id, document_id, chunk_index, CASE WHEN json_valid(entities_json) THEN CASE WHEN json_type(entities_json) = 'VARCHAR' THEN CASE WHEN json_valid(json_extract_string(entities_json, '$')) THEN CAST(json_extract_string(entities_json, '$') AS JSON) END
 ELSE CAST(entities_json AS JSON) END END AS j FROM {SQL_CHUNKS}))))"""


def _mentions(spark, sf_dir) -> DataFrame:
    """(document_id, record_id, no, entity_type, name, start_char), no from 1."""
    parsed = nested.with_parsed(chunks(spark, sf_dir, "document_id", "entities_json"), "entities_json")
    get = lambda m, path, kind: F.try_variant_get(m, path, kind)
    one = F.transform("entities_json", lambda m, i: F.struct((i + 1).cast("bigint").alias("no"), get(m, "$.entity_type", "string").alias("entity_type"), get(m, "$.text", "string").alias("name"), get(m, "$.start_char", "bigint").alias("start_char")))
    return parsed.select("document_id", "record_id", F.inline(one))


@query(f"SELECT record_id, string_agg(name, ', ' ORDER BY no) AS entity_names FROM {_MENTIONS_SQL} WHERE name <> '' GROUP BY 1")
def entity_names(spark, sf_dir):
    """The texts of a record's mentions, in order."""
    ordered = F.sort_array(F.collect_list(F.struct("no", "name")))
    return _mentions(spark, sf_dir).where("name <> ''").groupBy("record_id").agg(F.array_join(F.transform(ordered, lambda x: x["name"]), ", ").alias("entity_names"))


@query(f"""SELECT m.record_id, no, string_split(substr(chunk_text, 1, start_char), chr(10))[-1] || string_split(substr(chunk_text, start_char + 1), chr(10))[1] AS line FROM {_MENTIONS_SQL} m JOIN {SQL_CHUNKS} c USING (record_id)
 WHERE entity_type = 'person' AND start_char > 0 AND start_char < length(chunk_text)""")
def entity_line(spark, sf_dir):
    """The line that each person's mention stands in."""
    m = _mentions(spark, sf_dir).where("entity_type = 'person' AND start_char > 0").drop("document_id")
    j = m.join(chunks(spark, sf_dir, "chunk_text"), "record_id").where("start_char < length(chunk_text)")
    return j.select("record_id", "no", C.line_at(F.col("chunk_text"), F.col("start_char").cast("int")).alias("line"))


@query(f"SELECT record_id, kind, CAST(count(*) AS BIGINT) AS n FROM (SELECT record_id, entity_type AS kind FROM {_MENTIONS_SQL} WHERE entity_type IN ('company', 'person') UNION ALL SELECT record_id, 'monetary_value' FROM {_FOUND_MONEY_SQL}) GROUP BY 1, 2")
def union_entities(spark, sf_dir):
    """Named mentions and money found in the text, one below the other, counted."""
    named = _mentions(spark, sf_dir).where(F.col("entity_type").isin("company", "person")).select("record_id", F.col("entity_type").alias("kind"))
    return named.unionByName(money(spark, sf_dir).select("record_id", F.lit("monetary_value").alias("kind"))).groupBy("record_id", "kind").agg(F.count("*").alias("n"))


_CLEAN = relational._CLEAN_SQL
_COMPANY = relational._COMPANY_SQL
_PERSON = f"array_to_string(list_filter(string_split(regexp_replace({_CLEAN}, '^(?:{'|'.join(R.PERSON_TITLES)})\\s+', ''), ' '), lambda w: NOT list_contains([{_in(R.PERSON_SUFFIXES)}], w)), ' ')"
_NAMED_SQL = f"(SELECT DISTINCT document_id, entity_type, name FROM {_MENTIONS_SQL} WHERE entity_type IN ('company', 'person') AND trim(name) <> '')"


def _named(spark, sf_dir) -> DataFrame:
    return _mentions(spark, sf_dir).where(F.col("entity_type").isin("company", "person") & (F.trim("name") != "")).select("document_id", "entity_type", "name").distinct()


@query(f"SELECT DISTINCT name, {_CLEAN} AS clean FROM {_NAMED_SQL}")
def clean_name(spark, sf_dir):
    """Names in lower case without possessives and punctuation."""
    return _named(spark, sf_dir).select("name", C.clean_name(F.col("name")).alias("clean")).distinct()


@query(f"SELECT DISTINCT name, {_PERSON} AS person FROM {_NAMED_SQL} WHERE entity_type = 'person'")
def normalize_person(spark, sf_dir):
    """Persons' names without title and generation."""
    return _named(spark, sf_dir).where("entity_type = 'person'").select("name", C.normalize_person(F.col("name")).alias("person")).distinct()


_NORMED_SQL = f"(SELECT document_id, entity_type, name, CASE entity_type WHEN 'company' THEN {_COMPANY} ELSE {_PERSON} END AS norm FROM {_NAMED_SQL})"
_TOK = "string_split(norm, ' ')"
_COUNTED = f"list_filter({_TOK}, lambda w: NOT list_contains([{_in(R.ACRONYM_IGNORED)}], w))"
_INITIALS = f"array_to_string(list_transform({_COUNTED}, lambda w: substr(w, 1, 1)), '')"


def _normed(spark, sf_dir) -> DataFrame:
    norm = F.when(F.col("entity_type") == "company", C.normalize_company(F.col("name"))).otherwise(C.normalize_person(F.col("name")))
    return _named(spark, sf_dir).withColumn("norm", norm)


_KEYS_SQL = f"""(SELECT DISTINCT document_id, entity_type, name, norm, unnest(list_filter(CASE entity_type WHEN 'company' THEN ['first:' || {_TOK}[1], 'last:' || {_TOK}[-1], CASE WHEN length({_INITIALS}) BETWEEN 2 AND 6 THEN 'acro:' || {_INITIALS} END,
 CASE WHEN regexp_matches(trim(name), '^[^a-z]{{2,6}}$') THEN 'acro:' || lower(trim(name)) END, CASE WHEN starts_with(norm, 'interpublic group') THEN 'acro:ipg' END]
 ELSE ['last:' || {_TOK}[-1], CASE WHEN len({_TOK}) >= 2 THEN 'first:' || {_TOK}[1] END, CASE WHEN len({_TOK}) >= 2 THEN 'fi:' || substr({_TOK}[1], 1, 1) || ':' || {_TOK}[-1] END] END, lambda k: k IS NOT NULL)) AS key FROM {_NORMED_SQL} WHERE norm <> '')"""


def _keyed(spark, sf_dir) -> DataFrame:
    n = _normed(spark, sf_dir)
    return n.select("*", F.explode(resolve.block_keys(F.col("norm"), F.col("name"), F.col("entity_type"))).alias("key"))


@query(f"SELECT DISTINCT entity_type, name, key FROM {_KEYS_SQL}")
def block_keys(spark, sf_dir):
    """Keys under which each name is compared."""
    return _keyed(spark, sf_dir).select("entity_type", "name", "key").distinct()


_PAIRS_SQL = f"(SELECT DISTINCT a.document_id, a.entity_type, a.name AS name_a, b.name AS name_b, a.norm AS norm_a, b.norm AS norm_b FROM {_KEYS_SQL} a JOIN {_KEYS_SQL} b ON a.document_id = b.document_id AND a.entity_type = b.entity_type AND a.key = b.key AND a.name < b.name)"


def _pairs(spark, sf_dir) -> DataFrame:
    k = cut(_keyed(spark, sf_dir), "keyed")
    a = k.select("document_id", "entity_type", "key", F.col("name").alias("name_a"), F.col("norm").alias("norm_a"))
    b = k.select("document_id", "entity_type", "key", F.col("name").alias("name_b"), F.col("norm").alias("norm_b"))
    return a.join(b, ["document_id", "entity_type", "key"]).where("name_a < name_b").drop("key").distinct()


@query(f"SELECT document_id, entity_type, name_a, name_b FROM {_PAIRS_SQL}")
def join_blocking(spark, sf_dir):
    """Pairs of names of a document that meet under a block key."""
    return _pairs(spark, sf_dir).select("document_id", "entity_type", "name_a", "name_b")


@query(f"SELECT a.document_id, a.entity_type, a.name AS name_a, b.name AS name_b FROM {_NORMED_SQL} a JOIN {_NORMED_SQL} b ON a.document_id = b.document_id AND a.entity_type = b.entity_type AND a.norm = b.norm AND a.name < b.name WHERE a.norm <> ''")
def join_norm_exact(spark, sf_dir):
    """Pairs of names of a document with one normal form."""
    n = cut(_normed(spark, sf_dir).where("norm <> ''"), "normed")
    scope = ["document_id", "entity_type", "norm"]
    return n.withColumnRenamed("name", "name_a").join(n.withColumnRenamed("name", "name_b"), scope).where("name_a < name_b").drop("norm")


def _acronym_sql(short: str, norm: str) -> str:
    words = _COUNTED.replace("norm", norm)
    return f"(length(trim({short})) BETWEEN 2 AND 6 AND trim({short}) = upper(trim({short})) AND regexp_matches(trim({short}), '\\p{{Lu}}') AND len({words}) >= 2 AND upper({words}[1]) <> trim({short}) AND ((trim({short}) = 'IPG' AND {words}[1:2] = ['interpublic', 'group']) OR upper({_INITIALS.replace('norm', norm)}) = trim({short})))"


@query(f"SELECT a.document_id, a.name AS short, b.name AS long FROM {_NORMED_SQL} a JOIN {_NORMED_SQL} b ON a.document_id = b.document_id WHERE a.entity_type = 'company' AND b.entity_type = 'company' AND {_acronym_sql('a.name', 'b.norm')}")
def join_caps_nested_loop(spark, sf_dir):
    """Capitals and the company names of the document that they are the initials of, by an equi-join on the initials."""
    n = cut(_normed(spark, sf_dir).where("entity_type = 'company'"), "normed")
    words = F.filter(F.split("norm", " "), lambda w: (w != "") & ~w.isin(*R.ACRONYM_IGNORED))
    initials = F.upper(F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), ""))
    known = F.when(F.slice(words, 1, 2) == F.array(F.lit("interpublic"), F.lit("group")), F.lit("IPG"))
    of_long = n.select("document_id", F.col("name").alias("long"), F.col("norm"), F.explode(F.array_distinct(F.array_compact(F.array(initials, known)))).alias("caps"))
    short = n.select("document_id", F.col("name").alias("short"), F.trim("name").alias("caps"))
    return short.join(of_long, ["document_id", "caps"]).where(resolve.is_acronym(F.col("short"), F.col("norm"))).select("document_id", "short", "long").distinct()


@query(f"SELECT document_id, name_a, name_b FROM {_PAIRS_SQL} WHERE entity_type = 'company' AND ({_acronym_sql('name_a', 'norm_b')} OR {_acronym_sql('name_b', 'norm_a')})")
def acronym_match(spark, sf_dir):
    """Pairs of which one is the other's acronym."""
    either = resolve.is_acronym(F.col("name_a"), F.col("norm_b")) | resolve.is_acronym(F.col("name_b"), F.col("norm_a"))
    return _pairs(spark, sf_dir).where((F.col("entity_type") == "company") & either).select("document_id", "name_a", "name_b")


def _inside_sql(a: str, b: str) -> str:
    x, y = f"string_split({a}, ' ')", f"string_split({b}, ' ')"
    return f"({a} <> '' AND list_has_all({y}, {x}) AND list_has_any(list_filter({y}, lambda w: NOT list_contains({x}, w)), [{_in(R.CONTAINMENT_TOKENS)}]))"


_CONTAINED = f"({_inside_sql('norm_a', 'norm_b')} OR {_inside_sql('norm_b', 'norm_a')})"


@query(f"SELECT document_id, name_a, name_b FROM {_PAIRS_SQL} WHERE entity_type = 'company' AND {_CONTAINED}")
def containment_guard(spark, sf_dir):
    """Pairs that are never merged, as one names a unit of the other."""
    guarded = resolve.contains_unit(F.col("norm_a"), F.col("norm_b"))
    return _pairs(spark, sf_dir).where((F.col("entity_type") == "company") & guarded).select("document_id", "name_a", "name_b")


@query(f"""SELECT document_id, name_a, name_b, CASE WHEN norm_a = norm_b THEN 'normalized_exact' WHEN {_CONTAINED} THEN 'no_match' WHEN {_acronym_sql('name_a', 'norm_b')} OR {_acronym_sql('name_b', 'norm_a')} THEN 'acronym'
 WHEN least(length(norm_a), length(norm_b)) < 5 THEN 'no_match' ELSE 'by score' END AS method FROM {_PAIRS_SQL} WHERE entity_type = 'company'""")
def merge_company(spark, sf_dir):
    """The rule that decides each pair of company names, or that the score does."""
    rule = resolve.company_rule(*map(F.col, ("name_a", "name_b", "norm_a", "norm_b")))
    return _pairs(spark, sf_dir).where("entity_type = 'company'").select("document_id", "name_a", "name_b", F.coalesce(rule["method"], F.lit("by score")).alias("method"))


def _full_sql(norm: str) -> str:
    return f"list_filter(string_split({norm}, ' '), lambda w: length(w) > 1)"


_PA, _PB = "string_split(norm_a, ' ')", "string_split(norm_b, ' ')"
_GIVEN = "list_transform({t}[1:len({t}) - 1], lambda w: substr(w, 1, 1))"


@query(f"""SELECT document_id, name_a, name_b, CASE WHEN norm_a = norm_b THEN 'normalized_exact' WHEN len({_PA}) < 2 OR len({_PB}) < 2 THEN 'no_match'
 WHEN len({_full_sql('norm_a')}) >= 2 AND len({_full_sql('norm_b')}) >= 2 AND {_full_sql('norm_a')}[1] = {_full_sql('norm_b')}[1] AND {_full_sql('norm_a')}[-1] = {_full_sql('norm_b')}[-1] THEN 'person_name'
 WHEN {_PA}[-1] = {_PB}[-1] AND {_GIVEN.format(t=_PA)} = {_GIVEN.format(t=_PB)} THEN 'person_initials' ELSE 'by score' END AS method FROM {_PAIRS_SQL} WHERE entity_type = 'person'""")
def merge_person(spark, sf_dir):
    """The rule that decides each pair of persons' names, or that the score does."""
    rule = resolve.person_rule(F.col("norm_a"), F.col("norm_b"))
    return _pairs(spark, sf_dir).where("entity_type = 'person'").select("document_id", "name_a", "name_b", F.coalesce(rule["method"], F.lit("by score")).alias("method"))


_FORMALITY = f"""(CASE WHEN list_contains([{_in(R.LEGAL_SUFFIXES)}], string_split(clean, ' ')[-1]) THEN 1 ELSE 0 END + CASE WHEN name = upper(name) AND regexp_matches(name, '\\p{{L}}') THEN 0 ELSE 1 END + CASE WHEN len(string_split(clean, ' ')) > 1 THEN 1 ELSE 0 END
 + CASE WHEN length(clean) >= 3 AND NOT contains(name, chr(10)) AND NOT regexp_matches(clean, '^[0-9]+$') THEN 1 ELSE 0 END - len(list_filter(string_split(clean, ' '), lambda w: list_contains([{_in(R.GENERIC_TOKENS)}], w))))"""


@query(f"SELECT name, CAST({_FORMALITY} AS INTEGER) AS formality FROM (SELECT DISTINCT name, {_CLEAN} AS clean FROM {_NAMED_SQL})")
def canonical_score(spark, sf_dir):
    """How formal each name is: the first part of what a canonical name is chosen by."""
    return _named(spark, sf_dir).select("name").distinct().select("name", resolve.canonical_score(F.col("name"), F.lit(1))["a"].cast("int").alias("formality"))


@query(f"""SELECT document_id, entity_type, norm, name FROM (SELECT *, row_number() OVER (PARTITION BY document_id, entity_type, norm ORDER BY {_FORMALITY} DESC, length(name) DESC, name) AS k FROM (SELECT *, {_CLEAN} AS clean FROM {_NORMED_SQL}) WHERE norm <> '') WHERE k = 1""")
def agg_canonical_argmax(spark, sf_dir):
    """The most formal, then longest name of each normal form in a document."""
    score = resolve.canonical_score(F.col("name"), F.lit(1))
    order = Window.partitionBy("document_id", "entity_type", "norm").orderBy(score["a"].desc(), F.length("name").desc(), "name")
    return _normed(spark, sf_dir).where("norm <> ''").withColumn("k", F.row_number().over(order)).where("k = 1").select("document_id", "entity_type", "norm", "name")


@query(f"""SELECT document_id, entity_type, norm, CAST(count(*) AS BIGINT) AS n_variants, string_agg(name, '|' ORDER BY name) AS variants FROM {_NORMED_SQL} WHERE norm <> '' GROUP BY 1, 2, 3""")
def agg_group_rollup(spark, sf_dir):
    """The variants of each normal form in a document."""
    variants = F.array_join(F.sort_array(F.collect_list("name")), "|")
    return _normed(spark, sf_dir).where("norm <> ''").groupBy("document_id", "entity_type", "norm").agg(F.count("*").alias("n_variants"), variants.alias("variants"))


_EDGES_SQL = f"(SELECT document_id, name_a AS a, name_b AS b FROM {_PAIRS_SQL} UNION ALL SELECT document_id, name_b, name_a FROM {_PAIRS_SQL})"


@query(f"""WITH RECURSIVE e AS MATERIALIZED {_EDGES_SQL}, r(document_id, node, seen) AS (SELECT DISTINCT document_id, a, a FROM e UNION SELECT r.document_id, r.node, e.b FROM r JOIN e ON e.document_id = r.document_id AND e.a = r.seen)
 SELECT document_id, node, min(seen) AS component FROM r GROUP BY 1, 2""")
def agg_components(spark, sf_dir):
    """Names of a document that hang together by shared keys, with the least name of each component."""
    return graph.components_within(cut(_pairs(spark, sf_dir), "pairs"), ["document_id"], "name_a", "name_b")


# ---- stored tables --------------------------------------------------------------------------------------------------

_COLUMNS_SQL = f"(SELECT record_id, no AS table_no, list_transform({training._list('e', '$.columns')}, lambda c: json_extract_string(c, '$')) AS columns FROM {training._TABLES})"


def _columns(spark, sf_dir) -> DataFrame:
    """(record_id, table_no, columns) of the stored tables."""
    parsed = nested.with_parsed(chunks(spark, sf_dir, "document_id", "tables_json"), "tables_json")
    rows = parsed.select("record_id", F.posexplode("tables_json").alias("table_no", "t"))
    names = F.transform(nested.items(F.try_variant_get("t", "$.columns", "variant")), lambda c: F.try_variant_get(c, "$", "string"))
    return rows.select("record_id", F.col("table_no").cast("bigint").alias("table_no"), F.coalesce(names, F.array().cast("array<string>")).alias("columns"))


@query(f"SELECT record_id, table_no, len(list_filter(columns, lambda c: c <> 'Item')) > 0 AND len(list_filter(columns, lambda c: c <> 'Item' AND NOT regexp_matches(c, '^Col[0-9]+$'))) = 0 AS generic FROM {_COLUMNS_SQL}")
def generic_columns(spark, sf_dir):
    """Whether a table has placeholders for all its value columns."""
    return _columns(spark, sf_dir).select("record_id", "table_no", table_enrich.generic_columns(F.col("columns")).alias("generic"))


@query(f"SELECT record_id, table_no, array_to_string(list_transform(range(1, len(columns) + 1), lambda i: 'c' || i || '=' || columns[i]), ';') AS renamed FROM {_COLUMNS_SQL} WHERE len(columns) > 0")
def remap_columns(spark, sf_dir):
    """Rows of one cell per column, renamed: the new names by position, the old as values."""
    t = _columns(spark, sf_dir).where(F.size("columns") > 0)
    row = F.map_from_arrays(F.array_distinct("columns"), F.array_distinct("columns"))
    new = F.transform("columns", lambda c, i: F.concat(F.lit("c"), (i + 1).cast("string")))
    renamed = F.get(table_enrich.remapped_rows(F.array(row), F.col("columns"), new), F.lit(0))
    ordered = F.transform(new, lambda c: F.concat(c, F.lit("="), F.try_element_at(renamed, c)))
    return t.select("record_id", "table_no", F.array_join(ordered, ";").alias("renamed"))


@query(f"SELECT record_id, table_no, array_to_string(columns[1:3], ', ') || CASE WHEN len(columns) > 3 THEN ' … ' || (len(columns) - 3) || ' more' ELSE '' END AS preview FROM {_COLUMNS_SQL}")
def slice_preview(spark, sf_dir):
    """The first three columns and how many are left out."""
    more = F.when(F.size("columns") > 3, F.concat(F.lit(" … "), (F.size("columns") - 3).cast("string"), F.lit(" more"))).otherwise("")
    return _columns(spark, sf_dir).select("record_id", "table_no", F.concat(F.array_join(F.slice("columns", 1, 3), ", "), more).alias("preview"))


_MOST = "(" + "SELECT record_id, table_no, n_cells FROM (SELECT *, row_number() OVER (PARTITION BY record_id, table_no ORDER BY c DESC, first_row) AS k FROM (SELECT record_id, table_no, n_cells, count(*) AS c, min(row_no) AS first_row FROM ({rows}) GROUP BY 1, 2, 3)) WHERE k = 1)".format(rows=training.SQL["p1_rows"])


@query(f"SELECT record_id, table_no, array_to_string(list_prepend('Item', list_transform(range(1, n_cells), lambda i: 'Col' || i)), ',') AS columns FROM {_MOST} WHERE n_cells > 1")
def infer_columns(spark, sf_dir):
    """Placeholder names for the most common number of cells."""
    c = training.p1_rows(spark, sf_dir).groupBy("record_id", "table_no", "n_cells").agg(F.count("*").alias("c"), F.min("row_no").alias("first_row"))
    k = F.row_number().over(Window.partitionBy("record_id", "table_no").orderBy(F.desc("c"), "first_row"))
    named = F.transform(F.sequence(F.lit(1), F.col("n_cells").cast("int") - 1), lambda i: F.concat(F.lit("Col"), i.cast("string")))
    return c.withColumn("k", k).where("k = 1 AND n_cells > 1").select("record_id", "table_no", F.array_join(F.concat(F.array(F.lit("Item")), named), ",").alias("columns"))


_ISLANDS_SQL = f"(SELECT record_id, line_no, line, line_no - row_number() OVER (PARTITION BY record_id ORDER BY line_no) AS island FROM {_LINES_SQL} WHERE regexp_matches(line, '\\|[^|\\n]+\\|'))"
_PIPE_CELLS_SQL = "list_filter(list_transform(string_split(line, '|'), lambda x: trim(x)), lambda x: x <> '')"
_PIPE_ROWS_SQL = f"(SELECT *, row_number() OVER (PARTITION BY record_id, island ORDER BY line_no) AS k, first_value({_PIPE_CELLS_SQL}) OVER (PARTITION BY record_id, island ORDER BY line_no) AS head FROM {_ISLANDS_SQL} WHERE NOT regexp_matches(line, '^[|\\-\\s]+$'))"


def _pipe_rows(spark, sf_dir) -> DataFrame:
    """(record_id, line_no, island, k, cells, head) of the lines of pipe tables, rules left out."""
    piped = _lines(spark, sf_dir).where(F.col("line").rlike(R.PIPE_ROW))
    by_record = Window.partitionBy("record_id").orderBy("line_no")
    islands = piped.withColumn("island", F.col("line_no") - F.row_number().over(by_record)).where(~F.col("line").rlike(r"^[|\-\s]+$"))
    cells = F.filter(F.transform(F.split("line", "[|]"), lambda x: F.trim(x)), lambda x: x != "")
    of_table = Window.partitionBy("record_id", "island").orderBy("line_no")
    return islands.withColumn("cells", cells).withColumn("k", F.row_number().over(of_table)).withColumn("head", F.first("cells").over(of_table))


@query(f"SELECT record_id, line_no, array_to_string(list_transform(range(1, len(c) + 1), lambda i: CASE WHEN len(c) = len(head) THEN head[i] ELSE CAST(i - 1 AS VARCHAR) END || '=' || c[i]), ';') AS cells FROM (SELECT *, {_PIPE_CELLS_SQL} AS c FROM {_PIPE_ROWS_SQL}) WHERE k > 1")
def pipe_rows(spark, sf_dir):
    """The cells of each row of a pipe table by the header's names, by number where the counts differ."""
    r = _pipe_rows(spark, sf_dir).where("k > 1")
    named = F.transform("cells", lambda c, i: F.concat(F.when(F.size("cells") == F.size("head"), F.get("head", i)).otherwise(i.cast("string")), F.lit("="), c))
    return r.select("record_id", "line_no", F.array_join(named, ";").alias("cells"))


@query(f"SELECT record_id, min(line_no) AS first_line, array_to_string(any_value(head), ',') AS columns, CAST(count(*) - 1 AS BIGINT) AS n_rows FROM {_PIPE_ROWS_SQL} GROUP BY record_id, island HAVING count(*) > 1")
def pipe_table(spark, sf_dir):
    """Pipe tables: where they start, their columns and how many rows they have."""
    t = _pipe_rows(spark, sf_dir).groupBy("record_id", "island").agg(F.min("line_no").alias("first_line"), F.array_join(F.first("head"), ",").alias("columns"), (F.count("*") - 1).alias("n_rows"))
    return t.where("n_rows > 0").drop("island")


@query(f"SELECT record_id, line_no, array_to_string(list_transform(range(1, 4), lambda i: coalesce(CASE WHEN len(c) = 3 THEN c[i] WHEN i = 1 THEN label ELSE c[i - 1] END, '')), '~') AS aligned FROM (SELECT record_id, line_no, trim(regexp_extract(line, '^([^$0-9(]*)', 1)) AS label, list_transform(regexp_extract_all(line, '\\(?\\$?\\s*[0-9,]+(?:\\.[0-9]+)?\\s*%?\\)?'), lambda x: trim(x)) AS c FROM {_LINES_SQL} WHERE line LIKE '%   %') WHERE len(c) > 0")
def align_rows(spark, sf_dir):
    """Figures of spaced lines on three columns: one to one where there are three, else label first, padded or cut."""
    cells = F.transform(F.regexp_extract_all("line", F.lit(f"({R.CELL})"), F.lit(1)), lambda x: F.trim(x))
    r = _lines(spark, sf_dir).where(F.col("line").contains("   ")).select("record_id", "line_no", F.trim(F.regexp_extract("line", r"^([^$\d(]*)", 1)).alias("label"), cells.alias("c")).where(F.size("c") > 0)
    at = lambda i: F.when(F.size("c") == 3, F.get("c", F.lit(i))).otherwise(F.get("c", F.lit(i - 1)) if i else F.col("label"))
    return r.select("record_id", "line_no", F.concat_ws("~", *(F.coalesce(at(i), F.lit("")) for i in range(3))).alias("aligned"))


@query(f"SELECT record_id, kind, CAST(count(*) AS BIGINT) AS n FROM (SELECT record_id, 'stored' AS kind FROM {training._TABLES} UNION ALL SELECT record_id, 'pipe' FROM ({SQL['pipe_table']})) GROUP BY 1, 2")
def union_tables(spark, sf_dir):
    """Tables stored and tables of pipes, one below the other, counted."""
    stored = training.p1_tables(spark, sf_dir).select("record_id", F.lit("stored").alias("kind"))
    return stored.union(pipe_table(spark, sf_dir).select("record_id", F.lit("pipe"))).groupBy("record_id", "kind").agg(F.count("*").alias("n"))


@query(f"SELECT document_id, part, n_chars FROM (SELECT document_id, 'opening' AS part, CAST(length(raw_text) AS BIGINT) AS n_chars FROM {SQL_FILINGS} WHERE raw_text <> '' UNION ALL SELECT document_id, heading, CAST(length(chunk_text) AS BIGINT) FROM {SQL_CHUNKS})")
def union_sections(spark, sf_dir):
    """What precedes the headings and the sections, one below the other."""
    opening = filings(spark, sf_dir, "raw_text").where("raw_text <> ''").select("document_id", F.lit("opening").alias("part"), F.length("raw_text").cast("bigint").alias("n_chars"))
    return opening.union(chunks(spark, sf_dir, "document_id", "heading", "chunk_text").select("document_id", "heading", F.length("chunk_text").cast("bigint")))


# ---- JSON, replies, costs, vectors ----------------------------------------------------------------------------------


@query(f"SELECT record_id, CAST(to_json({{'record_id': record_id, 'chunk_index': chunk_index, 'has_tables': has_tables}}) AS VARCHAR) AS json FROM {SQL_CHUNKS}")
def serialize_json(spark, sf_dir):
    """Members of a record as one JSON text, nulls written."""
    j = F.to_json(F.struct("record_id", "chunk_index", "has_tables"), {"ignoreNullFields": "false"})
    return chunks(spark, sf_dir, "chunk_index", "has_tables").select("record_id", j.alias("json"))


@query(f"SELECT document_id, line_no, upper(regexp_extract(line, '{_LOOSE}', 1)) AS item_key FROM {_OPENINGS_SQL} WHERE regexp_matches(line, '{_LOOSE}') AND regexp_matches(regexp_extract(line, '{_LOOSE}', 1), '^[0-9]{{1,2}}[A-Za-z]?$')")
def json_parse(spark, sf_dir):
    """Valid item keys read from replies: JSON lists, here fenced as models do, one of a single key for each line with an item."""
    reply = F.concat(F.lit('```json\n["'), F.lower("item_key"), F.lit('", "x"]\n```'))
    keys = table_enrich.reply_keys(reply)
    return item_loose_re(spark, sf_dir).select("document_id", "line_no", F.explode(keys).alias("item_key"))


@query("SELECT model, round(sum(prompt_tokens) / 1e6 * 0.4 + sum(completion_tokens) / 1e6 * 1.6, 9) AS cost FROM (SELECT DISTINCT * FROM toc_llm_metrics) WHERE prompt_tokens IS NOT NULL AND completion_tokens IS NOT NULL GROUP BY 1")
def llm_cost(spark, sf_dir):
    """Cost of the calls of each model by its tokens, repeated rows counted once."""
    m = read_table(spark, sf_dir, "toc_llm_metrics").distinct().dropna(subset=["prompt_tokens", "completion_tokens"])
    return m.groupBy("model").agg(F.round(table_enrich.call_cost(F.sum("prompt_tokens"), F.sum("completion_tokens")), 9).alias("cost"))


@query("""SELECT model, round(100.0 * count(*) FILTER (WHERE status = 'cache_hit') / count(*), 4) AS hit_pct, CAST(count(*) FILTER (WHERE status LIKE 'error%') AS BIGINT) AS errors, CAST(sum(items_returned) AS BIGINT) AS items,
 round(sum(estimated_cost_usd), 6) AS logged_cost FROM (SELECT DISTINCT * FROM toc_llm_metrics) GROUP BY 1""")
def agg_llm_hits(spark, sf_dir):
    """Share of calls that a cache answered, errors of either kind, items and logged cost per model."""
    m = read_table(spark, sf_dir, "toc_llm_metrics").distinct()
    return m.groupBy("model").agg(
        F.round(100.0 * F.count_if(F.col("status") == "cache_hit") / F.count("*"), 4).alias("hit_pct"), F.count_if(F.col("status").startswith("error")).alias("errors"),
        F.sum("items_returned").alias("items"), F.round(F.sum("estimated_cost_usd"), 6).alias("logged_cost"),
    )


@query("SELECT a.vec_id, round(list_sum(list_transform(list_zip(a.embedding, q.embedding), lambda p: CAST(p[1] AS DOUBLE) * CAST(p[2] AS DOUBLE))), 6) AS score FROM embeddings a, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q")
def inner_product(spark, sf_dir):
    """Each vector's inner product with the first one, which is a literal of the plan."""
    e = read_table(spark, sf_dir, "embeddings")
    first = e.orderBy("vec_id").select("embedding").first()
    q = F.array(*(F.lit(float(x)) for x in (first[0] if first else [])))
    dot = F.aggregate(F.zip_with(q, "embedding", lambda a, b: a * b.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return e.select("vec_id", F.round(dot, 6).alias("score"))


@query("SELECT doc_id, n_chars FROM documents")
def scan_parquet(spark, sf_dir):
    """Two columns of a table, which is all that the scan reads."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")


def quality(t: Column) -> Column:
    return C.page_quality(t)


_Q = "coalesce(text, '')"
_WARN_SQL = f"""list_filter([CASE WHEN length({_Q}) < {R.PAGE_MIN_CHARS} THEN 'very_short_text' END, CASE WHEN length({_Q}) >= {R.PAGE_MIN_CHARS} AND length(regexp_replace({_Q}, '[^\\p{{L}}]', '', 'g')) / greatest(length({_Q}), 1) < {R.PAGE_MIN_ALPHA} THEN 'low_alpha_ratio' END,
 CASE WHEN length(regexp_replace({_Q}, '[^\\x{{FFFD}}]', '', 'g')) / greatest(length({_Q}), 1) > {R.PAGE_MAX_REPLACED} THEN 'high_replacement_ratio' END,
 CASE WHEN len(ls) > 0 AND list_sum(list_transform(ls, lambda x: length(x))) / len(ls) < {R.PAGE_MIN_LINE} THEN 'short_lines' END], lambda x: x IS NOT NULL)"""


@query(f"""SELECT doc_id, round(greatest(0, 1 - 0.25 * len(w)), 2) AS score, array_to_string(w, ',') AS warnings, len(w) >= 2 OR list_contains(w, 'very_short_text') AS requires_fallback
 FROM (SELECT doc_id, {_WARN_SQL} AS w FROM (SELECT doc_id, text, list_filter(string_split({_Q}, chr(10)), lambda x: trim(x) <> '') AS ls FROM documents))""")
def pdf_quality_report(spark, sf_dir):
    """Score, warnings and fallback flag of every document text."""
    q = read_table(spark, sf_dir, "documents").select("doc_id", quality(F.col("text")).alias("q"))
    return q.select("doc_id", F.col("q.score").alias("score"), F.array_join("q.warnings", ",").alias("warnings"), F.col("q.requires_fallback").alias("requires_fallback"))


# ---- sections of the openings, by lines -----------------------------------------------------------------------------

_STRIP = "regexp_replace(regexp_replace({t}, '^[\\s\\x{{00A0}}]+', ''), '[\\s\\x{{00A0}}]+$', '')"


@query(f"SELECT document_id, record_id AS section_id, heading, section_category, CAST(length({_STRIP.format(t='chunk_text')}) AS BIGINT) AS n_chars FROM {SQL_CHUNKS} WHERE chunk_text IS NOT NULL")
def proj_section(spark, sf_dir):
    """The members of a section, its text without blanks at the ends."""
    c = chunks(spark, sf_dir, "document_id", "heading", "section_category", "chunk_text").where("chunk_text IS NOT NULL")
    plain = F.regexp_replace(F.regexp_replace("chunk_text", r"^[\s\xa0]+", ""), r"[\s\xa0]+$", "")
    return c.select("document_id", F.col("record_id").alias("section_id"), "heading", "section_category", F.length(plain).cast("bigint").alias("n_chars"))


_NUMBERED_SQL = f"(SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY line_no) AS section_no FROM (SELECT document_id, line_no, line, regexp_matches(line, '{_BODY}') AS head FROM {_OPENINGS_SQL}))"


@query(f"""SELECT document_id, CAST(section_no AS BIGINT) AS section_no, coalesce(max(trim(line)) FILTER (WHERE head), 'Preamble') AS heading, trim(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT head AND NOT regexp_matches(line, '^-{{20,}}\\s*$')), '')) AS body
 FROM {_NUMBERED_SQL} GROUP BY 1, 2""")
def build_sections(spark, sf_dir):
    """What precedes the first heading line of an opening, and the lines under each, page rules dropped: a running count of headings numbers the sections."""
    head = F.col("line").rlike(_BODY_JAVA)
    number = F.sum(head.cast("int")).over(Window.partitionBy("document_id").orderBy("line_no"))
    lines = _openings(spark, sf_dir).withColumn("section_no", number).withColumn("head", head)
    kept = F.when(~F.col("head") & ~F.col("line").rlike(r"^-{20,}\s*$"), F.struct("line_no", "line"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(kept)), lambda x: x["line"]), "\n")
    heading = F.coalesce(F.max(F.when(F.col("head"), F.trim("line"))), F.lit("Preamble"))
    return lines.groupBy("document_id", "section_no").agg(heading.alias("heading"), F.trim(body).alias("body"))


_STRICT_SQL = f"(SELECT document_id, item_key, min(line_no) AS line_no FROM ({SQL['item_body_re']}) GROUP BY 1, 2)"
_GRID_SQL = f"""(SELECT *, last_value(line_no IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low, first_value(line_no IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY nth ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS high
 FROM (SELECT d.document_id, k AS item_key, nth, line_no FROM (SELECT DISTINCT document_id FROM {_STRICT_SQL}) d CROSS JOIN (VALUES {', '.join(f"('{k}', {i})" for i, k in enumerate(R.STANDARD_ITEMS))}) t(k, nth) LEFT JOIN {_STRICT_SQL} s ON s.document_id = d.document_id AND s.item_key = k))"""


def _windows(spark, sf_dir) -> DataFrame:
    """(document_id, item_key, line_no, low, high) of every standard item: its heading line or null, and the nearest ones of the items before and after it."""
    found = item_body_re(spark, sf_dir).groupBy("document_id", "item_key").agg(F.min("line_no").alias("line_no"))
    items = F.explode(F.array(*(F.struct(F.lit(k).alias("item_key"), F.lit(i).alias("nth")) for i, k in enumerate(R.STANDARD_ITEMS)))).alias("s")
    grid = found.select("document_id").distinct().select("document_id", items).select("document_id", "s.*").join(found, ["document_id", "item_key"], "left")
    w = Window.partitionBy("document_id").orderBy("nth")
    low, high = F.last("line_no", True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.first("line_no", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return grid.select("document_id", "item_key", "line_no", low.alias("low"), high.alias("high"))


_LOOKED_SQL = f"SELECT g.document_id, g.item_key, min(l.line_no) AS line_no FROM {_GRID_SQL} g JOIN ({SQL['item_loose_re']}) l ON l.document_id = g.document_id AND l.item_key = g.item_key WHERE g.line_no IS NULL AND l.line_no > coalesce(g.low, 0) AND l.line_no < coalesce(g.high, 1000000000) GROUP BY 1, 2"


@query(_LOOKED_SQL)
def interval_window_lookup(spark, sf_dir):
    """Items without a heading line, found between the headings of their neighbours."""
    lacking = _windows(spark, sf_dir).where("line_no IS NULL").drop("line_no")
    near = lacking.join(item_loose_re(spark, sf_dir), ["document_id", "item_key"]).where("line_no > coalesce(low, 0) AND line_no < coalesce(high, 1000000000)")
    return near.groupBy("document_id", "item_key").agg(F.min("line_no").alias("line_no"))


@query(f"SELECT document_id, item_key, line_no FROM {_GRID_SQL} WHERE line_no IS NOT NULL UNION ALL {_LOOKED_SQL}")
def find_body_headings(spark, sf_dir):
    """The standard items' headings: lines that open with one, else what the windows hold."""
    return _windows(spark, sf_dir).where("line_no IS NOT NULL").select("document_id", "item_key", "line_no").union(interval_window_lookup(spark, sf_dir))


@query(f"""SELECT document_id, n_items, first_line FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY n_items DESC, spread, first_line) AS k FROM (SELECT document_id, cluster, count(DISTINCT item_key) AS n_items, min(line_no) AS first_line, (max(line_no) - min(line_no)) / count(*) AS spread
 FROM (SELECT *, sum(CASE WHEN gap >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY line_no) AS cluster FROM (SELECT *, line_no - lag(line_no) OVER (PARTITION BY document_id ORDER BY line_no) AS gap FROM {relational._TOC_SQL})) GROUP BY 1, 2) WHERE n_items >= {R.TOC_MIN_ITEMS}) WHERE k = 1""")
def toc_headerless(spark, sf_dir):
    """The densest run of item lines with enough different items: most items, then the narrowest, then the first."""
    w = Window.partitionBy("document_id").orderBy("line_no")
    gaps = relational._toc_lines(spark, sf_dir).withColumn("gap", F.col("line_no") - F.lag("line_no").over(w))
    runs = gaps.withColumn("cluster", F.sum(F.when(F.col("gap") >= 3, 1).otherwise(0)).over(w))
    each = runs.groupBy("document_id", "cluster").agg(F.countDistinct("item_key").alias("n_items"), F.min("line_no").alias("first_line"), ((F.max("line_no") - F.min("line_no")) / F.count("*")).alias("spread"))
    k = F.row_number().over(Window.partitionBy("document_id").orderBy(F.desc("n_items"), "spread", "first_line"))
    return each.where(F.col("n_items") >= R.TOC_MIN_ITEMS).withColumn("k", k).where("k = 1").select("document_id", "n_items", "first_line")
