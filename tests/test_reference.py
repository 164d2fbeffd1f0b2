"""Names, headings, sections, tables, money, groups: the cases that define them."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions import fuzzy
from ledgerloom.operators import enrich, graph, resolve, retrieval, sections, table_enrich, text_tables
from ledgerloom.session import cut

SPACED = """(In millions, except per-share amounts)   2014   2013   2012

Net premiums    $ 19,072   $ 20,135   $ 22,148
Net investment income   3,319   3,293   3,473
Total revenues  22,728   23,939   25,364
"""
PIPED = """| Year | Revenue | Net Income |
|------|---------|------------|
| 2023 | $10.2B  | $1.4B      |
| 2022 | $9.8B   | $1.2B      |
"""
FILING = "TABLE OF CONTENTS\nItem 1. Business 1\nItem 1A. Risk Factors 2\nItem 3. Legal Proceedings 3\nItem 7. Management Discussion 4\n" + "-" * 25 + "\nITEM 1. BUSINESS\nWe make things.\nITEM 1A. RISK FACTORS\nMany.\nITEM 3. LEGAL PROCEEDINGS\nNone.\nITEM 7. MANAGEMENT DISCUSSION\nAll well."


def one(spark, value, expr, name="x"):
    return spark.createDataFrame([(value,)], f"{name} string").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(("name", "want"), [("Apple Inc.", "apple"), ("Apple Incorporated", "apple"), ("Microsoft Corp.", "microsoft"), ("Alphabet LLC", "alphabet"), ("Example GmbH", "example"), ("A.F.L.A.C.", "a f l a c"), ("LLC", "llc"), (None, None)])
def test_companies(spark, name, want):
    assert one(spark, name, C.normalize_company(F.col("x"))) == want


def test_persons_and_organisations(spark):
    assert one(spark, "Mr. Michael I. Roth Jr.", C.normalize_person(F.col("x"))) == "michael i roth"
    names = ["Company", "LLC", "SEC", "FERC", "FASB", "", "Securities Exchange Act of 1934", None, "Apple Inc.", "General Electric Company", "The Walt Disney Company"]
    got = spark.createDataFrame([(n,) for n in names], "x string").select(C.keep_org(F.col("x")).alias("k")).collect()
    assert [r.k for r in got] == [False] * 8 + [True] * 3


def test_headings(spark):
    cases = {"Item 1A. Risk Factors": "risk_factors", "Item 1. Business": "business_overview", "Item 7. MD&A": "management_discussion", "Item 8. Statements": "financial_results", "Item 3. Legal": "legal_proceedings", "Item 10. Directors": "governance", "ITEM 99. X": "other", "Item 4. Mine": "disclosures", "Note 1 Business": "business_overview", "Leases": "other"}
    got = spark.createDataFrame([(h,) for h in cases], "x string").select("x", C.categorize_heading(F.col("x")).alias("c")).collect()
    assert {r.x: r.c for r in got} == cases
    assert all(sections.category_of(h) == c for h, c in cases.items())


def test_sections():
    got = sections.parse(FILING)
    assert [(h, c) for h, c, _, _ in got] == [("Preamble", "other"), ("ITEM 1. BUSINESS", "business_overview"), ("ITEM 1A. RISK FACTORS", "risk_factors"), ("ITEM 3. LEGAL PROCEEDINGS", "legal_proceedings"), ("ITEM 7. MANAGEMENT DISCUSSION", "management_discussion")]
    assert got[1][2] == "We make things." and {m for *_, m in got} == {"toc"}
    assert [s[:2] for s in sections.parse("A plain paragraph.")] == [("Document", "other")]
    assert sections.parse(None) == [] and sections.parse(" \n") == []
    three = sections.parse("ITEM 1. BUSINESS\nx\nITEM 1A. RISK FACTORS\ny\nITEM 7. MANAGEMENT\nz")
    assert [c for _, c, _, _ in three] == ["business_overview", "risk_factors", "management_discussion"]
    assert sections.find_toc("x" * 500, ["1", "1A", "1B", "2"]).method == "llm_toc"


def test_a_missing_heading_is_sought_between_its_neighbours():
    text = "Item 1. A\nsome\nItem 1A. B\nbody. Item 1B. None. more\nItem 2. C\nend"
    assert [k for _, _, k in sections.locate(text, ["1", "1A", "1B", "2"], 0)] == ["1", "1A", "1B", "2"]
    assert [k for _, _, k in sections.locate("Item 5.05 x", ["5"], 0)] == []


def test_tables():
    table = text_tables.detect(SPACED)[0]
    assert table.kind == "financial" and len(table.rows) == 3 and table.columns[0] == "2014" and "3 rows" in table.summary()
    pipe = text_tables.detect(PIPED)[0]
    assert pipe.columns == ["Year", "Revenue", "Net Income"] and [r["Year"] for r in pipe.rows] == ["2023", "2022"]
    assert text_tables.detect("A plain paragraph.") == [] and text_tables.detect(None) == [] and text_tables.detect("| a | b |") == []


def test_money(spark):
    text = "é\nRevenue was $1.2 million and net income was USD 500,000; then 4.5 billion dollars."
    got = one(spark, text, C.money_mentions(F.col("x")))
    assert [(m.currency, m.amount) for m in got] == [("USD", 1.2e6), ("USD", 5e5), ("USD", 4.5e9)]
    assert all(text[m.start : m.end] == m.match for m in got)
    assert one(spark, "none", C.money_mentions(F.col("x"))) == [] and one(spark, None, C.money_mentions(F.col("x"))) is None


def groups(spark, names, kind="company"):
    rows = [("d", "r", kind, n, i) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "document_id string, record_id string, entity_type string, name string, position long")
    found, evidence = resolve.resolve(df)
    return {frozenset(g.variants.split("|")): g for g in found.collect()}, df, evidence


def test_resolution(spark):
    got, mentions, evidence = groups(spark, ["Apple", "APPLE INC", "Apple Inc.", "Apple", "Microsoft", "McCann", "McCann Health", "PECO", "Pepco", "The Interpublic Group of Companies, Inc.", "Interpublic Group", "IPG"])
    apple = got[frozenset(["Apple", "APPLE INC", "Apple Inc."])]
    assert apple.canonical_name == "Apple Inc." and apple.mention_count == 4
    assert {frozenset(["Microsoft"]), frozenset(["McCann"]), frozenset(["McCann Health"]), frozenset(["PECO"]), frozenset(["Pepco"])} <= set(got)
    assert any({"IPG", "Interpublic Group"} <= g for g in got)
    attached = resolve.attach(mentions, evidence).collect()
    assert len(attached) == len({a.canonical_name for a in attached}) and all(a.resolution_score is not None for a in attached)


def test_persons_resolve(spark):
    got, *_ = groups(spark, ["Michael I. Roth", "Michael Roth", "M. I. Roth", "Mr. Roth"], "person")
    assert set(got) == {frozenset(["Michael I. Roth", "Michael Roth", "M. I. Roth"]), frozenset(["Mr. Roth"])}


def test_resolution_of_nothing(spark):
    df = spark.createDataFrame([("d", "r", "company", None, 1), (None, "r", "company", "A", 1), ("d", "r", "money", "A", 1)], "document_id string, record_id string, entity_type string, name string, position long")
    assert resolve.resolve(df)[0].count() == 0


def test_fuzzy():
    assert fuzzy.ratio("apples", "apple") == pytest.approx(100 * 10 / 11) and fuzzy.ratio("", "") == 100
    assert fuzzy.lcs("abcbdab", "bdcaba") == 4 and fuzzy.token_sort("b a", "a b") == 100 and fuzzy.token_set("a b", "a b c") == 100 and fuzzy.partial("abc", "xxabcxx") == 100


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 10), (5, 5)] + [(i, i + 1) for i in range(20, 60)] + [(None, 1)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 9, 10: 9, 5: 5} | {i: 20 for i in range(20, 61)}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("most", [100, 3])
def test_components_within_a_scope(spark, most):
    edges = [("d", "a", "b"), ("d", "b", "c"), ("e", "b", "c"), ("d", "x", "y"), ("d", "y", "z"), ("d", "z", "z"), (None, "a", "b"), ("d", None, "b"), ("f", "q", "q")]
    got = {(r.s, r.node, r.component) for r in graph.components_within(spark.createDataFrame(edges, "s string, a string, b string"), ["s"], "a", "b", most).collect()}
    assert got == {("d", "a", "a"), ("d", "b", "a"), ("d", "c", "a"), ("e", "b", "b"), ("e", "c", "b"), ("d", "x", "x"), ("d", "y", "x"), ("d", "z", "x"), ("f", "q", "q")}


def test_cache_calls_each_content_once(spark):
    empty = spark.createDataFrame([], enrich.CACHE)
    records = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "bad"), ("d", None)], "id string, p string")
    call = lambda p: f"re {p}" if p != "bad" else None
    replies, cache = enrich.enrich(records, "id", "p", empty, call)
    assert {(r.id, r.reply, r.status) for r in replies.collect()} == {("a", "re x", "miss"), ("b", "re x", "miss"), ("c", None, "failed")}
    cache = cut(cache, "cache")
    again, _ = enrich.enrich(records, "id", "p", cache, call)
    assert {(r.id, r.status) for r in again.collect()} == {("a", "hit"), ("b", "hit"), ("c", "failed")}


def test_embedding_keeps_unchanged_texts(spark):
    df = spark.createDataFrame([("a", "one two"), ("b", None)], "record_id string, retrieval_text string")
    known = cut(retrieval.embed(df), "vectors")
    changed = spark.createDataFrame([("a", "one two"), ("b", "new")], "record_id string, retrieval_text string")
    got = retrieval.embed(changed, known=known, embedder=lambda t: retrieval.hashed_words(t)).collect()
    assert len(got) == 2 and {len(r.embedding) for r in got} == {64}


def table(spark, columns, rows, summary="plain", heading="H", raw="raw"):
    schema = "record_id string, table_no bigint, heading string, columns array<string>, rows array<map<string,string>>, raw_text string, summary string"
    return spark.createDataFrame([("r", 0, heading, columns, rows, raw, summary)], schema)


def test_summaries_come_from_the_provider_once(spark, tmp_path):
    import json

    path, asked = str(tmp_path / "cache"), str(tmp_path / "asked")

    def call(payload):
        with open(asked, "a") as log:
            log.write("x\n")
        return json.dumps({"summary": "inferred", "columns": ["Item", "2020", None]}) if json.loads(payload)["infer"] else "written"

    def run(t, provider=call):
        out, grown, log = table_enrich.apply_summaries(t, enrich.read_cache(spark, path), provider)
        rows, log, grown = out.collect(), log.collect(), cut(grown, "grown")
        enrich.append_cache(grown, path)
        return rows[0], [r.status for r in log]

    named = table(spark, ["Item", "2020"], [{"Item": "a", "2020": "1"}])
    first, log = run(named)
    assert (first.summary, first.summary_source, first.summary_cache_status, log) == ("written", "llm", "miss", ["ok"])
    again, log = run(named)
    assert (again.summary, again.summary_cache_status, log) == ("written", "hit", ["cache_hit"])
    changed, _ = run(table(spark, ["Item", "2020"], [{"Item": "a", "2020": "2"}]))
    assert changed.summary_cache_status == "miss" and len(open(asked).read().split()) >= 2
    generic, _ = run(table(spark, ["Item", "Col1", "Col2"], [{"Item": "a", "Col1": "1", "Col2": "2", "other": "z"}]))
    assert generic.columns == ["Item", "2020", "Col3"] and generic.rows == [{"Item": "a", "2020": "1", "Col3": "2", "other": "z"}] and generic.summary_source == "llm_inferred"
    failed, log = run(table(spark, ["Item", "2021"], []), lambda p: None)
    assert (failed.summary, failed.summary_used_llm, failed.summary_source, log) == ("plain", False, "deterministic", ["error"])
    off, log = run(named, None)
    assert (off.summary, off.summary_source, off.summary_cache_status, log) == ("plain", "deterministic", "", [])
    assert run(table(spark, [], []))[0].summary_source == "deterministic" and run(table(spark, None, None, None, None, None))[0].summary_used_llm is False


def test_replies(spark):
    df = spark.createDataFrame([('```json\n["1a", "x", "7"]\n```',), ("[]",), ("no json",), (None,)], "r string")
    assert [r.k for r in df.select(table_enrich.reply_keys(F.col("r")).alias("k")).collect()] == [["1A", "7"], [], [], []]
    bad = spark.createDataFrame([('{"summary": "s", "columns": ["a"]}',), ("?",)], "r string").select(table_enrich.reply_columns(F.col("r"), F.lit(2)).alias("k")).collect()
    assert [(r.k.summary, r.k.columns) for r in bad] == [("s", None), ("", None)]


def test_contents_lists_by_a_provider(spark):
    # So far apart that they are no contents list themselves.
    long = "words and more words. " * 50
    body = "\n".join(f"{h}\n{long}" for h in ("ITEM 1. BUSINESS", "ITEM 1A. RISK FACTORS", "ITEM 1B. UNRESOLVED", "ITEM 2. PROPERTIES"))
    docs = spark.createDataFrame([("d", body), ("e", FILING), ("f", "plain"), ("g", None)], "document_id string, raw_text string")
    provided, _, log = sections.provide_toc(docs, spark.createDataFrame([], enrich.CACHE), lambda s: '["1", "1A", "1B", "2"]' if "BUSINESS" in s else "?")
    provided = cut(provided, "provided")
    assert {r["document_id"]: r["items"] for r in provided.collect()} == {"d": ["1", "1A", "1B", "2"], "f": []} and log.count() == 2
    got = {}
    for r in sections.parse_sections(docs, provided).collect():
        got.setdefault(r.document_id, []).append(r.parse_method)
    without = {r.parse_method for r in sections.parse_sections(docs).where("document_id = 'd'").collect()}
    assert set(got["e"]) == {"toc"} and set(got["f"]) == {"fallback_regex"} and "g" not in got and "llm_toc" not in without
    assert got["d"] == ["llm_toc"] * 4


def test_pdf_pages_by_an_extractor(spark, tmp_path):
    from ledgerloom.sources import documents

    (tmp_path / "a.PDF").write_bytes(b"one|two")
    (tmp_path / "bad.pdf").write_bytes(b"!")
    (tmp_path / "c.txt").write_bytes(b"one")

    def extract(content):
        if content == b"!":
            raise ValueError("unreadable")
        return content.decode().split("|")

    got = documents.read_pdf_documents(spark, str(tmp_path), extract).collect()
    assert [(r.raw_text, r.page_count, r.file_type) for r in got] == [("one\ntwo", 2, "pdf")]
    assert documents.read_pdf_documents(spark, str(tmp_path)).count() == 0 or __import__("importlib").util.find_spec("pymupdf")


def test_matches_keep_their_places(spark):
    df = spark.createDataFrame([("é ab ab\nab",), ("",), (None,), ("x" * 5,)], "t string")
    got = [r.m for r in df.select(C.all_matches(F.col("t"), "ab").alias("m")).collect()]
    assert [(m.start, m.end, m.match) for m in got[0]] == [(2, 4, "ab"), (5, 7, "ab"), (8, 10, "ab")] and got[1:] == [[], None, []]


@pytest.mark.parametrize(("a", "b", "want"), [("Apple Inc", "Apple", "normalized_exact"), ("McCann", "McCann Health", "no_match"), ("GEC", "General Electric Co of America", "no_match"), ("GEA", "General Electric of America", "acronym"), ("abc", "abd", "no_match"), ("", "x", "no_match"), ("Fastenal Corp", "Fastenall Corp", None)])
def test_rules_of_two_companies(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string").select("a", "b", C.normalize_company(F.col("a")).alias("na"), C.normalize_company(F.col("b")).alias("nb"))
    r = df.select(resolve.company_rule(*map(F.col, ("a", "b", "na", "nb"))).alias("r")).first().r
    assert (r and r.method) == want


def test_a_page_and_a_report(spark):
    from ledgerloom import sinks

    df = spark.createDataFrame([("r", "d", "<H>", None, "a & b")], "record_id string, document_id string, heading string, section_category string, chunk_text string")
    page = sinks.cards_html(df, "T&T")
    assert "&lt;H&gt;" in page and "a &amp; b" in page and "T&amp;T" in page
    assert "| n |\n|---|\n| 1 |" in sinks.markdown_report("R", {"x": spark.sql("SELECT 1 AS n")})
