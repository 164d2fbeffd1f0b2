import os

import pytest

import __spark_entry__ as e

SMALL = "/root/testdata/sf0.001"


def test_every_twin_has_its_query():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the test tables aren't here")
def test_entry(spark):
    assert e.entry(spark).limit(1).count() == 1


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the test tables aren't here")
def test_documents_from_files(spark, tmp_path):
    from ledgerloom.sources import documents
    from ledgerloom.streaming import files

    (tmp_path / "a b__CIK0000123__00000001231400_x201410k.txt").write_bytes(b"ITEM 1. BUSINESS\r\nx\xff\rend")
    (tmp_path / "z.TXT").write_text("plain")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "no.pdf").write_text("x")
    got = documents.read_text_documents(spark, str(tmp_path)).orderBy("source_path").collect()
    assert [r.raw_text for r in got] == ["ITEM 1. BUSINESS\nx�\nend", "plain"]
    assert got[0].source_path == str(tmp_path / "a b__CIK0000123__00000001231400_x201410k.txt") and len(got[0].document_id) == 12
    q = files.start_sections(spark, str(tmp_path), str(tmp_path / "out"), str(tmp_path / "progress"))
    q.awaitTermination()
    assert sorted(r.heading for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["Document", "ITEM 1. BUSINESS"]
    pages = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a"), ("p", 3, None)], "source_path string, page_number int, text string")
    assert documents.documents_from_pages(pages).first().raw_text == "a\nb\n"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the test tables aren't here")
def test_streamed_sections_keep_every_filing(spark):
    from ledgerloom.operators import sections
    from ledgerloom.plans.base import filings

    opened = filings(spark, SMALL, "raw_text").where("raw_text IS NOT NULL")
    got = sorted(map(tuple, e.queries()["stream_sections"](spark, SMALL).collect()), key=str)
    assert {r[0] for r in got} == {r.document_id for r in opened.collect()}
    want = sections.parse_sections(opened).select("document_id", "section_no", "heading", "section_category")
    assert got == sorted(map(tuple, want.collect()), key=str)


def test_sections_of_one_heading_are_all_kept(spark):
    from ledgerloom.plans.documents import pipeline

    text = "ITEM 1. BUSINESS\nWe paid $5 million.\nITEM 1. BUSINESS\nWe paid $7 million to Acme Corp. today."
    rows = pipeline(spark.createDataFrame([("d", "/x/a.txt", text)], "document_id string, source_path string, raw_text string")).orderBy("chunk_index").collect()
    assert [r.chunk_text for r in rows] == ["We paid $5 million.", "We paid $7 million to Acme Corp. today."]
    assert rows[1].record_id == rows[0].record_id + "-2" and "$5 million" in rows[0].entities_json and "$7 million" in rows[1].entities_json


def test_entities_hold_names_and_money(spark):
    from ledgerloom.plans.documents import pipeline

    text = "ITEM 1. BUSINESS\nOur director, Margaret R. Mavnott, met Bolt Marine Corp. and Dr. Anna Roe."
    df = spark.createDataFrame([("d", "/x/a.txt", text)], "document_id string, source_path string, raw_text string")
    row = pipeline(df).first()
    assert row.entity_names == "Margaret R. Mavnott, Bolt Marine Corp., Dr. Anna Roe" and row.has_entities
    assert set(row.resolved_entity_names.split(", ")) == {"Margaret R. Mavnott", "Bolt Marine Corp.", "Dr. Anna Roe"}
    given = pipeline(df, lambda r: r.selectExpr("document_id", "record_id", "'person' AS entity_type", "'Zoe Poe' AS name", "0 AS position", "0 AS start", "7 AS end")).first()
    assert given.entity_names == "Zoe Poe" == given.resolved_entity_names
