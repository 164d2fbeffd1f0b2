"""Contents lists and sections of a filing's text.

Finding headings is sequential within one document (a found heading narrows
where the next is sought), so a document is read by one function over one
ordered list of item references; documents are independent of each other and
run in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import rules as R
from ledgerloom.operators import table_enrich
from ledgerloom.operators.enrich import enrich

# The patterns of contents headers, items and headings.
_BLANK = r"[\s\xa0]"
_HEADER = re.compile(rf"table{_BLANK}+of{_BLANK}+contents", re.I)
_ITEM = re.compile(rf"\bitem{_BLANK}+(\d+[A-Za-z]?)\b", re.I)
_KEY = re.compile(r"\d{1,2}[A-Z]?")
_RULE = re.compile(r"-{20,}")
_DELIMITER = r"[.:\s\xa0–—](?!\d)"
_STRICT = re.compile(rf"^[ \t\xa0]*(?:part{_BLANK}+\S+{_BLANK}+)?item{_BLANK}+(\d+[A-Za-z]?){_DELIMITER}", re.I | re.M)
_LOOSE = re.compile(rf"\bitem{_BLANK}+(\d+[A-Za-z]?){_DELIMITER}", re.I)
_BROAD = re.compile(rf"^(ITEM{_BLANK}+\d+[A-Z]?[.:\s].{{0,120}})$", re.I | re.M)
_PAGE_NUMBER = re.compile(r"[\s\xa0]+\d+\s*$")
_NUMBER_ONLY = re.compile(rf"item{_BLANK}+\d+[a-z]?[.\s]*", re.I)
_TITLES = [(re.compile(p), c) for p, c in R.HEADING_RULES]


class Toc(NamedTuple):
    """Item keys in order, where the list ends, and how it was found."""

    items: list[str]
    end: int
    method: str


def _squeeze(text: str) -> str:
    return re.sub(r"[ \t]+", " ", text).strip()


def category(item: str | None, heading: str) -> str:
    """By item, else by the first title rule."""
    if item in R.ITEM_CATEGORIES:
        return R.ITEM_CATEGORIES[item]
    low = heading.lower()
    return next((c for p, c in _TITLES if p.search(low)), "other")


def _first_seen(text: str) -> list[tuple[str, int, int]]:
    """(key, start, end) of the first reference to each valid item."""
    seen: dict[str, tuple[int, int]] = {}
    for m in _ITEM.finditer(text):
        key = m.group(1).upper()
        if _KEY.fullmatch(key):
            seen.setdefault(key, m.span())
    return [(k, *span) for k, span in seen.items()]


def _mean_gap(starts: list[int]) -> float:
    return (starts[-1] - starts[0]) / (len(starts) - 1) if len(starts) > 1 else 0.0


def _list_end(text: str, after: int) -> int:
    """The end of the page rule behind the list, else a short tail."""
    rule = _RULE.search(text, after)
    return rule.end() if rule else min(after + R.TOC_TAIL, len(text))


def toc_by_header(text: str) -> Toc | None:
    """The longest item list behind a contents header; items too far apart are body headings, not a list."""
    best: Toc | None = None
    for header in _HEADER.finditer(text[: R.TOC_SEARCH]):
        block = text[header.start() : header.start() + R.TOC_BLOCK]
        found = _first_seen(block)
        if not found or _mean_gap([f[1] for f in found]) > R.TOC_MAX_GAP:
            continue
        if best is None or len(found) > len(best.items):
            best = Toc([f[0] for f in found], header.start() + _list_end(block, found[-1][2]), "toc")
    return best if best and len(best.items) >= R.TOC_MIN_ITEMS else None


def toc_by_cluster(text: str) -> Toc | None:
    """The densest run of item references near the start: most items, then the smallest mean gap."""
    head = text[: R.BARE_SEARCH]
    refs = [(m.group(1).upper(), m.start(), m.end()) for m in _ITEM.finditer(head) if _KEY.fullmatch(m.group(1).upper())]
    best: tuple[int, float] | None = None
    chosen: Toc | None = None
    i = 0
    while i < len(refs):
        j = i + 1
        while j < len(refs) and refs[j][1] - refs[j - 1][1] < R.BARE_CLUSTER_GAP:
            j += 1
        first: dict[str, int] = {}
        for key, start, _ in refs[i:j]:
            first.setdefault(key, start)
        gap = _mean_gap(list(first.values()))
        if len(first) >= R.TOC_MIN_ITEMS and gap <= R.BARE_MAX_GAP and (best is None or (len(first), -gap) > (best[0], -best[1])):
            best = (len(first), gap)
            chosen = Toc(list(first), _list_end(head, list(first.values())[-1]), "headerless_toc")
        i = j
    return chosen


def find_toc(text: str, provided: list[str] | None = None) -> Toc:
    """Header-guided, else a bare cluster, else the items that a provider gave, else none."""
    found = toc_by_header(text) or toc_by_cluster(text)
    if found:
        return found
    keys = [k.upper() for k in provided or [] if _KEY.fullmatch(k.upper())]
    return Toc(keys, 0, "llm_toc") if len(keys) >= R.TOC_MIN_ITEMS else Toc([], 0, "none")


def locate(text: str, keys: list[str], start: int) -> list[tuple[int, int, str]]:
    """(start, end, key) of the items' headings, by position.

    First those that open a line. Then each missing item is sought anywhere
    between the headings of the nearest items before and after it in the list;
    what is found narrows the search of the next.
    """
    strict: dict[str, tuple[int, int]] = {}
    for m in _STRICT.finditer(text[start:]):
        strict.setdefault(m.group(1).upper(), (start + m.start(), start + m.end()))
    found = {k: strict[k] for k in keys if k in strict}
    if len(found) < len(keys):
        loose: dict[str, list[tuple[int, int]]] = {}
        for m in _LOOSE.finditer(text):
            loose.setdefault(m.group(1).upper(), []).append(m.span())
        for at, key in enumerate(keys):
            if key in found or key not in loose:
                continue
            low = next((found[k][0] + 1 for k in reversed(keys[:at]) if k in found), start)
            high = next((found[k][0] for k in keys[at + 1 :] if k in found), len(text))
            spans = loose[key]
            i = bisect_right(spans, (low, -1))
            if i < len(spans) and spans[i][0] >= low and spans[i][1] <= high:
                found[key] = spans[i]
    return sorted((*span, key) for key, span in found.items())


def heading_at(text: str, start: int, end: int) -> str:
    """The heading's line; of a bare item number, with the next line that isn't blank."""
    stop = text.find("\n", end)
    line = _squeeze(text[start : stop if stop >= 0 else end])
    if not _NUMBER_ONLY.sub("", line).strip() and stop >= 0:
        extra = next((x.strip() for x in text[stop + 1 : stop + 300].splitlines() if x.strip()), "")
        line = _squeeze(f"{line} {extra}")
    return line


def _body(text: str) -> str:
    return "\n".join(x for x in text.splitlines() if not re.match(r"-{20,}\s*$", x)).strip()


class Head(NamedTuple):
    """Where a heading starts, where its body does, and what it says."""

    start: int
    body: int
    heading: str
    category: str


def _cut(text: str, heads: list[Head], method: str) -> list[tuple[str, str, str, str]]:
    """(heading, category, body, method) of the text cut at the heads, what precedes them as the preamble."""
    before = _body(text[: heads[0].start])
    out = [("Preamble", "other", before, method)] if before else []
    stops = [h.start for h in heads[1:]] + [len(text)]
    return out + [(h.heading, h.category, _body(text[h.body : stop]), method) for h, stop in zip(heads, stops)]


def fallback(text: str) -> list[tuple[str, str, str, str]]:
    """Sections at every line that opens with an item; one whole section where there is none."""
    heads = []
    for m in _BROAD.finditer(text):
        line = _squeeze(m.group(1))
        if not _PAGE_NUMBER.search(m.group(1)) and len(line.split()) >= 2:
            heads.append(Head(m.start(), m.end(), line, category_of(line)))
    return _cut(text, heads, "fallback_regex") if heads else [("Document", "other", text.strip(), "fallback_regex")]


def category_of(heading: str) -> str:
    """By the first number of a heading, else by its title."""
    item = re.search(r"\d+[A-Za-z]?", heading)
    return category(item.group().upper() if item else None, heading)


def parse(text: str | None, provided: list[str] | None = None) -> list[tuple[str, str, str, str]]:
    """(heading, category, body, method) of a filing's sections; none for a null or blank text."""
    if not text or not text.strip():
        return []
    toc = find_toc(text, provided)
    method, heads = toc.method, locate(text, toc.items, toc.end) if toc.items else []
    if len(heads) < R.TOC_MIN_ITEMS:
        return fallback(text)

    def good(h: list) -> bool:
        return h[-1][0] / len(text) >= R.COVERAGE or len(h) >= R.ENOUGH_HEADINGS

    if not good(heads):
        wider = locate(text, list(dict.fromkeys(toc.items + R.STANDARD_ITEMS)), 0)
        if len(wider) >= len(heads):
            heads, method = wider, method if method == "llm_toc" else "augmented_toc"
        if len(heads) < R.TOC_MIN_ITEMS:
            return fallback(text)
    named = []
    for start, end, key in heads:
        heading, line_end = heading_at(text, start, end), text.find("\n", start)
        named.append(Head(start, line_end + 1 if line_end >= 0 else start, heading, category(key, heading)))
    return _cut(text, named, method)


SECTIONS = "document_id string, section_no bigint, heading string, section_category string, section_text string, parse_method string"


def parse_sections(documents: DataFrame, provided: DataFrame | None = None) -> DataFrame:
    """One row per section of document_id, raw_text; null and blank texts give none, repeated documents each their own.

    `provided` has document_id and items array<string>, the contents lists of a
    provider (`provide_toc`), used where a text shows none of its own.
    """
    rows = documents.select("document_id", "raw_text", F.lit(None).cast("array<string>").alias("items"))
    if provided is not None:
        rows = documents.select("document_id", "raw_text").join(provided.select("document_id", "items").dropDuplicates(["document_id"]), "document_id", "left")

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            given = (None if i is None else list(i) for i in pdf["items"])
            out = [(d, i, *s) for d, t, p in zip(pdf["document_id"], pdf["raw_text"], given) for i, s in enumerate(parse(t, p))]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SECTIONS.split(", ")])

    return rows.mapInPandas(batches, SECTIONS)


#: Characters that a provider is shown: from the contents header, or from the start.
SNIPPET, SNIPPET_START = 5_000, 8_000


def toc_snippet(text: Column) -> Column:
    """struct<snippet, source>: the stretch of a text that a provider of contents lists is shown."""
    head = F.regexp_extract(F.substring(text, 1, R.TOC_SEARCH), r"((?i)table[\s\xa0]+of[\s\xa0]+contents)", 1)
    from_header = F.substr(text, F.instr(text, head), F.lit(SNIPPET))
    return F.struct(F.when(head != "", from_header).otherwise(F.substring(text, 1, SNIPPET_START)).alias("snippet"), F.when(head != "", "toc_header").otherwise("document_start").alias("source"))


def provide_toc(documents: DataFrame, cache: DataFrame, call: Callable[[str], str | None], model: str = "offline", version: str = "1") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(provided, cache, log): item keys by a provider for the documents whose texts show no contents list.

    `call` gets the snippet and replies with a JSON list of item keys. Replies
    without valid keys give an empty list; failures are not cached.
    """
    lacking = extract_toc(documents).where("method = 'none'").select("document_id")
    asked = documents.join(lacking, "document_id", "left_semi").select("document_id", toc_snippet(F.col("raw_text"))["snippet"].alias("snippet"))
    replies, grown = enrich(asked, "document_id", "snippet", cache, call, model, version)
    provided = replies.select("document_id", table_enrich.reply_keys(F.col("reply")).alias("items"))
    return provided, grown, table_enrich.log_rows(replies, model)


def extract_toc(documents: DataFrame) -> DataFrame:
    """document_id, method, n_items, items, toc_end of each text that isn't null."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            tocs = [find_toc(t) for t in pdf["raw_text"]]
            yield pd.DataFrame({"document_id": pdf["document_id"], "method": [t.method for t in tocs], "n_items": [len(t.items) for t in tocs], "items": [",".join(t.items) for t in tocs], "toc_end": [t.end for t in tocs]})

    return documents.where("raw_text IS NOT NULL").select("document_id", "raw_text").mapInPandas(batches, "document_id string, method string, n_items bigint, items string, toc_end bigint")
