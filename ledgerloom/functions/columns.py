"""Column expressions: text, ids, names, headings, money, quality. All run in the JVM.

A null argument gives null unless the docstring says otherwise.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import rules as R


def _one_of(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def short_md5(*parts: Column | str) -> Column:
    """The first 12 hex digits of the MD5 of the parts joined by '|'."""
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.substring(F.md5(F.concat_ws("|", *cols).cast("binary")), 1, 12)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalize_ws(text: Column) -> Column:
    """Runs of blanks and tabs as one blank, ends stripped."""
    return strip(F.regexp_replace(text, r"[ \t]+", " "))


def normalize_table_text(text: Column) -> Column:
    """No-break space as blank, em dash as --, en dash and minus as -."""
    return F.translate(F.replace(text, F.lit("—"), F.lit("--")), " –−", " --")


def preview(text: Column, n: int) -> Column:
    """The first n characters, with … if there are more."""
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("…"))).otherwise(text)


def newline_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def company_of(name: Column) -> Column:
    """Of a file name: what precedes __CIK, underscores as blanks."""
    return F.trim(F.regexp_replace(F.element_at(F.split(name, "__CIK"), 1), "_+", " "))


def cik_of(name: Column) -> Column:
    return F.ltrim(F.regexp_extract(name, r"CIK(\d+)", 1), F.lit("0"))


def year_of(name: Column) -> Column:
    """The year before 6 digits and 10k or 10x; else 20 and the two digits behind the filing number; else ''."""
    named = F.regexp_extract(name, r"(?i)(\d{4})\d{6}10[xk]", 1)
    short = F.regexp_extract(name, r"__\d{10}(\d{2})", 1)
    return F.when(named != "", named).when(short != "", F.concat(F.lit("20"), short)).otherwise(F.lit(""))


def heading_item(heading: Column) -> Column:
    """The item number that a heading names first, upper case; '' without one."""
    return F.upper(F.regexp_extract(heading, r"(?i)item[\s ]+(\d+[A-Za-z]?)", 1))


def item_category(item: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in R.ITEM_CATEGORIES.items() for x in pair))
    return F.try_element_at(known, item)


def title_category(heading: Column) -> Column:
    """The category of the first rule that the heading matches, else 'other'."""
    text = F.lower(heading)
    return F.coalesce(*(F.when(text.rlike(p), F.lit(c)) for p, c in R.HEADING_RULES), F.lit("other"))


def first_number(heading: Column) -> Column:
    """The first number of a heading with its letter, upper case; '' without one."""
    return F.upper(F.regexp_extract(heading, r"(\d+[A-Za-z]?)", 1))


def categorize_heading(heading: Column) -> Column:
    """By its first number, whatever stands before, else by title; 'other' for null."""
    return F.coalesce(item_category(first_number(heading)), title_category(heading))


def is_toc_entry(heading: Column) -> Column:
    """Whether a heading ends in a page number, as those of contents lists do."""
    return heading.rlike(r"[\s ]+\d+\s*$")


def without_page_rules(text: Column) -> Column:
    """Lines of 20 and more dashes dropped, ends stripped."""
    lines = F.filter(F.split(text, "\n"), lambda line: ~line.rlike(r"^-{20,}\s*$"))
    return strip(F.array_join(lines, "\n"))


def clean_name(name: Column) -> Column:
    """Lower case words: possessive dropped, punctuation as blanks."""
    plain = F.regexp_replace(strip(name), r"(?i)(?:'s|’s)\s*$", "")
    plain = F.regexp_replace(F.replace(plain, F.lit(" "), F.lit(" ")), r"(?U)[^\p{L}\p{N}_\s]", " ")
    return F.lower(strip(F.regexp_replace(plain, r"(?U)\s+", " ")))


def normalize_company(name: Column) -> Column:
    """Without leading articles and trailing legal forms; at least one word stays."""
    plain = F.regexp_replace(clean_name(name), rf"^(?:{_one_of(R.LEADING_ARTICLES)} )+(?=\S)", "")
    return F.regexp_replace(plain, rf"(?<=\S)(?: {_one_of(R.LEGAL_SUFFIXES)})+$", "")


def normalize_person(name: Column) -> Column:
    """Without a title in front and the generation behind."""
    plain = F.regexp_replace(clean_name(name), rf"^{_one_of(R.PERSON_TITLES)}\s+", "")
    return F.array_join(F.filter(F.split(plain, " "), lambda w: ~w.isin(*R.PERSON_SUFFIXES)), " ")


def keep_org(name: Column) -> Column:
    """Whether a name is an organisation's and no boilerplate; false for null and for names without letters or digits."""
    plain = F.lower(F.trim(F.regexp_replace(name, r"[^\p{L}\p{N}_]+", " ")))
    stop = R.ORG_STOPWORDS + R.ORG_STOP_PHRASES
    return F.coalesce((plain != "") & ~plain.isin(*stop) & ~name.rlike(f"(?i){R.ORG_BOILERPLATE}"), F.lit(False))


def line_at(text: Column, position: Column) -> Column:
    """The line that holds the character at `position` (from 0)."""
    return F.concat(
        F.substring_index(F.substring(text, 1, position), "\n", -1), F.substring_index(F.substr(text, position + 1), "\n", 1)
    )


def is_table_row_line(line: Column) -> Column:
    """Whether a line holds a pipe or three numbers that stand alone."""
    return line.contains("|") | (F.regexp_count(line, F.lit(r"(?<!\w)\$?[\d,]+(?:\.\d+)?(?!\w)")) >= 3)


def is_heading_line(line: Column) -> Column:
    return line.rlike(r"(?i)^\s*(?:item|exhibit)\s+\d")


def keep_person(name: Column, text: Column, position: Column) -> Column:
    """The layers that need no tagger: words, line, and a title before a single word; false for null."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    plain = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}_]+", "")))
    line = line_at(text, position)
    before = F.lower(F.regexp_extract(F.substring(text, 1, position), r"(\S+?)\.?\s*$", 1))
    shape = F.exists(plain, lambda w: w != "") & ~F.exists(plain, lambda w: w.isin(*R.PERSON_STOPWORDS)) & ~name.rlike(r"\d")
    shape = shape & F.exists(words, lambda w: w.rlike(r"^\p{Lu}")) & name.rlike(r"\p{L}")
    placed = ~is_table_row_line(line) & ~is_heading_line(line)
    return F.coalesce(shape & placed & ((F.size(words) > 1) | before.isin(*R.ANNOUNCING_TITLES)), F.lit(False))


def all_matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of all matches, with positions from 0; null for null.

    One pass over each text in Arrow batches, whose cost is linear in the text:
    a list built up by expressions is copied with each match. The pattern is of
    the `regex` module's syntax and must not match an empty string.
    """

    @F.arrow_udf("array<struct<start:int,end:int,match:string>>")
    def find(texts: pa.Array) -> pa.Array:
        search = regex.compile(pattern).finditer
        offsets, starts, ends, found = [0], [], [], []
        for t in texts.to_pylist():
            for m in search(t) if t else ():
                starts.append(m.start())
                ends.append(m.end())
                found.append(m.group())
            offsets.append(len(starts))
        one = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(found, pa.string())], ["start", "end", "match"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), one)

    return F.when(text.isNotNull(), find(text))


def money_mentions(text: Column) -> Column:
    """array<struct<start, end, match, currency, amount>>: money as written, leftmost first, null amount where unreadable."""

    def read(m: Column) -> Column:
        low = F.lower(m["match"])
        symbol = reduce(lambda rest, kv: F.when(low.startswith(kv[0]), F.lit(kv[1])).otherwise(rest), reversed(R.MONEY_SYMBOLS.items()), F.lit(None).cast("string"))
        word = reduce(lambda rest, kv: F.when(low.rlike(f"{kv[0]}s?$"), F.lit(kv[1])).otherwise(rest), reversed(R.MONEY_WORDS.items()), F.lit("USD"))
        size = reduce(lambda rest, kv: F.when(low.contains(kv[0]), F.lit(kv[1])).otherwise(rest), reversed(R.MAGNITUDES.items()), F.lit(1.0))
        number = F.replace(F.regexp_extract(low, f"({R.MONEY_NUMBER})", 1), F.lit(","), F.lit(""))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["match"].alias("match"), F.coalesce(symbol, word).alias("currency"), (number.try_cast("double") * size).alias("amount"))

    return F.transform(all_matches(text, f"(?i)(?:{R.MONEY})"), read)


def page_quality(text: Column) -> Column:
    """struct<warnings, score, requires_fallback> of a page's text; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    alpha = F.regexp_count(t, F.lit(r"\p{L}")) / F.greatest(n, F.lit(1))
    replaced = F.regexp_count(t, F.lit("�")) / F.greatest(n, F.lit(1))
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")
    mean = F.aggregate(lines, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)) / F.greatest(F.size(lines), F.lit(1))
    short = n < R.PAGE_MIN_CHARS
    warnings = F.array_compact(
        F.array(
            F.when(short, "very_short_text"),
            F.when(~short & (alpha < R.PAGE_MIN_ALPHA), "low_alpha_ratio"),
            F.when(replaced > R.PAGE_MAX_REPLACED, "high_replacement_ratio"),
            F.when((F.size(lines) > 0) & (mean < R.PAGE_MIN_LINE), "short_lines"),
        )
    )
    count = F.size(warnings)
    return F.struct(warnings.alias("warnings"), F.round(F.greatest(F.lit(0.0), 1 - 0.25 * count), 2).alias("score"), ((count >= 2) | short).alias("requires_fallback"))


def indexed_quantile(values: Column, q: float) -> Column:
    """The sorted value at floor(n * q), from 0; null for no values."""
    s = F.sort_array(values)
    return F.get(s, F.floor(F.size(s) * q).cast("int"))
