"""Tables inside plain text: units-anchored columns of figures, and pipe tables.

Reading rows is a small state machine over lines, so each text is read by one
function, in Arrow batches; texts without a pipe or a units line never reach it.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import rules as R

_ANCHOR = re.compile(R.UNITS_ANCHOR, re.I)
_YEAR, _PERIOD = re.compile(R.YEAR), re.compile(R.PERIOD, re.I)
_CELL, _PIPE, _VALUE = re.compile(R.CELL), re.compile(R.PIPE_ROW), re.compile(R.VALUE_LINE)
_FOOTNOTE, _SKIP, _STOP = re.compile(R.FOOTNOTE_LINE), re.compile(R.SKIP_LINE, re.I), re.compile(R.STOP_LINE, re.I)
# Fixed value: what stands before a row's first figure.
_LABEL = re.compile(r"([^$\d(]+?)(?=\s*[$\d(]|$)")
_DASHES = str.maketrans({"\xa0": " ", "—": "--", "–": "-", "−": "-"})


class Table(NamedTuple):
    """A table as read from text."""

    kind: str
    units: str
    columns: list[str]
    rows: list[dict[str, str]]
    raw_text: str

    def summary(self) -> str:
        """One sentence on rows, units and the first four named columns; its words are fixed values."""
        count = lambda n, what: f"{n} {what}{'s' if n != 1 else ''}"
        head = f"Table with {count(len(self.rows), 'row')}" + (f" ({self.units})" if self.units else "")
        named = [c for c in self.columns if c != "Item" and not c.startswith("Col")]
        more = f" and {len(self.columns) - 5} more" if len(self.columns) > 5 else ""
        if named:
            return f"{head} across periods: {', '.join(named[:4])}{more}."
        return f"{head} and {count(len(self.columns), 'column')}." if self.columns else f"{head}."


def header_cells(line: str) -> list[str]:
    """The labels of a line that names years or periods, else none."""
    if not (_YEAR.search(line) or _PERIOD.search(line)):
        return []
    return [p.strip() for p in re.split(r"\s{2,}|\t", line.strip()) if p.strip()]


def read_rows(lines: list[str]) -> tuple[list[tuple[str, list[str]]], list[str]]:
    """(label, values) of rows: a labelled line opens a row, lines of figures extend it; and the lines used."""
    rows: list[tuple[str, list[str]]] = []
    used: list[str] = []
    for line in lines:
        text = line.strip()
        if _STOP.match(text):
            break
        if not text or _SKIP.match(text) or _FOOTNOTE.match(text):
            continue
        used.append(line)
        if _VALUE.match(text):
            if rows:
                rows[-1][1].extend(_CELL.findall(text))
        else:
            label = _LABEL.match(text)
            rows.append((label.group(1).strip() if label else text, _CELL.findall(text)))
    return [r for r in rows if r[1]], used


def inferred_columns(rows: list[tuple[str, list[str]]]) -> list[str]:
    """Item, Col1 ... for the most common number of values; ties to the first seen."""
    n = Counter(len(v) for _, v in rows).most_common(1)
    return ["Item", *(f"Col{i + 1}" for i in range(n[0][0]))] if n else []


def aligned(rows: list[tuple[str, list[str]]], columns: list[str]) -> list[dict[str, str]]:
    """Rows as column to value: one to one where the counts agree, else label first, padded or cut."""
    out = []
    for label, values in rows:
        if len(values) == len(columns):
            out.append(dict(zip(columns, values)))
        else:
            out.append(dict(zip(columns, [label, *values, *[""] * len(columns)])))
    return out


def units_table(text: str, anchor: int, units: str) -> Table | None:
    """The table around a units line: its header on that line or the nearest of 8 on either side."""
    first = max(0, anchor - 800)
    lines = text[first : anchor + 4_000].splitlines()
    at = next((i for i, x in enumerate(lines) if _ANCHOR.search(x)), 0)
    columns, header = header_cells(_ANCHOR.sub("", lines[at])), at
    if len(columns) < 2:
        columns, header = [], at
        for i in sorted(range(max(0, at - 8), min(len(lines), at + 9)), key=lambda i: (abs(i - at), i)):
            cells = header_cells(lines[i]) if i != at else []
            if len(cells) >= 2:
                columns, header = cells, i
                break
    rows, used = read_rows(lines[max(at, header) + 1 :])
    if len(rows) < 2:
        return None
    columns = columns or inferred_columns(rows)
    raw = "\n".join(lines[max(0, at - 2) : at + len(used) + 4])
    return Table("financial", units, columns, aligned(rows, columns), raw)


def pipe_table(block: list[str]) -> Table | None:
    """The table of consecutive pipe lines: the first names the columns."""
    cells = [[c.strip() for c in line.split("|") if c.strip()] for line in block if not re.fullmatch(r"[|\-\s]+", line)]
    if len(cells) < 2:
        return None
    columns = cells[0]
    rows = [dict(zip(columns if len(r) == len(columns) else map(str, range(len(r))), r)) for r in cells[1:]]
    return Table("pipe", "", columns, rows, "\n".join(block))


def detect(text: str | None) -> list[Table]:
    """All tables of a text: one per stretch of 200 characters with a units line, then pipe tables, each once."""
    if not text:
        return []
    text = text.translate(_DASHES)
    found: list[Table] = []
    taken: set[int] = set()
    for m in _ANCHOR.finditer(text):
        if m.start() // 200 in taken:
            continue
        table = units_table(text, m.start(), m.group())
        if table:
            taken.add(m.start() // 200)
            found.append(table)
    block: list[str] = []
    for line in [*text.splitlines(), ""]:
        if _PIPE.search(line):
            block.append(line)
            continue
        if len(block) >= 2:
            table = pipe_table(block)
            if table:
                found.append(table)
        block = []
    once: dict[str, Table] = {}
    for table in found:
        once.setdefault(table.raw_text[:120], table)
    return list(once.values())


TABLES = "record_id string, table_no bigint, table_type string, units string, columns_json string, rows_json string, n_rows bigint, n_columns bigint, summary string, raw_text string"


def detect_tables(records: DataFrame, key: str = "record_id", text: str = "chunk_text") -> DataFrame:
    """One row per table found in the texts, with columns and rows as arrays; null texts and texts without one give no row."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [
                (k, i, t.kind, t.units, json.dumps(t.columns, ensure_ascii=False), json.dumps(t.rows, ensure_ascii=False, sort_keys=True), len(t.rows), len(t.columns), t.summary(), t.raw_text)
                for k, x in zip(pdf["k"], pdf["t"])
                for i, t in enumerate(detect(x))
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in TABLES.split(", ")])

    hopeful = F.col(text).rlike(R.PIPE_ROW) | F.col(text).rlike(f"(?i){R.UNITS_ANCHOR}")
    found = records.where(hopeful).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(batches, TABLES)
    native = found.withColumn("columns", F.from_json("columns_json", "array<string>")).withColumn("rows", F.from_json("rows_json", "array<map<string,string>>"))
    return native.select("record_id", "table_no", "table_type", "units", "columns", "rows", "n_rows", "n_columns", "summary", "raw_text")
