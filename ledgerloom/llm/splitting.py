"""Oversized texts into pieces under a limit, by pointer doubling.

Every natural boundary of a text gets its farthest legal successor: the last
boundary that a piece may reach which starts where the overlap allows. Squaring
the successor table gives the boundary 2, 4, 8 ... cuts on, so all greedy cuts
of all texts of a batch are known after log2(most pieces) rounds of array
operations; no loop runs from cut to cut. The join of boundaries to successors
is a merge of sorted arrays within a batch: a text is never split over tasks
and nothing is shuffled.

Boundaries are the starts of sentences and lines. Where two lie farther apart
than a piece can bridge, the starts of words between them are used as well, and
where even those are missing, the starts of grapheme clusters. Only a cluster
that alone is longer than a piece can bridge is cut within.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2_000
OVERLAP = 200

_BLANKS = np.array([ord(c) for c in " \t\n\r     　"], dtype=np.uint32)
_ENDS = np.array([ord(c) for c in ".!?…"], dtype=np.uint32)
_WIDE_ENDS = np.array([ord(c) for c in "。！？"], dtype=np.uint32)
_CLOSERS = np.array([ord(c) for c in "\"')]}”’»"], dtype=np.uint32)
_WIDE_CLOSERS = np.array([ord(c) for c in "」』）】〉》”’"], dtype=np.uint32)
#: What never starts a cluster behind another character: marks, joiners, skin tones.
_IS_MARK = np.array([unicodedata.category(chr(c))[0] == "M" or 0x1F3FB <= c <= 0x1F3FF or c in (0x200C, 0x200D) for c in range(sys.maxunicode + 1)])
_CLUSTER = regex.compile(r"\X")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def cluster_starts(text: str) -> np.ndarray:
    """Where a grapheme cluster starts; a consonant behind a virama belongs to the cluster before."""
    starts = np.array([m.start() for m in _CLUSTER.finditer(text)], dtype=np.int64)
    joined = [i > 0 and unicodedata.combining(text[i - 1]) == 9 for i in starts.tolist()]
    return starts[~np.array(joined, dtype=bool)]


def boundaries(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
    """(where a piece may end, where a piece may start) of one text, both ascending, with 0 and its length."""
    codes = _codes(text)
    n = len(codes)
    blank = np.isin(codes, _BLANKS)
    starts_cluster = ~_IS_MARK[codes]
    word_start = np.flatnonzero(~blank[1:] & blank[:-1] & starts_cluster[1:]) + 1
    wide = np.flatnonzero(np.isin(codes[:-1], _WIDE_ENDS)) + 1 if n else np.array([], dtype=np.int64)
    while len(closed := np.flatnonzero(np.isin(codes[np.minimum(wide, n - 1)], _WIDE_CLOSERS) & (wide < n))) if n else 0:
        wide[closed] += 1
    wide = wide[starts_cluster[np.minimum(wide, n - 1)] | (wide == n)] if n else wide
    # The last sign before the blanks that precede a word: a sentence's end, perhaps behind a closing quote.
    solid = np.maximum.accumulate(np.where(blank, -1, np.arange(n))) if n else np.array([], dtype=np.int64)
    last = solid[word_start - 1] if len(word_start) else word_start
    sign = codes[np.maximum(last, 0)]
    closed = np.isin(sign, _CLOSERS) & (last > 0)
    sign = np.where(closed, codes[np.maximum(last - 1, 0)], sign)
    newline = np.concatenate([[0], np.cumsum(codes == 10)])
    lines = newline[word_start] > newline[np.maximum(last, 0)]
    # After "e.g." or "approx." a sentence goes on in lower case.
    following = codes[word_start]
    lower = (following >= 97) & (following <= 122)
    natural = word_start[np.isin(sign, _ENDS) & ~lower | np.isin(sign, _WIDE_ENDS) | lines]
    natural = np.unique(np.concatenate([[0], natural, wide, [n]]))
    starts = np.unique(np.concatenate([natural, word_start]))
    reach = limit - overlap
    bridged = _fill(natural, lambda a, b: starts[np.searchsorted(starts, a, "right") : np.searchsorted(starts, b, "left")], reach)
    bridged = _fill(bridged, lambda a, b: cluster_starts(text[a:b]) + a, reach)
    return _fill(bridged, lambda a, b: np.arange(a + 1, b), reach), starts


def _fill(have: np.ndarray, finer: Callable[[int, int], np.ndarray], reach: int) -> np.ndarray:
    """`have` with the finer positions wherever two of it lie more than `reach` apart."""
    gaps = np.flatnonzero(np.diff(have) > reach)
    return np.unique(np.concatenate([have, *(finer(have[g], have[g + 1]) for g in gaps)])) if len(gaps) else have


def split_batch(texts: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text no, start, end) of all pieces of all texts, in order."""
    ends, begins, owner_of_end, base, bases = [], [], [], 0, []
    for i, text in enumerate(texts):
        e, s = boundaries(text, limit, overlap)
        ends.append(e + base)
        begins.append(s + base)
        owner_of_end.append(np.full(len(e), i))
        bases.append(base)
        # Texts lie so far apart on the common line that no piece reaches into the next.
        base += len(text) + limit + overlap + 1
    b, s, owner = np.concatenate(ends), np.concatenate(begins), np.concatenate(owner_of_end)
    bases = np.array(bases)
    final = np.array([e[-1] for e in ends])[owner]
    first = np.array([e[0] for e in ends])[owner]
    # Where the piece after the cut b starts: the first word within the overlap, or the cut itself.
    start = np.maximum(s[np.searchsorted(s, np.maximum(b - overlap, first), "left")], first)
    start = np.where(start > b, b, start)
    start = np.where(b == first, first, start)
    reach = np.searchsorted(b, np.minimum(start + limit, final), "right") - 1
    here = np.arange(len(b))
    successor = np.where(b >= final, here, np.maximum(reach, np.minimum(here + 1, len(b) - 1)))
    roots = np.searchsorted(b, bases, "left")
    cuts = np.zeros(len(b), dtype=bool)
    cuts[roots] = True
    while True:
        reached = successor[np.flatnonzero(cuts)]
        grown = cuts.copy()
        grown[reached] = True
        if (grown == cuts).all():
            break
        cuts = grown
        successor = successor[successor]
    at = np.flatnonzero(cuts & (b < final))
    # A piece lasts from the start behind its cut to the cut's own successor: the next marked boundary.
    marked = np.flatnonzero(cuts)
    nxt = marked[np.searchsorted(marked, at, "right")]
    return owner[at], start[at] - bases[owner[at]], b[nxt] - bases[owner[at]]


def split_oversized(records: DataFrame, key: str, fields: list[str], limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """key, field_name, piece_no, start_char, end_char, piece of every field longer than `limit`.

    Characters are code points. Null, empty and short texts give no rows.
    Pieces are numbered from 0, cover the text without gaps and each repeats at
    most `overlap` characters of the one before. A text without any boundary is
    cut between grapheme clusters. Columns beside `key` and `fields` are ignored.
    """
    long = records.select(
        key, F.inline(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields)))
    ).where(F.length("text") > limit)
    names = [key, "field_name", "piece_no", "start_char", "end_char", "piece"]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if not len(pdf):
                continue
            texts = pdf["text"].tolist()
            owner, start, end = split_batch(texts, limit, overlap)
            number = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
            yield pd.DataFrame(
                {
                    key: pdf[key].to_numpy()[owner],
                    "field_name": pdf["field_name"].to_numpy()[owner],
                    "piece_no": number,
                    "start_char": start,
                    "end_char": end,
                    "piece": [texts[o][a:b] for o, a, b in zip(owner, start, end)],
                },
                columns=names,
            )

    return long.mapInPandas(batches, f"{key} string, field_name string, piece_no bigint, start_char bigint, end_char bigint, piece string")
