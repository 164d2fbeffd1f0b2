"""Text that looks the same, in one form: a compiled longest-match transducer over grapheme clusters.

The mapping has keys of one character (widths, blanks, invisible characters,
look-alike letters) and of several (a letter and its marks, half-width kana and
its voicing sign, a look-alike and the marks it bears). It is made by rules
over the Unicode database and the Unicode confusables data, checked for
conflicts (`checked`) and compiled into automata that find the longest key at
each place from left to right.

Two mappings share the pass: the plain one, and the one of words with a Latin
letter, which holds the look-alikes of all other scripts besides. A word is a
maximal run of letters, marks, digits and invisible characters; a word wholly
in another script keeps its letters, and Han, kana, Hangul and Bopomofo have no
look-alikes. Invisible characters inside a word are skipped as its clusters are
read, so they part no letter from its marks. Marks that no key takes up are put
in canonical order.
"""

from __future__ import annotations

import re
import struct
import sys
import unicodedata
import zipfile
from collections.abc import Iterator
from functools import cache, lru_cache
from pathlib import Path

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cyrillic and Greek letters read as Latin ones here, also where their usual form differs a little.
CYRILLIC_PLAIN = "АВЕЅІЈКМНОРСТУХаеѕіјорсухԛԝһԁӏүԌѡ"
CYRILLIC_LATIN = "ABESIJKMHOPCTYXaesijopcyxqwhdlyGw"
CYRILLIC_MORE_PLAIN = "ЬвкмнтгѵѴӀԚԜҮп"
CYRILLIC_MORE_LATIN = "bBkmHTrvVIQWYn"
GREEK_PLAIN = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυχϲϳγκτεω"
GREEK_LATIN = "ABEZHIKMNOPTYXaivopuxcjyktew"

# Characters that show nothing, beyond the Unicode category Cf.
INVISIBLE_EXTRA = "͏ᅟᅠ឴឵ㅤﾠ︀︁︂︃︄︅︆︇︈︉︊︋︌︍︎"
LIGATURES = "ﬀﬁﬂﬃﬄﬅﬆ"
#: The emoji joiner and the emoji variation selector are part of the emoji they stand in.
JOINER, EMOJI_STYLE = "\u200d", "\ufe0f"
#: The half-width signs that voice the kana before them, by the mark they stand for.
_HALF_MARKS = {"゙": "ﾞ", "゚": "ﾟ"}
_OWN_SCRIPT = regex.compile(r"[\p{Latin}\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Bopomofo}\p{Common}\p{Inherited}]")


def confusables_data() -> dict[str, str]:
    """Character to prototype, from the Unicode confusables data that Spark's own ICU library carries.

    Empty where the library isn't found. The file has sorted keys (the
    character, and the prototype's length less one in the highest byte) and for
    each the prototype or its place in a string table.
    """
    import os

    import pyspark

    for home in (os.environ.get("SPARK_HOME", ""), os.path.dirname(pyspark.__file__)):
        for jar in sorted(Path(home, "jars").glob("icu4j-*.jar")) if home else []:
            with zipfile.ZipFile(jar) as z:
                names = [n for n in z.namelist() if n.endswith("confusables.cfu")]
                if names:
                    return _read_prototypes(z.read(names[0]))
    return {}


def _read_prototypes(raw: bytes) -> dict[str, str]:
    data = raw[struct.unpack(">H", raw[:2])[0] :]
    keys_at, n, values_at, _, strings_at, n_strings = struct.unpack(">6i", data[12:36])
    keys = struct.unpack(f">{n}I", data[keys_at : keys_at + 4 * n])
    values = struct.unpack(f">{n}H", data[values_at : values_at + 2 * n])
    strings = data[strings_at : strings_at + 2 * n_strings]
    out = {}
    for key, value in zip(keys, values):
        size = (key >> 24) + 1
        out[chr(key & 0xFFFFFF)] = chr(value) if size == 1 else strings[2 * value : 2 * (value + size)].decode("utf-16-be", "replace")
    return out


@cache
def lookalikes() -> dict[str, str]:
    """Letter or mark of another script to the Latin letter or the common mark that it looks like.

    The fixed pairs hold first. Of the confusables data, a letter is taken whose
    prototype is that of a Latin letter of the same case, else of the other.
    """
    out = dict(zip(GREEK_PLAIN + CYRILLIC_PLAIN + CYRILLIC_MORE_PLAIN, GREEK_LATIN + CYRILLIC_LATIN + CYRILLIC_MORE_LATIN, strict=True))
    prototypes = confusables_data()
    latin: dict[tuple[str, bool], str] = {}
    for x in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
        latin.setdefault((prototypes.get(x, x), x.isupper()), x)
    for c, prototype in prototypes.items():
        kind = unicodedata.category(c)
        if c in out or _OWN_SCRIPT.match(c) or unicodedata.normalize("NFD", c) != c:
            continue
        if kind[0] == "L":
            found = latin.get((prototype, c.isupper())) or latin.get((prototype, not c.isupper()))
            if found:
                out[c] = found
        elif kind == "Mn" and len(prototype) == 1 and regex.match(r"\p{Inherited}", prototype):
            out[c] = prototype
    return out


def checked(pairs: Iterator[tuple[str, str]]) -> dict[str, str]:
    """The mapping of the pairs; ValueError on a conflict.

    No key may have two outputs. Reading an output again must change nothing. A
    key that begins with another key must come out the same if that one is
    rewritten first.
    """
    out: dict[str, str] = {}
    for source, target in pairs:
        if out.setdefault(source, target) != target:
            raise ValueError(f"two outputs for {source!r}: {out[source]!r} and {target!r}")
    again = _apply(_automaton(out))
    for source, target in out.items():
        if again(target) != target:
            raise ValueError(f"{source!r} gives {target!r}, which is rewritten again")
        for n in range(1, len(source)):
            first = out.get(source[:n])
            if first and again(first + source[n:]) != target:
                raise ValueError(f"{source!r} gives another form behind {source[:n]!r}")
    return out


def _single_pairs() -> Iterator[tuple[str, str]]:
    """Widths, ligatures, blanks, invisible characters, letters with a canonical twin."""
    for code in range(sys.maxunicode + 1):
        ch = chr(code)
        category = unicodedata.category(ch)
        if category == "Zs" and ch != " " or ch == "\t":
            yield ch, " "
        elif category == "Cf" and ch != JOINER or ch in INVISIBLE_EXTRA or category == "Cc" and ch not in "\n\r\t":
            yield ch, ""
        elif 0xFF01 <= code <= 0xFF9F and category[0] in "LN" or ch in LIGATURES or 0x1D400 <= code <= 0x1D7FF and category[0] in "LN":
            yield ch, unicodedata.normalize("NFKC", ch)
        elif category[0] == "L" and len(twin := unicodedata.normalize("NFC", ch)) == 1 and twin != ch and not regex.match(r"\p{Han}", ch):
            yield ch, twin


@cache
def _composites() -> dict[str, list[tuple[str, str]]]:
    """Of each base: its marks in canonical order, and the one character that both make."""
    out: dict[str, list[tuple[str, str]]] = {}
    for code in range(sys.maxunicode + 1):
        ch = chr(code)
        apart = unicodedata.normalize("NFD", ch)
        if len(apart) > 1 and not 0xAC00 <= code <= 0xD7A3 and unicodedata.normalize("NFC", ch) == ch:
            out.setdefault(apart[0], []).append((apart[1:], ch))
    return out


def _with_marks(shown: str, base: str) -> Iterator[tuple[str, str]]:
    """Every spelling of `shown` for `base` and marks, also with the first marks composed."""
    for marks, whole in _composites().get(base, []):
        for n in range(len(marks)):
            head = unicodedata.normalize("NFC", base + marks[:n])
            if n == 0:
                head = shown
            elif len(head) > 1:
                continue
            yield head + marks[n:], whole
            if marks[n:] in _HALF_MARKS:
                yield head + _HALF_MARKS[marks[n:]], whole


@cache
def plain_mapping() -> dict[str, str]:
    """The mapping of all text."""

    def pairs() -> Iterator[tuple[str, str]]:
        single = dict(_single_pairs())
        yield from single.items()
        for base in _composites():
            yield from _with_marks(base, base)
        for shown, base in single.items():
            if len(base) == 1 and base != " ":
                yield from _with_marks(shown, base)

    return checked(pairs())


def latin_mapping(look: dict[str, str]) -> dict[str, str]:
    """The mapping of words with a Latin letter: the plain one, with look-alikes, bare and with marks."""

    def pairs() -> Iterator[tuple[str, str]]:
        own = {c for base in look for _, c in _composites().get(base, [])}
        for source, target in plain_mapping().items():
            if target not in own and target not in look:
                yield source, target
        for shown, latin in look.items():
            yield shown, latin
            yield from _with_marks(shown, latin)
            # Letters of the other script that are composed with marks, such as the one with a diaeresis.
            for marks, whole in _composites().get(shown, []):
                turned = unicodedata.normalize("NFC", latin + marks)
                yield whole, turned
                for spelled, target in _with_marks(shown, shown):
                    if target == whole and spelled[:1] != shown:
                        yield spelled, turned
        for source, target in plain_mapping().items():
            # What the plain mapping turns into such a letter, as a full-width or styled form does.
            if target in look:
                yield source, look[target]
            elif target in own and source[:1] not in look and not any(source.startswith(o) for o in own):
                base, marks = unicodedata.normalize("NFD", target)[0], unicodedata.normalize("NFD", target)[1:]
                yield source, unicodedata.normalize("NFC", look[base] + marks)

    return checked(pairs())


def _automaton(mapping: dict[str, str]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for source, target in mapping.items():
        out.add_word(source, (len(source), target))
    if mapping:
        out.make_automaton()
    return out


def _apply(automaton: ahocorasick.Automaton):
    """A function that rewrites a string by the longest key at each place, in one pass."""

    def run(text: str) -> str:
        if not len(automaton):
            return text
        parts, at = [], 0
        for end, (size, target) in automaton.iter_long(text):
            start = end + 1 - size
            parts.append(text[at:start])
            parts.append(target)
            at = end + 1
        return "".join([*parts, text[at:]]) if parts else text

    return run


class Transducer:
    """The two mappings compiled, and the pass over a text; `look` as `lookalikes` gives it."""

    def __init__(self, look: dict[str, str]):
        plain, latin = plain_mapping(), latin_mapping(look)
        self._plain, self._latin = _apply(_automaton(plain)), _apply(_automaton(latin))
        invisible = "".join(re.escape(c) for c, t in plain.items() if t == "" and len(c) == 1) + JOINER
        self._invisible = re.compile(f"[{invisible}]")
        marks = "".join(re.escape(c) for c in look if unicodedata.category(c)[0] == "M")
        emoji, emoji_base = "←-⯿\U0001f000-\U0001faff", "←-⯿‼-㊙\U0001f000-\U0001faff0-9#*©®"
        # A word; or a joiner or a style sign outside an emoji; or what stands between.
        self._pass = regex.compile(
            rf"(?P<word>[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}]|(?!{EMOJI_STYLE})\p{{M}}|[{marks}{invisible}])*)"
            rf"|(?P<stray>(?<![{emoji}{EMOJI_STYLE}]){JOINER}|{JOINER}(?![{emoji}])|(?<![{emoji_base}]){EMOJI_STYLE})|(?P<other>[^\p{{L}}\p{{N}}{JOINER}{EMOJI_STYLE}]+|[{JOINER}{EMOJI_STYLE}])"
        )
        self._has_latin = regex.compile(r"[\p{Latin}\U0001d400-\U0001d6a5]")
        self._mark = regex.compile(r"\p{M}")
        #: A text with none of these is in its form already.
        self._suspects = frozenset(c for k in (plain | latin) for c in (k if len(k) == 1 else k[1:])) | {JOINER, EMOJI_STYLE} | {chr(c) for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))}
        self._word = lru_cache(maxsize=262_144)(self._word_form)

    def _word_form(self, word: str) -> str:
        read = self._invisible.sub("", word)
        if self._mark.search(read):
            read = self._ordered(read)
        out = (self._latin if self._has_latin.search(read) else self._plain)(read)
        return unicodedata.normalize("NFC", out) if self._mark.search(out) else out

    @staticmethod
    def _ordered(word: str) -> str:
        """Marks of each cluster in canonical order, letters as they are."""
        out, held = [], []
        for c in word:
            if unicodedata.combining(c):
                held.append(c)
            else:
                out += sorted(held, key=unicodedata.combining)
                held = []
                out.append(c)
        return "".join(out + sorted(held, key=unicodedata.combining))

    def _stretch(self, m: regex.Match) -> str:
        if m["word"] is not None:
            return m["word"] if m["word"].isascii() else self._word(m["word"])
        return "" if m["stray"] is not None else self._plain(m["other"])

    def normalize(self, text: str | None) -> str | None:
        """The consistent form of a text; null stays null, an empty text empty."""
        if text is None or self._suspects.isdisjoint(text):
            return text
        # A blank is in no key, so the stretches between blanks are read one by one and plain ones passed over.
        return " ".join([t if self._suspects.isdisjoint(t) else self._pass.sub(self._stretch, t) for t in text.split(" ")])


@lru_cache(maxsize=2)
def _compiled(look: tuple[tuple[str, str], ...]) -> Transducer:
    return Transducer(dict(look))


def normalize(text: str | None) -> str | None:
    """The consistent form of one text."""
    return _compiled(tuple(lookalikes().items())).normalize(text)


def _suspect(col: Column) -> Column:
    """Whether the JVM must hand a text to the pass: anything but printable ASCII and line ends."""
    return col.rlike(r"[^\x20-\x7e\n]")


def with_consistent_form(records: DataFrame, *fields: str, suffix: str = "_form") -> DataFrame:
    """`records` with each field's consistent form beside it.

    Texts of plain ASCII never leave the JVM. Nulls stay null. Other columns
    pass through untouched; a column that already bears the new name is
    replaced.
    """
    look = tuple(lookalikes().items())  # read by the driver, some hundred pairs

    @F.pandas_udf("string")
    def form(texts: pd.Series) -> pd.Series:
        return texts.map(_compiled(look).normalize, na_action="ignore")

    out = records
    for f in fields:
        out = out.withColumn(f + suffix, F.when(_suspect(F.col(f)), form(F.when(_suspect(F.col(f)), F.col(f)))).otherwise(F.col(f)))
    return out


def inconsistent_fields(records: DataFrame, key: str, *fields: str) -> DataFrame:
    """(key, field_name) of each field that isn't in its consistent form yet; null and empty fields are."""
    look = tuple(lookalikes().items())
    long = records.select(
        key, F.inline(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields)))
    ).where(_suspect(F.col("text")))

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        form = _compiled(look).normalize
        for pdf in frames:
            changed = [form(t) != t for t in pdf["text"]]
            yield pdf.loc[changed, [key, "field_name"]]

    return long.mapInPandas(batches, f"{key} string, field_name string")
