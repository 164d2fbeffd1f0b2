"""Reading measured values: numbers, scales, currencies and units as written.

Plain functions over strings, for use inside Arrow-batched operators. All
arithmetic is on integers and ratios of integers, so no value loses digits.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

# Exact size of each unit in the common unit, as numerator and denominator.
UNITS: dict[str, tuple[str, int, int]] = {
    "m2": ("m2", 1, 1),
    "ha": ("m2", 10_000, 1),
    "km2": ("m2", 1_000_000, 1),
    "acre": ("m2", 40_468_564_224, 10_000_000),
    "ft2": ("m2", 9_290_304, 100_000_000),
    "kg": ("kg", 1, 1),
    "g": ("kg", 1, 1_000),
    "t": ("kg", 1_000, 1),
    "kt": ("kg", 1_000_000, 1),
    "lb": ("kg", 45_359_237, 100_000_000),
    "short_ton": ("kg", 2_000 * 45_359_237, 100_000_000),
    "mwh": ("mwh", 1, 1),
    "kwh": ("mwh", 1, 1_000),
    "gwh": ("mwh", 1_000, 1),
    "twh": ("mwh", 1_000_000, 1),
    "mj": ("mwh", 1, 3_600),
    "gj": ("mwh", 10, 36),
    "tj": ("mwh", 10_000, 36),
    "pj": ("mwh", 10_000_000, 36),
    "km": ("km", 1, 1),
    "m": ("km", 1, 1_000),
    "mi": ("km", 1_609_344, 1_000_000),
    "ft": ("km", 3_048, 10_000_000),
    "l": ("l", 1, 1),
    "hl": ("l", 100, 1),
    "ml": ("l", 1_000_000, 1),
    "m3": ("l", 1_000, 1),
    "gal": ("l", 3_785_411_784, 1_000_000_000),
    "bbl": ("l", 42 * 3_785_411_784, 1_000_000_000),
    "pct": ("pct", 1, 1),
    "bps": ("pct", 1, 100),
}

# Spellings of units (matched in any case unless a spelling needs its case).
UNIT_WORDS: dict[str, str] = {
    "m2": r"m²|m2|sqm|sq\.? ?m|square met(?:re|er)s?",
    "ha": r"ha|hectares?",
    "km2": r"km²|km2|sq\.? ?km|square kilomet(?:re|er)s?",
    "acre": r"acres?",
    "ft2": r"ft²|ft2|sqft|sq\.? ?ft\.?|square (?:feet|foot)",
    "kg": r"kg|kgs|kilograms?|kilogrammes?|kilos?",
    "t": r"t|tonnes?|metric tons?|metric tonnes?",
    "kt": r"kt|kilotonnes?|kilotons?",
    "lb": r"lbs?\.?|pounds of resin|pounds?",
    "short_ton": r"short tons?|tons?",
    "mwh": r"MWh|megawatt[- ]hours?",
    "kwh": r"kWh|kilowatt[- ]hours?",
    "gwh": r"GWh|gigawatt[- ]hours?",
    "twh": r"TWh|terawatt[- ]hours?",
    "mj": r"MJ|megajoules?",
    "gj": r"GJ|gigajoules?",
    "tj": r"TJ|terajoules?",
    "pj": r"PJ|petajoules?",
    "km": r"km|kilomet(?:re|er)s?",
    "m": r"m|met(?:re|er)s?",
    "mi": r"mi|route miles?|miles?",
    "ft": r"ft|feet|foot",
    "l": r"l|lit(?:re|er)s?",
    "hl": r"hl|hectolit(?:re|er)s?",
    "m3": r"m³|m3|cubic met(?:re|er)s?",
    "gal": r"gal\.?|US gallons?|gallons?",
    "bbl": r"bbls?|barrels?",
    "pct": r"%|percent|per cent|pct",
    "bps": r"bps|bp|basis points?",
}

# Currencies.
CURRENCY_WORDS: dict[str, str] = {
    "USD": r"US\$|\$|USD|US dollars?|dollars?",
    "EUR": r"EUR|€|euros?",
    "GBP": r"GBP|£|pounds sterling|pounds?",
    "CHF": r"CHF|Swiss francs?|francs?",
    "JPY": r"JPY|¥|yen",
}

# Scales; of `kind` w a word of its own, s a suffix that needs a currency, d German.
SCALE_WORDS: list[tuple[int, str, str]] = [
    (10**3, "w", r"thousands?|(?<!\d)'000s?|(?<!\d)(?<!\d[.,'’])000s?"),
    (10**6, "w", r"millions?"),
    (10**9, "w", r"billions?"),
    (10**12, "w", r"trillions?"),
    (10**3, "d", r"Tsd\.?|Tausend"),
    (10**6, "d", r"Mio\.?|Millionen"),
    (10**9, "d", r"Mrd\.?|Milliarden"),
    (10**3, "s", r"k|K"),
    (10**6, "s", r"m|M|mn|mln|mm"),
    (10**9, "s", r"b|B|bn|bln"),
]



def _spellings(pattern: str) -> list[str]:
    """The alternatives of a pattern, without those inside brackets."""
    return re.findall(r"(?:[^|(]|\([^)]*\))+", pattern)


_CURRENCY = re.compile(
    "|".join(f"(?P<{c}>{'|'.join(w if w[0] in '$€£¥' or w[-1] == '$' else rf'(?<![A-Za-z])(?:{w})(?![A-Za-z])' for w in p.split('|'))})" for c, p in CURRENCY_WORDS.items())
)
_WORD_SCALE = re.compile("|".join(rf"(?P<x{i}>(?:(?<![A-Za-z])|(?<={'|'.join(CURRENCY_WORDS)})){'(?:' + p + ')'}(?![A-Za-z0-9]))" for i, (_, k, p) in enumerate(SCALE_WORDS) if k in "wd"))
_SUFFIX_SCALE = re.compile("|".join(rf"(?P<x{i}>(?<![A-Za-z])(?:{p})(?![A-Za-z0-9²³/]))" for i, (_, k, p) in enumerate(SCALE_WORDS) if k == "s"))
_LONGEST = sorted(
    ((w, u) for u, p in UNIT_WORDS.items() for w in _spellings(p)), key=lambda x: -len(x[0])
)
_UNIT = re.compile(
    "|".join(rf"(?P<u{i}>(?<![A-Za-z]){'(?:' + w + ')'}(?![A-Za-z0-9²³]))" if w != "%" else rf"(?P<u{i}>%)" for i, (w, _) in enumerate(_LONGEST)),
)
_UNIT_OF = {f"u{i}": u for i, (_, u) in enumerate(_LONGEST)}
_SCALE_OF = {f"x{i}": (size, kind) for i, (size, kind, _) in enumerate(SCALE_WORDS)}
NUMBER = re.compile(r"\d+(?:[.,'’  ]\d+)*")
PER_SHARE = re.compile(r"per[- ]share|per[- ]unit|pro Aktie|a share", re.I)
_EXCEPT = re.compile(r"(?:,|\bund\b)?\s*\(?except(?: for)? per[- ]share[^)]*\)?", re.I)


class Unit(NamedTuple):
    """What a string says of a unit; None where it says nothing."""

    currency: str | None
    scale: int | None
    unit: str | None
    german: bool | None


@lru_cache(maxsize=65_536)
def read_unit(text: str) -> Unit:
    """Currency, scale and unit named in `text` (a unit, a label, a heading, the rest of a cell)."""
    text = _EXCEPT.sub("", text)
    c = _CURRENCY.search(text)
    currency = c.lastgroup if c else None
    s = _WORD_SCALE.search(text)
    unit = None
    rest = text
    if s:
        rest = text[: s.start()] + " " + text[s.end() :]
    u = _UNIT.search(rest)
    if u:
        unit = _UNIT_OF[u.lastgroup]
    if currency and unit == "lb" and "resin" in rest:
        currency = None
    if currency and unit not in ("pct", "bps"):
        unit = None
        if not s:
            s = _SUFFIX_SCALE.search(text)
    scale, kind = _SCALE_OF[s.lastgroup] if s else (None, None)
    german = True if kind == "d" or "Angaben" in text or "Beträge" in text else False if s or unit not in (None, "pct") or (c and len(c.group()) > 3) else None
    return Unit(currency, scale, unit, german)


def read_number(text: str, german: bool) -> tuple[int, int] | None:
    """The first number of `text` as mantissa and decimals, signed as written; None without digits.

    German numbers have a decimal comma and points between thousands, others
    the reverse. A minus before it or brackets around it make it negative.
    """
    m = NUMBER.search(text)
    if not m:
        return None
    digits = m.group()
    point = "," if german else "."
    whole, _, part = digits.partition(point)
    strip = lambda x: re.sub(r"\D", "", x)
    part = strip(part)
    value = int(strip(whole) + part)
    before = text[: m.start()]
    if "-" in before or "−" in before or "(" in before and ")" in text[m.end() :]:
        value = -value
    return value, len(part)


def times_100(number: tuple[int, int], scale: int, num: int = 1, den: int = 1) -> int:
    """number * scale * num / den * 100, rounded to the nearest integer, halves away from zero."""
    mantissa, decimals = number
    n = abs(mantissa) * scale * num * 100
    d = den * 10**decimals
    q = (2 * n + d) // (2 * d)
    return -q if mantissa < 0 else q


def convert(number: tuple[int, int], scale: int, unit: str) -> tuple[str, int]:
    """(common unit, value times 100)."""
    code, num, den = UNITS[unit]
    return code, times_100(number, scale, num, den)
