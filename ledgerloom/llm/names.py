"""Variant spellings of people's and companies' names, linked within a filing.

Names are read into tokens. Every token of a name is indexed under its
symmetric-delete neighbourhood together with the initials of the other tokens,
whatever their order, so spellings meet in a hash join on (filing, key) without
comparing all names: one token may be an edit off, the others may be initials,
abbreviations or nicknames. Pairs that meet are aligned token by token, by the
assignment of least cost.

A token may be one edit away from another of four letters and more. Two edits
link different names: of 207 pairs with leading tokens two edits apart in the
filings of the sf0.1 tables, none is of one entity.

Spellings are of two kinds. A full spelling names the entity by itself. A short
one (initials for a first name, an acronym, a company's first word) may fit
several entities, so it is linked only if all full spellings that it fits
belong to one entity; where it fits a company and its subsidiaries, it means
the company.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.graph import components_within
from ledgerloom.session import cut

# Usual short names of English first names.
NICKNAMES: dict[str, str] = {
    "alexander": "alex al sandy", "andrew": "andy drew", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben benny",
    "catherine": "cathy kate katie cat", "charles": "chuck charlie chas", "christopher": "chris kit", "daniel": "dan danny",
    "david": "dave davy", "deborah": "deb debbie debby", "donald": "don donny", "dorothy": "dot dottie", "edward": "ed eddie ted ned",
    "eleanor": "ellie nell nora", "elizabeth": "liz beth betty lizzie eliza betsy", "emily": "em", "eugene": "gene",
    "francesca": "fran frannie cesca", "francis": "frank", "frederick": "fred freddie", "gerald": "gerry jerry", "gregory": "greg",
    "henry": "harry hank", "isabella": "bella izzy", "jacob": "jake", "james": "jim jimmy jamie", "jennifer": "jen jenny jenn",
    "john": "jack johnny", "jonathan": "jon", "joseph": "joe joey", "joshua": "josh", "katherine": "kate kathy katie kat kitty",
    "kenneth": "ken kenny", "lawrence": "larry laurie", "leonard": "len lenny leo", "louis": "lou", "margaret": "peggy meg maggie marge greta",
    "matthew": "matt", "michael": "mike mick mickey", "nathaniel": "nate nat", "nicholas": "nick nicky", "olivia": "liv livvy ollie",
    "patricia": "pat patty trish tricia", "peter": "pete", "philip": "phil", "raymond": "ray", "rebecca": "becky becca", "richard": "dick rick rich richie",
    "robert": "bob rob bobby robbie", "ronald": "ron ronnie", "samuel": "sam sammy", "sarah": "sally", "stephen": "steve stevie", "steven": "steve stevie",
    "susan": "sue susie", "susanna": "sue susie sanna", "theodora": "dora thea teddy", "theodore": "ted teddy theo", "thomas": "tom tommy",
    "timothy": "tim timmy", "victoria": "vicky tori vic vickie", "vincent": "vince", "virginia": "ginny", "walter": "walt wally",
    "william": "bill will billy willie liam", "zachary": "zach zack",
}
# Legal forms by their shortest usual spelling.
LEGAL = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "co", "company": "co", "ltd": "ltd", "limited": "ltd",
    "llc": "llc", "llp": "llp", "lp": "lp", "plc": "plc", "ag": "ag", "gmbh": "gmbh", "sa": "sa", "nv": "nv", "bv": "bv", "spa": "spa", "ab": "ab",
}
# Abbreviations that aren't a beginning of the word they stand for.
ABBREVIATIONS = {
    "svcs": "services", "svc": "service", "mfg": "manufacturing", "indl": "industrial", "intl": "international", "natl": "national", "hldgs": "holdings",
    "labs": "laboratories", "inds": "industries", "mgmt": "management", "grp": "group", "bros": "brothers", "assn": "association", "dept": "department",
    "no": "northern", "so": "southern", "mkts": "markets", "fin": "financial", "ctr": "center", "pkg": "packaging", "eqpt": "equipment",
}
# Last words that make a company's name that of a unit of it.
UNIT_WORDS = frozenset("academy foundation finance gas insurance leasing realty water school university institute museum ventures capital partners bank trust energy health media studios".split())
TITLES = frozenset("mr mrs ms miss dr prof sir dame hon rev judge capt".split())
GENERATIONS = frozenset("jr sr ii iii iv".split())
_LINKS = frozenset(["and", "of", "the", "&"])
_FULL_OF = {short: frozenset(full for full, s in NICKNAMES.items() if short in s.split()) for s in NICKNAMES.values() for short in s.split()}


class Name(NamedTuple):
    """A spelling read: first names in order, the leading token, whether it may fit several, legal form or generation."""

    lead: str
    others: tuple[str, ...]
    short: bool
    tag: str
    letters: str


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:\.(?=\s|,|$))?|[,&]", re.sub(r"\b(?:[^\W\d_]\.){2,}", lambda m: m.group() if " " in m.group() else m.group(), re.sub(r"['’]s?\b", "", text)))


@lru_cache(maxsize=262_144)
def read_person(text: str) -> Name:
    """Surname as the lead, first names as the others; a short spelling has no full first name."""
    text = re.sub(r"(?<=\b[^\W\d_])\.(?=[^\W\d_]\b)", ". ", text)
    words = [w for w in _words(text) if w != "&"]
    lower = [w.lower().rstrip(".") for w in words]
    tag = next((w for w in lower if w in GENERATIONS), "")
    keep = [(w, x) for w, x in zip(words, lower) if x not in GENERATIONS and not (x in TITLES and len(words) > 1)]
    if "," in [w for w, _ in keep]:
        at = [w for w, _ in keep].index(",")
        keep = keep[at + 1 :] + keep[:at] if at else keep[1:]
    keep = [(w, x) for w, x in keep if w != ","]
    if not keep:
        return Name("", (), True, tag, "")
    lead, firsts = keep[-1][1], tuple(x if not (w.endswith(".") and len(x) > 1) else x + "." for w, x in keep[:-1])
    short = not firsts or len(firsts[0]) == 1 or firsts[0].endswith(".")
    return Name(lead, firsts, short, tag, "")


@lru_cache(maxsize=262_144)
def read_company(text: str) -> Name:
    """First word as the lead, the other content words in order; short: an acronym or one word only."""
    plain = text.strip()
    letters = re.sub(r"[.\s]", "", plain)
    if re.fullmatch(r"[A-Z]{2,}", letters) and (" " not in plain or re.fullmatch(r"(?:[A-Z]\.\s?)+", plain)):
        return Name("", (), True, "", letters.lower())
    plain = re.sub(r"\b(?:[^\W\d_]\.){2,}", lambda m: m.group().replace(".", "") + " ", plain)
    words = [w.lower().rstrip(".") for w in _words(plain)]
    if words and words[0] == "the":
        words = words[1:]
    tag = ""
    while len(words) > 1 and words[-1] in LEGAL:
        tag = tag or LEGAL[words.pop()]
        while len(words) > 1 and words[-1] == ",":
            words.pop()
    if "," in words:
        # "Services, Acme International": what stands before the comma belongs at the end.
        at = words.index(",")
        words = words[at + 1 :] + words[:at]
    if "of" in words[1:-1]:
        # "Energy Systems of Acme": the lead stands behind.
        at = len(words) - 1 - words[::-1].index("of")
        words = words[at + 1 :] + words[:at]
    words = [w for w in words if w not in _LINKS and w != ","]
    if not words:
        return Name("", (), True, tag, "")
    return Name(words[0], tuple(words[1:]), len(words) == 1, tag, "")


def _initials(text: str) -> list[str]:
    """The acronyms a full company name may have: with and without what follows an ampersand."""
    head = re.sub(r"\s*(?:&|\band\b)\s*[^\W_]+", "", text)
    return list(dict.fromkeys("".join([n.lead[:1], *(w[:1] for w in n.others)]) for n in (read_company(head), read_company(text))))


def within_one_edit(a: str, b: str) -> bool:
    """Equal, or one insertion, deletion, substitution or swap of neighbours apart, where one has four letters at least."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or max(len(a), len(b)) < 4:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


def deletions(token: str) -> list[str]:
    """The symmetric-delete neighbourhood of a token: itself and each with one character left out."""
    return list(dict.fromkeys([token, *(token[:i] + token[i + 1 :] for i in range(len(token)))])) if len(token) > 2 else [token]


def _initials_of(token: str) -> list[str]:
    """The letters that a given name or what it is short for may begin with."""
    plain = token.rstrip(".")
    return sorted({plain[0], *(f[0] for f in _FULL_OF.get(plain, ()))}) if plain else []


def keys(kind: str, text: str) -> tuple[list[str], list[str]]:
    """The index keys of a spelling as the one that is sought, and as a full one that others may fit."""
    if kind == "person":
        name = read_person(text)
        alone = ["s:" + name.lead]
        if not name.others:
            return alone, []
        first = name.others[0]
        sought = [f"n:{d}:{i}" for d in deletions(name.lead) for i in _initials_of(first)]
        if not name.short:
            sought += [f"n:{d}:{i}" for d in deletions(first) for i in _initials_of(name.lead)]
        return sought, [] if name.short else sought + alone
    name = read_company(text)
    if name.letters:
        return ["a:" + name.letters], []
    alone = ["s:" + name.lead]
    if name.short:
        return alone, []
    tokens = [ABBREVIATIONS.get(t.rstrip("."), t.rstrip(".")) for t in (name.lead, *name.others)]
    sought = []
    for k, token in enumerate(tokens):
        rest = "".join(sorted(t[:1] for n, t in enumerate(tokens) if n != k))
        sought += [f"n:{d}:{rest}" for d in deletions(token)]
    sought = list(dict.fromkeys(sought))
    return sought, sought + alone + ["a:" + i for i in _initials(text) if len(i) > 1]


def token_cost(a: str, b: str) -> float:
    """0 for the same word, less than 1 for what may stand for it, 9 for different words."""
    if a == b:
        return 0.0
    x, y = a.rstrip("."), b.rstrip(".")
    if len(x) > len(y):
        x, y = y, x
        a, b = b, a
    if len(x) == 1:
        return 0.4 if y[0] == x or any(f[0] == x for f in _FULL_OF.get(y, ())) else 9.0
    fx, fy = _FULL_OF.get(x, frozenset()), _FULL_OF.get(y, frozenset())
    if y in fx or x in fy or fx & fy:
        return 0.3
    if any(within_one_edit(f, y) for f in fx) or any(within_one_edit(f, x) for f in fy):
        return 0.6
    full_x, full_y = ABBREVIATIONS.get(x, x), ABBREVIATIONS.get(y, y)
    if full_x == full_y:
        return 0.2
    if len(x) > 3 and x[-1] == y[-1] == "s" and y.startswith(x[:-1]):
        # "Prods." for "Products": the beginning and the plural.
        return 0.3
    if len(x) >= 3 and y.startswith(x) and (a.endswith(".") or len(y) - len(x) >= 2):
        return 0.3
    if a.endswith(".") and any(f.startswith(x) for f in fy):
        return 0.4
    if within_one_edit(full_x, full_y):
        return 0.6
    if a.endswith(".") and len(x) >= 3 and (within_one_edit(x, y[: len(x)]) or within_one_edit(x, y[: len(x) + 1])):
        return 0.6
    return 9.0


def assignment(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Least total cost of giving each token of the shorter a token of the other; the rest is free.

    The shortest augmenting path for each token in turn, with potentials: n * n * m steps.
    """
    if len(a) > len(b):
        a, b = b, a
    straight = sum(map(token_cost, a, b))
    if straight == 0:
        return 0.0
    n, m = len(a), len(b)
    cost = [[token_cost(x, y) for y in b] for x in a]
    of_row, of_column, row_of = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        row_of[0], column = i, 0
        least, before, done = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while row_of[column]:
            done[column] = True
            row, step, nearest = row_of[column], float("inf"), 0
            for j in range(1, m + 1):
                if not done[j]:
                    rest = cost[row - 1][j - 1] - of_row[row] - of_column[j]
                    if rest < least[j]:
                        least[j], before[j] = rest, column
                    if least[j] < step:
                        step, nearest = least[j], j
            for j in range(m + 1):
                if done[j]:
                    of_row[row_of[j]] += step
                    of_column[j] -= step
                else:
                    least[j] -= step
            column = nearest
        while column:
            row_of[column], column = row_of[before[column]], before[column]
    return sum(cost[row_of[j] - 1][j - 1] for j in range(1, m + 1) if row_of[j])


def _first_fits(first: str, other: str) -> bool:
    return token_cost(first, other) < 1


def same_person(a: Name, b: Name) -> bool:
    """Surname and all given names fit; a middle name may be missing on one side, but not differ. Surnames may stand first."""
    if a.tag and b.tag and a.tag != b.tag:
        return False
    if not within_one_edit(a.lead, b.lead):
        # Both names whole and in another order, such as the surname first without a comma.
        return len(a.others) == len(b.others) > 0 and not a.short and not b.short and a.lead in b.others and assignment((a.lead, *a.others), (b.lead, *b.others)) == 0
    if not a.others or not b.others:
        return a.lead == b.lead
    edits = (a.lead != b.lead) + (token_cost(a.others[0], b.others[0]) == 0.6)
    return edits <= 2 and _first_fits(a.others[0], b.others[0]) and assignment(a.others[1:], b.others[1:]) < 1


def same_company(a: Name, b: Name, text_a: str, text_b: str) -> bool:
    """Every content word fits one of the other's; legal forms agree where both have one."""
    if a.letters or b.letters:
        if a.letters and b.letters:
            return a.letters == b.letters
        short, full = (a, text_b) if a.letters else (b, text_a)
        return short.letters in _initials(full)
    if a.tag and b.tag and a.tag != b.tag:
        return False
    if not within_one_edit(a.lead, b.lead):
        # The same words in another order, at most one of them misspelled.
        return not (a.short or b.short) and len(a.others) == len(b.others) and assignment((a.lead, *a.others), (b.lead, *b.others)) < 0.7
    if a.short or b.short:
        return a.lead == b.lead or a.short and b.short
    if len(a.others) != len(b.others):
        return False
    return assignment(a.others, b.others) < 1.3 * max(1, len(a.others)) and all(
        min((token_cost(x, y) for y in b.others), default=9) < 1 for x in a.others
    )


def same(kind: str, a: str, b: str) -> bool:
    """Whether two spellings of one filing can mean the same person or company."""
    if kind == "person":
        return same_person(read_person(a), read_person(b))
    return same_company(read_company(a), read_company(b), a, b)


def _rank(kind: str, text: str) -> int:
    """Words of a company's full name, one more for a unit's; the shorter is the parent."""
    if kind == "person":
        return 0
    name = read_company(text)
    return len(name.others) + (10 if name.others and name.others[-1] in UNIT_WORDS and len(name.others) > 2 else 0)


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        read = [(read_person(n) if k == "person" else read_company(n)).short for k, n in zip(pdf["kind"], pdf["name"])]
        both = [keys(k, n) for k, n in zip(pdf["kind"], pdf["name"])]
        yield pdf.assign(short=read, sought=[k[0] for k in both], full=[k[1] for k in both])


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        fits = [same(k, a, b) for k, a, b in zip(pdf["kind"], pdf["name_a"], pdf["name_b"])]
        kept = pdf[fits]
        rank = [_rank(k, b) for k, b in zip(kept["kind"], kept["name_b"])]
        yield kept.assign(rank=rank)


def linked_spellings(names: DataFrame) -> DataFrame:
    """(scope, kind, name, entity): every spelling with its entity's smallest full spelling.

    `names` has scope, kind ('person' or 'company') and name. Nulls and blank
    names are left out, repeated rows count once; other columns are ignored.
    Only spellings of one scope meet that share a token, but for an edit, and
    the initials of the others.
    """
    clean = names.select("scope", "kind", "name").dropna().where(F.trim("name") != "").distinct()
    read = cut(clean.mapInPandas(_read, "scope string, kind string, name string, short boolean, sought array<string>, full array<string>"), "names")
    a = read.where("NOT short").select("scope", "kind", F.explode("full").alias("key"), F.col("name").alias("name_b"))
    b = read.select("scope", "kind", F.explode("sought").alias("key"), F.col("name").alias("name_a"), F.col("short").alias("short_a"))
    # Full with full in one direction, short with full in the other: each pair is met once.
    met = b.join(a, ["scope", "kind", "key"]).where("short_a OR name_a < name_b").select("scope", "kind", "name_a", "name_b", "short_a").distinct()
    fits = cut(met.mapInPandas(_verify, "scope string, kind string, name_a string, name_b string, short_a boolean, rank int"), "fits")

    full = read.where("NOT short").select("scope", "kind", "name")
    entities = components_within(fits.where("NOT short_a"), ["scope", "kind"], "name_a", "name_b").withColumnRenamed("node", "name")
    full = full.join(entities, ["scope", "kind", "name"], "left").select("scope", "kind", "name", F.coalesce("component", "name").alias("entity"))
    candidates = fits.where("short_a").join(full.withColumnRenamed("name", "name_b"), ["scope", "kind", "name_b"])
    # The least rank is the parent; then all fitting full spellings must be of one entity.
    ranked = candidates.groupBy("scope", "kind", "name_a", "entity").agg(F.min("rank").alias("rank"))
    least = ranked.groupBy("scope", "kind", "name_a").agg(F.min("rank").alias("least"))
    ties = ranked.join(least, ["scope", "kind", "name_a"]).where("rank = least")
    sole = ties.groupBy("scope", "kind", "name_a").agg(F.count("*").alias("n"), F.min("entity").alias("entity")).where("n = 1")
    short = read.where("short").select("scope", "kind", "name")
    placed = short.join(sole.select("scope", "kind", F.col("name_a").alias("name"), "entity"), ["scope", "kind", "name"], "left")
    alone = F.when(F.col("kind") == "company", F.upper(F.regexp_replace("name", r"[.\s]", ""))).otherwise(F.col("name"))
    placed = placed.select("scope", "kind", "name", F.coalesce("entity", F.concat(F.lit("\x1e"), alone)).alias("entity"))
    return full.union(placed)


def spelling_pairs(linked: DataFrame) -> DataFrame:
    """(scope, name_a, name_b), a < b: all pairs of an entity's spellings in a scope."""
    a = linked.select("scope", "kind", "entity", F.col("name").alias("name_a"))
    b = linked.select("scope", "kind", "entity", F.col("name").alias("name_b"))
    return a.join(b, ["scope", "kind", "entity"]).where("name_a < name_b").select("scope", "name_a", "name_b").distinct()
