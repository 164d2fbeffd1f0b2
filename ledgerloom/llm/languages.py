"""Languages of documents and of their segments, by nearest centroid.

A sentence is the sum of its words' character n-grams, hashed to DIMENSIONS and
weighted by inverse document frequency; its cosine is taken with several
centroids per language, found by spherical k-means. The centroids are trained
here, on a bounded sample of the labelled documents, after sentences whose
nearest centroid denies their label have been dropped (labels may be wrong).

A sentence too far from every centroid, or of a single word, has no language of
its own (names, figures): it belongs to the segment before it, at the start of
a text to the one behind it. A sentence that stands alone between two of one
other language and is near both is taken as theirs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import spread

DIMENSIONS = 512
#: The sample that centroids are fitted on: documents per language, in the order of a hash of their ids.
SAMPLE_DOCS = 250
CENTROIDS = 4
SHARPNESS = 25.0

# Usual codes and names of the languages, in lower case.
LANGUAGE_NAMES: dict[str, str] = {
    "en": "en eng english anglais englisch inglés",
    "de": "de deu ger german deutsch allemand alemán",
    "fr": "fr fra fre french français francais",
    "es": "es spa spanish español espanol castellano castilian",
    "it": "it ita italian italiano",
    "nl": "nl nld dut dutch nederlands flemish",
    "pt": "pt por portuguese português portugues",
    "sv": "sv swe swedish svenska",
    "ja": "ja jpn japanese 日本語 jp",
}
# What stands in place of a missing label.
PLACEHOLDERS = ("", "und", "unknown", "unk", "xx", "xxx", "zxx", "mul", "mis", "n/a", "na", "none", "null", "?", "-", "--", "undefined", "other")
# Words before a full stop that doesn't end the sentence.
ABBREVIATIONS = "Mio Mrd Tsd Nr Inc Corp Ltd Co Dr Mr Mrs Ms Prof St Art Abs bzw ca etc vs approx No Sr Sra Sig Dhr Mevr M Mme bl jfr kap"

_NOT_END = "|".join(re.escape(a) for a in ABBREVIATIONS.split())
_BREAK = re.compile(rf"(?<=[.!?…])(?<!\b(?:e\.g|i\.e|z\.B)\.)[\"”’»)\]]*\s+|(?<=[。！？])|\n+")
_ABBREVIATED = re.compile(rf"(?:^|[\s(])(?:{_NOT_END}|[^\W\d_]|(?:[^\W\d_]\.)+[^\W\d_])\.$")
_WORD = re.compile(r"[぀-ヿ一-鿿]|[^\W\d_぀-ヿ一-鿿]+")


def label_code(label: Column) -> Column:
    """The code that a label denotes, with or without a country; null where it is missing or a placeholder, '?' where unknown."""
    plain = F.lower(F.trim(label))
    base = F.element_at(F.split(plain, "[-_ ]"), 1)
    codes = {name: code for code, names in LANGUAGE_NAMES.items() for name in names.split()}
    known = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))
    return F.when(plain.isNull() | plain.isin(*PLACEHOLDERS), F.lit(None)).otherwise(
        F.coalesce(F.try_element_at(known, plain), F.try_element_at(known, base), F.lit("?"))
    )


def sentences(text: str) -> list[str]:
    """The sentences of a text, in order; a stop after an abbreviation ends none."""
    out: list[str] = []
    held = ""
    at = 0
    for m in _BREAK.finditer(text):
        piece = text[at : m.end()]
        at = m.end()
        if "\n" not in m.group() and m.group() and _ABBREVIATED.search(piece.rstrip()):
            held += piece
            continue
        out.append(held + piece)
        held = ""
    out.append(held + text[at:])
    return [s for s in out if s.strip()]


def _grams(word: str) -> list[int]:
    """The hashed n-grams (1 to 3 characters) of a word and its borders."""
    marked = f"_{word}_"
    return [zlib.crc32(marked[i : i + n].encode("utf-8", "surrogatepass")) % DIMENSIONS for n in (1, 2, 3) for i in range(len(marked) - n + 1)]


class _Words:
    """The n-grams of each word seen, one word behind the other; emptied when they get many."""

    def __init__(self, most: int = 200_000):
        self.most, self.rows = most, {}
        self.grams, self.ends = np.zeros(65_536, dtype=np.int32), [0]

    def ids(self, words: list[str]) -> list[int]:
        rows = self.rows
        for w in set(words).difference(rows):
            own, at = _grams(w), self.ends[-1]
            while at + len(own) > len(self.grams):
                self.grams = np.concatenate([self.grams, np.zeros_like(self.grams)])
            self.grams[at : at + len(own)] = own
            self.ends.append(at + len(own))
            rows[w] = len(rows)
        return [rows[w] for w in words]

    def trim(self) -> None:
        if len(self.rows) > self.most:
            self.rows, self.ends = {}, [0]


def _counts(words: _Words, parts: list[list[str]]) -> np.ndarray:
    """The n-gram counts of each sentence, given as its words."""
    sizes = np.array([len(p) for p in parts])
    out = np.zeros((len(parts), DIMENSIONS), dtype=np.float32)
    filled = np.flatnonzero(sizes)
    # In blocks, so that the n-grams gathered at a time stay few.
    for block in np.array_split(filled, max(1, int(sizes.sum()) // 20_000)):
        if len(block):
            ids = np.array([i for k in block for i in words.ids(parts[k])])
            ends = np.array(words.ends)
            starts, n = ends[ids], ends[ids + 1] - ends[ids]
            # Where each word's n-grams lie, run by run, and the sentence that each belongs to.
            at = np.arange(n.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            owner = np.repeat(np.repeat(np.arange(len(block)), sizes[block]), n)
            out[block] = np.bincount(owner * DIMENSIONS + words.grams[at], minlength=len(block) * DIMENSIONS).reshape(len(block), DIMENSIONS)
    return out


class Model(NamedTuple):
    """Centroids by row, the language of each, the n-grams' weights and the least similarity."""

    languages: list[str]
    centroids: np.ndarray
    owner: np.ndarray
    weights: np.ndarray
    least: float


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means: `k` unit centroids, or as many as there are rows."""
    if len(x) <= k:
        return x
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(12):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(k)])
        c = _unit(sums)
    return c


def fit(texts: list[str], labels: list[str], rounds: int = 3) -> Model:
    """Centroids of each label; rounds after the first leave out sentences that the last ones deny."""
    words = _Words(most=10**9)
    parts, tags = [], []
    for text, label in zip(texts, labels):
        for s in sentences(text):
            w = _WORD.findall(s.lower())
            if len(w) >= 3:
                parts.append(w)
                tags.append(label)
    languages = sorted(set(tags))
    if not languages:
        return Model([], np.zeros((0, DIMENSIONS), np.float32), np.array([], int), np.ones(DIMENSIONS, np.float32), 1.0)
    counts = _counts(words, parts)
    weights = (np.log((1 + len(parts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = _unit(np.log1p(counts) * weights)
    y = np.array([languages.index(t) for t in tags])
    keep = np.ones(len(y), dtype=bool)
    for turn in range(rounds):
        rng = np.random.default_rng(7)
        # The first round has one centroid a language, which wrong labels move little.
        found = [_kmeans(x[keep & (y == i)], 1 if turn == 0 else CENTROIDS, rng) for i in range(len(languages))]
        c = np.concatenate(found)
        owner = np.repeat(np.arange(len(languages)), [len(f) for f in found])
        similar = x @ c.T
        keep = owner[np.argmax(similar, axis=1)] == y
    own = np.where(keep, similar.max(axis=1), np.nan)
    # A label whose every sentence is nearer to another language has no centroid, so it is no language here.
    have = np.unique(owner)
    languages, owner = [languages[i] for i in have], np.searchsorted(have, owner)
    return Model(languages, c.astype(np.float32), owner, weights, float(np.nanquantile(own, 0.001)) * 0.8)


def _score(model: Model, words: _Words, parts: list[list[str]]) -> np.ndarray:
    """Best cosine of each sentence with each language."""
    similar = _unit(np.log1p(_counts(words, parts)) * model.weights) @ model.centroids.T
    return np.stack([similar[:, model.owner == i].max(axis=1) for i in range(len(model.languages))], axis=1)


def segments_of(scores: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, least: float, near: float = 0.03) -> list[tuple[int, float, int]]:
    """(language no, confidence, characters) of the runs of sentences of one text; empty where none has a language."""
    best = scores.argmax(axis=1)
    sure = (scores.max(axis=1) >= least) & (sizes >= 2)
    if not sure.any():
        return []
    known = np.flatnonzero(sure)
    lang = best[known]
    # A sentence between two of one other language that is near to it too is taken as theirs.
    for i in range(1, len(known) - 1):
        if lang[i - 1] == lang[i + 1] != lang[i] and scores[known[i], lang[i]] - scores[known[i], lang[i - 1]] < near:
            lang[i] = lang[i - 1]
    full = lang[np.maximum(np.searchsorted(known, np.arange(len(best)), "right") - 1, 0)]
    starts = np.flatnonzero(np.concatenate([[True], full[1:] != full[:-1]]))
    bounds = [*starts, len(full)]
    e = np.exp(SHARPNESS * (scores - scores.max(axis=1, keepdims=True)))
    p = e / e.sum(axis=1, keepdims=True)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        weight = np.where(sure[a:b], lengths[a:b], 0)
        confidence = float((p[a:b, full[a]] * weight).sum() / weight.sum()) if weight.sum() else 0.0
        out.append((int(full[a]), confidence, int(lengths[a:b].sum())))
    return out


def training_sample(documents: DataFrame, key: str, text: str, label: str, most: int = SAMPLE_DOCS) -> DataFrame:
    """(text, lang) of at most `most` different texts of each known label, the first by a hash of the text.

    Copies count once, so a text that fills a third of the table weighs no more
    than any other.
    """
    labelled = documents.where((F.length(text) > 0) & F.col(key).isNotNull()).select(key, F.xxhash64(text).alias("digest"), label_code(F.col(label)).alias("lang"))
    labelled = labelled.where(F.col("lang").isNotNull() & (F.col("lang") != "?"))
    once = labelled.groupBy("lang", "digest").agg(F.min(key).alias(key))
    first = Window.partitionBy("lang").orderBy("digest", key)
    chosen = once.withColumn("n", F.row_number().over(first)).where(F.col("n") <= most).select(key, "lang")
    # At most `most` rows a language.
    return documents.select(key, text).join(F.broadcast(chosen), key).select(F.col(text).alias("text"), "lang")


def segment_languages(documents: DataFrame, key: str, text: str, label: str, model: Model) -> DataFrame:
    """(key, label, segment_no, lang, confidence, n_chars, main_lang, n_segments) of every document with a sentence.

    Null and empty texts and texts without a sentence of a known language give
    no rows. Repeated texts are each given their own rows.
    """
    kind = dict(documents.dtypes)[key]
    columns = [key, "label", "segment_no", "lang", "confidence", "n_chars", "main_lang", "n_segments"]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for whole in frames:
            for at in range(0, len(whole), 256):
                pdf = whole.iloc[at : at + 256]
                texts = [sentences(t) for t in pdf["text"]]
                parts = [_WORD.findall(s.lower()) for t in texts for s in t]
                lengths = np.array([len(s.strip()) for t in texts for s in t])
                sizes = np.array([len(p) for p in parts])
                out = []
                if len(parts) and model.languages:
                    scores = _score(model, words, parts)
                    a = 0
                    for k, given, t in zip(pdf[key], pdf["label"], texts):
                        b = a + len(t)
                        runs = segments_of(scores[a:b], sizes[a:b], lengths[a:b], model.least) if t else []
                        a = b
                        share: dict[int, int] = {}
                        for lang, _, n in runs:
                            share[lang] = share.get(lang, 0) + n
                        main = max(share, key=lambda x: share[x]) if share else 0
                        out += [(k, given, i, model.languages[lang], round(c, 4), n, model.languages[main], len(runs)) for i, (lang, c, n) in enumerate(runs)]
                words.trim()
                yield pd.DataFrame(out, columns=columns)

    schema = f"{key} {kind}, label string, segment_no bigint, lang string, confidence double, n_chars bigint, main_lang string, n_segments bigint"
    rows = documents.where(F.length(text) > 0).select(key, F.col(text).alias("text"), label_code(F.col(label)).alias("label"))
    return spread(rows).mapInPandas(batches, schema)


def detect(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Segments of all documents, by centroids fitted on their own labelled sample."""
    sample = training_sample(documents, key, text, label).toPandas()
    order = sample.assign(h=[zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in sample["text"]]).sort_values(["lang", "h", "text"])
    model = fit(order["text"].tolist(), order["lang"].tolist())
    return segment_languages(documents, key, text, label, model)
