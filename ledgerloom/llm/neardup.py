"""Near-duplicate texts: tensored banding of minhashes, then an exact check.

Two small collections of `side` half keys are computed, each half key from
`rows` minhashes. A table key is a pair of half keys, one of each collection:
side * side tables cost only 2 * side * rows minhashes a text. Two texts of
similarity s meet with probability (1 - (1 - s**rows)**side)**2; with rows = 2
and side = 10 that is 0.977 at s = 0.60, 0.998 at 0.70 and above 0.9999 at 0.80.

Texts with the same set of shingles are one class and go through the tables
once, so copies of one text never meet in a bucket. Pairs of classes that meet
are checked on their whole shingle sets.

A bucket of many classes is cut into blocks of about BLOCK of them, and every
pair of blocks is a group of its own: no pair is lost, and no task gets more
than two blocks of a bucket at once. Only buckets of a half key that many
classes share can be that large, so sizes are counted of those alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.graph import components
from ledgerloom.session import cut
from ledgerloom.streams import whole_groups

SIDE = 10
ROWS = 2
#: Classes of one bucket that are compared in one go; larger buckets are compared block by block.
BLOCK = 256
_WORD = re.compile(r"[^\W_]+")
_SEED = 20_240_229


class _WordHash(dict):
    """64-bit hash of each word seen; emptied when it gets large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def features(texts: list[str], memo: dict, words: int, least_words: int, side: int = SIDE, rows: int = ROWS) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(which texts take part, their shingle sets, class, half keys of side a, half keys of side b)."""
    hashes, sizes, kept = [], [], []
    for i, text in enumerate(texts):
        found = _WORD.findall(text.lower())
        if len(found) >= max(least_words, words):
            kept.append(i)
            sizes.append(len(found))
            hashes += [memo[w] for w in found]
    if not kept:
        none = np.zeros((0, side), dtype=np.int64)
        return np.array([], dtype=int), [], none[:, 0], none, none
    w = np.array(hashes, dtype=np.uint64)
    ends = np.cumsum(sizes)
    last = np.zeros(len(w), dtype=bool)
    for k in range(words - 1):
        last[ends - 1 - k] = True
    n = len(w) - words + 1
    h = np.zeros(n, dtype=np.uint64)
    for k in range(words):
        h = _mix(h + w[k : k + n])
    owner = np.repeat(np.arange(len(kept), dtype=np.uint64), sizes)
    inside = ~last[:n]
    sets = np.unique((owner[:n][inside] << np.uint64(32)) | (h[inside] >> np.uint64(32)))
    owner = (sets >> np.uint64(32)).astype(np.int64)
    low = sets & np.uint64(0xFFFFFFFF)
    starts = np.searchsorted(owner, np.arange(len(kept)))
    rng = np.random.default_rng(_SEED)
    minima = np.empty((2 * side * rows, len(kept)), dtype=np.uint64)
    for k in range(2 * side * rows):
        a, b = (np.uint64(x) for x in rng.integers(1, 2**63, 2, dtype=np.int64))
        minima[k] = np.minimum.reduceat(_mix(low * (a | np.uint64(1)) + b), starts)
    halves = np.zeros((2 * side, len(kept)), dtype=np.uint64)
    for k in range(2 * side * rows):
        halves[k // rows] = _mix(halves[k // rows] + minima[k])
    halves = np.ascontiguousarray(halves.T).view(np.int64)
    shingles = np.split(low.astype(np.uint32).view(np.int32), starts[1:])
    classes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in shingles], dtype=np.uint64).view(np.int64)
    return np.array(kept), shingles, classes, halves[:, :side], halves[:, side:]


def text_classes(records: DataFrame, key: str, text: str, words: int, least_words: int) -> DataFrame:
    """record, class_id, shingles, half_a, half_b of every text with at least `least_words` words; the record is its key."""
    names = ["record", "class_id", "shingles", "half_a", "half_b"]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _WordHash()
        for pdf in frames:
            kept, sets, classes, a, b = features(pdf["text"].tolist(), memo, words, least_words)
            if len(kept):
                yield pd.DataFrame({"record": pdf["record"].to_numpy()[kept], "class_id": classes, "shingles": sets, "half_a": list(a), "half_b": list(b)}, columns=names)

    kind = dict(records.dtypes)[key]
    return (
        records.select(F.col(key).alias("record"), F.col(text).alias("text"))
        .where("record IS NOT NULL AND text IS NOT NULL")
        .mapInPandas(batches, f"record {kind}, class_id bigint, shingles array<int>, half_a array<bigint>, half_b array<bigint>")
    )


_KEYED = "bucket bigint, class_id bigint, part int"


def bucket_rows(one: DataFrame, block: int) -> DataFrame:
    """(bucket, class_id, part) of every table key; two rows of a bucket are compared unless they have one part of 0 and more."""
    half = F.transform("half_a", lambda a, i: F.struct(F.xxhash64(i, a).alias("half"), i.alias("i"), a.alias("a")))
    crowded = one.select(F.inline(half)).groupBy("half").agg(F.count("*").alias("n")).where(F.col("n") > block).select("half")
    table = F.transform("half_b", lambda b, j: F.xxhash64("i", j, "a", b))
    if crowded.isEmpty():
        every = F.flatten(F.transform("half_a", lambda a, i: F.transform("half_b", lambda b, j: F.xxhash64(i, j, a, b))))
        return one.select(F.explode(every).alias("bucket"), "class_id", F.lit(-1).alias("part"))
    crowded = cut(crowded, "crowded")
    halves = one.select("class_id", "half_b", F.inline(half)).join(crowded.withColumn("large", F.lit(True)), "half", "left")
    keyed = halves.select(F.explode(table).alias("bucket"), "class_id", F.coalesce("large", F.lit(False)).alias("large"))
    sizes = keyed.where("large").groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > block)
    # Joined by bucket and salt, since the rows to split are those of the crowded buckets.
    salts = 16
    sizes = sizes.select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.explode(F.array(*map(F.lit, range(salts)))).alias("salt"))
    suspects = keyed.where("large").select("bucket", "class_id", F.pmod(F.xxhash64("class_id"), F.lit(salts)).cast("int").alias("salt"))
    sized = suspects.join(sizes, ["bucket", "salt"], "left")
    own = F.pmod(F.xxhash64("class_id", F.lit(1)), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.xxhash64("bucket", F.least(j, own), F.greatest(j, own)).alias("bucket"), F.when(j == own, -1).otherwise(own).alias("part")),
    )
    alone = F.array(F.struct(F.col("bucket"), F.lit(-1).alias("part")))
    split = sized.select("class_id", F.inline(F.when(F.col("blocks").isNull(), alone).otherwise(pairs)))
    return keyed.where("NOT large").select("bucket", "class_id", F.lit(-1).alias("part")).unionByName(split)


def _meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of classes of each bucket, of frames sorted by bucket."""
    for pdf in whole_groups(frames, "bucket"):
        bucket, classes, part = (pdf[c].to_numpy() for c in ("bucket", "class_id", "part"))
        out = []
        at, step = np.arange(len(bucket) - 1), 1
        while len(at := at[bucket[at] == bucket[at + step]]):
            fit = (part[at] < 0) | (part[at] != part[at + step])
            out.append(np.stack([classes[at[fit]], classes[at[fit] + step]]))
            step += 1
            at = at[at + step < len(bucket)]
        if out:
            a, b = np.concatenate(out, axis=1)
            yield pd.DataFrame({"class_a": np.minimum(a, b), "class_b": np.maximum(a, b)}).drop_duplicates()


def similar_classes(classes: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(class_a, class_b, similarity) of the distinct classes that reach the threshold, a < b."""
    one = classes.groupBy("class_id").agg(F.first("half_a").alias("half_a"), F.first("half_b").alias("half_b"))
    met = bucket_rows(one, block).repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_meet, "class_a bigint, class_b bigint").distinct()
    sets = classes.groupBy("class_id").agg(F.first("shingles").alias("shingles"))
    of_a = sets.select(F.col("class_id").alias("class_a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("class_id").alias("class_b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        met.join(of_a, "class_a")
        .join(of_b, "class_b")
        .select("class_a", "class_b", (both / (F.size("set_a") + F.size("set_b") - both)).alias("similarity"))
        .where(F.col("similarity") >= threshold - 1e-12)
    )


def linked_classes(records: DataFrame, key: str, text: str, words: int, threshold: float, least_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, heads, close): record and class_id; class_id, head (the first record) and n of each class; pairs of classes that reach the threshold."""
    classes = cut(text_classes(records, key, text, words, least_words), "classes")
    members = classes.select("record", "class_id")
    heads = members.groupBy("class_id").agg(F.min("record").alias("head"), F.count("*").alias("n"))
    return members, heads, cut(similar_classes(classes, threshold).select("class_a", "class_b"), "close")


def similar_pairs(records: DataFrame, key: str, text: str, words: int = 5, threshold: float = 0.8, least_words: int = 5) -> DataFrame:
    """(key_a, key_b), a < b, of all records whose texts reach the threshold.

    Null keys, null texts and texts of fewer than `least_words` words take no
    part; other columns are ignored. Records of one class are copies: each pair of them is a result, too. Where
    copies are many, `similar_groups` and `representative_pairs` say the same
    in as many rows as there are records and pairs of classes.
    """
    members, heads, close = linked_classes(records, key, text, words, threshold, least_words)
    copies = heads.where("n > 1").select(F.col("class_id").alias("class_a"), F.col("class_id").alias("class_b"))
    of_a = members.select(F.col("class_id").alias("class_a"), F.col("record").alias("member_a"))
    of_b = members.select(F.col("class_id").alias("class_b"), F.col("record").alias("member_b"))
    # A class meets itself in both orders, two classes in one; so no pair comes twice.
    every = close.union(copies).join(of_a, "class_a").join(of_b, "class_b").where("class_a <> class_b OR member_a < member_b")
    return every.select(F.least("member_a", "member_b").alias(f"{key}_a"), F.greatest("member_a", "member_b").alias(f"{key}_b"))


def representative_pairs(records: DataFrame, key: str, text: str, words: int = 5, threshold: float = 0.8, least_words: int = 5) -> tuple[DataFrame, DataFrame]:
    """(pairs, membership): key_a, key_b of the first records of every two linked classes; key, head of every record that takes part."""
    members, heads, close = linked_classes(records, key, text, words, threshold, least_words)
    of = lambda side: heads.select(F.col("class_id").alias(f"class_{side}"), F.col("head").alias(f"head_{side}"))
    linked = close.join(of("a"), "class_a").join(of("b"), "class_b")
    pairs = linked.select(F.least("head_a", "head_b").alias(f"{key}_a"), F.greatest("head_a", "head_b").alias(f"{key}_b"))
    return pairs, members.join(heads.select("class_id", "head"), "class_id").select(F.col("record").alias(key), "head")


def similar_groups(records: DataFrame, key: str, text: str, words: int = 5, threshold: float = 0.8, least_words: int = 5) -> DataFrame:
    """key, group_id, n_links of every record with a similar one: the first record of its group, and how many it is similar to.

    Both come from the classes and their sizes, so no pair of records is made.
    """
    members, heads, close = linked_classes(records, key, text, words, threshold, least_words)
    sides = close.select(F.col("class_a").alias("class_id"), F.col("class_b").alias("other")).union(close.select("class_b", "class_a"))
    others = sides.join(heads.select(F.col("class_id").alias("other"), F.col("n").alias("n_other")), "other").groupBy("class_id").agg(F.sum("n_other").alias("n_others"))
    ends = close.join(heads.select(F.col("class_id").alias("class_a"), F.col("head").alias("head_a")), "class_a").join(heads.select(F.col("class_id").alias("class_b"), F.col("head").alias("head_b")), "class_b")
    groups = components(ends, "head_a", "head_b").select(F.col("node").alias("head"), "component")
    n_links = F.col("n") - 1 + F.coalesce("n_others", F.lit(0))
    sized = heads.join(others, "class_id", "left").join(groups, "head", "left").select("class_id", F.coalesce("component", "head").alias("group_id"), n_links.alias("n_links"))
    return members.join(sized.where("n_links > 0"), "class_id").select(F.col("record").alias(key), "group_id", "n_links")
