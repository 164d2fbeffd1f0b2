"""Texts into containers of fixed capacity, by optimal length buckets.

The histogram of all sizes (at most `capacity` of them) comes to the driver; a
dynamic program over it picks the bucket bounds that make the padding least.
Batches are formed inside each bucket up to the token budget: as many items of
the bucket as a container holds. What such a batch leaves free is topped up
from the smaller buckets, largest first, since equal lengths alone would leave
up to half of a container empty. The plan is thus a few kinds of containers
with a number of each, and texts get their places by their rank in the bucket.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut

#: Buckets per capacity.
BUCKETS = 192
#: Parts that each bucket is ranked in, so that no bucket is sorted in one task: at least this many, more where pieces are many.
SALTS = 64
PART_PIECES = 200_000


def bucket_bounds(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds, ascending, of at most `buckets` buckets with the least total padding.

    best[k][j] = least padding of the j smallest sizes in k buckets; each step
    is the lower hull of lines, as the cost of a bucket is linear in the
    number and the sum of the sizes before it.
    """
    sizes = sorted(histogram)
    n = len(sizes)
    if n <= buckets:
        return sizes
    count, total = [0], [0]
    for s in sizes:
        count.append(count[-1] + histogram[s])
        total.append(total[-1] + s * histogram[s])
    best = [float("inf")] * (n + 1)
    best[0] = 0.0
    froms: list[list[int]] = []
    for _ in range(buckets):
        new, back = [float("inf")] * (n + 1), [0] * (n + 1)
        hull: list[tuple[int, float, int]] = []  # slope (falling), intercept, where from
        head, added = 0, 0
        for j in range(1, n + 1):
            while added < j:
                if best[added] < float("inf"):
                    m, c = -count[added], best[added] + total[added]
                    while len(hull) - head >= 2:
                        (m1, c1, _), (m2, c2, _) = hull[-2], hull[-1]
                        if (c - c1) * (m1 - m2) <= (c2 - c1) * (m1 - m):
                            hull.pop()
                        else:
                            break
                    hull.append((m, c, added))
                added += 1
            x = sizes[j - 1]
            while len(hull) - head >= 2 and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                head += 1
            if len(hull) > head:
                m, c, i = hull[head]
                new[j], back[j] = x * count[j] - total[j] + m * x + c, i
        froms.append(back)
        best = new
    bounds, j = [], n
    for back in reversed(froms):
        bounds.append(sizes[j - 1])
        j = back[j]
        if j == 0:
            break
    return sorted(bounds)


class Slot(NamedTuple):
    """Items of a bucket from `first_rank` on: `each` to a container, from `container` on, for `containers` of them."""

    bucket: int
    first_rank: int
    each: int
    containers: int
    container: int


def plan(counts: dict[int, int], capacity: int) -> list[Slot]:
    """Kinds of containers for the counts of items by their bucket's bound.

    Each kind takes as many of the largest bound left as fit, then tops up with
    smaller ones; it is repeated as long as all its items last, so that every
    step uses up a bound and there are few kinds.
    """
    left = {b: n for b, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    slots: list[Slot] = []
    container = 0
    while left:
        room, kind = capacity, []
        for b in sorted(left, reverse=True):
            each = min(left[b], room // b)
            if each:
                kind.append((b, each))
                room -= b * each
        times = min(left[b] // each for b, each in kind)
        for b, each in kind:
            slots.append(Slot(b, used[b], each, times, container))
            used[b] += each * times
            left[b] -= each * times
            if not left[b]:
                del left[b]
        container += times
    return slots


_PACK = ["pack_name", "capacity_tokens"]


def pieces(sized: DataFrame, key: str, size: str) -> DataFrame:
    """(pack_name, capacity_tokens, key, piece_no, first_token, n_tokens): items over the row's capacity in full pieces and a rest, others whole."""
    capacity = F.col("capacity_tokens")
    whole = F.floor(F.col(size) / capacity).cast("bigint")
    full = F.when(whole > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), whole - 1), lambda i: F.struct(i.alias("piece_no"), (i * capacity).alias("first_token"), capacity.alias("n_tokens"))))
    rest = F.col(size) - whole * capacity
    last = F.when(rest > 0, F.array(F.struct(whole.alias("piece_no"), (whole * capacity).alias("first_token"), rest.cast("bigint").alias("n_tokens"))))
    empty = F.array().cast("array<struct<piece_no:bigint,first_token:bigint,n_tokens:bigint>>")
    return sized.where(F.col(size) > 0).select(*_PACK, key, F.inline(F.concat(F.coalesce(full, empty), F.coalesce(last, empty))))


def pack(sized: DataFrame, key: str, size: str, capacity: int, buckets: int = BUCKETS) -> DataFrame:
    """(container_no, key, piece_no, first_token, n_tokens) of all items with a positive size, for one capacity."""
    return pack_all(sized, key, size, [("one", capacity)], buckets).drop(*_PACK)


def pack_all(sized: DataFrame, key: str, given: str, capacities: list[tuple[str, int]], buckets: int = BUCKETS) -> DataFrame:
    """(pack_name, capacity_tokens, container_no, key, piece_no, first_token, n_tokens) of all items with a positive size, for each named capacity.

    `given` is the column of the sizes; items of null or no size take no
    container, other columns are ignored. All capacities go through one
    histogram and one ranking. The driver gets one row per capacity and size, at
    most as many as the capacities add up to, and sends back the plans, at most
    buckets * buckets rows each.
    """
    spark = sized.sparkSession
    packs = F.array(*(F.struct(F.lit(name).alias("pack_name"), F.lit(c).cast("bigint").alias("capacity_tokens")) for name, c in capacities))
    # Names of its own, so that the key may be called anything; it gets its name back at the end.
    named, key, size = key, "__key", "__size"
    sized = cut(sized.select(F.col(named).alias(key), F.col(given).alias(size)), "sizes")
    cutup = pieces(sized.select(key, size, F.inline(packs)) if capacities else sized.select(key, size, F.lit("").alias("pack_name"), F.lit(1).cast("bigint").alias("capacity_tokens")).limit(0), key, size)
    histograms: dict[str, dict[int, int]] = {name: {} for name, _ in capacities}
    for r in cutup.groupBy("pack_name", "n_tokens").count().collect():
        histograms[r["pack_name"]][r["n_tokens"]] = r["count"]
    slots, bucket = [], F.lit(None).cast("bigint")
    for name, capacity in capacities:
        histogram = histograms[name]
        bounds = bucket_bounds(histogram, buckets)
        counts: dict[int, int] = dict.fromkeys(bounds, 0)
        at = 0
        for s in sorted(histogram):
            while s > bounds[at]:
                at += 1
            counts[bounds[at]] += histogram[s]
        slots += [(name, *slot) for slot in plan(counts, capacity)]
        if bounds:
            of_size = F.element_at(F.filter(F.array(*(F.lit(b).cast("bigint") for b in bounds)), lambda b: b >= F.col("n_tokens")), 1)
            bucket = F.when(F.col("pack_name") == name, of_size).otherwise(bucket)
    plans = spark.createDataFrame(slots or [("", 0, 0, 1, 0, 0)], "of_pack string, b bigint, first_rank bigint, each bigint, containers bigint, container bigint")
    salts = max(SALTS, max((sum(h.values()) for h in histograms.values()), default=0) // PART_PIECES)
    scope = ["pack_name", "bucket", "salt"]
    salted = cutup.withColumn("bucket", bucket).withColumn("salt", F.pmod(F.xxhash64(key, "piece_no"), F.lit(salts)))
    sums = salted.groupBy(*scope).agg(F.count("*").alias("n"))
    before = Window.partitionBy("pack_name", "bucket").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*scope, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = salted.withColumn("n", F.row_number().over(Window.partitionBy(*scope).orderBy(key, "piece_no"))).join(offsets, scope)
    ranked = ranked.withColumn("rank", F.col("offset") + F.col("n") - 1)
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("each") * F.col("containers"))
    # The plans are bounded by the number of buckets, however large the input.
    placed = ranked.join(F.broadcast(plans), (F.col("pack_name") == F.col("of_pack")) & (F.col("bucket") == F.col("b")) & inside)
    number = F.col("container") + F.floor((F.col("rank") - F.col("first_rank")) / F.col("each"))
    return placed.select(*_PACK, number.cast("bigint").alias("container_no"), F.col(key).alias(named), "piece_no", "first_token", "n_tokens")


def fill_report(containers: DataFrame) -> DataFrame:
    """pack_name, capacity_tokens, n_containers, n_tokens, unused_share."""
    each = containers.groupBy("pack_name", "capacity_tokens", "container_no").agg(F.sum("n_tokens").alias("n"))
    out = each.groupBy("pack_name", "capacity_tokens").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"), F.max("n").alias("fullest"))
    return out.withColumn("unused_share", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6))
