"""Sources mixed to target shares of all tokens, by prefix sums in random order.

Every text gets a hash-random key. The keys' ranges split each source into
parts of about equal size, whichever source it is; sums per part give each part
its offset, a running sum inside the part the rest. So no source is sorted in
one task, and the cut at a source's budget is exact to one text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut

#: Rows that a part holds at most on average, were all rows of one source.
PART_ROWS = 20_000


def distinct_texts(documents: DataFrame, key: str, text: str, source: str, targets: DataFrame | None = None) -> DataFrame:
    """(key, source, text) of one row per text: the smallest key among its copies, in whatever source.

    With `targets`, only copies in target sources count, so a copy in another
    or no source takes no text away; of those, copies in sources that can be
    drawn from come first.
    """
    rows = documents.where(F.length(text) > 0).select(key, source, text).withColumn("__late", F.lit(False))
    if targets is not None:
        drawn = (F.coalesce(F.max("target_share"), F.lit(0.0)) > 0) & (F.max(F.coalesce("max_repeats", F.lit(1))) > 0)
        aims = targets.dropna(subset=["source"]).groupBy(F.col("source").alias("__aim")).agg((~drawn).alias("__late"))
        rows = rows.drop("__late").join(F.broadcast(aims), F.col(source) == F.col("__aim")).select(key, source, text, "__late")
    first = rows.groupBy(F.md5(text).alias("digest")).agg(F.min(F.struct("__late", F.col(key).alias("__key"))).alias("__first"))
    return rows.select(key, source, text).join(first.select(F.col("__first.__key").alias(key)), key, "left_semi")


def mix(sized: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", size: str = "n_tokens", seed: int = 42, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(selection, shares).

    `sized` has one row per text. The total is the largest at which every
    source that has texts can give its share within its repeats, or `total` if
    less. Of each source, whole rounds of all texts are taken first, then the
    texts in random order up to the budget; no text is cut. Sources without a
    target or of null name are left out; a target source without texts has no
    tokens, which the shares report. Texts of no size are left out. Repeated
    targets of one source count once, the first by share; null or negative
    targets count as 0.
    """
    spark = sized.sparkSession
    aims = targets.dropna(subset=["source"]).groupBy("source").agg(
        F.greatest(F.lit(0.0), F.coalesce(F.max("target_share"), F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).cast("bigint").alias("max_repeats")
    )
    aims = spark.createDataFrame(aims.collect(), aims.schema)  # one row per target, a parameter table
    rows = cut(
        sized.where(F.col(size) > 0).select(F.col(key), F.col(source).alias("source"), F.col(size).alias("size")).join(F.broadcast(aims.select("source")), "source", "left_semi"), "sizes"
    )
    have = {r["source"]: (r["tokens"], r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("tokens"), F.count("*").alias("n")).collect()}
    given = [r for r in aims.collect() if r["source"] in have and r["target_share"] > 0 and r["max_repeats"] > 0]
    most = min((have[r["source"]][0] * r["max_repeats"] / r["target_share"] for r in given), default=0)
    whole = int(most if total is None else min(most, total))
    budgets = [(r["source"], int(whole * r["target_share"]), have[r["source"]][0]) for r in given]
    budget = spark.createDataFrame(
        [(s, b // a, b % a) for s, b, a in budgets] or [("", 0, 0)], "source string, rounds bigint, rest bigint"
    )
    parts = max(1, -(-sum(n for _, n in have.values()) // PART_ROWS))
    random = F.xxhash64(F.lit(seed), F.col(key))
    keyed = rows.join(F.broadcast(budget), "source").withColumn("random", random)
    # The part is the range of the random key: floor((key - least) / width).
    part = F.floor((F.col("random") / F.lit(2.0**64) + F.lit(0.5)) * parts).cast("int")
    keyed = keyed.withColumn("part", part)
    sums = keyed.groupBy("source", "part").agg(F.sum("size").alias("tokens"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    running = Window.partitionBy("source", "part").orderBy("random", key).rowsBetween(Window.unboundedPreceding, 0)
    summed = keyed.withColumn("running", F.sum("size").over(running)).join(offsets, ["source", "part"])
    times = F.col("rounds") + (F.col("offset") + F.col("running") <= F.col("rest")).cast("bigint")
    selection = summed.select(key, "source", F.col("size").alias(size), times.alias("times")).where("times > 0")
    reached = selection.groupBy("source").agg(F.sum(F.col(size) * F.col("times")).alias("tokens"), F.count("*").alias("n_texts"), F.max("times").alias("most_repeats"))
    stock = spark.createDataFrame([(s, int(t)) for s, (t, _) in have.items()] or [("", 0)], "source string, available_tokens bigint")
    every = Window.partitionBy()
    shares = (
        aims.join(F.broadcast(stock), "source", "left")
        .join(reached, "source", "left")
        .select(
            "source",
            "target_share",
            "max_repeats",
            F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"),
            F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
            F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
            F.coalesce("tokens", F.lit(0)).alias("tokens"),
        )
        .withColumn("share_reached", F.round(F.col("tokens") / F.sum("tokens").over(every), 6))
    )
    return selection, shares
