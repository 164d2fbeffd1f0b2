"""Connected components by alternating star steps, on executors only."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut, drop_cut


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 40) -> DataFrame:
    """(node, component): the smallest node of each connected component, for every node of an edge.

    Large-star links every larger neighbour of a node to the smallest of its
    neighbourhood, small-star the smaller ones; together they need about
    log(longest path) rounds. Neighbourhoods are only ever aggregated by `min`
    with map-side combining and joined back, so no neighbourhood is gathered
    in one task. Each round is written to the shared folder, and only two
    counters come to the driver. Null ends are left out; loops keep their node.
    """
    pairs = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).dropna()
    nodes = pairs.select(F.col("hi").alias("node")).union(pairs.select(F.col("lo").alias("node"))).distinct()
    links = cut(pairs.where("hi <> lo").distinct(), "links")
    state = _state(links)
    for _ in range(most_rounds):
        # Large star: of every node, the larger neighbours point to the least of the neighbourhood.
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        # Small star: of every node, itself and the smaller neighbours point to the least of them.
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi")
        small = moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").union(moved.select("hi", F.col("m").alias("lo"))).distinct()
        before, links = links, cut(small, "links")
        seen, state = state, _state(links)
        drop_cut(before)
        if state == seen:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return nodes.join(links, nodes["node"] == links["hi"], "left").select("node", F.coalesce("lo", "node").alias("component"))


def _state(links: DataFrame) -> tuple:
    """Row count and an order-free hash of the links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


#: Edges that the components of one scope are found in memory for; scopes of more go through star steps.
IN_MEMORY = 200_000


def components_within(edges: DataFrame, scope: list[str], a: str, b: str, most: int = IN_MEMORY) -> DataFrame:
    """(scope columns, node, component) of edges that never leave their scope, such as a document.

    `edges` should be a table that is cheap to read twice. Scopes of at most
    `most` edges are solved each in one call, many to an Arrow batch, after one
    shuffle; larger ones by `components`, with the same result. Rows with a null
    scope or end are left out; nodes are strings, compared by their bytes.
    """
    links = edges.select(*scope, F.col(a).alias("__a"), F.col(b).alias("__b")).dropna()
    large = links.groupBy(*scope).agg(F.count("*").alias("__n")).where(F.col("__n") > most).select(*scope)
    kinds = dict(links.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in scope) + ", node string, component string"

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for *key, left, right in pdf.itertuples(index=False, name=None):
                out += [(*key, n, c) for n, c in _least_of_each(left, right).items()]
            yield pd.DataFrame(out, columns=[*scope, "node", "component"])

    def together(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy(*scope).agg(F.collect_list(F.struct("__a", "__b")).alias("e"))
        return ends.select(*scope, F.transform("e", lambda e: e["__a"]).alias("left"), F.transform("e", lambda e: e["__b"]).alias("right")).mapInPandas(solve, schema)

    if large.isEmpty():
        return together(links)
    large = cut(large, "large")
    node = lambda c: F.to_json(F.array(*(F.col(s).cast("string") for s in scope), F.col(c)))
    of_large = links.join(large, scope, "left_semi").select(*scope, "__a", "__b", node("__a").alias("na"), node("__b").alias("nb"))
    found = components(of_large, "na", "nb")
    names = of_large.select(*scope, F.col("__a").alias("node"), F.col("na").alias("id")).union(of_large.select(*scope, "__b", "nb")).distinct()
    grouped = names.join(found.select(F.col("node").alias("id"), F.col("component").alias("of")), "id")
    # The least node by its own bytes, whatever the order of the ids that the steps ran on.
    least = grouped.groupBy("of").agg(F.min("node").alias("component"))
    return together(links.join(large, scope, "left_anti")).unionByName(grouped.join(least, "of").select(*scope, "node", "component"))


def _least_of_each(left: list[str], right: list[str]) -> dict[str, str]:
    """Node to the least node of its component."""
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(left, right):
        lo, hi = sorted((root(x), root(y)))
        parent[hi] = lo
    return {x: root(x) for x in list(parent)}
