"""The k most similar vectors of every vector, by NN-descent; queries by greedy graph search.

Vectors of one direction are one node, however many copies there are. Trees of
random projections put every node into leaves of similar nodes; the best of each
leaf start the neighbour graph. Each round then joins the graph with itself: a
node hosts its neighbours, forward and backward, and compares them with each
other, since a neighbour's neighbour is likely a neighbour. Rounds end when
hardly a list changes.

Groups are bounded throughout: a leaf by MOST nodes, a host by k forward and k
backward neighbours (the nearest), a node's lists by k. The driver fits trees of
at most 2 ** ROOT_DEPTH leaves on SAMPLE nodes, whatever the size of the
collection; leaves that are still too large get trees of their own, fitted on
the executors, until none is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut, drop_cut
from ledgerloom.streams import whole_groups

#: Nodes that a tree is fitted on, at most about: by the driver, and for each leaf that is split further.
SAMPLE, LEAF_SAMPLE = 20_000, 2_000
TREES = 4
#: Nodes of a leaf: what the trees aim at, and beyond which a leaf is split again.
LEAF, MOST = 512, 2_048
#: Levels of one tree; so many bits of a leaf's number each tree takes.
ROOT_DEPTH = 10
#: Neighbours that a node keeps while the graph is built.
KEEP = 10
#: The graph has settled when a round changes the lists of at most one node in so many, about a thousandth of all list entries.
SETTLED = 100
_DIGITS = 9


def unit_vectors(vectors: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(id, unit, direction): vectors of `dims` finite numbers, not all zero, at length one; the rest is left out."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if not len(pdf):
                continue
            x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            size = np.linalg.norm(x, axis=1)
            ok = np.isfinite(size) & (size > 0)
            x = (x[ok] / size[ok, None]).astype(np.float32)
            same = np.round(x, 5) + np.float32(0)
            yield pd.DataFrame(
                {"id": pdf["id"].to_numpy()[ok], "unit": [r.tobytes() for r in x], "direction": [xxhash.xxh3_64_intdigest(r.tobytes()) - 2**63 for r in same]}
            )

    whole = vectors.where(F.col(key).isNotNull() & (F.size(vector) == dims) & ~F.exists(vector, lambda x: x.isNull()))
    return whole.select(F.col(key).alias("id"), F.col(vector).alias("v")).mapInPandas(batches, "id bigint, unit binary, direction bigint")


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), dtype=np.float32).reshape(len(units), -1)


def depth_for(n_nodes: int, leaf: int, most: int = ROOT_DEPTH) -> int:
    """Levels of a tree over n nodes with leaves of about `leaf`, at most `most`."""
    return min(most, max(0, int(np.ceil(np.log2(max(1, n_nodes) / leaf)))))


def fit_tree(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and thresholds of the 2 ** depth - 1 inner nodes of a balanced tree, in level order."""
    rng = np.random.default_rng(seed)
    inner = 2**depth - 1
    w = np.zeros((inner, sample.shape[1] if sample.size else 1), dtype=np.float32)
    t = np.zeros(inner, dtype=np.float32)
    rows = {0: np.arange(len(sample))}
    for node in range(inner):
        own = rows.pop(node)
        if len(own) >= 2:
            a, b = sample[rng.choice(own, 2, replace=False)]
            w[node] = a - b
        else:
            w[node] = rng.standard_normal(w.shape[1])
        p = sample[own] @ w[node]
        t[node] = np.median(p) if len(p) else 0.0
        if 2 * node + 1 < inner:
            rows[2 * node + 1], rows[2 * node + 2] = own[p <= t[node]], own[p > t[node]]
    return w, t


def _leaves(x: np.ndarray, w: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The leaf of each row, from 0."""
    node = np.zeros(len(x), dtype=np.int64)
    while len(x) and node[0] < len(t):
        node = 2 * node + 1 + (np.einsum("ij,ij->i", x, w[node]) > t[node])
    return node - len(t)


_PLACED = "leaf bigint, id bigint, unit binary"


def grow(nodes: DataFrame, n: int, dims: int, trees: int, leaf: int, most: int, root_depth: int = ROOT_DEPTH) -> DataFrame:
    """(leaf, id, unit): every node in a leaf of each tree, no leaf of more than `most` nodes unless they can't be parted.

    The driver fits one tree of constant size each on about SAMPLE nodes.
    Leaves that are still too large are split by trees fitted on LEAF_SAMPLE of
    their own nodes by the executors, round after round.
    """
    every = max(1, n // SAMPLE)
    sample = nodes.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).select("unit").toPandas()["unit"]
    sample = _matrix(sample) if len(sample) else np.zeros((0, dims), np.float32)
    roots = [fit_tree(sample, depth_for(n, leaf, root_depth), k) for k in range(trees)]

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                x = _matrix(pdf["unit"])
                for k, (w, t) in enumerate(roots):
                    yield pd.DataFrame({"leaf": _leaves(x, w, t) * len(roots) + k, "id": pdf["id"], "unit": pdf["unit"]})

    placed = nodes.select("id", "unit").mapInPandas(place, _PLACED)
    done: DataFrame | None = None
    before = None
    while True:
        sizes = placed.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > most)
        large = cut(sizes, "large")
        seen = large.agg(F.count("*"), F.sum("n")).first()
        if not seen[0] or tuple(seen) == before:
            # None is too large, or the last round parted none of them.
            return placed if done is None else done.unionByName(placed)
        before = tuple(seen)
        fine = placed.join(large.select("leaf"), "leaf", "left_anti")
        done = fine if done is None else done.unionByName(fine)
        placed = cut(_split(placed.join(large, "leaf"), leaf, root_depth), "placed")


def _split(rows: DataFrame, leaf: int, root_depth: int) -> DataFrame:
    """(leaf, id, unit) of (leaf, id, unit, n): each leaf by a tree of its own."""
    sampled = rows.where(F.pmod(F.xxhash64("id", "leaf"), F.greatest(F.lit(1), F.floor(F.col("n") / LEAF_SAMPLE))) == 0)
    grouped = sampled.groupBy("leaf", "n").agg(F.sort_array(F.collect_list("unit")).alias("units"))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            fitted = [fit_tree(_matrix(pd.Series(u)), depth_for(n, leaf, root_depth), int(at) % 2**32) for at, n, u in zip(pdf["leaf"], pdf["n"], pdf["units"])]
            yield pd.DataFrame({"leaf": pdf["leaf"], "w": [w.tobytes() for w, _ in fitted], "t": [t.tobytes() for _, t in fitted]})

    trees = grouped.mapInPandas(fit, "leaf bigint, w binary, t binary")
    none = F.lit(None).cast("binary")
    both = trees.select("leaf", F.lit(None).cast("bigint").alias("id"), none.alias("unit"), "w", "t").unionByName(rows.select("leaf", "id", "unit", none.alias("w"), none.alias("t")))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A leaf's tree comes before its nodes; a batch may begin in the midst of a leaf.
        at, w, t = None, None, None
        for pdf in frames:
            for a, b in _groups(pdf, "leaf") if len(pdf) else []:
                one = pdf.iloc[a:b]
                if one["w"].iloc[0] is not None:
                    at, t = one["leaf"].iloc[0], np.frombuffer(one["t"].iloc[0], np.float32)
                    w = np.frombuffer(one["w"].iloc[0], np.float32).reshape(len(t), -1)
                    one = one.iloc[1:]
                if len(one):
                    yield pd.DataFrame({"leaf": int(at) * 2**root_depth + _leaves(_matrix(one["unit"]), w, t), "id": one["id"].astype("int64"), "unit": one["unit"]})

    # Trees first: of equal leaves, the row without an id.
    return both.repartition("leaf").sortWithinPartitions("leaf", F.col("id").asc_nulls_first()).mapInPandas(place, _PLACED)


def _groups(pdf: pd.DataFrame, by: str) -> Iterator[tuple[int, int]]:
    g = pdf[by].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    yield from zip(starts, [*starts[1:], len(g)])


_EDGES = "u bigint, v bigint, similarity double"


def _edges(u: list, v: list, s: list) -> pd.DataFrame:
    if not u:
        return pd.DataFrame({"u": np.array([], np.int64), "v": np.array([], np.int64), "similarity": np.array([], float)})
    return pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v), "similarity": np.round(np.concatenate(s), _DIGITS)})


def leaf_edges(placed: DataFrame, keep: int) -> DataFrame:
    """(u, v, similarity): of every node, the best of each of its leaves."""

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(frames, "leaf"):
            us, vs, ss = [], [], []
            for a, b in _groups(pdf, "leaf"):
                ids, n = pdf["id"].to_numpy()[a:b], b - a
                if n < 2:
                    continue
                x = _matrix(pdf["unit"].iloc[a:b]).astype(np.float64)
                m = min(keep, n - 1)
                # In blocks of rows, so that a large leaf needs no square matrix at once.
                for c in range(0, n, 2_048):
                    s = x[c : c + 2_048] @ x.T
                    rows = np.arange(len(s))
                    s[rows, rows + c] = -2.0
                    top = np.argpartition(-s, m - 1, axis=1)[:, :m]
                    us.append(np.repeat(ids[c : c + 2_048], m))
                    vs.append(ids[top].ravel())
                    ss.append(np.take_along_axis(s, top, 1).ravel())
            yield _edges(us, vs, ss)

    return placed.repartition("leaf").sortWithinPartitions("leaf").mapInPandas(best, _EDGES)


def _graph(edges: DataFrame, keep: int) -> DataFrame:
    """(u, list): of each node its `keep` most similar, nearest first, ties by the smaller id."""
    ranked = F.sort_array(F.collect_set(F.struct((-F.col("similarity")).alias("d"), F.col("v").alias("v"))))
    return edges.groupBy("u").agg(F.slice(ranked, 1, keep).alias("list"))


def _as_edges(graph: DataFrame) -> DataFrame:
    return graph.select("u", F.inline("list")).select("u", "v", (-F.col("d")).alias("similarity"))


def descend(nodes: DataFrame, graph: DataFrame, changed: DataFrame | None, keep: int) -> DataFrame:
    """The graph after one round: neighbours of one host compared with each other.

    After the first round only hosts whose list has changed take part; a pair
    is passed on only if it would enter the list of its first node.
    """
    links = _as_edges(graph)
    nearest = Window.partitionBy("host").orderBy(F.col("similarity").desc(), "member")
    back = links.select(F.col("v").alias("host"), F.col("u").alias("member"), "similarity")
    back = back.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= keep).select("host", "member")
    hosted = links.select(F.col("u").alias("host"), F.col("v").alias("member")).union(back).distinct()
    if changed is not None:
        hosted = hosted.join(changed.select(F.col("u").alias("host")), "host", "left_semi")
    worst = F.when(F.size("list") >= keep, -F.element_at("list", -1)["d"]).otherwise(F.lit(-2.0))
    bars = graph.select(F.col("u").alias("member"), worst.alias("bar"))
    members = nodes.select(F.col("id").alias("member"), "unit").join(bars, "member", "left")
    met = hosted.join(members, "member").select("host", "member", "unit", F.coalesce("bar", F.lit(-2.0)).alias("bar"))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(frames, "host"):
            us, vs, ss = [], [], []
            ids, bar = pdf["member"].to_numpy(), pdf["bar"].to_numpy()
            x = _matrix(pdf["unit"]).astype(np.float64)
            for a, b in _groups(pdf, "host"):
                if b - a < 2:
                    continue
                s = x[a:b] @ x[a:b].T
                i, j = np.nonzero((s > bar[a:b][:, None]) & ~np.eye(b - a, dtype=bool))
                us.append(ids[a:b][i])
                vs.append(ids[a:b][j])
                ss.append(s[i, j])
            yield _edges(us, vs, ss)

    new = met.repartition("host").sortWithinPartitions("host").mapInPandas(compare, _EDGES)
    return _graph(_as_edges(graph).union(new), keep)


def build(vectors: DataFrame, key: str, vector: str, dims: int = 64, keep: int = KEEP, trees: int = TREES, leaf: int = LEAF, most: int = MOST, root_depth: int = ROOT_DEPTH) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, nodes, graph, placed): rows with their node, nodes with unit vectors, the neighbour graph of nodes, the leaves it started from.

    Null, empty, too short or long and zero vectors are left out, as are rows
    without a key; copies share a node. Lists only ever improve, so the rounds
    come to an end; they stop when one changes the lists of hardly any node.
    """
    units = unit_vectors(vectors, key, vector, dims)
    order = Window.partitionBy("direction").orderBy("id")
    ranked = cut(
        units.withColumn("rank", F.row_number().over(order)).withColumn("node", F.min("id").over(Window.partitionBy("direction"))), "vectors"
    )
    members = ranked.select("id", "node", "rank")
    nodes = ranked.where("rank = 1").select("id", "unit")
    n = nodes.count()
    placed = grow(nodes, n, dims, trees, leaf, most, root_depth)
    graph = cut(_graph(leaf_edges(placed, keep), keep), "graph")
    changed = None
    while True:
        after = cut(descend(nodes, graph, changed, keep), "graph")
        old = graph.select("u", F.col("list").alias("before"))
        moved = cut(after.join(old, "u", "left").where("before IS NULL OR list <> before").select("u"), "changed")
        for table in (graph, *([changed] if changed is not None else [])):
            drop_cut(table)
        graph, changed = after, moved
        if moved.count() <= n // SETTLED:
            return members, nodes, graph, placed


def nearest(members: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """(id, neighbour, similarity): the k nearest rows of every row, ties by the smaller id.

    Copies have one list; of a node only its first k + 1 rows can be among
    anybody's k nearest, so no more of them are joined.
    """
    heads = members.where(F.col("rank") <= k + 1).select(F.col("node").alias("v"), F.col("id").alias("neighbour"))
    own = members.where("rank = 2").select(F.col("node").alias("u"), F.col("node").alias("v"), F.lit(1.0).alias("similarity"))
    near = _as_edges(graph).union(own).join(heads, "v")
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("d"), F.col("neighbour").alias("v"))))
    # A node's own rows come first; one more than k, as a row isn't its own neighbour.
    lists = near.groupBy("u").agg(F.slice(ranked, 1, k + 1).alias("list"))
    rows = members.select("id", F.col("node").alias("u")).join(lists, "u")
    mine = F.slice(F.filter("list", lambda x: x["v"] != F.col("id")), 1, k)
    return rows.select("id", F.inline(mine)).select("id", F.col("v").alias("neighbour"), (-F.col("d")).alias("similarity"))


def leaf_starts(placed: DataFrame, queries: DataFrame, most: int) -> DataFrame:
    """(query, node, similarity): of every query, a node of the collection, the best nodes of each of its leaves."""

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(frames, "leaf"):
            us, vs, ss = [], [], []
            x, ids, asked = _matrix(pdf["unit"]).astype(np.float64), pdf["id"].to_numpy(), pdf["asked"].to_numpy()
            for a, b in _groups(pdf, "leaf"):
                q, n = np.flatnonzero(asked[a:b]) + a, np.arange(a, b)
                if not len(q):
                    continue
                s = x[q] @ x[n].T
                m = min(most, len(n))
                top = np.argpartition(-s, m - 1, axis=1)[:, :m]
                us.append(np.repeat(ids[q], m))
                vs.append(ids[n][top].ravel())
                ss.append(np.take_along_axis(s, top, 1).ravel())
            yield _edges(us, vs, ss)

    both = placed.join(queries.select(F.col("query").alias("id"), F.lit(True).alias("asked")), "id", "left").select("leaf", "id", "unit", F.coalesce("asked", F.lit(False)).alias("asked"))
    found = both.repartition("leaf").sortWithinPartitions("leaf").mapInPandas(best, _EDGES)
    return found.groupBy(F.col("u").alias("query"), F.col("v").alias("node")).agg(F.max("similarity").alias("similarity"))


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, k: int, placed: DataFrame, beam: int = 96, width: int = 32) -> DataFrame:
    """(query, node, similarity): the k nearest nodes of each query by greedy search along the graph.

    `queries` has query, a node, and its unit. A search starts from the best
    nodes of the leaves that its vector lies in. All searches take a hop at a
    time: the `width` best nodes of each beam that haven't been left yet are
    joined with the graph, forward and backward, the nodes they lead to with
    their vectors. A search keeps its `beam` best and ends when its beam holds
    no node that hasn't been left; beams only improve, so all searches end.
    """

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                s = np.einsum("ij,ij->i", _matrix(pdf["unit"]).astype(np.float64), _matrix(pdf["of_query"]).astype(np.float64))
                yield pd.DataFrame({"query": pdf["query"], "node": pdf["node"], "similarity": np.round(s, _DIGITS), "open": True})

    form = "query bigint, node bigint, similarity double, open boolean"
    queries = cut(queries, "queries")
    links = graph.select(F.col("u").alias("at"), F.explode("list.v").alias("node"))
    links = cut(links.union(links.select(F.col("node").alias("at"), F.col("at").alias("node"))).distinct(), "links")
    best = Window.partitionBy("query").orderBy(F.col("similarity").desc(), "node")
    nearest_open = Window.partitionBy("query", "open").orderBy(F.col("similarity").desc(), "node")

    def beams(df: DataFrame) -> DataFrame:
        kept = df.withColumn("n", F.row_number().over(best)).where(F.col("n") <= beam)
        leave = F.col("open") & (F.row_number().over(nearest_open) <= width)
        return cut(kept.withColumn("leave", leave).drop("n"), "beam")

    state = beams(leaf_starts(placed, queries, beam).withColumn("open", F.lit(True)))
    while not state.where("leave").isEmpty():
        frontier = state.where("leave").select("query", F.col("node").alias("at"))
        ahead = frontier.join(links, "at").select("query", "node").distinct().join(state.select("query", "node"), ["query", "node"], "left_anti")
        looked = ahead.join(nodes.select(F.col("id").alias("node"), "unit"), "node").join(queries.select("query", F.col("unit").alias("of_query")), "query")
        left = state.select("query", "node", "similarity", (F.col("open") & ~F.col("leave")).alias("open"))
        before, state = state, beams(left.union(looked.mapInPandas(look, form)))
        drop_cut(before)
    return state.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("query", "node", "similarity")
