import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import names as N
from ledgerloom.llm import neardup as D
from ledgerloom.llm import queries as Q
from ledgerloom.llm import similar as V


@pytest.mark.parametrize(
    ("kind", "a", "b", "want"),
    [
        ("person", "Elizabeth J. Stavvint", "ELIZABETH STAVVINT", True), ("person", "Wilsbory, Thomas", "Tom Wilsbory", True), ("person", "Ric. R. Yelrask", "Richard R. Yelrask", True),
        ("person", "R. T. Yelwards", "Richard T. Yelwards", True), ("person", "Dr. Victoria Wilvint", "Vicky R. Wilvint", True), ("person", "Anthonny Wilpello", "Anthony J. Wilpello", True),
        ("person", "Michael Tolxley", "Elizabeth M. Tolxley", False), ("person", "Anna B. Roe", "Anna C. Roe", False), ("person", "John Roe Jr.", "John Roe Sr.", False), ("person", "Roe", "John Roe", True),
        ("company", "Fengotha Precision Services, LLC", "FENGOTHA PRECISION SERVICES L.L.C.", True), ("company", "Fengotha Precision Serrvices", "Fengotha Precision Services LLC", True),
        ("company", "Mornax Energy Systems, LLC", "Energy Systems of Mornax", True), ("company", "Holdings, Selvann International Inc.", "Selvann International Holdings Inc.", True),
        ("company", "The Ulvwisk General Logistics Incorporated", "Ulvwisk Gen. Logistics, Inc.", True), ("company", "Grilorp Precision Prods.", "Grilorp Precision Products LLC", True),
        ("company", "Q.N.I.", "Quilwisk Northern Industries Ltd.", True), ("company", "KPRM", "Kesnax Pacific Rim Materials & Coatings", True), ("company", "Turgotha", "Turgotha Precision Materials", True),
        ("company", "Caljell LLC", "Caljell General Products Inc.", False), ("company", "Prakvist Energy Holdings", "Prakvist Energy Holdings Leasing", False), ("company", "Vervann Marine Services", "Vervann Marine Systems", False),
        ("company", "Acme", "", False), ("person", "Jane Roe", "Roe Jane", True), ("person", "Jane Roe", "Roe Janet", False), ("person", "Ann Roe", "Ann Rob", False),
        ("company", "Alpha Beta Gamma Delta Epsilon Zeta Eta Theta Inc.", "Alpha Theta Eta Zeta Epsilon Delta Gamma Beta Inc.", True),
        ("company", "Marine Bolt Services", "Bolt Marine Services", True), ("company", "Bolt Marine Services", "Bolt Inland Services", False), ("company", "ABCDEFGHIJ", "A.B.C.D.E.F.G.H.I.J.", True),
    ],
)
def test_spellings(kind, a, b, want):
    assert N.same(kind, a, b) is want and N.same(kind, b, a) is want


def edits(a):
    s = "abc"
    yield from (a[:i] + a[i + 1 :] for i in range(len(a)))
    yield from (a[:i] + c + a[i:] for i in range(len(a) + 1) for c in s)
    yield from (a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in s)
    yield from (a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1))


@settings(deadline=None, max_examples=60)
@given(st.text("abc", min_size=4, max_size=7), st.text("abc", min_size=4, max_size=7))
def test_one_edit_and_its_index(a, b):
    near = a == b or b in set(edits(a))
    assert N.within_one_edit(a, b) == near
    if near:
        assert set(N.deletions(a)) & set(N.deletions(b))


def test_the_assignment_is_the_best_of_all():
    rng = random.Random(6)
    words = ["alpha", "alpah", "a", "beta", "bet.", "gamma", "gama", "intl", "international", "x", "delta", "robert", "bob"]
    for _ in range(200):
        a, b = (tuple(rng.choice(words) for _ in range(rng.randint(0, 5))) for _ in range(2))
        short, long = sorted((a, b), key=len)
        best = min(sum(map(N.token_cost, short, p)) for p in itertools.permutations(long, len(short)))
        assert N.assignment(a, b) == pytest.approx(best)


@pytest.mark.parametrize(("kind", "a", "b"), [("person", "Jane Roe", "Roe Jane"), ("person", "Bob Roe", "Robert Roeh"), ("person", "Peggy Roe", "Margaret Roe"), ("person", "J. Roe", "Jane Roe"), ("person", "Roe", "Jane Roe"), ("company", "Gen. Svcs of Mornax", "Mornax General Services Inc."), ("company", "Mornax Energy", "Mornax Enrgy LLC"), ("company", "Mornax", "Mornax Energy")])
def test_spellings_that_fit_share_a_key(kind, a, b):
    (sought_a, full_a), (sought_b, full_b) = N.keys(kind, a), N.keys(kind, b)
    assert set(sought_a) & set(full_b) or set(sought_b) & set(full_a)


def test_linked_spellings(spark):
    rows = [("d", "company", n) for n in ["Acme Precision Products LLC", "Acme Precision Prods.", "ACME PRECISION PRODUCTS LLC", "Acme", "A.P.P.", "APP", "Acme Precision Products Finance", "Bolt Marine", "Bolt Inland", "Bolt", None, " "]]
    rows += [("d", "person", n) for n in ["Charles Roe", "Chuck Roe", "C. Roe", "Mary Roe", "M. Roe"]] + [("e", "person", "Charles Roe"), ("d", "person", "Charles Roe"), (None, "person", "X Y"), ("d", "person", "Catherine Doe"), ("d", "person", "Cynthia Doe"), ("d", "person", "C. Doe")]
    df = spark.createDataFrame(rows, "scope string, kind string, name string")
    linked = N.linked_spellings(df)
    groups = {}
    for r in linked.collect():
        groups.setdefault((r.scope, r.kind, r.entity), set()).add(r.name)
    got = set(map(frozenset, groups.values()))
    assert {"Acme Precision Products LLC", "Acme Precision Prods.", "ACME PRECISION PRODUCTS LLC", "Acme", "A.P.P.", "APP"} in got
    assert {"Charles Roe", "Chuck Roe", "C. Roe"} in got and {"Mary Roe", "M. Roe"} in got and {"C. Doe"} in got and {"Bolt"} in got
    pairs = {tuple(r) for r in N.spelling_pairs(linked).collect()}
    assert ("d", "C. Roe", "Charles Roe") in pairs and all(a < b for _, a, b in pairs) and not any(s == "e" for s, *_ in pairs)
    assert N.spelling_pairs(N.linked_spellings(df.limit(0))).count() == 0


def shingles(text, k):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 80))]
        texts.append(" ".join(base))
        for _ in range(3):
            other = list(base)
            for _ in range(rng.randint(0, 6)):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    texts += [texts[0], texts[0].upper(), "too short", "", None]
    df = spark.createDataFrame([(f"{i:03}", t) for i, t in enumerate(texts)], "record_id string, chunk_text string")
    got = {tuple(r) for r in D.similar_pairs(df, "record_id", "chunk_text", words=3, threshold=0.6, least_words=20).collect()}
    sets = {f"{i:03}": shingles(t, 3) for i, t in enumerate(texts) if t and len(t.split()) >= 20}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    assert got <= want and len(want - got) <= 0.03 * len(want)
    assert D.similar_pairs(df.limit(0), "record_id", "chunk_text").count() == 0


def test_crowded_buckets_in_blocks_give_the_same_pairs(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(120):
        other = list(base)
        for _ in range(rng.randint(0, 4)):
            other[rng.randrange(60)] = f"x{rng.randint(0, 9)}"
        texts.append(" ".join(other))
    df = spark.createDataFrame([(f"{i:03}", t) for i, t in enumerate(texts)], "record_id string, chunk_text string")
    classes = D.text_classes(df, "record_id", "chunk_text", 3, 20)
    whole = {(r.class_a, r.class_b) for r in D.similar_classes(classes, 0.6).collect()}
    blocks = [(r.class_a, r.class_b) for r in D.similar_classes(classes, 0.6, block=7).collect()]
    assert len(whole) > 1_000 and set(blocks) == whole and len(blocks) == len(whole)


def test_pairs_of_representatives_and_their_members(spark):
    base = " ".join(f"w{i}" for i in range(40))
    texts = [base] * 5 + [base.upper() + " x"] * 3 + ["short", None, ""]
    df = spark.createDataFrame([(f"{i:03}", t) for i, t in enumerate(texts)], "record_id string, chunk_text string")
    pairs, members = D.representative_pairs(df, "record_id", "chunk_text")
    assert [tuple(r) for r in pairs.collect()] == [("000", "005")]
    assert {(r.record_id, r.head) for r in members.collect()} == {(f"{i:03}", "000" if i < 5 else "005") for i in range(8)}


def vectors(spark, x, extra=()):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows + list(extra), "id long, v array<float>")


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16))
    x = np.concatenate([c + 0.15 * rng.standard_normal((12, 16)) for c in centres] + [centres[:1] * 2, centres[:1]])
    extra = [(9_000, None), (9_001, []), (9_002, [0.0] * 16), (9_003, [1.0] * 15), (9_004, [float("nan")] * 16), (9_005, [None] * 16), (None, [1.0] * 16)]
    members, _, graph, _ = V.build(vectors(spark, x, extra), "id", "v", dims=16, leaf=64)
    got = {}
    for r in V.nearest(members, graph, 5).collect():
        got.setdefault(r.id, {})[r.neighbour] = r.similarity
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {i: set(np.argsort(-np.round(s[i], 9), kind="stable")[:5]) for i in range(len(x))}
    assert set(got) == set(want)
    assert np.mean([len(want[i] & set(got[i])) / 5 for i in want]) >= 0.95
    assert got[len(x) - 1][len(x) - 2] == 1.0 and all(i not in got[i] for i in got)
    assert all(v == pytest.approx(s[i, j], abs=1e-5) for i in list(got)[:50] for j, v in got[i].items())


def test_large_leaves_are_split_on_the_executors(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((900, 8)).astype(np.float32)
    nodes = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(x)], "id long, unit binary")
    placed = V.grow(nodes, 900, 8, trees=2, leaf=10, most=30, root_depth=2)
    sizes = [r.n for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 30 and sum(sizes) == 1_800 and placed.select("id").distinct().count() == 900
    # Nodes that no projection parts stay together, and the rounds end.
    same = spark.createDataFrame([(i, bytearray(x[0].tobytes())) for i in range(50)], "id long, unit binary")
    assert V.grow(same, 50, 8, trees=1, leaf=10, most=30, root_depth=2).count() == 50


def test_search_and_empty_tables(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([c + 0.2 * rng.standard_normal((15, 16)) for c in rng.standard_normal((40, 16))])
    members, nodes, graph, placed = V.build(vectors(spark, x), "id", "v", dims=16, leaf=64)
    asked = nodes.where("id % 20 = 0").selectExpr("id AS query", "unit")
    found = {}
    for r in V.search(nodes, graph, asked, 6, placed).collect():
        found.setdefault(r.query, set()).add(r.node)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    best = {q: set(np.argsort(-(u @ u[q]))[:6]) for q in found}
    assert len(found) == 30 and np.mean([len(best[q] & found[q]) / 6 for q in found]) >= 0.9
    members, _, graph, _ = V.build(vectors(spark, x[:0]), "id", "v", dims=16)
    assert V.nearest(members, graph, 5).count() == 0
    members, _, graph, _ = V.build(vectors(spark, x[:1]), "id", "v", dims=16)
    assert V.nearest(members, graph, 5).count() == 0


def test_every_pair_and_link_of_large_classes(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(40))
    texts = [base] * 1003 + [base + " x"] * 99 + [" ".join(f"v{i}" for i in range(40))] + [" ".join(f"u{i}" for i in range(30))] * 2
    df = spark.createDataFrame([(f"{i:04}", t) for i, t in enumerate(texts)], "record_id string, chunk_text string")
    df.withColumn("loaded_at", F.current_timestamp()).write.parquet(str(tmp_path / "chunks.parquet"))
    got = [tuple(r) for r in Q.p7_found(spark, str(tmp_path)).collect()]
    want = {*itertools.combinations([f"{i:04}" for i in range(1102)], 2), ("1103", "1104")}
    assert len(got) == len(want) and set(got) == want
    groups = {tuple(r) for r in Q.p7_groups(spark, str(tmp_path)).select("record_id", "group_id", "n_links").collect()}
    assert groups == {(f"{i:04}", "0000", 1101) for i in range(1102)} | {("1103", "1103", 1), ("1104", "1103", 1)}


def test_columns_may_bear_the_names_used_inside(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(f"{i}", base + " x" * (i > 1), None, i) for i in range(4)] + [(None, base, None, 9), ("7", None, "n", 9), ("8", "", "n", 9)]
    df = spark.createDataFrame(rows, "class_id string, shingles string, bucket string, record long")
    pairs = {tuple(r) for r in D.similar_pairs(df, "class_id", "shingles").collect()}
    assert pairs == set(itertools.combinations("0123", 2))
    groups = D.similar_groups(df, "class_id", "shingles")
    assert groups.columns == ["class_id", "group_id", "n_links"] and {tuple(r) for r in groups.collect()} == {(i, "0", 3) for i in "0123"}
    named = spark.createDataFrame([("d", "person", "Jane Roe", None), ("d", "person", "Roe, Jane", "x"), ("d", "person", "Jane Roe", "y")], "scope string, kind string, name string, entity string")
    assert N.spelling_pairs(N.linked_spellings(named)).count() == 1
