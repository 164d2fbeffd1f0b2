import itertools
import random

import pytest

from ledgerloom.llm import mixing as X
from ledgerloom.llm import packing as P
from ledgerloom.llm import tokens as T


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= s) - s) for s, n in histogram.items())


def test_bounds_are_optimal():
    rng = random.Random(1)
    for _ in range(150):
        h = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        k = rng.randint(1, 5)
        sizes = sorted(h)
        best = min(padding(h, c + (sizes[-1],)) for r in range(min(k, len(sizes))) for c in itertools.combinations(sizes[:-1], r))
        bounds = P.bucket_bounds(h, k)
        assert len(bounds) <= k and padding(h, bounds) == best


@pytest.mark.parametrize("capacity", [10, 64, 512])
def test_every_token_has_one_place(spark, capacity):
    rng = random.Random(capacity)
    rows = [(i, rng.choice([0, None, 1, 2, rng.randint(1, 300), rng.randint(1, 1500)])) for i in range(400)] + [(i, 300) for i in range(400, 600)]
    df = spark.createDataFrame(rows, "doc_id long, n long")
    got = P.pack(df, "doc_id", "n", capacity).collect()
    boxes, items = {}, {}
    for r in got:
        boxes[r.container_no] = boxes.get(r.container_no, 0) + r.n_tokens
        items.setdefault(r.doc_id, []).append((r.piece_no, r.first_token, r.n_tokens))
    assert max(boxes.values()) <= capacity and set(boxes) == set(range(len(boxes)))
    for i, n in rows:
        at = 0
        for k, (piece, first, size) in enumerate(sorted(items.get(i, []))):
            assert (piece, first) == (k, at)
            at += size
        assert at == (n or 0) and (not n or n > capacity or len(items[i]) == 1)
    # No packing needs fewer containers than the tokens fill, or than there are pieces over half a container.
    sizes = [size for parts in items.values() for _, _, size in parts]
    least = max(-(-sum(sizes) // capacity), sum(2 * size > capacity for size in sizes))
    assert len(boxes) <= 1.05 * least + 1


def test_packing_nothing(spark):
    assert P.pack(spark.createDataFrame([], "doc_id long, n long"), "doc_id", "n", 8).count() == 0


TARGETS = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 8), ("none", 0.0, 1)]


def test_shares(spark):
    rng = random.Random(2)
    rows = [(i, "a", rng.randint(50, 150)) for i in range(3000)] + [(i, "b", rng.randint(50, 150)) for i in range(3000, 3500)] + [(i, "c", 100) for i in range(3500, 3700)]
    rows += [(9000, None, 5), (9001, "other", 5), (9002, "a", 0), (9003, "a", None)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame(TARGETS + [("gone", 0.1, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats long")
    selection, shares = X.mix(sized, targets)
    got = {r.source: r for r in shares.collect()}
    total = sum(r.tokens for r in got.values())
    for s, want, most in TARGETS[:3]:
        assert got[s].tokens / total == pytest.approx(want, abs=0.004) and got[s].most_repeats <= most and got[s].share_reached == pytest.approx(got[s].tokens / total, abs=1e-6)
    assert got["gone"].tokens == 0 and got["none"].tokens == 0 and None not in got
    chosen = selection.collect()
    assert {r.source for r in chosen} == {"a", "b", "c"} and len({r.doc_id for r in chosen}) == len(chosen)
    again, _ = X.mix(sized.repartition(7), targets)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, chosen))
    assert X.mix(sized.limit(0), targets)[0].count() == 0


def test_the_cut_is_exact_to_one_text(spark, monkeypatch):
    monkeypatch.setattr(X, "PART_ROWS", 10)
    sized = spark.createDataFrame([(i, "a", 1 + i % 7) for i in range(500)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 1.0, 3)], "source string, target_share double, max_repeats long")
    selection, _ = X.mix(sized, targets, total=1_000)
    assert 1_000 - 7 < sum(r.n_tokens * r.times for r in selection.collect()) <= 1_000


def test_one_text_under_two_ids_counts_once(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "b", "x"), (3, "a", "y"), (4, "a", None), (5, None, "")], "doc_id long, source string, text string")
    assert sorted(r.doc_id for r in X.distinct_texts(df, "doc_id", "text", "source").collect()) == [1, 3]


def test_token_counts(spark):
    pytest.importorskip("tiktoken")
    df = spark.createDataFrame([(1, "Hello world", 7), (2, "", 7), (3, None, 7), (4, "<|endoftext|> é日", 7)], "doc_id long, text string, n_tokens long")
    got = {r.doc_id: r.n_tokens for r in T.with_token_counts(df).collect()}
    enc = T.encoding(T.RANKS)
    assert got == {1: 2, 2: 0, 3: 0, 4: len(enc.encode_ordinary("<|endoftext|> é日"))}
    assert enc.decode(enc.encode_ordinary("<|endoftext|> é日")) == "<|endoftext|> é日"


def test_copies_outside_the_targets_take_no_text_away(spark):
    rows = [(1, None, "x"), (2, "other", "y"), (3, "a", "x"), (4, "a", "y"), (5, "a", "y"), (6, "none", "z"), (7, "a", "z"), (8, "none", "only"), (9, "other", "gone")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    targets = spark.createDataFrame([*TARGETS, (None, 0.5, 1)], "source string, target_share double, max_repeats long")
    got = X.distinct_texts(df, "doc_id", "text", "source", targets).collect()
    assert sorted((r.doc_id, r.source) for r in got) == [(3, "a"), (4, "a"), (7, "a"), (8, "none")]


def test_keys_may_bear_the_names_used_inside(spark):
    df = spark.createDataFrame([(i, 3 + i % 4, None) for i in range(20)] + [(99, None, 1)], "bucket long, rank long, salt long")
    got = P.pack_all(df, "bucket", "rank", [("a", 10), ("b", 4)])
    rows = got.collect()
    assert got.columns == ["pack_name", "capacity_tokens", "container_no", "bucket", "piece_no", "first_token", "n_tokens"]
    assert {r.bucket for r in rows} == set(range(20)) and {n: sum(r.n_tokens for r in rows if r.pack_name == n) for n in "ab"} == {"a": 90, "b": 90}
    assert P.pack_all(df, "bucket", "rank", []).count() == 0
