import random
import unicodedata

import pytest

from ledgerloom.llm import confusables as X
from ledgerloom.llm import languages as L
from ledgerloom.llm import splitting as S


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Ｉｔｅｍ　１", "Item 1"), ("wоrld", "world"), ("Сompany", "Company"), ("Кестрофим", "Кестрофим"), ("Μοριθαν", "Μοριθαν"), ("café", "café"),
        ("a​b­c", "abc"), ("x y z", "x y z"), ("™ m² ½ № § ®", "™ m² ½ № § ®"), ("“a” – b’s — c", "“a” – b’s — c"), ("signiﬁcant", "significant"),
        ("監査役は、報告書。", "監査役は、報告書。"), ("ｶﾞ", "ガ"), ("👨‍👩", "👨‍👩"), ("🏭 ok", "🏭 ok"), ("x\ty", "x y"), ("a\nb", "a\nb"), ("", ""), (None, None),
        ("Ｗе​ lｅаse", "We lease"), ("Façonelle", "Façonelle"), ("﻿A", "A"),
    ],
)
def test_one_form(text, want):
    assert X.normalize(text) == want
    assert X.normalize(want) == want


def test_the_pass_agrees_with_a_character_by_character_one():
    def slow(text):
        out = []
        for word in __import__("re").findall(r"[^\W_][^\W_̀-ͯ​­А-я]*(?:[^\W_]|[̀-ͯ​­])*|.", text, __import__("re").S):
            plain = "".join(single.get(c, c) for c in word)
            plain = unicodedata.normalize("NFC", plain)
            if any("LATIN" in unicodedata.name(c, "") for c in plain):
                plain = "".join(X.lookalikes().get(c, c) for c in plain)
            out.append(plain)
        return unicodedata.normalize("NFC", "".join(out))

    rng = random.Random(4)
    single = dict(X._single_pairs())
    for _ in range(500):
        text = "".join(rng.choice(["a", "B", "о", "е", " ", ".", "​", "­", "é", "Ｘ", " ", "é", "7"]) for _ in range(rng.randint(0, 14)))
        if not text.startswith(("́",)):
            assert X.normalize(text) == slow(text), repr(text)


def test_conflicts_are_refused():
    assert X.checked(iter([("ab", "c"), ("a", "x"), ("xb", "c")])) == {"ab": "c", "a": "x", "xb": "c"}
    for pairs in ([("a", "b"), ("a", "c")], [("a", "b"), ("b", "c")], [("ab", "c"), ("a", "x")]):
        with pytest.raises(ValueError):
            X.checked(iter(pairs))


def test_the_longest_key_of_a_cluster_wins():
    plain = X.plain_mapping()
    assert plain["ｶﾞ"] == plain["カﾞ"] == plain["カ\u3099"] == "ガ" and plain["ｶ"] == "カ" and plain["e\u0302\u0301"] == plain["ê\u0301"] == "ế"
    assert X.normalize("Ｅ\u0301a") == "Éa" and X.normalize("e\u200b\u0301") == "é" and X.normalize("x\u0301\u0323") == "x\u0323\u0301"
    assert X.normalize("a\ufe0f 1\ufe0f\u20e3 👍🏽\u200d") == "a 1\ufe0f\u20e3 👍🏽" and X.normalize("\u212a") == "K"


@pytest.mark.parametrize(("text", "want"), [("abcս", "abcu"), ("AᎪB", "AAB"), ("\u0451lite", "ëlite"), ("\u0435\u0301tat", "état"), ("Ընդհանուր", "Ընդհանուր"), ("ᎠᎪ", "ᎠᎪ"), ("X社の", "X社の")])
def test_lookalikes_of_any_script_in_latin_words(text, want):
    if not X.confusables_data():
        pytest.skip("Spark's ICU library isn't here")
    assert X.normalize(text) == want == X.normalize(want)


def test_forms_in_spark(spark):
    df = spark.createDataFrame([("a", "wоrld", None, "kept"), ("b", "plain", "", "kept"), ("c", None, "x y", "kept")], "record_id string, chunk_text string, heading string, heading_form string")
    found = {tuple(r) for r in X.inconsistent_fields(df, "record_id", "chunk_text", "heading").collect()}
    assert found == {("a", "chunk_text"), ("c", "heading")}
    forms = {r.record_id: (r.chunk_text_form, r.heading_form) for r in X.with_consistent_form(df, "chunk_text", "heading").collect()}
    assert forms == {"a": ("world", None), "b": ("plain", ""), "c": (None, "x y")}
    assert X.inconsistent_fields(df.limit(0), "record_id", "chunk_text").count() == 0


def greedy(text, limit, overlap):
    ends, starts = (x.tolist() for x in S.boundaries(text, limit, overlap))
    out, at = [], 0
    while at < len(text):
        start = 0 if at == 0 else min([x for x in starts if x >= at - overlap] + [at])
        end = max(x for x in ends if x <= min(start, at) + limit)
        out.append((min(start, at), end))
        at = end
    return out


def test_doubling_finds_the_greedy_cuts():
    rng = random.Random(3)
    for _ in range(150):
        texts = ["".join(rng.choice("ab  .\n。é́") for _ in range(rng.randint(60, 400))) for _ in range(3)] + ["x" * rng.randint(51, 300), "́" * 120, " " * 130]
        overlap = rng.choice([0, 5, 10])
        owner, start, end = S.split_batch(texts, 50, overlap)
        for i, text in enumerate(texts):
            got = [(a, b) for o, a, b in zip(owner, start, end) if o == i]
            assert got == greedy(text, 50, overlap)
            assert got[0][0] == 0 and got[-1][1] == len(text) and all(b - a <= 50 for a, b in got)
            assert all(0 <= got[k][1] - got[k + 1][0] <= overlap for k in range(len(got) - 1))


@pytest.mark.parametrize("unit", ["👍🏽", "🇩🇪", "क्ष", "か\u3099", "e\u0301\u0323", "👨\u200d👩\u200d👧", "각", "é"])
def test_forced_cuts_keep_clusters(unit):
    text = unit * 60
    _, start, end = S.split_batch([text], 50, 10)
    assert start[0] == 0 and end[-1] == len(text) and len(start) > 1
    # The farthest cluster that fits, no multiple of anything.
    assert all(e % len(unit) == 0 for e in end) and end[0] == 50 // len(unit) * len(unit)
    assert all(b - a <= 50 for a, b in zip(start, end))


def test_no_piece_starts_with_a_mark_or_a_closing_sign():
    text = "一二三。」" * 30 + "a \u0301b " * 30
    _, start, end = S.split_batch([text], 50, 10)
    assert not any(text[e : e + 1] in {"」", "\u0301"} for e in end) and not any(text[a] in {"」", "\u0301"} for a in start)


def test_cuts_are_natural(spark):
    text = "One sentence here. Another one, e.g. this, follows. " * 60
    df = spark.createDataFrame([("a", text, None), ("b", "x" * 2000, ""), ("c", "y" * 2001, "z" * 9000)], "record_id string, chunk_text string, retrieval_text string")
    got = S.split_oversized(df, "record_id", ["chunk_text", "retrieval_text"]).collect()
    assert {(r.record_id, r.field_name) for r in got} == {("a", "chunk_text"), ("c", "chunk_text"), ("c", "retrieval_text")}
    for r in got:
        assert len(r.piece) <= 2000 and r.end_char - r.start_char == len(r.piece)
        if r.record_id == "a" and r.end_char < len(text):
            assert r.piece.rstrip().endswith((".",)) and text[r.end_char] in "OA"


DE = "Der Umsatz der Gruppe hat die Kosten deutlich erhöht. Der Aufsichtsrat hatte die Dividende bestätigt, weil die Preise gestiegen sind. "
FR = "La société mère a soutenu les charges financières. Le conseil d'administration avait réduit le risque de change en 2010. "
EN = "The committee reported that the margin of the company increased. We lease several sites near the coast because of our plans. "


def test_segments(spark):
    rows = [(i, t, lab) for i, (t, lab) in enumerate([(DE * 3, "de"), (DE * 2, "German"), (FR * 3, "fr"), (FR * 2, "fr-FR"), (EN * 3, "en"), (EN * 2, "EN")] * 4)]
    rows += [(100, DE, None), (101, FR, "en"), (102, EN * 2 + DE * 3, "de"), (103, None, "en"), (104, "", None), (105, "1,2   3\n4", "de"), (106, EN, "en_GB"), (107, DE + "The Acme Company Ltd. ", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {}
    for r in L.detect(df).collect():
        got.setdefault(r.doc_id, []).append((r.segment_no, r.lang, r.label, r.main_lang))
    assert sorted(got[100]) == [(0, "de", None, "de")] and sorted(got[101]) == [(0, "fr", "en", "fr")]
    assert sorted(got[102]) == [(0, "en", "de", "de"), (1, "de", "de", "de")]
    assert not {103, 104, 105} & set(got) and got[106][0][2] == "en"
    assert all(0 <= r.confidence <= 1 for r in L.detect(df).collect())
    assert L.detect(df.limit(0)).count() == 0


def test_labels(spark):
    labels = ["de_DE", "GERMAN", "deu", " ", "und", "n/a", "xx", None, "pl", "pt-BR", "日本語"]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    assert [r.c for r in df.select(L.label_code(df.x).alias("c")).collect()] == ["de", "de", "de", None, None, None, None, None, "?", "pt", "ja"]


def test_sentences():
    assert L.sentences("Er zahlte 5 Mio. EUR an Acme (X S.p.A.). Dann ging er.\nEnde") == ["Er zahlte 5 Mio. EUR an Acme (X S.p.A.). ", "Dann ging er.\n", "Ende"]
    assert L.sentences("一。二。") == ["一。", "二。"] and L.sentences("") == []


def test_a_label_that_no_sentence_bears_out_is_dropped():
    model = L.fit([DE * 3, FR * 3, EN * 3, EN * 2], ["de", "fr", "en", "sv"])
    assert set(model.languages) >= {"de", "fr"} and len(model.centroids) == len(model.owner) and set(model.owner) == set(range(len(model.languages)))


def test_copies_count_once_in_the_sample(spark):
    rows = [(i, EN, "en") for i in range(50)] + [(100 + i, f"{DE} {i}", "de") for i in range(5)] + [(200, None, "de"), (None, FR, "fr")]
    got = L.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang", most=3).collect()
    assert sorted(r.lang for r in got) == ["de", "de", "de", "en"]
