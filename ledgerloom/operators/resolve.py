"""Name variants of a document merged conservatively, with the evidence of each merge.

Distinct names meet in hash joins on narrow block keys, within a document and
type. All rules but the fuzzy ones are column expressions, so pairs that they
decide, or that are too unequal in length to reach the least score, never leave
the JVM; fuzzy scores run in Arrow batches on the rest. Groups are the connected
components of the merges inside a document and type.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import columns as C
from ledgerloom.functions import fuzzy
from ledgerloom.functions import rules as R
from ledgerloom.operators.graph import components_within
from ledgerloom.session import cut

LEAST_SCORE, PERSON_SCORE = 90, 93


def _words(norm: Column) -> Column:
    return F.filter(F.split(norm, " "), lambda w: w != "")


def _letters(words: Column) -> Column:
    """The first letters of words, as one string."""
    return F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), "")


def is_acronym(short: Column, norm: Column) -> Column:
    """Whether 2 to 6 capitals are the initials of the words that count of a longer name's normal form; null for null."""
    plain = F.trim(short)
    words = F.filter(_words(norm), lambda w: ~w.isin(*R.ACRONYM_IGNORED))
    capitals = F.length(plain).between(2, 6) & (plain == F.upper(plain)) & plain.rlike(r"\p{Lu}")
    known = (plain == "IPG") & (F.slice(words, 1, 2) == F.array(F.lit("interpublic"), F.lit("group")))
    return capitals & (F.size(words) >= 2) & (F.upper(F.get(words, F.lit(0))) != plain) & (known | (F.upper(_letters(words)) == plain))


def contains_unit(norm_a: Column, norm_b: Column) -> Column:
    """Whether one normal form is the other and a word that makes it another organisation; null for null."""
    a, b = _words(norm_a), _words(norm_b)
    units = F.array(*map(F.lit, R.CONTAINMENT_TOKENS))
    inside = lambda x, y: (F.size(x) > 0) & (F.size(F.array_except(x, y)) == 0) & F.arrays_overlap(F.array_except(y, x), units)
    return inside(a, b) | inside(b, a)


def _decision(merge: bool, method: str, score: int) -> Column:
    return F.struct(F.lit(merge).alias("merge"), F.lit(method).alias("method"), F.lit(score).alias("score"))


def company_rule(a: Column, b: Column, norm_a: Column, norm_b: Column) -> Column:
    """struct<merge, method, score> of two company names by the rules that need no score; null where the score decides."""
    no = _decision(False, "no_match", 0)
    return (
        F.when((F.coalesce(norm_a, F.lit("")) == "") | (F.coalesce(norm_b, F.lit("")) == ""), no)
        .when(norm_a == norm_b, _decision(True, "normalized_exact", 100))
        .when(contains_unit(norm_a, norm_b), no)
        .when(is_acronym(a, norm_b) | is_acronym(b, norm_a), _decision(True, "acronym", 100))
        .when(F.least(F.length(norm_a), F.length(norm_b)) < 5, no)
    )


def person_rule(norm_a: Column, norm_b: Column) -> Column:
    """struct<merge, method, score> of two persons' normal forms by the rules that need no score; null where the score decides."""
    no = _decision(False, "no_match", 0)
    a, b = _words(norm_a), _words(norm_b)
    whole = lambda t: F.filter(t, lambda w: F.length(w) > 1)
    first, last = lambda t: F.get(t, F.lit(0)), lambda t: F.try_element_at(t, F.lit(-1))
    full_a, full_b = whole(a), whole(b)
    named = (F.size(full_a) >= 2) & (F.size(full_b) >= 2) & (first(full_a) == first(full_b)) & (last(full_a) == last(full_b))
    given = lambda t: F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0)))
    initials = (last(a) == last(b)) & (F.size(a) == F.size(b)) & (_letters(given(a)) == _letters(given(b)))
    return (
        F.when((F.coalesce(norm_a, F.lit("")) == "") | (F.coalesce(norm_b, F.lit("")) == ""), no)
        .when(norm_a == norm_b, _decision(True, "normalized_exact", 100))
        .when((F.size(a) < 2) | (F.size(b) < 2), no)
        .when(named, _decision(True, "person_name", 95))
        .when(initials, _decision(True, "person_initials", 95))
    )


def judged(pairs: DataFrame, merges_only: bool = False) -> DataFrame:
    """Pairs (entity_type, name_a, name_b, norm_a, norm_b, ...) with merge, method and score, by rule or by score.

    With `merges_only`, pairs that aren't merged are left out, most of them
    before any score is taken: two strings whose lengths differ too much can't
    reach the least ratio.
    """
    company = F.col("entity_type") == "company"
    rule = F.when(company, company_rule(*map(F.col, ("name_a", "name_b", "norm_a", "norm_b")))).otherwise(person_rule(F.col("norm_a"), F.col("norm_b")))
    ruled = pairs.withColumn("__rule", rule)
    least = F.when(company, LEAST_SCORE).otherwise(PERSON_SCORE)
    if merges_only:
        shorter = F.least(F.length("norm_a"), F.length("norm_b"))
        ruled = ruled.where(F.coalesce(F.col("__rule.merge"), 200 * shorter >= least * (F.length("norm_a") + F.length("norm_b"))))

    @F.pandas_udf("ratio double, token_sort double, token_set double, partial double")
    def scores(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        got = [fuzzy.scores(x, y) if isinstance(x, str) and isinstance(y, str) else (None,) * 4 for x, y in zip(a, b)]
        return pd.DataFrame(got, columns=["ratio", "token_sort", "token_set", "partial"], dtype=float)

    open_ = F.col("__rule").isNull()
    scored = ruled.withColumn("__s", scores(F.when(open_, F.col("norm_a")), F.when(open_, F.col("norm_b"))))
    worst = F.when(company, F.least("__s.ratio", "__s.token_sort", "__s.token_set")).otherwise(F.least("__s.ratio", "__s.token_sort"))
    best = F.greatest("__s.ratio", "__s.token_sort", "__s.token_set", "__s.partial")
    by_score = F.when(worst >= least, F.struct(F.lit(True).alias("merge"), F.lit("strict_fuzzy").alias("method"), worst.cast("int").alias("score"))).otherwise(
        F.struct(F.lit(False).alias("merge"), F.lit("no_match").alias("method"), best.cast("int").alias("score"))
    )
    out = scored.withColumn("__d", F.coalesce("__rule", by_score)).select(*pairs.columns, "__d.merge", "__d.method", "__d.score")
    return out.where("merge") if merges_only else out


def block_keys(norm: Column, name: Column, kind: Column) -> Column:
    """The keys under which a name is compared; short capitals and the initials of long names share one."""
    t = F.split(norm, " ")
    first, last = F.get(t, F.lit(0)), F.element_at(t, -1)
    initials = F.array_join(F.transform(F.filter(t, lambda w: ~w.isin(*R.ACRONYM_IGNORED)), lambda w: F.left(w, F.lit(1))), "")
    key = lambda tag, *c: F.concat_ws(":", F.lit(tag), *c)
    two = F.size(t) >= 2
    company = F.array(
        key("first", first), key("last", last), F.when(F.length(initials).between(2, 6), key("acro", initials)),
        F.when(F.trim(name).rlike(r"^[^a-z]{2,6}$"), key("acro", F.lower(F.trim(name)))), F.when(norm.startswith("interpublic group"), F.lit("acro:ipg")),
    )
    person = F.array(key("last", last), F.when(two, key("first", first)), F.when(two, key("fi", F.left(first, F.lit(1)), last)))
    return F.when(norm != "", F.array_distinct(F.array_compact(F.when(kind == "company", company).otherwise(person))))


def canonical_score(name: Column, count: Column) -> Column:
    """Formal, frequent, not all capitals, no fragment, long."""
    clean = C.clean_name(name)
    t = F.split(clean, " ")
    generic = F.size(F.filter(t, lambda w: w.isin(*R.GENERIC_TOKENS)))
    legal = F.element_at(t, -1).isin(*R.LEGAL_SUFFIXES).cast("int")
    mixed = (~((name == F.upper(name)) & name.rlike(r"\p{L}"))).cast("int")
    whole = ((F.length(clean) >= 3) & ~name.contains("\n") & ~clean.rlike(r"^\d+$")).cast("int")
    formality = legal + mixed + (F.size(t) > 1).cast("int") + whole - generic
    return F.struct(formality.alias("a"), count.alias("b"), mixed.alias("c"), whole.alias("d"), F.length(name).alias("e"))


def resolve(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, evidence) of mentions: document_id, entity_type, name, position.

    Names of other types, null and empty names are left out; repeated mentions
    count. A name's position is its first. Empty normal forms never merge.
    """
    keep = mentions.where(F.col("entity_type").isin("company", "person") & (F.trim("name") != "") & F.col("document_id").isNotNull())
    scope = ["document_id", "entity_type"]
    names = keep.groupBy(*scope, "name").agg(F.count("*").alias("n"), F.min("position").alias("first_at"))
    norm = F.when(F.col("entity_type") == "company", C.normalize_company(F.col("name"))).otherwise(C.normalize_person(F.col("name")))
    names = cut(names.withColumn("norm", norm), "names")
    # Equal normal forms hang on their first name; only one name of each is compared further.
    head = F.first("name").over(Window.partitionBy(*scope, "norm").orderBy("first_at", "name"))
    headed = names.withColumn("head", F.when(F.col("norm") != "", head).otherwise(F.col("name")))
    keyed = headed.select(*scope, "name", "norm", F.explode(block_keys(F.col("norm"), F.col("name"), F.col("entity_type"))).alias("key"))
    a = keyed.select(*scope, "key", F.col("name").alias("name_a"), F.col("norm").alias("norm_a"))
    b = keyed.select(*scope, "key", F.col("name").alias("name_b"), F.col("norm").alias("norm_b"))
    met = a.join(b, [*scope, "key"]).where("name_a < name_b AND norm_a <> norm_b").drop("key").distinct()
    merged = judged(met, merges_only=True).select(*scope, F.col("name_a").alias("a"), F.col("name_b").alias("b"))
    edges = cut(merged.union(headed.where("head <> name").select(*scope, "head", "name")), "merges")
    groups = components_within(edges, scope, "a", "b").withColumnRenamed("node", "name")
    grouped = headed.join(groups, [*scope, "name"], "left").withColumn("group_id", F.coalesce("component", "name"))
    best = Window.partitionBy(*scope, "group_id").orderBy(canonical_score(F.col("name"), F.col("n")).desc(), "first_at", "name")
    placed = cut(grouped.withColumn("canonical_name", F.first("name").over(best)).withColumn("canonical_norm", F.first("norm").over(best)).select(*scope, "name", "norm", "n", "first_at", "group_id", "canonical_name", "canonical_norm"), "groups")
    asked = placed.select(*scope, F.col("name").alias("name_a"), F.col("canonical_name").alias("name_b"), F.col("norm").alias("norm_a"), F.col("canonical_norm").alias("norm_b"))
    scored = judged(asked.where("name_a <> name_b"))
    method = F.when(F.col("merge"), F.col("method")).otherwise(F.lit("cluster_link"))
    proof = scored.select(*scope, F.col("name_a").alias("variant"), F.col("name_b").alias("canonical_name"), method.alias("resolution_method"), F.col("score").alias("resolution_score"))
    itself = placed.where("name = canonical_name").select(*scope, F.col("name").alias("variant"), "canonical_name", F.lit("canonical").alias("resolution_method"), F.lit(100).alias("resolution_score"))
    evidence = cut(proof.union(itself), "evidence")
    counts = placed.groupBy(*scope, "canonical_name").agg(F.sum("n").alias("mention_count"), F.count("*").alias("n_variants"), F.array_join(F.sort_array(F.collect_list("name")), "|").alias("variants"))
    kinds = evidence.where("resolution_method <> 'canonical'").groupBy(*scope, "canonical_name").agg(F.min("resolution_method").alias("lo"), F.max("resolution_method").alias("hi"))
    how = F.when(F.col("lo").isNull(), "singleton").when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("mixed")
    groups = counts.join(kinds, [*scope, "canonical_name"], "left").select(*scope, "canonical_name", "variants", "n_variants", "mention_count", how.alias("resolution_method"))
    return groups, evidence


def attach(mentions: DataFrame, evidence: DataFrame) -> DataFrame:
    """record_id, canonical_name, entity_type, matched_text, method and score: of each canonical name its first mention in a record.

    Mentions find their group by text alone: where a company's and a person's
    spelling agree, the person's group is taken.
    """
    proof = evidence.groupBy("document_id", F.col("variant").alias("name")).agg(
        F.max_by(F.struct("canonical_name", "entity_type", "resolution_method", "resolution_score"), "entity_type").alias("g")
    )
    hit = mentions.select("document_id", "record_id", "name", "position").join(proof, ["document_id", "name"]).select("record_id", "name", "position", "g.*")
    first = Window.partitionBy("record_id", "canonical_name").orderBy("position", "name")
    return hit.withColumn("k", F.row_number().over(first)).where("k = 1").select("record_id", "canonical_name", "entity_type", F.col("name").alias("matched_text"), "resolution_method", "resolution_score")
