"""Queries p3_ to p10_ (without p1_ and p2_, which are general)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import confusables, languages, mixing, names, neardup, packing, similar, splitting, tokens
from ledgerloom.operators import nested
from ledgerloom.sources import latest_records, read_table


#: Neighbours kept where the whole lists count: far neighbours, among many about as far, need longer lists than near ones.
P3_WIDE = 28


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of vectors with cosine 0.90 or more of which one is among the other's 5 nearest."""
    members, _, graph, _ = similar.build(read_table(spark, sf_dir, "index_vectors"), "faiss_id", "embedding")
    near = similar.nearest(members, graph, 5).where(F.col("similarity") >= 0.9)
    return near.select(F.least("id", "neighbour").alias("faiss_id_a"), F.greatest("id", "neighbour").alias("faiss_id_b")).distinct()


def p3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector, however far."""
    members, _, graph, _ = similar.build(read_table(spark, sf_dir, "index_vectors"), "faiss_id", "embedding", keep=P3_WIDE)
    return similar.nearest(members, graph, 5).select(F.col("id").alias("faiss_id"), "neighbour", "similarity")


def p3_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every vector whose id is divisible by 100, by greedy graph search."""
    members, nodes, graph, placed = similar.build(read_table(spark, sf_dir, "index_vectors"), "faiss_id", "embedding", keep=P3_WIDE)
    asked = members.where("id % 100 = 0").select("id", "node")
    queries = asked.select("node").distinct().join(nodes.withColumnRenamed("id", "node"), "node").select(F.col("node").alias("query"), "unit")
    found = similar.search(nodes, graph, queries, 6, placed)
    rows = members.where("rank <= 6").select("node", F.col("id").alias("neighbour"))
    near = found.join(rows, "node").join(asked.select(F.col("node").alias("query"), F.col("id").alias("faiss_id")), "query").where("neighbour <> faiss_id")
    order = similar.Window.partitionBy("faiss_id").orderBy(F.round("similarity", 9).desc(), "neighbour")
    ranked = near.withColumn("rank", F.row_number().over(order)).where("rank <= 5")
    return ranked.select("faiss_id", F.col("rank").cast("bigint").alias("rank"), "neighbour", F.round("similarity", 6).alias("similarity"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that aren't in the consistent form yet."""
    chunks = read_table(spark, sf_dir, "chunks")
    suspect = chunks.where(F.concat_ws("", "chunk_text", "heading").rlike(r"[^\x20-\x7e\n]"))
    return confusables.inconsistent_fields(latest_records(suspect, "chunk_text", "heading"), "record_id", "chunk_text", "heading")


def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fields of every record in the consistent form."""
    chunks = latest_records(read_table(spark, sf_dir, "chunks"), "chunk_text", "heading")
    return confusables.with_consistent_form(chunks, "chunk_text", "heading").select("record_id", "heading_form", "chunk_text_form")


def _oversized(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["chunk_text", "retrieval_text"]
    chunks = read_table(spark, sf_dir, "chunks")
    longer = " OR ".join(f"length({f}) > {splitting.LIMIT}" for f in fields)
    return splitting.split_oversized(latest_records(chunks.where(longer), *fields), "record_id", fields)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that had to be cut: those with a second piece."""
    return _oversized(spark, sf_dir).where("piece_no = 1").select("record_id", "field_name")


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all oversized fields."""
    return _oversized(spark, sf_dir)


def filing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scope, kind, name): the distinct spellings of people and companies in each filing's chunks."""
    fields = ("entities_json", "resolved_entities_json")
    chunks = read_table(spark, sf_dir, "chunks")
    chunks = chunks.where(F.col("entities_json").contains("{") | F.col("resolved_entities_json").contains("{"))
    # Deliveries of a record hold the same names, so the distinct below counts each once.
    parsed = nested.with_parsed(chunks.where("record_id IS NOT NULL AND document_id IS NOT NULL"), *fields)
    empty = F.array().cast("array<struct<kind:string,name:string>>")

    def spelled(v, kind, path):
        return F.struct(F.try_variant_get(kind, "$.entity_type", "string").alias("kind"), F.try_variant_get(v, path, "string").alias("name"))

    mentions = F.transform("entities_json", lambda m: spelled(m, m, "$.text"))
    resolved = F.flatten(
        F.transform(
            "resolved_entities_json",
            lambda e: F.concat(
                F.array(spelled(e, e, "$.canonical_name"), spelled(e, e, "$.matched_text")),
                F.transform(nested.items(F.try_variant_get(e, "$.variant_evidence", "variant")), lambda v: spelled(v, e, "$.variant")),
            ),
        )
    )
    every = F.array_distinct(F.concat(F.coalesce(mentions, empty), F.coalesce(resolved, empty)))
    rows = parsed.select(F.col("document_id").alias("scope"), F.inline(every))
    return rows.where(F.col("kind").isin("person", "company")).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of spellings of one person or company in one filing."""
    linked = names.linked_spellings(filing_names(spark, sf_dir))
    return names.spelling_pairs(linked).withColumnRenamed("scope", "document_id")


def p6_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of each filing with the entity it names."""
    linked = names.linked_spellings(filing_names(spark, sf_dir))
    return linked.select(F.col("scope").alias("document_id"), "kind", "name", F.ltrim("entity", F.lit("\x1e")).alias("entity"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records whose texts share at least 0.60 of their three-word shingles."""
    chunks = latest_records(read_table(spark, sf_dir, "chunks"), "chunk_text")
    return neardup.similar_pairs(chunks, "record_id", "chunk_text", words=3, threshold=0.6, least_words=20)


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record with a near duplicate: its group and its number of links."""
    chunks = latest_records(read_table(spark, sf_dir, "chunks"), "chunk_text")
    return neardup.similar_groups(chunks, "record_id", "chunk_text", words=3, threshold=0.6, least_words=20)


def p7_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different near-duplicate texts, by the first record of each."""
    chunks = latest_records(read_table(spark, sf_dir, "chunks"), "chunk_text")
    return neardup.representative_pairs(chunks, "record_id", "chunk_text", words=3, threshold=0.6, least_words=20)[0]


def p7_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record with the same shingles, of every record that takes part."""
    chunks = latest_records(read_table(spark, sf_dir, "chunks"), "chunk_text")
    return neardup.representative_pairs(chunks, "record_id", "chunk_text", words=3, threshold=0.6, least_words=20)[1]


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's place in the containers of every capacity."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    capacities = [(r["pack_name"], r["capacity_tokens"]) for r in read_table(spark, sf_dir, "pack_sizes").orderBy("capacity_tokens").collect()]
    return packing.pack_all(tokens.with_token_counts(documents), "doc_id", "n_tokens", capacities)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and unused share of every capacity."""
    return packing.fill_report(p8_containers(spark, sf_dir))


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = read_table(spark, sf_dir, "mix_targets")
    documents = mixing.distinct_texts(read_table(spark, sf_dir, "documents"), "doc_id", "text", "source", targets)
    return mixing.mix(tokens.with_token_counts(documents), targets)


def p9_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts taken of every target source and how many times."""
    return _mixture(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of every target source."""
    return _mixture(spark, sf_dir)[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the documents whose label is missing or wrong or that mix languages."""
    rows = languages.detect(read_table(spark, sf_dir, "documents"))
    case = F.col("label").isNull() | (F.col("label") != F.col("main_lang")) | (F.col("n_segments") > 1)
    return rows.where(case).select("doc_id", "segment_no", "lang")


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every segment of every document."""
    return languages.detect(read_table(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (p3_found, p3_neighbours, p3_search, p4_found, p4_forms, p5_found, p5_pieces, p6_found, p6_entities, p7_found, p7_groups, p7_pairs, p7_members, p8_containers, p8_fill, p9_selection, p9_shares, p10_found, p10_segments)}
_TEXTS = "(SELECT record_id, max(chunk_text) AS t FROM chunks WHERE record_id IS NOT NULL GROUP BY 1)"
_WORDS = f"(SELECT record_id, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') AS w FROM {_TEXTS})"
_SHINGLES = f"(SELECT DISTINCT record_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM {_WORDS} WHERE len(w) >= 20)"

SQL = {
    "p3_found": """
        WITH v AS (SELECT faiss_id AS id, CAST(embedding AS DOUBLE[64]) AS e FROM index_vectors WHERE len(embedding) = 64 AND list_sum(list_transform(embedding, lambda x: x * x)) > 0),
        s AS (SELECT a.id AS a, b.id AS b, round(array_cosine_similarity(a.e, b.e), 9) AS c FROM v a JOIN v b ON a.id <> b.id),
        r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS k FROM s WHERE c > 0.85)
        SELECT DISTINCT least(a, b) AS faiss_id_a, greatest(a, b) AS faiss_id_b FROM r WHERE k <= 5 AND c >= 0.9
    """,
    "p5_found": """
        SELECT DISTINCT record_id, field_name FROM (
          SELECT record_id, 'chunk_text' AS field_name, chunk_text AS t FROM chunks
          UNION ALL SELECT record_id, 'retrieval_text', retrieval_text FROM chunks)
        WHERE length(t) > 2000 AND record_id IS NOT NULL
    """,
    "p7_found": f"""
        WITH s AS {_SHINGLES}, n AS (SELECT record_id, count(*) AS n FROM s GROUP BY 1),
        b AS (SELECT x.record_id AS a, y.record_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.record_id < y.record_id GROUP BY 1, 2)
        SELECT a AS record_id_a, b AS record_id_b FROM b JOIN n na ON na.record_id = a JOIN n nb ON nb.record_id = b WHERE c >= 0.6 * (na.n + nb.n - c) - 1e-9
    """,
}
_SETS = f"(SELECT record_id, min(record_id) OVER (PARTITION BY shingles) AS head FROM (SELECT record_id, array_to_string(list_sort(list(s)), '|') AS shingles FROM {_SHINGLES} GROUP BY 1))"
SQL |= {
    "p7_members": f"SELECT record_id, head FROM {_SETS}",
    "p7_pairs": f"SELECT record_id_a, record_id_b FROM ({SQL['p7_found']}) JOIN {_SETS} a ON a.record_id = record_id_a JOIN {_SETS} b ON b.record_id = record_id_b WHERE a.head = record_id_a AND b.head = record_id_b",
    "p7_groups": f"""WITH RECURSIVE p AS MATERIALIZED (SELECT record_id_a AS a, record_id_b AS b FROM ({SQL['p7_found']})), e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
        r(node, seen) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen)
        SELECT g.record_id, group_id, n_links FROM (SELECT node AS record_id, min(seen) AS group_id FROM r GROUP BY 1) g JOIN (SELECT a AS record_id, CAST(count(*) AS BIGINT) AS n_links FROM e GROUP BY 1) n USING (record_id)""",
}
