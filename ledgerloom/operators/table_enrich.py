"""Enrichment of tables and contents lists by a model: who is asked, what for, and what becomes of the reply.

A provider is any callable from a payload to a reply; without one, everything
stays deterministic. Each distinct content is asked once (`enrich`), replies are
kept in a cache, and every call or hit gives a row of the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.enrich import enrich

# Price of a million tokens in and out.
PRICE_IN, PRICE_OUT = 0.40, 1.60


def call_cost(prompt_tokens: Column, completion_tokens: Column, price_in: float = PRICE_IN, price_out: float = PRICE_OUT) -> Column:
    """Cost of a call by its tokens; null for null."""
    return prompt_tokens / 1e6 * price_in + completion_tokens / 1e6 * price_out


def generic_columns(columns: Column) -> Column:
    """Whether all columns but 'Item' are placeholders, and there is one."""
    values = F.filter(columns, lambda c: c != "Item")
    return (F.size(values) > 0) & F.forall(values, lambda c: c.rlike(r"^Col\d+$"))


def unfenced(reply: Column) -> Column:
    """A reply without the code fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(reply), r"^```[a-z]*\n?", ""), r"`+$", ""))


def reply_keys(reply: Column) -> Column:
    """The valid item keys of a reply that is a JSON list, in upper case; none for any other reply."""
    keys = F.transform(F.from_json(unfenced(reply), "array<string>"), lambda k: F.upper(k))
    return F.coalesce(F.filter(keys, lambda k: k.rlike(r"^\d{1,2}[A-Z]?$")), F.array().cast("array<string>"))


def reply_columns(reply: Column, n: Column) -> Column:
    """struct<summary, columns> of a reply on a table of n columns; no columns unless there are n, placeholders for those unnamed."""
    read = F.from_json(unfenced(reply), "summary string, columns array<string>")
    named = F.transform(read["columns"], lambda c, i: F.when(c.isNull() | c.isin("", "null"), F.concat(F.lit("Col"), (i + 1).cast("string"))).otherwise(c))
    return F.struct(F.coalesce(read["summary"], F.lit("")).alias("summary"), F.when(F.size(read["columns"]) == n, named).alias("columns"))


def remapped_rows(rows: Column, old: Column, new: Column) -> Column:
    """array<map<string,string>> with the keys `old` called `new`, by position; unchanged where their numbers differ. Other keys stay."""

    def one(row: Column) -> Column:
        key = lambda k: F.coalesce(F.get(new, (F.array_position(old, k) - 1).cast("int")), k)
        renamed = F.transform(F.map_entries(row), lambda e: F.struct(F.when(F.array_contains(old, e["key"]), key(e["key"])).otherwise(e["key"]).alias("key"), e["value"].alias("value")))
        # Of two old names that come to one new one, the later holds.
        return F.aggregate(renamed, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_entries(F.array(e))))

    return F.when(F.size(old) == F.size(new), F.transform(rows, one)).otherwise(rows)


def apply_summaries(tables: DataFrame, cache: DataFrame, call: Callable[[str], str | None] | None = None, model: str = "offline", version: str = "1") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tables, cache, log): each table's summary, where it comes from, and columns recovered where they were placeholders.

    `tables` has record_id, table_no, heading, columns array<string>, rows
    array<map<string,string>>, raw_text and summary. A table with named columns
    is asked for a summary, the reply being the summary; one with placeholders
    for a JSON object of summary and columns, over its raw text. A failed or
    empty reply leaves the deterministic summary. Tables without columns aren't
    asked. Null members count as empty.
    """
    if call is None:
        plain = (F.lit(False).alias("summary_used_llm"), F.lit("deterministic").alias("summary_source"), F.lit("").alias("summary_cache_status"))
        return tables.select("*", *plain), cache, log_rows(tables.select(F.lit("").alias("status")).limit(0), model)
    generic = F.coalesce(generic_columns(F.col("columns")), F.lit(False))
    text = F.to_json(F.struct(generic.alias("infer"), F.coalesce("heading", F.lit("")).alias("heading"), "columns", F.when(generic, F.col("raw_text")).alias("raw_text"), F.when(~generic, F.col("rows")).alias("rows")))
    keyed = tables.withColumn("__key", F.concat_ws("\x1f", "record_id", "table_no"))
    asked = keyed.where(F.size("columns") > 0).select("__key", text.alias("payload"))
    replies, grown = enrich(asked, "__key", "payload", cache, call, model, version)
    j = keyed.join(replies, "__key", "left").withColumn("__generic", generic)
    read = F.when(F.col("__generic"), reply_columns(F.col("reply"), F.size("columns"))).otherwise(F.struct(F.col("reply").alias("summary"), F.lit(None).cast("array<string>").alias("columns")))
    j = j.withColumn("__r", read).withColumn("__used", F.coalesce(F.col("__r.summary") != "", F.lit(False)))
    source = F.when(~F.col("__used"), "deterministic").when(F.col("__generic"), "llm_inferred").otherwise("llm")
    new = F.when(F.col("__used"), F.col("__r.columns"))
    # Renamed before the select below, in which `columns` would mean the new ones.
    j = j.withColumn("__rows", F.when(new.isNotNull(), remapped_rows(F.col("rows"), F.col("columns"), new)).otherwise(F.col("rows")))
    out = j.select(
        *(c for c in tables.columns if c not in ("columns", "rows", "summary")), F.coalesce(new, F.col("columns")).alias("columns"),
        F.col("__rows").alias("rows"),
        F.when(F.col("__used"), F.col("__r.summary")).otherwise(F.col("summary")).alias("summary"),
        F.col("__used").alias("summary_used_llm"), source.alias("summary_source"), F.when(F.col("__used"), F.col("status")).otherwise("").alias("summary_cache_status"),
    )
    return out, grown, log_rows(replies, model)


def log_rows(replies: DataFrame, model: str) -> DataFrame:
    """A log row for each reply: a hit costs nothing, a failure is an error."""
    status = F.when(F.col("status") == "hit", "cache_hit").when(F.col("status") == "failed", "error").otherwise("ok")
    return replies.select(F.lit(model).alias("model"), status.alias("status"), F.when(status == "cache_hit", F.lit(0.0)).alias("estimated_cost_usd"))
