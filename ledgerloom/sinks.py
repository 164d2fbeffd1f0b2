"""Sinks: JSON lines, Parquet flat and nested, caches, logs, reports."""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls written, NaN as null."""
    plain = df.select(*(F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema))
    plain.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_nested_as_json(df: DataFrame, path: str) -> None:
    """Parquet in which nested columns are JSON texts."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    df.select(*(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema)).write.mode("overwrite").parquet(path)


def write_parquet(df: DataFrame, path: str, *partitions: str) -> None:
    """Parquet, by partition columns where given."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def text_files(folder: str, name: str, text: str) -> Callable[[Iterator[Row]], None]:
    """For foreachPartition: each row's text as a file of its own, named after the row, in a folder that all executors reach."""

    def write(rows: Iterator[Row]) -> None:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for row in rows:
            with system.open_output_stream(f"{root}/{row[name]}.txt") as out:
                out.write(row[text].encode())

    return write


def append_log(df: DataFrame, path: str) -> None:
    """Rows appended to a log of CSV parts with headers."""
    df.write.mode("append").option("header", True).csv(path)


_AS_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for a sample that a person reads; quotes doubled, line ends kept."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).options(**_AS_IS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `write_csv` wrote."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("lineSep", "\n").options(**_AS_IS).schema(schema).csv(path)


def write_index(vectors: DataFrame, metadata: DataFrame, path: str) -> None:
    """An index: vectors and their records' metadata, each a Parquet table under `path`."""
    vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    metadata.write.mode("overwrite").parquet(f"{path}/metadata")


def merge_cache(cache: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The cache with the new entries; of one key, the new entry holds."""
    return new.dropDuplicates([key]).unionByName(cache.join(new.select(key), key, "left_anti"))


def escaped(text: Column) -> Column:
    """HTML-safe text; null as empty."""
    out = F.coalesce(text, F.lit(""))
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(plain), F.lit(safe))
    return out


def card(counts: list[tuple[Column, str]] | None = None) -> Column:
    """A record's card: heading, document, category, counts where given, the start of the text."""
    items = [F.concat(F.lit("<li>"), n.cast("string"), F.lit(f" {what}</li>")) for n, what in counts or []]
    listed = F.concat(F.lit("<ul>"), *items, F.lit("</ul>")) if items else F.lit("")
    head = (F.lit("<section><h2>"), escaped(F.col("heading")), F.lit("</h2><p>"), escaped(F.col("document_id")), F.lit(" · "), escaped(F.col("section_category")), F.lit("</p>"))
    return F.concat(*head, listed, F.lit("<pre>"), escaped(F.left("chunk_text", F.lit(400))), F.lit("</pre></section>"))


def cards_html(records: DataFrame, title: str, most: int = 500) -> str:
    """A page of the first `most` records by id."""
    cards = "\n".join(r["card"] for r in records.orderBy("record_id").limit(most).select("record_id", card().alias("card")).orderBy("record_id").collect())
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title>\n{cards}\n"


def markdown_report(title: str, tables: dict[str, DataFrame], most: int = 500) -> str:
    """A report of aggregates, one table each of at most `most` rows."""
    parts = [f"# {title}"]
    for name, df in tables.items():
        rows = df.limit(most).collect()
        head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
        parts.append(f"## {name}\n\n{head}\n" + "\n".join("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows))
    return "\n\n".join(parts) + "\n"
