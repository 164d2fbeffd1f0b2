"""Nested JSON fields to related flat tables.

The fields are parsed once into VARIANT; nested `transform` calls attach the
keys and positions of all ancestors, `flatten` joins the arrays and a single
`inline` per target table emits its rows. No Python, no shuffle beyond the one
that counts each record once.

Shapes that several writers give are brought to one form first:

* a field is readable if the whole of it is one JSON value; a JSON string that
  holds JSON again is opened once more; anything else yields nothing,
* a list may be wrapped in an object (`tables`, `resolved_entities`),
* an object where a list is expected is a list of one; null is an empty list,
* rows may stand in `rows` or in the `rows` of `row_groups`,
* a row is an object of cells or a bare list named by `columns`; values beyond
  the columns are named by their position.

Null, blank and unreadable fields, empty lists and tables without rows give no
rows. Repeated rows and cells are all kept, each under its own position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Members that hold the list when a field wraps it in an object.
WRAPPERS = {"tables_json": "tables", "resolved_entities_json": "resolved_entities", "entities_json": "entities"}

_V = "array<variant>"
_O = "map<string,variant>"


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _whole(text: Column) -> Column:
    """The one JSON value that `text` holds, or null. Brackets rule out text after the value."""
    boxed = _get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", _V)
    return F.when(F.size(boxed) == 1, F.get(boxed, F.lit(0)))


def items(v: Column) -> Column:
    """A list of variants: the list itself, a list of one for any other value, empty for null."""
    one = F.when(v.isNull() | F.is_variant_null(v), F.array().cast(_V)).otherwise(F.array(v))
    return F.coalesce(_get(v, "$", _V), one)


def parse_field(field: Column, wrapper: str) -> Column:
    """array<variant> of the entries of a field, null where the field isn't readable."""
    outer = _whole(field)
    inner = _get(outer, "$", "string")
    is_text = F.schema_of_variant(outer) == "STRING"
    value = F.when(is_text, _whole(inner)).otherwise(outer)
    wrapped = F.map_contains_key(F.coalesce(_get(value, "$", _O), F.create_map().cast(_O)), wrapper)
    return F.when(value.isNotNull(), F.when(wrapped, items(_get(value, f"$.{wrapper}", "variant"))).otherwise(items(value)))


def with_parsed(chunks: DataFrame, *fields: str, keep: list[str] | None = None) -> DataFrame:
    """record_id, document_id, the columns to keep and the parsed entries of each field as array<variant>."""
    return chunks.select(
        "document_id", "record_id", *(keep or []), *(parse_field(F.col(f), WRAPPERS[f]).alias(f) for f in fields)
    )


def _groups(table: Column) -> Column:
    """array<struct<label, row>> in written order, however the rows are grouped."""
    plain = F.transform(
        items(_get(table, "$.rows", "variant")), lambda r: F.struct(F.lit(None).cast("string").alias("label"), r.alias("row"))
    )
    grouped = F.flatten(
        F.transform(
            items(_get(table, "$.row_groups", "variant")),
            lambda g: F.transform(
                items(_get(g, "$.rows", "variant")),
                lambda r: F.struct(_get(g, "$.label", "string").alias("label"), r.alias("row")),
            ),
        )
    )
    return F.concat(plain, grouped)


def _cells(row: Column, columns: Column) -> Column:
    """array<struct<pos, name, value>> of one row."""
    by_name = F.transform(
        F.map_entries(_get(row, "$", _O)),
        lambda e, i: F.struct(i.alias("pos"), e["key"].alias("name"), e["value"].alias("value")),
    )
    by_position = F.transform(
        _get(row, "$", _V),
        lambda v, i: F.struct(i.alias("pos"), F.coalesce(F.get(columns, i), i.cast("string")).alias("name"), v.alias("value")),
    )
    return F.coalesce(by_position, by_name, F.array().cast("array<struct<pos:int,name:string,value:variant>>"))


def _value_text(v: Column) -> Column:
    """A cell's text: of an object its `raw` member, of a scalar the value as written."""
    return F.coalesce(_get(v, "$.raw", "string"), _get(v, "$", "string"))


def tables(parsed: DataFrame) -> DataFrame:
    """document_id, record_id, table_no and the table's own members."""
    rows = F.transform(
        F.col("tables_json"),
        lambda t, i: F.struct(
            F.col("document_id"),
            F.col("record_id"),
            i.cast("bigint").alias("table_no"),
            _get(t, "$.table_type", "string").alias("table_type"),
            _get(t, "$.units", "string").alias("units"),
            _get(t, "$.summary", "string").alias("summary"),
            F.size(items(_get(t, "$.columns", "variant"))).cast("bigint").alias("n_columns"),
            F.size(_groups(t)).cast("bigint").alias("n_rows"),
        ),
    )
    return parsed.select(F.inline(rows))


def rows(parsed: DataFrame) -> DataFrame:
    """document_id, record_id, table_no, row_no, group_label, n_cells."""
    out = F.flatten(
        F.transform(
            F.col("tables_json"),
            lambda t, i: F.transform(
                _groups(t),
                lambda r, j: F.struct(
                    F.col("document_id"),
                    F.col("record_id"),
                    i.cast("bigint").alias("table_no"),
                    j.cast("bigint").alias("row_no"),
                    r["label"].alias("group_label"),
                    F.size(_cells(r["row"], F.array().cast("array<string>"))).cast("bigint").alias("n_cells"),
                ),
            ),
        )
    )
    return parsed.select(F.inline(out))


def cells(parsed: DataFrame) -> DataFrame:
    """document_id, record_id, table_no, row_no, cell_name, cell_value, cell_unit.

    Objects don't say in which order their members were written, so a cell is
    known by its name, not by a number.
    """
    out = F.flatten(
        F.transform(
            F.col("tables_json"),
            lambda t, i: F.flatten(
                F.transform(
                    _groups(t),
                    lambda r, j: F.transform(
                        _cells(r["row"], _get(t, "$.columns", "array<string>")),
                        lambda c: F.struct(
                            F.col("document_id"),
                            F.col("record_id"),
                            i.cast("bigint").alias("table_no"),
                            j.cast("bigint").alias("row_no"),
                            c["name"].alias("cell_name"),
                            _value_text(c["value"]).alias("cell_value"),
                            _get(c["value"], "$.unit", "string").alias("cell_unit"),
                        ),
                    ),
                )
            ),
        )
    )
    return parsed.select(F.inline(out))


def entities(parsed: DataFrame) -> DataFrame:
    """document_id, record_id, entity_no, canonical_name, entity_type, matched_text, resolution_method, resolution_score."""
    out = F.transform(
        F.col("resolved_entities_json"),
        lambda e, i: F.struct(
            F.col("document_id"),
            F.col("record_id"),
            i.cast("bigint").alias("entity_no"),
            _get(e, "$.canonical_name", "string").alias("canonical_name"),
            _get(e, "$.entity_type", "string").alias("entity_type"),
            _get(e, "$.matched_text", "string").alias("matched_text"),
            _get(e, "$.resolution_method", "string").alias("resolution_method"),
            _get(e, "$.resolution_score", "bigint").alias("resolution_score"),
            _get(e, "$.mention_count", "bigint").alias("mention_count"),
        ),
    )
    return parsed.select(F.inline(out))


def evidence(parsed: DataFrame) -> DataFrame:
    """document_id, record_id, entity_no, evidence_no, variant, resolution_method, resolution_score."""
    out = F.flatten(
        F.transform(
            F.col("resolved_entities_json"),
            lambda e, i: F.transform(
                items(_get(e, "$.variant_evidence", "variant")),
                lambda v, j: F.struct(
                    F.col("document_id"),
                    F.col("record_id"),
                    i.cast("bigint").alias("entity_no"),
                    j.cast("bigint").alias("evidence_no"),
                    _get(v, "$.variant", "string").alias("variant"),
                    _get(v, "$.resolution_method", "string").alias("resolution_method"),
                    _get(v, "$.resolution_score", "bigint").alias("resolution_score"),
                ),
            ),
        )
    )
    return parsed.select(F.inline(out))


def leaves(parsed: DataFrame) -> DataFrame:
    """record_id, field_name, item_no, child_no, leaf_name: every cell and every variant.

    Both fields end in one array, so the record's text is parsed and exploded
    in a single pass.
    """

    def leaf(field: str, item: Column, child: Column, name: Column) -> Column:
        return F.struct(
            F.col("record_id"),
            F.lit(field).alias("field_name"),
            item.cast("bigint").alias("item_no"),
            child.cast("bigint").alias("child_no"),
            name.alias("leaf_name"),
        )

    def names(row: Column, columns: Column) -> Column:
        by_position = F.transform(_get(row, "$", _V), lambda v, i: F.coalesce(F.get(columns, i), i.cast("string")))
        return F.coalesce(by_position, F.map_keys(_get(row, "$", _O)), F.array().cast("array<string>"))

    of_tables = F.flatten(
        F.transform(
            F.col("tables_json"),
            lambda t, i: F.flatten(
                F.transform(
                    _groups(t),
                    lambda r, j: F.transform(
                        names(r["row"], _get(t, "$.columns", "array<string>")),
                        lambda n: leaf("tables_json", i, j, n),
                    ),
                )
            ),
        )
    )
    of_entities = F.flatten(
        F.transform(
            F.col("resolved_entities_json"),
            lambda e, i: F.transform(
                items(_get(e, "$.variant_evidence", "variant")),
                lambda v, j: leaf("resolved_entities_json", i, j, _get(v, "$.variant", "string")),
            ),
        )
    )
    empty = F.array().cast("array<struct<record_id:string,field_name:string,item_no:bigint,child_no:bigint,leaf_name:string>>")
    return parsed.select(F.inline(F.concat(F.coalesce(of_tables, empty), F.coalesce(of_entities, empty))))
