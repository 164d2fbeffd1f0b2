import json

from ledgerloom.operators import nested
from ledgerloom.sources import latest_records

TABLE = {"columns": ["Item", "2020"], "rows": [{"Item": "Sales", "2020": {"raw": "1", "unit": "USD m"}}, ["Costs", None, "x"]], "table_type": "financial"}
GROUPED = {"columns": ["A"], "row_groups": [{"label": "one", "rows": [{"A": ""}]}, {"label": "two", "rows": {"A": "z"}}]}
ENTITY = {"canonical_name": "Acme Inc.", "entity_type": "company", "variant_evidence": {"variant": "Acme"}}


def frame(spark, rows):
    return spark.createDataFrame(rows, "document_id string, record_id string, tables_json string, resolved_entities_json string")


def leaves(spark, rows):
    parsed = nested.with_parsed(frame(spark, rows), "tables_json", "resolved_entities_json")
    return sorted(map(tuple, nested.leaves(parsed).collect()))


def test_shapes_of_several_writers(spark):
    t = json.dumps([TABLE, GROUPED])
    want = [
        ("r", "resolved_entities_json", 0, 0, "Acme"),
        ("r", "tables_json", 0, 0, "2020"),
        ("r", "tables_json", 0, 0, "Item"),
        ("r", "tables_json", 0, 1, "2"),
        ("r", "tables_json", 0, 1, "2020"),
        ("r", "tables_json", 0, 1, "Item"),
        ("r", "tables_json", 1, 0, "A"),
        ("r", "tables_json", 1, 1, "A"),
    ]
    for tables in (t, json.dumps(t), json.dumps({"tables": [TABLE, GROUPED]})):
        for entities in (json.dumps([ENTITY]), json.dumps(ENTITY), json.dumps({"resolved_entities": [ENTITY]})):
            assert leaves(spark, [("d", "r", tables, entities)]) == want


def test_unreadable_null_and_empty_fields_give_nothing(spark):
    bad = ["", " ", "[", "[1] x", '[{"columns": ["A"], "rows": [["1"]]}', "null", "[]", "{}", '"text"', "[null]", "3"]
    assert leaves(spark, [("d", f"r{i}", b, b) for i, b in enumerate(bad)] + [("d", "n", None, None)]) == []


def test_flat_tables_keep_their_parents(spark):
    parsed = nested.with_parsed(frame(spark, [("d", "r", json.dumps([TABLE]), json.dumps([ENTITY]))]), "tables_json", "resolved_entities_json")
    assert nested.tables(parsed).collect()[0].asDict() == {"document_id": "d", "record_id": "r", "table_no": 0, "table_type": "financial", "units": None, "summary": None, "n_columns": 2, "n_rows": 2}
    assert [(r.row_no, r.n_cells) for r in nested.rows(parsed).collect()] == [(0, 2), (1, 3)]
    cells = {(r.row_no, r.cell_name): (r.cell_value, r.cell_unit) for r in nested.cells(parsed).collect()}
    assert cells == {(0, "Item"): ("Sales", None), (0, "2020"): ("1", "USD m"), (1, "Item"): ("Costs", None), (1, "2020"): (None, None), (1, "2"): ("x", None)}
    assert nested.entities(parsed).collect()[0].canonical_name == "Acme Inc."
    assert nested.evidence(parsed).collect()[0].variant == "Acme"


def test_records_count_once(spark):
    rows = [("r", 1, "a"), ("r", 2, "b"), ("s", None, "c"), (None, 1, "d")]
    df = spark.createDataFrame([(r, None if t is None else f"2024-01-0{t}", x) for r, t, x in rows], "record_id string, loaded_at string, x string")
    assert sorted(map(tuple, latest_records(df, "x").collect())) == [("r", "b"), ("s", "c")]
    assert latest_records(df.limit(0), "x").count() == 0
