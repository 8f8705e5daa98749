from datetime import date

from rastro.operators.wide_table import statements, wide_table
from rastro.plans.problems import LABELS

ROWS = "asin string, label_raw string, value_raw string"
COLS = "column_name string, data_type string, unit string, label_es string"
COLUMNS = [("peso_g", "bigint", "g", "Peso del producto"), ("capacidad_ml", "bigint", "ml", "Capacidad"), ("numero_piezas", "bigint", None, "Número de piezas"), ("numero_pieza", "string", None, "Número de pieza"), ("apto_lavavajillas", "boolean", None, "Apto para lavavajillas"), ("fecha_disponible", "date", None, "Disponible desde")]


def wide(spark, rows):
    out = wide_table(spark.createDataFrame(rows, ROWS), spark.createDataFrame(COLUMNS, COLS), labels=LABELS).collect()
    assert len({r.asin for r in out}) == len(out)
    return {r.asin: r.asDict() for r in out}


def test_conversion_and_agreement(spark):
    rows = [
        ("a1", "Peso", "2,268 kg"), (" A1 ", "Item Weight", "5 lb"), ("A1", "Pe​so neto :", "‎aprox. 2.268 g."), ("A1", "Peso del paquete", "9 kg"),
        ("A2", "Peso", "1 kg"), ("A2", "Peso", "1.001 g"),  # contradicted
        ("A3", "Peso", "N/D"), ("A3", "Peso", "3,5 kilos"), ("A3", "Peso del producto (g)", "3500"), ("A4", "Peso", "350"), ("A4", "Peso", ""), ("A4", None, "1 kg"), ("A4", "Peso", None),
        ("A5", "¿Apto para lavavajillas?", "No apto"), ("A5", "Nº de piezas", "Juego de 4"), ("A5", "piezas", "cuatro"), ("A5", "Nº de pieza", "4711"), ("A5", "Capacidad (l)", "1,5"), ("A5", "capacidad", "1.500 ml"),
        ("A6", "Disponible desde", "44293"), ("A6", "Date First Available", "7 abril 2021"), ("A7", "Disponible desde", "03/02/2024"), ("A8", "Disponible desde", "31 febrero 2024"), ("A9", "Disponible desde", "September 19, 2020"),
        (None, "Peso", "1 kg"), ("", "Peso", "1 kg"), ("  ", "Peso", "1 kg"),
    ]
    got = wide(spark, rows + rows)
    assert got["A1"]["peso_g"] == 2268
    assert "A2" not in got and "A4" not in got and "A8" not in got
    assert got["A3"]["peso_g"] == 3500
    assert (got["A5"]["apto_lavavajillas"], got["A5"]["numero_piezas"], got["A5"]["numero_pieza"], got["A5"]["capacidad_ml"]) == (False, 4, "4711", 1500)
    assert (got["A6"]["fecha_disponible"], got["A7"]["fecha_disponible"], got["A9"]["fecha_disponible"]) == (date(2021, 4, 7), date(2024, 2, 3), date(2020, 9, 19))
    assert set(got) == {"A1", "A3", "A5", "A6", "A7", "A9"}


def test_empty_tables(spark):
    assert wide(spark, []) == {}
    assert wide_table(spark.createDataFrame([("A", "Peso", "1 kg")], ROWS), spark.createDataFrame([], COLS)).collect() == []


def test_long_values_and_clashing_columns(spark):
    rows = spark.createDataFrame([("A", "Peso", "1 kg" + " " * 100_000, 1, "x"), ("A", "Peso" * 30_000, "1 kg", 1, "x"), ("B", "Peso", "9" * 5000 + " kg", 2, "y")], ROWS + ", number int, entity string")
    out = wide_table(rows, spark.createDataFrame(COLUMNS, COLS), labels=LABELS).collect()
    assert [(r.asin, r.peso_g) for r in out if r.asin == "A"] == [("A", 1000)]


def test_many_entities_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = wide(spark, [(f"E{i:04}", label, value) for i in range(300) for label, value in (("Peso", f"{i + 1} g"), ("Capacidad", f"{i + 1} ml"), ("piezas", "2"))])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 300 and all(v["peso_g"] == v["capacidad_ml"] == int(k[1:]) + 1 for k, v in got.items())


def test_unreadable_statements_are_null(spark):
    rows = statements(spark.createDataFrame([("A", "Peso", "pesado")], ROWS), spark.createDataFrame(COLUMNS, COLS), labels=LABELS).collect()
    assert [(r.number, r.text) for r in rows] == [(None, None)]


def test_labels_are_given(spark):
    """Without more labels only the one usual label of each column is known."""
    rows = spark.createDataFrame([("A", COLUMNS[0][3], "1 kg"), ("B", "Greek weight", "2 kg")], ROWS)
    columns = spark.createDataFrame(COLUMNS, COLS)
    assert {r.entity for r in statements(rows, columns).collect()} == {"A"}
    assert {r.entity for r in statements(rows, columns, labels={COLUMNS[0][0]: ["Greek weight"]}).collect()} == {"A", "B"}
