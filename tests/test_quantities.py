import numpy as np
import pytest

from rastro.functions.trees import Forest
from rastro.operators.quantities import convert_quantities, fit_units, scan

SCHEMA = "field_name string, source int, record_id bigint, text string"


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("pesa 2,5 kg", [("g", 2500)]), ("1.250 g", [("g", 1250)]), ("4.26 libras", [("g", 1932)]), ("0,631 kg", [("g", 631)]), ("2½ kg", [("g", 2500)]), ("2 1/4 L", [("ml", 2250)]), ("¾ l", [("ml", 750)]),
        ("1/2 kg", [("g", 500)]), ("medio litro", [("ml", 500)]), ("litro y medio", [("ml", 1500)]), ("un cuarto de kilo", [("g", 250)]), ("dos metros", [("mm", 2000)]), ("doscientos gramos", [("g", 200)]),
        ("1250 c.c.", [("ml", 1250)]), ("900 cm³", [("ml", 900)]), ("20 fl. oz", [("ml", 591)]), ("4,23 onzas líquidas", [("ml", 125)]), ('33"', [("mm", 838)]), ("40,5″", [("mm", 1029)]), ("20000 mgs", [("g", 20)]),
        ("60 cm/s, 3 L/min, 500 g/m², 29 kg/m³, 3 kg/cm², 2 ml/día", []), ("46 m²", []), ("38 °C, 6.000 mAh, 1800 W, 24 unidades, clase M2, talla L, cable tipo C5", []), ("170 m³/h", []),
        ("2 ml al día", []), ("", []), ("8 cm / Altura: 5 cm", [("mm", 80), ("mm", 50)]), ("18 ml", [("ml", 18)]),
    ],
)
def test_scan(text, wanted):
    _, numbers = scan(text)
    assert [(n.base, int(n.value * n.factor + 0.5)) for n in numbers if n.base] == wanted


TRAINING = [
    *[f"Medidas: {a} cm x {a + 7} cm" for a in range(5, 60)], *[f"Medidas: {a} mm x {a + 90} mm x {a + 30} mm" for a in range(5, 60)],
    *[f"Capacidad: {n} unidades de {v} ml; Peso neto pack de {n} de {v} g" for n in (2, 3, 4, 6) for v in range(100, 900, 40)],
    *[f"Peso: de {a} a {a + 3} kg y admite hasta entre {a} y {a + 9} litros, Grosor entre {a} y {a + 2} cm" for a in range(1, 50)],
]


@pytest.fixture(scope="module")
def forest(spark):
    return fit_units(spark.createDataFrame([(f"f{i % 3}", 0, i, t) for i, t in enumerate(TRAINING)], SCHEMA))


def found(spark, forest, *texts):
    rows = convert_quantities(spark.createDataFrame([("f", 0, i, t) for i, t in enumerate(texts)], SCHEMA), forest=forest).filter("status <> 'review'").collect()
    return {(r.record_id, r.dimension, r.value) for r in rows}


def test_shared_units(spark, forest):
    got = found(spark, forest, "Medidas: 20 x 30 x 40 cm", "Capacidad: 4 x 250 ml", "Peso: 2-3 kg", "Tamaño 78l. x 40an. x 16al. milímetros", "Capacidad: pack de 6 de 330 ml", "Depósito de 12x11 lt", "30x45x12cm")
    assert got == {
        (0, "length", 200), (0, "length", 300), (0, "length", 400), (1, "volume", 250), (2, "mass", 2000), (2, "mass", 3000), (3, "length", 78), (3, "length", 40), (3, "length", 16),
        (4, "volume", 330), (5, "volume", 11000), (6, "length", 300), (6, "length", 450), (6, "length", 120),
    }


def test_held_out_accuracy(spark, forest):
    wanted, texts = set(), []
    for i, a in enumerate(range(61, 161)):
        texts.append(f"Medidas: {a} x {a + 1} cm" if i % 2 else f"Capacidad: 3 x {a} ml")
        wanted |= {(i, "length", a * 10), (i, "length", a * 10 + 10)} if i % 2 else {(i, "volume", a)}
    got = found(spark, forest, *texts)
    assert len(got & wanted) / len(wanted) > 0.97 and len(got - wanted) <= 2


def test_edges(spark, forest):
    assert found(spark, forest, None, "", "   ", "sin datos") == set()
    assert found(spark, forest, "x" * 300_000 + " 5 kg", "5 kg, 5 kg y 5000 g") == {(0, "mass", 5000), (1, "mass", 5000)}
    assert convert_quantities(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([("f", 0, 1, "5 kg", 1.0, "a")], SCHEMA + ", value double, status string")
    assert [r.value for r in convert_quantities(clash, forest=forest).collect()] == [5000]


def test_forest_is_calibrated():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = (rng.random(4000) < np.where(x[:, 0] > 0.5, 0.8, 0.1)).astype(float)
    f = Forest().fit(x[:3000], y[:3000])
    top, sure, _ = f.predict(x[3000:])
    p = np.where(top == 1, sure, 1 - sure)
    assert abs(p.mean() - y[3000:].mean()) < 0.05
    assert abs(p[x[3000:, 0] > 0.55].mean() - 0.8) < 0.07 and abs(p[x[3000:, 0] < 0.45].mean() - 0.1) < 0.07


def test_forest_without_classes():
    assert [v.tolist() for v in Forest().fit(np.empty((0, 2)), np.empty(0, int)).predict(np.zeros((2, 2)))[:2]] == [[-1, -1], [0, 0]]
    assert [v.tolist() for v in Forest().fit(np.zeros((5, 2)), np.ones(5, int)).predict(np.zeros((2, 2)))[:2]] == [[1, 1], [1, 1]]


def test_texts_without_labelled_numbers(spark):
    few = spark.createDataFrame([("f", 0, 1, "sin datos"), ("f", 0, 2, "nada"), ("f", 0, 3, "Peso: 480")], SCHEMA)
    assert [(r.record_id, r.dimension, r.value, r.status) for r in convert_quantities(few).collect()] == [(3, None, None, "review")]


def test_every_field_is_learnt_from(spark):
    texts = [(f"field{i % 5}", 0, i, f"Peso neto: {100 + 7 * i} g. Mide {i + 2} cm x {i + 9} cm. Nivel {i % 6} unidades") for i in range(400)]
    df = spark.createDataFrame(texts, SCHEMA)
    assert fit_units(df, sample_texts=40).nodes and fit_units(df, sample_rows=50).nodes


def test_missing_units_by_name(spark):
    """Labels that always go with one unit and size: held-out numbers without a unit are converted; unclear ones are reviewed."""
    rng = np.random.default_rng(3)
    texts = [f"Peso: {rng.integers(300, 900)} g\nAltura: {rng.integers(10, 60)} cm\nTalla {rng.integers(1, 9)} niveles\nTamaño {rng.integers(10, 60)} {'cm' if i % 2 else 'g'}" for i in range(400)]
    forest = fit_units(spark.createDataFrame([("f", 0, i, t) for i, t in enumerate(texts)], SCHEMA))
    asked = spark.createDataFrame([("f", 0, i, f"Peso: {400 + i}\nAltura: {20 + i % 30}\nTamaño {20 + i % 30}") for i in range(100)], SCHEMA)
    rows = convert_quantities(asked, forest=forest).collect()
    sure = [r for r in rows if r.status == "predicted"]
    wanted = {(i, "mass", 400 + i) for i in range(100)} | {(i, "length", 10 * (20 + i % 30)) for i in range(100)}
    right = [r for r in sure if (r.record_id, r.dimension, r.value) in wanted]
    assert len(right) / len(sure) > 0.9 and len(right) > 150
    assert sum(r.status == "review" for r in rows) > 50
