import json

import pytest

from rastro.operators.capacities import capacity_proof, json_after


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("Capacidad total de 3 litros: 4 botes de 500 ml y 2 vasos de 500 ml", ("PROVEN", 3000, 3000)), ("Capacidad total: 2 L, 3 x 500 ml", ("CONFLICT", 2000, 1500)), ("dos botellas de 1 l, en total 2 l", ("PROVEN", 2000, 2000)),
        ("Capacidad total de 2 l", ("UNPROVEN", 2000, None)), ("4 botes de 500 ml", ("UNPROVEN", None, 2000)), ("Capacidad total de 2 l; no incluye 2 vasos de 1 l", ("UNPROVEN", 2000, None)), ("", ("UNPROVEN", None, None)), (None, ("UNPROVEN", None, None)),
    ],
)
def test_capacity_proof(text, wanted):
    assert capacity_proof(text) == wanted


def test_denials_reach_back_to_the_start_of_the_clause():
    far = "no incluye " + "los accesorios de la imagen, ni tampoco " * 4
    assert capacity_proof(f"Capacidad total de 2 l; {far}2 vasos de 1 l") == ("UNPROVEN", 2000, None)
    assert capacity_proof(f"{far}capacidad total de 2 l. 2 vasos de 1 l") == ("UNPROVEN", None, 2000)
    assert capacity_proof(f"{far}nada. Capacidad total de 2 l, 2 vasos de 1 l") == ("PROVEN", 2000, 2000)


def test_json_after():
    value = {"a": [1, {"b": "}\"]"}], "c": None}
    assert json.loads(json_after(f"x {{}} data = {json.dumps(value)}; }}", "data =")) == value
    assert json_after("data = {", "data =") is None and json_after("nothing", "data =") is None and json_after(None, "x") is None
