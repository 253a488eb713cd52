import datetime as dt
import statistics

import pytest
from conftest import PROCESSED_SCHEMA, processed_rows

from mostrador.errors import FilterError
from mostrador.operators.filters import apply_filters, filter_predicate
from mostrador.operators.summary import summary

PERSON = "0F1E2D3C-4B5A-4978-8695-000000000011"
ROWS = [dict(zip([c.split(" ")[0] for c in PROCESSED_SCHEMA.split(", ")], row)) for row in processed_rows()]

# Filters, and the same condition in Python.
CASES = [
    ([], lambda r: True),
    ([("LOCAL", "62")], lambda r: r["LOCAL"] == 62),
    ([("CANAL", "cct"), ("LOCAL", "61")], lambda r: r["CANAL"] == "CCT" and r["LOCAL"] == 61),
    ([("GENERO", "Masculino")], lambda r: r["GENERO"] == 1),
    ([("GENERO", "No especificado")], lambda r: r["GENERO"] == 0),
    (
        [("FECHA_DESDE", "2023-02-25"), ("FECHA_HASTA", "2023-03-04")],
        lambda r: dt.datetime(2023, 2, 25) <= r["FECHA"] <= dt.datetime(2023, 3, 4),
    ),
    ([("ID_PERSONA", PERSON)], lambda r: r["CODIGO_CLIENTE"] == PERSON.lower()),
    ([("GENERO", "Femenino"), ("EDAD", "90"), ("CANAL", "WEB")], lambda r: False),
]


@pytest.mark.parametrize("filters,condition", CASES)
def test_seven_statistics(processed, filters, condition):
    values = [r["MONTO_APLICADO"] for r in ROWS if condition(r)]
    row = summary(processed, filters).first()
    assert tuple(row.asDict()) == (
        "suma", "conteo", "promedio", "minimo", "maximo", "mediana", "desviacion_estandar",
    )
    want = (0,) * 7
    if values:
        sd = statistics.stdev(values) if len(values) > 1 else 0
        want = (sum(values), len(values), statistics.mean(values), min(values), max(values), statistics.median(values), sd)
    assert tuple(row) == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize(
    "values",
    [
        [1e12 + i % 7 for i in range(700)],
        [123456789 + i % 3 / 100 for i in range(999)],
        [1e9 + i % 2 for i in range(1000)],
        [-4e15 + i for i in range(50)] + [4e15],
    ],
)
def test_deviation_far_from_zero(frame, values):
    row = summary(frame([(float(v),) for v in values], "MONTO_APLICADO double")).first()
    assert row["desviacion_estandar"] == pytest.approx(statistics.stdev(map(float, values)), rel=1e-6)


def test_null_measure_is_not_counted(frame):
    row = summary(frame([(1.0,), (None,), (3.0,)], "MONTO_APLICADO double")).first()
    assert (row["conteo"], row["suma"], row["mediana"]) == (2, 4.0, 2.0)


@pytest.mark.parametrize(
    "filters,count",
    [
        ([("GENERO", " Otro ")], 7),
        ([("EDAD", "+34")], 5),
        ([("CODIGO_PRODUCTO", "7_015")], 1),
        ([("codigo_producto ", "7015")], 1),
        ([("ID_PERSONA", "{0f1e2d3c4b5a49788695000000000011}")], 1),
        ([("ID_PERSONA", "urn:uuid:" + PERSON)], 1),
        ([("FECHA_HASTA", "2023-02-22")], 2),
        ([("LOCAL", "61"), ("LOCAL", "62")], 0),
        ([("LOCAL", "9" * 30)], 0),
    ],
)
def test_filters_select(processed, filters, count):
    assert apply_filters(processed, filters).count() == count


@pytest.mark.parametrize(
    "name,value,message",
    [
        ("GENERO", "otra cosa", "El valor 'otra cosa' no es un género válido."),
        ("EDAD", "treinta", "El valor 'treinta' no es un número entero válido para la edad."),
        ("EDAD", "5.0", "número entero"),
        ("CANAL", "FAX", "Los valores permitidos son: APP, APR, CCT, POS, WEB, WPR."),
        ("CODIGO_PRODUCTO", "siete", "el código de producto"),
        ("ID_PERSONA", "1234-56", "no es un UUID válido"),
        ("LOCAL", "x", "el ID de tienda"),
        ("FECHA_DESDE", "31-12-2023", "no es una fecha ISO-8601 válida para la fecha desde."),
        ("FECHA_HASTA", "2026-01-01T00:00:00+03:00", "fecha ISO-8601"),
        ("COLOR", "x", "El filtro 'COLOR' no es uno de los valores permitidos."),
    ],
)
def test_bad_filters_are_rejected_before_reading(spark, name, value, message):
    with pytest.raises(FilterError, match="(?s).*") as caught:
        filter_predicate([(name, value)])
    assert message in caught.value.detail
