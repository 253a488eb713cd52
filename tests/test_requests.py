import datetime as dt
import json
import uuid

import pytest

from mostrador import schema as S
from mostrador.errors import FilterError
from mostrador.operators import batch, requests
from mostrador.operators.filters import filter_predicate
from mostrador.operators.summary import summary


def _body(*pairs):
    return json.dumps({"consultas": [{"consulta": c, "valor": v} for c, v in pairs]})


SOUND = {
    "none": None,
    "object": "{}",
    "other": '{"otra": 1}',
    "store": _body(("local", "61")),
    "cct": _body(("CANAL", "cct"), ("LOCAL", "61")),
    "dates": _body(("FECHA_DESDE", "2023-02-21"), ("FECHA_DESDE", "2023-02-25"), ("FECHA_HASTA", "2023-03-04")),
    "person": _body(("ID_PERSONA", "{0F1E2D3C-4B5A-4978-8695-000000000011}")),
    "age": _body(("EDAD", "3_4")),
    "gender": _body(("GENERO", "Femenino")),
    "product": _body(("CODIGO_PRODUCTO", "7015")),
    "nothing": _body(("LOCAL", "4040")),
    "clash": _body(("LOCAL", "61"), ("LOCAL", "62")),
    "huge": _body(("LOCAL", "9" * 30)),
}
DEFECTIVE = {
    "list": '{"consultas": []}',
    "null": '{"consultas": null}',
    "text": '{"consultas": "x"}',
    "number": '{"consultas": [{"consulta": "EDAD", "valor": 34}]}',
    "half": '{"consultas": [{"consulta": "EDAD"}]}',
    "mixed": '{"consultas": [{"consulta": "EDAD", "valor": "34"}, {"consulta": "EDAD", "valor": 34}]}',
    "broken": '{"consultas": [',
    "array": "[1]",
    "name": _body(("COLOR", "x")),
    "age": _body(("CANAL", "POS"), ("EDAD", "34.0"), ("GENERO", "x")),
    "date": _body(("FECHA_DESDE", "31-12-2023")),
    "uuid": _body(("ID_PERSONA", "1234-56")),
}


def _validated(spark, bodies):
    table = spark.createDataFrame(list(bodies.items()), "request_id string, body string")
    return requests.validate_requests(requests.parse_requests(table))


def test_errors(spark):
    rows = requests.request_errors(_validated(spark, DEFECTIVE)).collect()
    found = {r["request_id"]: r["detail"] for r in rows}
    assert set(found) == set(DEFECTIVE)
    assert {r["error_code"] for r in rows} == {"VF"}
    assert found["list"] == found["null"]
    assert found["age"] == "El valor '34.0' no es un número entero válido para la edad."
    assert found["name"].startswith("El filtro 'COLOR' no es uno de los valores permitidos.")
    assert "JSON" in found["broken"]
    assert requests.request_errors(_validated(spark, SOUND)).isEmpty()


def test_batch_equals_one_by_one(spark, processed):
    got = {r["request_id"]: tuple(r)[1:] for r in batch.batch_summary(processed, _validated(spark, SOUND)).collect()}
    assert set(got) == set(SOUND)
    for name, body in SOUND.items():
        filters = [(f["consulta"], f["valor"]) for f in json.loads(body or "{}").get("consultas", [])]
        assert got[name] == pytest.approx(tuple(summary(processed, filters).first())), name


def test_only_defective_requests_give_no_answers(spark, processed):
    assert batch.batch_summary(processed, _validated(spark, DEFECTIVE)).isEmpty()


def test_requests_that_share_an_identifier_are_rejected(spark, processed):
    rows = [("a", _body(("LOCAL", "61"))), ("a", _body(("LOCAL", "62"))), ("b", None), (None, "{}")]
    table = spark.createDataFrame(rows, "request_id string, body string")
    validated = requests.validate_requests(requests.parse_requests(table))
    found = [(r["request_id"], r["detail"]) for r in requests.request_errors(validated).collect()]
    assert sorted(found, key=str) == [("a", S.MSG_REPEATED_REQUEST)] * 2 + [(None, S.MSG_MISSING_REQUEST_ID)]
    assert {r["request_id"] for r in batch.batch_summary(processed, validated).collect()} == {"b"}


INSTANTS = [
    "2023-02-25", "20230225", "2023-W08-6", "2023W086", "2023W08", "2023-W08", "2020-W53-1", "2023-W53-1", "2023-W00-1", "0001-W01-1",
    "9999-W52-6", "2023-02-25T10", "2023-02-25 10:30", "20230225T1030", "2023-W08-6x10:30:15", "2023W086T103015", "2023-W08-12",
    "2023-W08-1210", "2023W08T10:30", "2023-02-25T10,5", "2023-02-25T10:30.25", "2023-02-25T10:30:15,1234567", "2023-02-25T103015.5",
    "2023-02-25T10:30:15.", "2023-02-25T", "2023-02-25T24:00", "2023-02-25T10:60", "2023-02-25T10:3015", "2023-02-25T1", "2023-02-30",
    "0000-01-01", "2023-2-5", "25-02-2023", "2023-02-25é10:30", "2023-02-25-03:00", "\u06632023-02-25", "", "2023-02-25T10:30\n",
    "\u00a02023-02-25\u3000", "2024-02-29", "2023-02-29", "2023-056", "20230230", "2023-02-25|10:30", "9999-12-31T23:59:59.999999",
]
INTEGERS = [
    "34", "+34", "-34", "3_4", "\u0663\u0664", "\u096910", "\U0001d7d1\U0001d7d2", "3\u0664", " 34\u2003", "\u00a034", "_34", "34_",
    "3__4", "34.0", "", "+", "0x22", "9" * 30, "\u00b2", "\u2167", "0034", "+ 34", "34\n", "--34",
]
CUSTOMERS = [
    "0F1E2D3C-4B5A-4978-8695-000000000011", "{0f1e2d3c4b5a49788695000000000011}", "urn:uuid:0f1e2d3c-4b5a-4978-8695-000000000011",
    "uuid:0f1e2d3c4b5a4978-8695000000000011", "0f1e2d3c-4b5a-4978-8695-00000000001", "0f1e2d3c-4b5a-4978-8695-0000000000\u0661\u0661", "", "g" * 32,
]


def _by_python(name, text):
    """The value of a text by the standard library, None if it does not accept it; offsets are refused."""
    try:
        if name == "EDAD":
            return int(text.strip())
        if name == "ID_PERSONA":
            return str(uuid.UUID(text.strip()))
        at = dt.datetime.fromisoformat(text.strip())
        return None if at.tzinfo else at
    except ValueError:
        return None


@pytest.mark.parametrize("name,texts", [("FECHA_DESDE", INSTANTS), ("EDAD", INTEGERS), ("ID_PERSONA", CUSTOMERS)])
def test_both_forms_read_the_same_texts(spark, name, texts):
    """A table of requests and a single request accept what the standard library accepts, as the same value."""
    bodies = {str(k): _body((name, text)) for k, text in enumerate(texts)}
    validated = _validated(spark, bodies)
    refused = {r["request_id"]: r["detail"] for r in requests.request_errors(validated).collect()}
    bounds = {r["request_id"]: r for r in requests.request_bounds(validated).collect()}
    for k, text in enumerate(texts):
        want = _by_python(name, text)
        try:
            filter_predicate([(name, text)])
            alone = None
        except FilterError as exc:
            alone = exc.detail
        assert (want is None) == (alone is not None), repr(text)
        assert alone == refused.get(str(k)), repr(text)
        if want is None:
            continue
        row = bounds[str(k)]
        if name == "FECHA_DESDE":
            assert row["desde"] == want, repr(text)
        elif name == "EDAD" and abs(want) < 1 << 63:
            assert float(row[name]) == want, repr(text)
        elif name == "ID_PERSONA":
            assert row[name] == want, repr(text)


def test_single_filters_start_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("single", "single")
    try:
        filter_predicate([("FECHA_DESDE", "2023-W08-6"), ("EDAD", "34")])
        assert not tracker.getJobIdsForGroup("single")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_each_document_is_parsed_once(spark):
    table = spark.createDataFrame(list(SOUND.items()), "request_id string, body string")
    errors = requests.request_errors(requests.validate_requests(requests.parse_requests(table)))
    plan = errors._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") <= 2
