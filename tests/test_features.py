import datetime as dt

import pytest
from pyspark.sql import functions as F

from mostrador.operators import features
from mostrador.operators.lookup import lookup_by_key
from mostrador.plans.flows import one_pass, two_pass


def test_unit_price_without_units_is_missing(frame):
    df = frame([(1000.0, 0), (500.0, 5), (1000.0, 2)], "MONTO_APLICADO double, UNIDADES bigint")
    got = {(r[0], r[1]): r[2] for r in features.add_unit_price(df).collect()}
    assert got == {(1000.0, 0): None, (500.0, 5): 100.0, (1000.0, 2): 500.0}
    assert tuple(features.unit_price_quality(df).first()) == (1, 300.0, 300.0)


@pytest.mark.parametrize(
    "born,sold,age",
    [
        ((1996, 1, 1), (2026, 1, 1), 30.0),
        ((2027, 1, 1), (2026, 1, 1), None),
        ((1900, 1, 1), (2026, 1, 1), None),
        ((1996, 12, 25), (2026, 6, 15), 29.0),
        ((1996, 1, 1), (2026, 6, 15), 30.0),
        ((1700, 1, 1), (2026, 6, 15), None),
        ((2000, 2, 29), (2023, 2, 28), 22.0),
        ((2000, 2, 29), (2023, 3, 1), 23.0),
        (None, (2023, 3, 1), None),
    ],
)
def test_age(spark, born, sold, age):
    row = (dt.datetime(*sold), dt.date(*born) if born else None)
    df = spark.createDataFrame([row], "FECHA timestamp_ntz, FECHA_NACIMIENTO date")
    assert features.add_age(df).first()["EDAD"] == age


def _purchases(frame):
    rows = [("C1", 100), ("C1", 100), ("C1", 101), ("C2", 200), (None, 300), ("C3", None)]
    return frame(rows, "CODIGO_CLIENTE string, BOLETA bigint")


def test_frequency_counts_distinct_receipts(frame):
    df = _purchases(frame)
    table = {r[0]: r[1] for r in features.purchase_frequency(df).collect()}
    assert table == {"C1": 2, "C2": 1, "C3": 0}
    assert tuple(features.purchase_frequency_summary(df).first()) == (3, 1.0, 2)
    joined = features.add_frequency(df).groupBy("CODIGO_CLIENTE", "FRECUENCIA_COMPRA").count().collect()
    assert {tuple(r) for r in joined} == {("C1", 2, 3), ("C2", 1, 1), (None, None, 1), ("C3", 0, 1)}


@pytest.mark.parametrize("broadcast_bytes", [150, 1 << 24])
def test_lookup_is_the_same_with_hot_keys_apart(spark, broadcast_bytes):
    """One key holds half of the rows, a quarter has no key, some keys are unknown."""
    rows = spark.sql(
        "SELECT id, CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 4 = 1 THEN NULL ELSE concat('k', id % 40) END AS k "
        "FROM range(4000)"
    )
    table = spark.sql(
        "SELECT k, n AS v, n AS w FROM VALUES ('hot', 2000L), ('k3', 100L), ('k7', 100L), ('k11', 100L) AS t(k, n)"
    )
    got = {r["id"]: r["v"] for r in lookup_by_key(rows, table, "k", "v", "w", broadcast_bytes).collect()}
    assert len(got) == 4000
    for i, v in got.items():
        want = 2000 if i % 2 == 0 else None
        if i % 4 == 3 and i % 40 in (3, 7, 11):
            want = 100
        assert v == want, i


def test_lookup_bound_counts_bytes_of_keys(spark):
    """The same number of keys is broadcast or not by how long they are."""
    rows = spark.sql("SELECT id, cast(id % 50 as string) AS k FROM range(200)")

    def shuffled(length: int) -> bool:
        table = spark.sql(f"SELECT lpad(cast(id as string), {length}, 'x') AS k, id AS v, 4L AS w FROM range(50)")
        plan = lookup_by_key(rows, table, "k", "v", "w", 8_000)._jdf.queryExecution().optimizedPlan().toString()
        return "Union" in plan

    assert not shuffled(10) and shuffled(500)


def test_identical_rows_of_a_hot_key_stay_spread(spark):
    """A million rows alike in every column, whose key is hot, stay in all tasks; each is found once."""
    rows = spark.range(0, 1_000_000, 1, 8).select(F.when(F.col("id") >= 0, "hot").alias("k"), F.lit(1).alias("x"))
    table = spark.sql("SELECT * FROM VALUES ('hot', 7L, 1000000L) AS t(k, v, w) UNION ALL SELECT concat('k', id), id, 1L FROM range(500)")
    found = lookup_by_key(rows, table, "k", "v", "w", 10_000)
    assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()
    tasks = found.groupBy(F.spark_partition_id()).agg(F.count("*"), F.min("v"), F.max("v")).collect()
    assert sorted(tuple(r)[1:] for r in tasks) == [(125_000, 7, 7)] * 8


def test_standardize(frame):
    df = frame([(float(v), 5, 1) for v in (10, 20, 30, 40, 50)], "MONTO_APLICADO double, UNIDADES bigint, X int")
    scaled, scales = features.standardize(df)
    values = [r["MONTO_APLICADO_STD"] for r in scaled.collect()]
    assert sum(values) == pytest.approx(0)
    assert sum(v * v for v in values) / 4 == pytest.approx(1)
    assert scales["MONTO_APLICADO"].mean == 30.0
    assert scales["UNIDADES"] == (5.0, 0.0)
    assert "UNIDADES_STD" not in scaled.columns
    assert set(scales) == {"MONTO_APLICADO", "UNIDADES"}


def test_frequency_can_be_left_out(processed):
    assert "FRECUENCIA_COMPRA" not in features.engineer_features(processed, False).columns
    done = features.engineer_features(processed)
    assert {"MONTO_POR_UNIDAD", "EDAD", "FRECUENCIA_COMPRA", "MONTO_APLICADO_STD"} <= set(done.columns)
    assert done.count() == 28


def test_no_customer_at_all_gives_no_frequency_column(frame):
    df = frame([(None, 1)], "CODIGO_CLIENTE string, BOLETA bigint")
    assert features.fit_features(df).frequency is None


def test_both_flows_differ_only_in_the_imputed_scale(processed):
    some = processed.selectExpr(
        "* EXCEPT (PORCENTAJE_DESCUENTO)", "CASE WHEN SKU % 4 <> 0 THEN SKU / 10000 END AS PORCENTAJE_DESCUENTO"
    )
    one = one_pass(some, False).drop("PORCENTAJE_DESCUENTO_STD")
    two = two_pass(some, False).drop("PORCENTAJE_DESCUENTO_STD")
    assert one.columns == two.columns
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
