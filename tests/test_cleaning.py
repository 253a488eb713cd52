import pytest

from mostrador.operators import cleaning, quality
from mostrador.operators.missingness import mann_whitney, mcar_p_value, mcar_report, two_sided_p

AMOUNTS = [10.0, 11.0, 9.0, 10.0, 12.0, 11.0, 10.0, 1000.0]


def _amounts(frame, values=AMOUNTS):
    return frame([(v,) for v in values], "MONTO_APLICADO double")


def _flagged(df):
    return sorted(r["MONTO_APLICADO"] for r in df.collect() if r["MONTO_APLICADO_ES_OUTLIER"])


def test_missing_discounts_get_the_median(frame):
    df = frame([(0.1,), (0.2,), (None,), (0.4,), (None,)], "PORCENTAJE_DESCUENTO double")
    values = sorted(r[0] for r in cleaning.impute_median(df).collect())
    assert values == [0.1, 0.2, 0.2, 0.2, 0.4]
    assert [tuple(r) for r in quality.null_profile(df).collect()] == [("PORCENTAJE_DESCUENTO", 2)]


def test_all_missing_stays_missing_and_absent_column_is_skipped(frame):
    empty = frame([(None,), (None,)], "PORCENTAJE_DESCUENTO double")
    assert [r[0] for r in cleaning.impute_median(empty).collect()] == [None, None]
    other = frame([(1,)], "X int")
    assert cleaning.impute_median(other).columns == ["X"]
    assert cleaning.clean(other).columns == ["X"]


def test_interquartile_fences(frame):
    found = cleaning.fences(_amounts(frame)).first()
    assert (found["q1"], found["q3"], found["low"], found["high"]) == (10.0, 11.25, 8.125, 13.125)
    assert _flagged(cleaning.mark_outliers(_amounts(frame), "MONTO_APLICADO")) == [1000.0]


def test_zscore(frame):
    assert _flagged(cleaning.outliers_zscore(_amounts(frame), "MONTO_APLICADO", 2.0)) == [1000.0]
    for method in ("iqr", "zscore"):
        assert _flagged(cleaning.mark_outliers(_amounts(frame, [5.0] * 4), "MONTO_APLICADO", method)) == []
    with pytest.raises(ValueError):
        cleaning.mark_outliers(_amounts(frame), "MONTO_APLICADO", "otro")


def test_missing_value_is_no_outlier(frame):
    marked = cleaning.mark_outliers(_amounts(frame, [*AMOUNTS, None]), "MONTO_APLICADO")
    assert marked.count() == 9
    assert _flagged(marked) == [1000.0]
    assert marked.where("MONTO_APLICADO_ES_OUTLIER IS NULL").isEmpty()


def test_fit_then_apply_uses_only_the_given_parameters(frame, spark):
    whole = frame([(v, None) for v in AMOUNTS] + [(10.0, 0.3)], "MONTO_APLICADO double, PORCENTAJE_DESCUENTO double")
    params = cleaning.settle(cleaning.fit_cleaning(whole))
    part = spark.createDataFrame([(10.0, None), (1000.0, 0.5)], whole.schema)
    rows = cleaning.apply_cleaning(part, params).orderBy("MONTO_APLICADO").collect()
    assert [tuple(r) for r in rows] == [(10.0, 0.3, False), (1000.0, 0.5, True)]
    assert cleaning.apply_cleaning(part.limit(0), params).count() == 0


def test_report(frame):
    df = frame(
        [(10.0, 1, 0.1, None)] * 8 + [(9000.0, 1, None, None)],
        "MONTO_APLICADO double, UNIDADES bigint, PORCENTAJE_DESCUENTO double, FECHA_NACIMIENTO date",
    )
    report = {(r["metric"], r["column"]): r["value"] for r in cleaning.cleaning_report(df, mcar_report(df)).collect()}
    assert report[("rows_before", None)] == report[("rows_after", None)] == "9"
    assert report[("missing_before", "PORCENTAJE_DESCUENTO")] == "1"
    assert ("missing_before", "UNIDADES") not in report
    assert report[("missing_treatment", "PORCENTAJE_DESCUENTO")] == "imputacion_mediana(valor=0.1000)"
    assert report[("missing_treatment", "FECHA_NACIMIENTO")].startswith("sin_imputacion")
    assert report[("outliers_detected", "MONTO_APLICADO")] == "1"
    assert report[("outliers_detected", "UNIDADES")] == "0"
    assert not any(metric == "mcar_test_pvalue" for metric, _ in report)


def _brute_force_u(missing, present):
    """Pairs won by one group, ties counting one half."""
    won = sum((a > b) + 0.5 * (a == b) for a in missing for b in present)
    return max(won, len(missing) * len(present) - won)


def test_rank_test_matches_counting_pairs(frame):
    missing = [float(i * 7 % 23) for i in range(40)]
    present = [float(i * 5 % 31) for i in range(65)]
    rows = [(None, v) for v in missing] + [(0.5, v) for v in present] + [(0.5, None)]
    df = frame(rows, "PORCENTAJE_DESCUENTO double, MONTO_APLICADO double")
    row = mann_whitney(df, "PORCENTAJE_DESCUENTO", "MONTO_APLICADO").first()
    assert (row["n_missing"], row["n_present"]) == (40, 65)
    assert row["u"] == _brute_force_u(missing, present)
    assert 0 <= mcar_p_value(df, "PORCENTAJE_DESCUENTO") <= 1


def test_rank_test_needs_two_values_per_group(frame):
    df = frame([(None, 1.0), (0.1, 2.0), (0.2, 3.0)], "PORCENTAJE_DESCUENTO double, MONTO_APLICADO double")
    assert mcar_p_value(df, "PORCENTAJE_DESCUENTO") is None
    assert mcar_p_value(df, "AUSENTE") is None


def test_p_value_of_known_scores():
    assert two_sided_p(1.959963984540054) == pytest.approx(0.05)
    assert two_sided_p(-0.5) == 1.0


def test_profiles(frame):
    df = frame([("1", float("inf")), ("x", None), ("NA", 1.0)], "SKU string, MONTO double")
    assert [tuple(r) for r in quality.infinite_counts(df, ["MONTO", "AUSENTE"]).collect()] == [("MONTO", 1)]
    assert [tuple(r) for r in quality.type_conformance(df, ["SKU"]).collect()] == [("SKU", 1)]
    quality.require_numeric(df, "MONTO")
    for column in ("SKU", "AUSENTE"):
        with pytest.raises(quality.MissingColumnsError):
            quality.require_numeric(df, column)
