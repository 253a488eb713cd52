import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mostrador.operators import quantiles
from mostrador.operators.histogram import coarse_bucket, distinct_counts
from mostrador.operators.missingness import mann_whitney
from mostrador.operators.quantiles import column_quantiles, group_quantiles, group_summary

PROBS = {"p0": 0.0, "p10": 0.1, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p99": 0.99, "p100": 1.0}


def _populations():
    rnd = random.Random(7)
    return {
        "one": [3.25],
        "pair": [1.0, 2.0],
        "ties": [5.0] * 50 + [7.0] * 3,
        "hot": [100.0] * 400 + [rnd.uniform(-1e6, 1e6) for _ in range(200)],
        "signs": [rnd.gauss(0, 1) for _ in range(301)],
        "narrow": [1e6 + i * 1e-7 for i in range(257)],
        "tiny": [10.0 ** -rnd.uniform(1, 300) for _ in range(120)],
        "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(200)],
    }


def test_groups_of_any_shape_match_numpy(frame):
    populations = _populations()
    rows = [(g, v) for g, values in populations.items() for v in values]
    found = group_quantiles(frame(rows, "g string, value double"), ["g"], PROBS).collect()
    assert {r["g"] for r in found} == set(populations)
    for r in found:
        for name, p in PROBS.items():
            want = float(np.quantile(populations[r["g"]], p))
            assert r[name] == pytest.approx(want, rel=1e-12), (r["g"], name)


def test_infinities_have_a_place(frame):
    rows = [(-math.inf,), (1.0,), (2.0,), (math.inf,), (math.inf,)]
    found = column_quantiles(frame(rows, "x double"), ["x"], {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert (found["low"], found["mid"], found["high"]) == (-math.inf, 2.0, math.inf)


def test_several_columns_skip_nulls(frame):
    df = frame([(1, 0.5), (2, None), (4, 1.5), (None, None)], "a bigint, b double")
    found = {r["column"]: r["median"] for r in column_quantiles(df, ["a", "b"], {"median": 0.5}).collect()}
    assert found == {"a": 2.0, "b": 1.0}


def test_summary_keeps_precision_for_large_values_with_small_spread(frame):
    values = [1e9 + 1e4 * i for i in range(100)]
    r = group_summary(frame([("g", v) for v in values], "g string, value double"), ["g"]).first()
    assert r["deviation"] == pytest.approx(np.std(values, ddof=1), rel=1e-9)
    assert (r["n"], r["low"], r["high"], r["median"]) == (100, 1e9, 1e9 + 99e4, 1e9 + 49.5e4)


def test_buckets_never_decrease(frame):
    rnd = random.Random(3)
    values = sorted(rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-320, 308) for _ in range(500))
    placed = frame([(v,) for v in values], "v double").select("v", coarse_bucket(F.col("v")).alias("b"))
    buckets = [r["b"] for r in placed.orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_same_answer_on_one_and_many_partitions(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 37 % 1009).cast("double").alias("value"))
    one = group_summary(df.coalesce(1), ["g"]).first()
    many = group_summary(df.repartition(8), ["g"]).first()
    assert tuple(one)[1:] == pytest.approx(tuple(many)[1:], rel=1e-12)


def _dense():
    """Values under one part in a billion, and a cluster around 0.007 that a few others in its bucket spread apart."""
    rnd = random.Random(9)
    tiny = [10.0 ** -rnd.uniform(9, 40) for _ in range(30_000)]
    cluster = [0.007 * (1 + i * 2e-16) for i in range(60_000)]
    return tiny, [*cluster, 0.00697, 0.00704]


def test_the_last_range_is_small_at_any_magnitude(frame):
    tiny, cluster = _dense()
    for values in (tiny, cluster, tiny + cluster):
        hist = distinct_counts(frame([("x", v) for v in values], "column string, value double"), ["column"])
        targets = quantiles._locate(quantiles._coarse(hist, ["column"]), ["column"], [0.25, 0.6])
        targets = quantiles._confine(hist, targets, ["column"], True)
        assert quantiles._inside(hist, targets, ["column"], True).groupBy("target").count().agg(F.max("count")).first()[0] <= 1500
        found = column_quantiles(frame([(v,) for v in values], "x double"), ["x"], {"a": 0.25, "b": 0.6}).first()
        assert (found["a"], found["b"]) == pytest.approx(tuple(np.quantile(values, [0.25, 0.6])), rel=1e-14)


def test_many_groups_are_shuffled_and_give_the_same(spark, frame):
    rows = [(g, float(g * 7 % 13 + k * k)) for g in range(300) for k in range(1 + g % 5)]
    df = frame(rows, "g int, value double")
    few = {r["g"]: tuple(r)[1:] for r in group_summary(df, ["g"], few_groups=True).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = group_summary(df, ["g"])
        assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
        assert {r["g"]: tuple(r)[1:] for r in many.collect()} == few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rank_test_on_a_dense_cluster(frame):
    _, cluster = _dense()
    df = frame([(v, None if i % 3 else 1.0) for i, v in enumerate(cluster)], "value double, target double")
    missing, values = np.array([i % 3 > 0 for i in range(len(cluster))]), np.array(cluster)
    order = np.argsort(values, kind="stable")
    ranks = np.empty(len(values))
    _, start, count = np.unique(values[order], return_index=True, return_counts=True)
    for s, c in zip(start, count):
        ranks[order[s : s + c]] = s + (c + 1) / 2
    n1, n2 = missing.sum(), (~missing).sum()
    u1 = ranks[missing].sum() - n1 * (n1 + 1) / 2
    found = mann_whitney(df, "target", "value").first()
    assert found["u"] == pytest.approx(max(u1, n1 * n2 - u1))
