"""Batches of overlapping time ranges: the tree's nodes, the answers, and how many rows are joined for them."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from mostrador.operators import batch, requests, time_tree
from mostrador.operators.summary import summary
from mostrador.sources.facts import read_facts, write_facts

RANGES = "id int, desde timestamp_ntz, hasta timestamp_ntz"
SALES = "fecha timestamp_ntz, canal string, monto_aplicado double"


def _inside(at, low, high):
    if low is None and high is None:
        return True
    return at is not None and (low is None or at >= low) and (high is None or at <= high)


def _covered(spark, ranges, times):
    """(range, time) pairs, found through the nodes."""
    table = spark.createDataFrame(ranges, RANGES)
    grid = time_tree.fit_grid(table)
    nodes = time_tree.add_covering_nodes(table, grid).select("id", F.inline("nodes"))
    points = spark.createDataFrame([(k, t) for k, t in enumerate(times)], "k int, at timestamp_ntz")
    cell = F.lit(None).cast("bigint") if grid is None else time_tree.segment(F.col("at"), grid)
    levels = [time_tree.ALL_LEVEL, *range((grid.levels if grid else 0) + 1)]
    at = [F.struct(F.lit(n).alias("level"), (F.lit(0).cast("bigint") if n < 0 else time_tree.node_at(cell, n)).alias("idx")) for n in levels]
    return grid, nodes, [(r.id, r.k) for r in points.select("k", F.inline(F.array(*at))).join(nodes, ["level", "idx"]).collect()]


@pytest.mark.parametrize(
    "step",
    [dt.timedelta(days=1), dt.timedelta(hours=7), dt.timedelta(minutes=1), dt.timedelta(seconds=3, microseconds=1)],
    ids=["days", "hours", "minutes", "microseconds"],
)
def test_nodes_cover_each_range_exactly_once(spark, step):
    r = random.Random(4)
    start = dt.datetime(1969, 12, 30, 5 if step < dt.timedelta(days=1) else 0)
    bounds = [start + step * r.randint(0, 60) for _ in range(40)]
    ranges = [(i, None if i % 9 == 3 else a, None if i % 11 == 4 else b) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    ranges += [(100, None, None), (101, bounds[0], bounds[0]), (102, dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31))]
    tick = dt.timedelta(microseconds=1)
    times = [None, dt.datetime(1500, 1, 1), dt.datetime(9000, 1, 1)] + [b + d for b in bounds for d in (-tick, 0 * tick, tick, step / 2)]
    grid, nodes, found = _covered(spark, ranges, times)
    want = [(i, k) for i, low, high in ranges for k, t in enumerate(times) if _inside(t, low, high)]
    assert sorted(found) == sorted(want)
    assert nodes.groupBy("id").count().agg(F.max("count")).first()[0] <= 6 * (grid.levels + 1)


def test_the_grid_is_as_coarse_as_the_bounds_allow(spark):
    def unit(*bounds):
        grid = time_tree.fit_grid(spark.createDataFrame([(1, b, None) for b in bounds], RANGES))
        return grid and grid.unit

    day = dt.datetime(2020, 1, 31)
    assert unit(day, day + dt.timedelta(days=9)) == time_tree.UNITS[0]
    assert unit(day, day + dt.timedelta(minutes=5)) == time_tree.UNITS[2]
    assert unit(day + dt.timedelta(microseconds=1)) == 1
    assert unit(None) is None


def _request(**filters):
    names = {"desde": "FECHA_DESDE", "hasta": "FECHA_HASTA", "canal": "CANAL"}
    return json.dumps({"consultas": [{"consulta": names[k], "valor": v} for k, v in filters.items()]})


def _batch(spark, sales, bodies):
    table = spark.createDataFrame(list(bodies.items()), "request_id string, body string")
    return batch.batch_summary(sales, requests.validate_requests(requests.parse_requests(table)))


def _sales(n, seed=2):
    r = random.Random(seed)
    values = [1e9 + 0.25, -3.5, 0.0, 7e-12, 5e-324, float("inf"), None, float("nan")]
    rows = [(dt.datetime(2021, 1, 1) + dt.timedelta(hours=r.randint(0, 24 * 90)), r.choice(["POS", "WEB"]), round(r.random() * 50, 1)) for _ in range(n)]
    return rows + [(None, "POS", 4.0)] + [(dt.datetime(2021, 3, 30, 12), "WEB", v) for v in values]


def test_overlapping_ranges_equal_single_summaries(spark):
    sales = spark.createDataFrame(_sales(700), SALES).repartition(3)
    bodies = {}
    for i in range(12):
        desde, hasta = dt.date(2021, 1, 1) + dt.timedelta(days=i * 5), dt.date(2021, 1, 20) + dt.timedelta(days=i * 4)
        bodies[f"r{i}"] = _request(desde=str(desde), hasta=f"{hasta}T10:00:00")
        bodies[f"c{i}"] = _request(canal="web", desde=str(desde))
    bodies |= {"all": "{}", "none": _request(desde="2022-01-01"), "late": _request(desde="2021-03-30"), "crossed": _request(desde="2021-02-02", hasta="2021-02-01")}
    got = {r["request_id"]: tuple(r)[1:] for r in _batch(spark, sales, bodies).collect()}
    assert set(got) == set(bodies)
    for name in ("r0", "r7", "r11", "c0", "c9", "all", "none", "late", "crossed"):
        filters = [(f["consulta"], f["valor"]) for f in json.loads(bodies[name]).get("consultas", [])]
        assert got[name] == pytest.approx(tuple(summary(sales, filters).first()), nan_ok=True), name


def _joined_rows(spark, since):
    """Rows put out by all joins of the executions from number ``since`` on, and the number of the next one."""
    store = spark._jsparkSession.sharedState().statusStore()
    executions, total = store.executionsList(), 0
    for k in range(executions.size()):
        number = executions.apply(k).executionId()
        if number < since:
            continue
        metrics, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
        for n in range(nodes.size()):
            node = nodes.apply(n)
            if "Join" in node.name():
                for m in range(node.metrics().size()):
                    metric = node.metrics().apply(m)
                    if metric.name() == "number of output rows" and metrics.contains(metric.accumulatorId()):
                        total += int(metrics.apply(metric.accumulatorId()).replace(",", ""))
    return total, executions.apply(executions.size() - 1).executionId() + 1 if executions.size() else 0


def test_joined_rows_grow_with_sales_plus_requests(spark):
    sales = spark.createDataFrame(_sales(4000), SALES)
    joined = {}
    for n in (60, 240):
        bodies = {f"r{i}": _request(desde=str(dt.date(2021, 1, 1) + dt.timedelta(days=i % 40)), hasta=str(dt.date(2021, 2, 10) + dt.timedelta(days=i // 5))) for i in range(n)}
        _, since = _joined_rows(spark, 0)
        _batch(spark, sales, bodies).collect()
        joined[n], _ = _joined_rows(spark, since)
    # All pairs would be about 4,000 x 240 / 2 and four times as many as for 60 requests.
    assert joined[240] < 4000 * 240 / 4
    assert joined[240] - joined[60] < 180 * 600


def test_months_no_request_asks_for_are_not_read(spark, processed, folder):
    write_facts(processed.toDF(*[c.lower() for c in processed.columns]), folder("facts"))
    facts = read_facts(spark, folder("facts"))
    ranges = spark.createDataFrame([(1, dt.datetime(2023, 2, 21), dt.datetime(2023, 2, 25)), (2, dt.datetime(2023, 2, 22), dt.datetime(2023, 2, 28))], RANGES)
    plan = batch.within_bounds(facts, ranges)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "2023-02" in plan
    open_ended = ranges.unionByName(spark.createDataFrame([(3, None, dt.datetime(2023, 2, 1))], RANGES))
    low = batch.within_bounds(facts, open_ended)._jdf.queryExecution().executedPlan().toString()
    assert ">= 2023-02" not in low and "<= 2023-02" in low


def test_no_round_of_the_search_carries_lists_of_nodes(spark, monkeypatch):
    day = dt.datetime(2020, 1, 1)
    sales = spark.createDataFrame([(day + dt.timedelta(days=k), "POS", float(k * k)) for k in range(70)], SALES)
    bounds = [((day + dt.timedelta(days=a)).isoformat(), (day + dt.timedelta(days=b)).isoformat()) for a, b in [(0, 69), (3, 44), (10, 11)]]
    bodies = [
        (f"r{k}", json.dumps({"consultas": [{"consulta": "FECHA_DESDE", "valor": a}, {"consulta": "FECHA_HASTA", "valor": b}]}))
        for k, (a, b) in enumerate(bounds)
    ]
    rounds, stored = [], batch._stored

    def noted(df, folder):
        if "/search-" in folder:
            rounds.append(df)
        return stored(df, folder)

    monkeypatch.setattr(batch, "_stored", noted)
    parsed = requests.parse_requests(spark.createDataFrame(bodies, "request_id string, body string"))
    found = batch.batch_summary(sales, requests.validate_requests(parsed), "monto_aplicado").collect()
    assert {r["request_id"]: r["mediana"] for r in found} == {"r0": (34**2 + 35**2) / 2, "r1": (23**2 + 24**2) / 2, "r2": 110.5}
    assert len(rounds) == 2
    assert all("nodes" not in df.columns for df in rounds)


def test_values_are_kept_once_however_high_the_tree(spark, monkeypatch):
    """Amounts that differ from sale to sale: no stored table has a row per sale and level of the tree."""
    r = random.Random(6)
    day = dt.datetime(2020, 1, 1)
    rows = [(day + dt.timedelta(days=r.randint(0, 400)), "POS", k + r.random()) for k in range(1500)]
    sales = spark.createDataFrame([*rows, (None, "POS", 7.5)], SALES)
    ranges = [(a, a + r.randint(1, 200)) for a in range(0, 200, 9)]
    bodies = {f"r{k}": _request(desde=str((day + dt.timedelta(days=a)).date()), hasta=str((day + dt.timedelta(days=b)).date())) for k, (a, b) in enumerate(ranges)}
    bodies["all"] = "{}"
    stored, sizes = batch._stored, {}

    def noted(df, folder):
        kept = stored(df, folder)
        sizes[folder.rsplit("/", 1)[1]] = kept.count()
        return kept

    monkeypatch.setattr(batch, "_stored", noted)
    got = {q["request_id"]: tuple(q)[1:] for q in _batch(spark, sales, bodies).collect()}
    for name in ("r0", "r11", "r22", "all"):
        filters = [(f["consulta"], f["valor"]) for f in json.loads(bodies[name]).get("consultas", [])]
        assert got[name] == pytest.approx(tuple(summary(sales, filters).first())), name
    assert sizes["histogram"] <= 1501 and sizes["numbered"] <= 1501
    assert max(n for name, n in sizes.items() if name.startswith("left-")) < 1501
