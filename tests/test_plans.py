"""Checks on the plans Spark makes: pruning, reuse of shuffles, no Python in the rows' way."""

import datetime as dt

from pyspark.sql import functions as F

from mostrador.catalog.queries import FLAGSHIP_FILTERS
from mostrador.operators.features import add_age, purchase_frequency
from mostrador.operators.filters import apply_filters
from mostrador.operators.summary import summary
from mostrador.plans.flows import two_pass
from mostrador.sources import facts


def _plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _stored(processed, folder):
    # Three months of sales.
    spread = processed.withColumn("FECHA", F.col("FECHA") + F.expr("make_dt_interval(BOLETA % 3 * 31)"))
    path = folder("ventas")
    assert facts.write_facts(facts.to_fact_columns(spread), path) == 28
    return facts.read_facts(processed.sparkSession, path)


def test_date_filters_skip_months_and_reach_the_scan(processed, folder):
    stored = _stored(processed, folder)
    kept = apply_filters(stored, [("FECHA_DESDE", "2023-03-01"), ("FECHA_HASTA", "2023-03-20"), ("CANAL", "POS")])
    plan = _plan(kept.select("monto_aplicado"))
    partitions = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "2023-03" in partitions
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(canal,POS)" in pushed and "GreaterThanOrEqual(fecha" in pushed
    assert "producto" not in pushed
    assert all(r["fecha"] >= dt.datetime(2023, 3, 1) for r in kept.collect())


def test_customer_lookup_reaches_the_scan(processed, folder):
    person = "0F1E2D3C-4B5A-4978-8695-000000000011"
    kept = apply_filters(_stored(processed, folder), [("ID_PERSONA", person)])
    assert f"EqualTo(cliente_clave,{person.lower()})" in _plan(kept)
    assert kept.count() == 1


def test_summary_reads_the_source_once(processed, folder):
    plan = _plan(summary(_stored(processed, folder), FLAGSHIP_FILTERS), final=True)
    final = plan[: plan.index("Initial Plan")]
    assert final.count("FileScan parquet") <= 1
    assert "Python" not in final


def test_flow_has_no_python_and_no_cartesian_product(processed):
    plan = _plan(two_pass(processed))
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_distinct_receipts_are_reduced_before_and_spread_over_both_keys(processed):
    plan = _plan(purchase_frequency(add_age(processed)))
    assert "hashpartitioning(CODIGO_CLIENTE" in plan
    assert any("CODIGO_CLIENTE" in line and "BOLETA" in line for line in plan.splitlines() if "hashpartitioning" in line)


def test_the_two_pass_flow_reads_its_input_four_times_at_most(spark, processed, folder):
    processed.write.parquet(folder("entrada"))
    sales = spark.read.parquet(folder("entrada"))
    store = spark._jsparkSession.sharedState().statusStore()
    since = store.executionsList().size() and store.executionsList().apply(store.executionsList().size() - 1).executionId() + 1
    assert len(two_pass(sales).collect()) == 28
    executions, read = store.executionsList(), 0
    for k in range(executions.size()):
        number = executions.apply(k).executionId()
        metrics, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
        for node in (nodes.apply(n) for n in range(nodes.size())) if number >= since else ():
            if node.name().startswith("Scan parquet") and "entrada" in node.desc():
                rows = [node.metrics().apply(m) for m in range(node.metrics().size())]
                ids = [m.accumulatorId() for m in rows if m.name() == "number of output rows"]
                read += sum(int(metrics.apply(i)) for i in ids if metrics.contains(i))
    assert 28 <= read <= 4 * 28
