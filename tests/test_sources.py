import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from mostrador import schema as S
from mostrador.errors import EmptyInputError, MissingColumnsError, UnreadableInputError
from mostrador.plans import flows
from mostrador.sources import extract, facts, json_sample, load_log

HEADER = ";".join(S.RAW_COLUMNS)


def _line(i=0, **changes):
    values = {
        "FECHA": f"2026-01-{i % 28 + 1:02d}T10:30:00", "CANAL": "POS", "SKU": str(1000 + i), "PRODUCTO": f"P{i}",
        "UNIDADES": "2", "PORCENTAJE DESCUENTO": "0.1", "MONTO APLICADO": str(100 + i), "BOLETA": str(i),
        "LOCAL": "1001", "CODIGO CLIENTE": f"CLI-{i % 5:04d}", "RUN CLIENTE": "1-9", "NOMBRES": "N",
        "APELLIDOS": "A", "FECHA NACIMIENTO": "1990-05-05", "GENERO": "1",
    }
    values.update(changes)
    return ";".join(values[c] for c in S.RAW_COLUMNS)


@pytest.fixture
def write(tmp_path):
    def make(lines, name="ventas.csv", header=HEADER):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        return str(path)

    return make


def test_defective_files(spark, write, tmp_path):
    with pytest.raises(EmptyInputError):
        extract.typed_rows(spark, str(tmp_path / "ausente.csv"))
    (tmp_path / "vacio.csv").write_bytes(b"")
    with pytest.raises(EmptyInputError):
        extract.typed_rows(spark, str(tmp_path / "vacio.csv"))
    (tmp_path / "binario.csv").write_bytes(bytes([200, 0, 7, 255, 254, 13]) * 33)
    with pytest.raises(UnreadableInputError):
        extract.typed_rows(spark, str(tmp_path / "binario.csv"))
    with pytest.raises(MissingColumnsError, match="BOLETA"):
        extract.typed_rows(spark, write(["2026-01-01;POS"], "corto.csv", "FECHA;CANAL"))
    with pytest.raises(UnreadableInputError):
        extract.typed_rows(spark, write([], "sin_filas.csv"))


def test_long_lines_are_skipped_and_short_ones_kept(spark, write):
    whole = _line(1)
    path = write(
        [
            whole,
            whole + ";x",
            whole + ";",
            whole + ";;",
            whole + ";x;y",
            whole.rsplit(";", 1)[0],
            _line(2, PRODUCTO='"a;b"'),
            _line(3, PRODUCTO='"di ""hola"";"'),
        ]
    )
    rows = extract.read_rows(spark, path)
    assert tuple(extract.malformed_counts(rows).first()) == (4, 4)
    good, bad = extract.skip_malformed(rows)
    assert {r["PRODUCTO"] for r in good.collect()} == {"P1", "a;b", 'di "hola";'}
    assert good.where("GENERO IS NULL").count() == 1
    assert bad.count() == 4
    assert good.select("SKU").count() == 4


def test_types_and_misfits(spark, write):
    path = write(
        [
            _line(1, SKU="12.0", LOCAL="NA", **{"PORCENTAJE DESCUENTO": "null", "FECHA NACIMIENTO": "1999-4-1"}),
            _line(2, UNIDADES="dos"),
            _line(3, FECHA="ayer"),
            _line(4, SKU="12.5", **{"FECHA NACIMIENTO": "1990-01-01 05:30:00"}),
            _line(5, **{"MONTO APLICADO": "-inf", "FECHA NACIMIENTO": "19990401"}),
            _line(6, **{"MONTO APLICADO": "1.5d"}),
        ]
    )
    typed = extract.typed_rows(spark, path)
    by_receipt = {r["BOLETA"]: r for r in typed.collect()}
    first = by_receipt[1]
    assert (first["SKU"], first["LOCAL"], first["PORCENTAJE_DESCUENTO"]) == (12, None, None)
    assert first["FECHA_NACIMIENTO"] == dt.date(1999, 4, 1)
    assert first["FECHA"] == dt.datetime(2026, 1, 2, 10, 30)
    misfits = {k: r[extract.REJECTED] for k, r in by_receipt.items()}
    assert misfits == {1: [], 2: ["UNIDADES"], 3: ["FECHA"], 4: ["SKU"], 5: [], 6: ["MONTO_APLICADO"]}
    assert by_receipt[4]["FECHA_NACIMIENTO"] is None and by_receipt[5]["FECHA_NACIMIENTO"] is None
    assert by_receipt[5]["MONTO_APLICADO"] == float("-inf")
    assert extract.accepted(typed).count() == 2
    with pytest.raises(UnreadableInputError):
        extract.require_no_rejects(typed)


def test_columns_may_come_in_any_order_and_more_of_them(spark, write, tmp_path):
    order = [*reversed(S.RAW_COLUMNS), "NOTA"]
    fields = dict(zip(S.RAW_COLUMNS, _line(7).split(";")))
    mixed = ";".join([*(fields[c] for c in reversed(S.RAW_COLUMNS)), "x"])
    path = write([mixed], "d/uno.csv", ";".join(order))
    row = extract.typed_rows(spark, path).first()
    assert (row["BOLETA"], row["NOTA"]) == (7, "x")
    write([_line(8)], "d/dos.csv")
    both = extract.read_mixed_extract(spark, str(tmp_path / "d"))
    assert sorted(r["BOLETA"] for r in both.collect()) == [7, 8]
    told_apart = extract.typed_rows(spark, str(tmp_path / "d"))
    assert sorted(r["BOLETA"] for r in told_apart.collect()) == [7, 8]
    assert extract.schema_check(spark, str(tmp_path / "d")).isEmpty()
    write(["x;y"], "d/tres.csv", "FECHA;CANAL")
    assert extract.schema_check(spark, str(tmp_path / "d")).count() == 13


def test_json(spark, tmp_path):
    fields = dict(zip(S.RAW_COLUMNS, _line(3).split(";")))
    record = {**fields, "SKU": 49, "MONTO APLICADO": 8697, "PORCENTAJE DESCUENTO": 0.3}
    (tmp_path / "m.json").write_text(json.dumps([record], indent=1))
    row = json_sample.read_json(spark, str(tmp_path / "m.json"), multi_line=True).first()
    assert (row["SKU"], row["MONTO_APLICADO"], row["PORCENTAJE_DESCUENTO"], row[extract.REJECTED]) == (49, 8697.0, 0.3, [])


@pytest.mark.parametrize(
    "at,name,start,end",
    [
        ("2024-02-29 18:05:00", "ventas_y2024m02", "2024-02-01", "2024-03-01"),
        ("2019-12-01 00:00:00", "ventas_y2019m12", "2019-12-01", "2020-01-01"),
        ("2041-10-31 23:59:58", "ventas_y2041m10", "2041-10-01", "2041-11-01"),
        ("1987-07-04 03:00:00", "ventas_y1987m07", "1987-07-01", "1987-08-01"),
    ],
)
def test_month_of_a_time(spark, at, name, start, end):
    df = spark.range(1).select(F.lit(at).cast("timestamp_ntz").alias("FECHA"))
    row = facts.month_partitions(df).first()
    assert tuple(row) == (name, dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end))


def test_months_come_from_the_data_only(frame):
    rows = [(dt.datetime(2026, 1, 5),), (dt.datetime(2026, 3, 1),), (dt.datetime(2026, 1, 9),), (None,)]
    df = frame(rows, "FECHA timestamp_ntz")
    assert {r[0] for r in facts.months_present(df).collect()} == {"2026-01", "2026-03"}
    assert facts.months_present(df.limit(0)).isEmpty()


def test_ingest_once(spark, write, folder):
    source = write([_line(i) for i in range(60)])
    root = folder("carga")
    assert not load_log.is_complete(spark, root)
    state = flows.ingest(spark, source, root)
    assert state.completed and state.rows == 60
    again = flows.ingest(spark, source, root)
    assert again == state
    stored = flows.published_facts(spark, root)
    assert stored.columns == [*S.FACT_COLUMNS, "cliente_clave", "ym"]
    assert stored.count() == 60
    assert {r[0] for r in stored.select("ym").distinct().collect()} == {"2026-01"}
    assert {r[0] for r in stored.select("frecuencia_compra").distinct().collect()} == {12}
    load_log.reset(spark, root)
    assert not load_log.is_complete(spark, root)
    assert flows.ingest(spark, source, root).folder != state.folder
    assert flows.published_facts(spark, root).count() == 60


def test_a_load_packs_what_it_stores(spark, write, folder, monkeypatch):
    monkeypatch.setattr(flows, "remove_folder", lambda *_: True)
    root = folder("carga")
    flows.ingest(spark, write([_line(i) for i in range(20)] + [_line(20, SKU="x")]), root, strict=False)
    for step in ("lineas", "filas", "rechazos", "ventas"):
        files = [p.name for p in Path(root).rglob("*.parquet") if f"/{step}/" in str(p)]
        assert files and all(n.endswith(".zstd.parquet") for n in files), step


def test_facts_written_in_turns_are_whole(spark, write, folder, monkeypatch):
    lines = [_line(i, FECHA=f"20{20 + i % 3}-0{1 + i % 7}-03T10:00:00") for i in range(60)]
    flows.ingest(spark, write(lines), folder("at once"))
    want = flows.published_facts(spark, folder("at once"))
    monkeypatch.setattr(flows, "TURN_ROWS", 9)  # seven turns; some hold no month
    state = flows.ingest(spark, write(lines), folder("turns"))
    found = flows.published_facts(spark, folder("turns"))
    assert state.rows == 60 and found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    path = folder("one month")
    one = spark.createDataFrame([(dt.datetime(2020, 5, k), "C") for k in range(1, 9)], "fecha timestamp_ntz, codigo_cliente string")
    released = []
    monkeypatch.setattr(facts, "release_shuffles", released.append)
    assert facts.write_facts(one, path, 4) == 8 and len(released) == 4
    assert len(list(Path(path).glob("ym=2020-05/*.parquet"))) == 1


def test_failed_load_is_not_visible(spark, write, folder):
    root = folder("carga")
    with pytest.raises(UnreadableInputError):
        flows.ingest(spark, write([_line(1), _line(2, SKU="x")]), root)
    assert not load_log.is_complete(spark, root)
    with pytest.raises(RuntimeError):
        flows.published_facts(spark, root)
    assert flows.ingest(spark, write([_line(1), _line(2, SKU="x")]), root, strict=False).rows == 1


def test_explore_writes_its_reports(spark, write, folder):
    work = folder("trabajo")
    done = flows.explore(spark, write([_line(i) for i in range(30)]), work)
    assert done.count() == 30
    for name in ("reporte_limpieza.json", "parametros_estandarizacion.json"):
        assert list(Path(work, name).glob("*.json"))


def _with_bad_bytes(tmp_path, spoilt):
    """Two files of 3,000 lines; ``spoilt`` replaces a product late in the second one."""
    for name in ("a.csv", "b.csv"):
        lines = [HEADER, *[_line(i) for i in range(3000)]]
        data = "\n".join(lines).encode()
        if name == "b.csv":
            data = data.replace(b";P2900;", b";" + spoilt + b";")
        (tmp_path / name).write_bytes(data + b"\n")
    return f"{tmp_path}/*.csv"


@pytest.mark.parametrize("spoilt", [b"a\xf1o", b"nul\x00"])
def test_bytes_that_are_no_text_are_found_on_any_line(spark, tmp_path, spoilt):
    path = _with_bad_bytes(tmp_path, spoilt)
    typed = extract.typed_rows(spark, path)
    assert [(r["BOLETA"], r[extract.REJECTED]) for r in extract.rejected(typed).collect()] == [(2900, ["PRODUCTO"])]
    assert extract.accepted(typed).count() == 5999
    with pytest.raises(UnreadableInputError, match="PRODUCTO"):
        extract.require_no_rejects(typed)
    with pytest.raises(UnreadableInputError):
        flows.ingest(spark, path, str(tmp_path / "almacen"))


def test_other_failures_are_not_taken_for_a_first_load(spark, tmp_path):
    (tmp_path / "estado_carga").mkdir()
    (tmp_path / "estado_carga" / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception, match="(?i)parquet|corrupt"):
        load_log.load_state(spark, str(tmp_path))


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("at", [10, 2500])
def test_bad_bytes_mean_the_same_on_an_early_and_a_late_line(spark, tmp_path, at, strict):
    lines = [HEADER, *[_line(i) for i in range(3000)]]
    data = "\n".join(lines).encode().replace(b";P%d;" % at, b";a\xf1o;")
    (tmp_path / "a.csv").write_bytes(data + b"\n")
    root = str(tmp_path / "almacen")
    if strict:
        with pytest.raises(UnreadableInputError, match="PRODUCTO"):
            flows.ingest(spark, str(tmp_path / "a.csv"), root)
    else:
        state = flows.ingest(spark, str(tmp_path / "a.csv"), root, strict=False)
        assert (state.rows, state.skipped, state.rejected) == (2999, 0, 1)


def test_a_header_that_is_no_text_is_refused_whatever_the_mode(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(HEADER.encode().replace(b"NOMBRES", b"NOMBR\xc9S") + b"\n" + _line(1).encode())
    with pytest.raises(UnreadableInputError):
        flows.ingest(spark, str(tmp_path / "a.csv"), str(tmp_path / "almacen"), strict=False)


def test_layouts_of_several_files_are_told_apart_and_keep_their_further_columns(spark, write, tmp_path):
    fields = dict(zip(S.RAW_COLUMNS, _line(7).split(";")))
    turned = [*reversed(S.RAW_COLUMNS), "NOTA"]
    write([";".join([*(fields[c] for c in reversed(S.RAW_COLUMNS)), "x"]), ";".join([fields[c] for c in reversed(S.RAW_COLUMNS)] + ["x", "y"])], "d/uno.csv", ";".join(turned))
    write([_line(8), "", "   ", _line(9) + ";sobra", _line(10).rsplit(";", 2)[0], HEADER], "d/dos.csv", "\ufeff" + HEADER)
    write([";".join([_line(11), "", "z"])], "d/tres.csv", HEADER + ";VACIA;OTRA")
    found = extract.read_extract(spark, str(tmp_path / "d"))
    rows = {r["BOLETA"]: r for r in found.rows.collect()}
    assert set(rows) == {7, 8, 10, 11}
    assert [(rows[k]["NOTA"], rows[k]["OTRA"], rows[k]["GENERO"]) for k in (7, 8, 10, 11)] == [("x", None, 1), (None, None, 1), (None, None, None), (None, "z", 1)]
    assert found.malformed.count() == 2
    # A second header is a line like any other: its texts are no values.
    assert [r["FECHA_NACIMIENTO"] for r in found.rejected.collect()] == [None]


def _rows_read(spark, since):
    """Rows put out by scans of text since an execution, and the number of the next one."""
    store = spark._jsparkSession.sharedState().statusStore()
    executions, total = store.executionsList(), 0
    for k in range(executions.size()):
        number = executions.apply(k).executionId()
        if number < since:
            continue
        metrics, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
        for n in range(nodes.size()):
            node = nodes.apply(n)
            if node.name().startswith(("Scan text", "Scan csv")):
                for m in range(node.metrics().size()):
                    metric = node.metrics().apply(m)
                    if metric.name() == "number of output rows" and metrics.contains(metric.accumulatorId()):
                        total += int(metrics.apply(metric.accumulatorId()).replace(",", ""))
    return total, executions.apply(executions.size() - 1).executionId() + 1 if executions.size() else 0


def test_the_text_is_read_once_also_in_several_blocks(spark, write, tmp_path, folder):
    for name in ("a", "b"):
        write([_line(i) for i in range(400)], f"d/{name}.csv")
    _, since = _rows_read(spark, 0)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert spark.read.text(str(tmp_path / "d")).rdd.getNumPartitions() > 6
        state = flows.ingest(spark, str(tmp_path / "d"), folder("almacen"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert state.rows == 800
    assert _rows_read(spark, since)[0] == 802


def test_left_out_lines_are_kept_and_unfinished_loads_go(spark, write, folder):
    root = folder("carga")
    with pytest.raises(UnreadableInputError):
        flows.ingest(spark, write([_line(1), _line(2, SKU="x")], "malo.csv"), root)
    assert len(list(Path(root, "cargas").iterdir())) == 1
    state = flows.ingest(spark, write([_line(1), _line(2, SKU="x"), _line(3) + ";sobra"]), root, strict=False)
    assert (state.rows, state.skipped, state.rejected) == (1, 1, 1)
    runs = list(Path(root, "cargas").iterdir())
    assert [str(r) for r in runs] == [state.folder.rsplit("/", 1)[0]]
    assert sorted(p.name for p in runs[0].iterdir()) == ["rechazos", "ventas"]
    left = {(r["linea"], tuple(r["columnas"] or ())) for r in flows.rejected_lines(spark, root).collect()}
    assert left == {(_line(3) + ";sobra", ()), (None, ("SKU",))}
