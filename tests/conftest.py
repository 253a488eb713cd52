from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mostrador.session import build_session  # noqa: E402

PREFIX = "0f1e2d3c-4b5a-4978-8695-"
PROCESSED_SCHEMA = (
    "FECHA timestamp_ntz, CANAL string, SKU bigint, UNIDADES bigint, PORCENTAJE_DESCUENTO double, "
    "MONTO_APLICADO double, BOLETA bigint, LOCAL bigint, CODIGO_CLIENTE string, "
    "FECHA_NACIMIENTO date, GENERO bigint, EDAD double"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.maxMetadataStringLength": "2000"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def processed_rows():
    """Twenty-eight enriched sales, no two alike; every seventh has no store, every ninth no gender."""
    rows = []
    for i in range(28):
        rows.append(
            (
                dt.datetime(2023, 2, 20, 7, 15) + dt.timedelta(days=i, hours=5 * i % 11),
                ("WEB", "CCT", "POS")[i % 3],
                7000 + 3 * i,
                1 + i % 4,
                0.05 * (i % 5),
                round(12.75 * (i * i % 29) + 3.5, 2),
                880000 + i,
                None if i % 7 == 5 else (61, 62)[i // 4 % 2],
                f"{PREFIX}{i:012d}",
                dt.date(1971, 6, 30) + dt.timedelta(days=401 * i),
                None if i % 9 == 4 else i % 4,
                33.0 + i % 6,
            )
        )
    return rows


@pytest.fixture(scope="session")
def processed(spark):
    return spark.createDataFrame(processed_rows(), PROCESSED_SCHEMA).repartition(3)


@pytest.fixture
def frame(spark):
    """A small frame spread over two partitions, so that partial results must be merged."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(2)

    return make


@pytest.fixture
def folder(tmp_path):
    def make(name):
        return str(tmp_path / name)

    return make
