from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgermap.sources.schemas import SOURCES, mapping_schema  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _fit(value, kind: str):
    if value is None:
        return None
    if kind.startswith("decimal"):
        return Decimal(str(value))
    if kind == "date" and isinstance(value, str):
        return dt.date.fromisoformat(value)
    return value


def _frame(spark, schema, rows):
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    unknown = {k for r in rows for k in r} - set(kinds)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(_fit(r.get(n), k) for n, k in kinds.items()) for r in rows], schema)


@pytest.fixture(scope="session")
def source(spark):
    """Landed table ``name`` from dicts; columns not given are NULL; the folder is F1."""

    def make(name, *rows):
        return _frame(spark, SOURCES[name].schema(), [{"Data_Folder_Id": "F1", **r} for r in rows])

    return make


@pytest.fixture(scope="session")
def mapped(spark):
    """Translation table ``name`` from dicts; the folder is F1."""

    def make(name, *rows):
        schema = mapping_schema(name)
        folder = {"data_folder_id": "F1"} if "data_folder_id" in schema.names else {}
        return _frame(spark, schema, [{**folder, **r} for r in rows])

    return make


@pytest.fixture(scope="session")
def tables(spark):
    from checks.landed import landed

    return landed(spark, SF)
