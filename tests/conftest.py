from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rivulet.schemas import READINGS


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def readings(spark) -> Callable[..., DataFrame]:
    """Build readings from dicts; times are UTC wall clock, missing columns null."""
    schema = T.StructType(
        [T.StructField(f.name, T.TimestampNTZType() if f.name == "horodatage" else f.dataType) for f in READINGS]
    )

    def build(*rows: dict) -> DataFrame:
        data = []
        for i, row in enumerate(rows):
            full = {"nom_automate": "A", "seq": i, **row}
            if isinstance(full["horodatage"], str):
                full["horodatage"] = datetime.fromisoformat(full["horodatage"])
            data.append(tuple(full.get(f.name) for f in schema))
        return spark.createDataFrame(data, schema)

    return build


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def readings_table(readings, tmp_path) -> str:
    """A date-partitioned readings table on disk."""
    path = str(tmp_path / "mesures")
    df = readings(
        {"horodatage": "2024-01-01 23:59"},
        {"horodatage": "2024-01-02 05:00"},
        {"horodatage": "2024-01-02 06:00", "nom_automate": "B"},
        {"horodatage": "2024-01-03 00:00"},
    )
    df.selectExpr("*", "to_date(horodatage) as d").write.partitionBy("d").parquet(path)
    return path
