import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gridloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def grid_rows(lats, lons, value):
    return [(float(a), float(b), float(value(i, j))) for i, a in enumerate(lats) for j, b in enumerate(lons)]


@pytest.fixture(scope="session")
def small_grid(spark):
    """Three by three grid with two variables and their attributes."""
    temperature = [[11, 14, 13], [9, 12.5, 16], [8, 7, 15]]
    humidity = [[41, 38, 55], [47, 33, 52], [36, 58, 49]]
    rows = [
        (lat, lon, float(temperature[i][j]), float(humidity[i][j]))
        for i, lat in enumerate((50.0, 50.5, 51.0))
        for j, lon in enumerate((6.0, 6.5, 7.0))
    ]
    df = spark.createDataFrame(rows, "latitude double, longitude double, temperature double, humidity double")
    return df.withMetadata("temperature", {"units": "celsius", "description": "Temperature"}).withMetadata(
        "humidity", {"units": "percent", "description": "Humidity"}
    )


@pytest.fixture(scope="session")
def sample(spark):
    """Four records of one variable at two places."""
    rows = [
        (50.75, 6.01, "2023-01-01T00:00:00Z", 4.25),
        (50.75, 6.01, "2023-01-04T00:00:00Z", 6.5),
        (50.75, 6.01, "2023-01-07T00:00:00Z", 3.0),
        (-12.5, 77.0, "2023-01-01T00:00:00Z", 1.5),
    ]
    df = spark.createDataFrame(rows, "latitude double, longitude double, time string, precipitation double")
    return df.withColumn("time", df.time.cast("timestamp"))


def collected(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
