import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom import GridDataset
from gridloom.streaming import histogram_quantile, merge_histograms, retrieval_histogram, retrieval_rollup, stream_cells
from tests.conftest import collected, grid_rows


def drain(df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def test_filters_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "cells")
    rows = grid_rows(range(10), range(10), lambda i, j: i + j)
    cells = spark.createDataFrame(rows, "latitude double, longitude double, v double").withColumn(
        "time", F.expr("TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, int(v))")
    )
    cells.repartition(4).write.parquet(path)
    live, still = GridDataset(stream_cells(spark, path, cells.schema, 1)), GridDataset(cells)
    steps = {
        "boxed": lambda d: d.rectangle(2, 2, 5, 5),
        "circled": lambda d: d.circle(4, 4, 250),
        "timed": lambda d: d.time_range("2024-01-03", "2024-01-05"),
        "pointed": lambda d: d.point(3, 4, method="exact"),
        "chained": lambda d: d.rectangle(2, 2, 8, 8).time_range("2024-01-06", "2024-01-10").circle(5, 5, 400),
    }
    for name, step in steps.items():
        got = drain(step(live).to_records("v"), name)
        want = step(still).to_records("v")
        assert collected(got) == collected(want) and want.count() > 0


def test_rollup_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.range(500).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("ts"),
        F.concat(F.lit("gw"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5)).alias("gateway"),
        F.lit("store").alias("store_type"),
        F.when(F.col("id") % 7 == 0, "request timed out").when(F.col("id") % 11 == 0, "bad metadata").alias("message"),
        (F.col("id") % 13).cast("double").alias("duration_ms"),
    )
    log.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 3).parquet(path)
    got = drain(retrieval_rollup(stream, "1 hour", "10 minutes"), "rolled", "complete")
    assert collected(got) == collected(retrieval_rollup(log, "1 hour"))


def test_rollup_percentiles(spark):
    log = spark.range(101).selectExpr(
        "timestamp'2024-01-01' AS ts", "'g' AS gateway", "'s' AS store_type", "CAST(NULL AS STRING) AS message", "CAST(id AS DOUBLE) AS duration_ms"
    )
    row = retrieval_rollup(log, percentiles=(0.5, 0.95)).first()
    assert (row.requests, row.min_ms, row.max_ms, row.sum_ms, row.p50_ms, row.p95_ms) == (101, 0, 100, 5050, 50, 95)


def request_log(spark, n=2000):
    rng = random.Random(5)
    rows = [
        (
            datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(6 * 24 * 60)),
            rng.choice(["a", "a", "a", "b"]),
            rng.choice(["s", None]),
            rng.choice([None, None, "timed out", "bad"]),
            rng.choice([None, float("nan"), 5.0, 10.0, rng.lognormvariate(4, 2), 1e6]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "ts timestamp_ntz, gateway string, store_type string, message string, duration_ms double")


def rounded(df):
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()), key=repr
    )


def test_days_from_hours_equal_days_from_the_log(spark):
    log = request_log(spark)
    hourly = retrieval_histogram(log, "1 hour")
    daily = merge_histograms(hourly, "1 day")
    assert rounded(daily) == rounded(retrieval_histogram(log, "1 day"))
    assert rounded(merge_histograms(daily)) == rounded(merge_histograms(hourly)) == rounded(retrieval_histogram(log))
    assert rounded(merge_histograms(daily, "3 days")) == rounded(retrieval_histogram(log, "3 days"))
    for r in daily.collect():
        assert sum(r.buckets) == r.measured <= r.requests
    assert merge_histograms(hourly.limit(0)).count() == 0
    with pytest.raises(ValueError):
        retrieval_histogram(log, boundaries=(5, 5))


def test_quantiles_lie_in_the_right_bucket(spark):
    rng = random.Random(8)
    values = [rng.lognormvariate(5, 1.5) for _ in range(999)]
    log = spark.createDataFrame([(datetime(2024, 1, 1), "a", "s", None, v) for v in values], "ts timestamp_ntz, gateway string, store_type string, message string, duration_ms double")
    quantiles = (0.0, 0.01, 0.5, 0.9, 0.99, 1.0)
    got = retrieval_histogram(log).select(*[histogram_quantile(q) for q in quantiles]).first()
    edges = [min(values), *(b for b in (5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10_000) if min(values) < b < max(values)), max(values)]
    for q, found in zip(quantiles, got, strict=True):
        true = sorted(values)[max(0, math.ceil(q * len(values)) - 1)]
        low, high = next((a, b) for a, b in zip(edges, edges[1:]) if a <= true <= b)
        assert low - 1e-9 <= found <= high + 1e-9
    none = log.withColumn("duration_ms", F.lit(None).cast("double"))
    assert retrieval_histogram(none).select(histogram_quantile(0.5)).first()[0] is None


def test_histograms_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "requests")
    log = request_log(spark, 300).withColumn("ts", F.col("ts").cast("timestamp"))
    log.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(retrieval_histogram(stream, "1 hour", "10 days"), "hours", "complete")
    assert rounded(merge_histograms(got, "1 day")) == rounded(retrieval_histogram(log, "1 day"))
