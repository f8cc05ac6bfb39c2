"""Retrieval counters and durations, for batch and streaming logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.status import retrieval_status

LABELS = ["gateway", "store_type", "status"]


def retrieval_rollup(
    log: DataFrame,
    window: str | None = None,
    watermark: str | None = None,
    percentiles: tuple[float, ...] = (),
) -> DataFrame:
    """Requests and duration statistics by gateway, store type and status.

    ``log``: ``ts``, ``gateway``, ``store_type``, ``message`` (NULL = success)
    and ``duration_ms``. ``window`` splits by time; a stream also needs a
    ``watermark``. All aggregates combine on the map side, so a gateway with
    most of the requests costs no more than the others.
    """
    if watermark:
        log = log.withWatermark("ts", watermark)
    labelled = log.withColumn("status", retrieval_status(F.col("message")))
    by = [F.window("ts", window).alias("window")] if window else []
    duration = F.col("duration_ms")
    rows = labelled.groupBy(*by, *LABELS).agg(
        F.count("*").alias("requests"),
        F.min(duration).alias("min_ms"),
        F.max(duration).alias("max_ms"),
        F.sum(duration).alias("sum_ms"),
        *[F.percentile_approx(duration, p).alias(f"p{round(p * 100)}_ms") for p in percentiles],
    )
    if not window:
        return rows
    return rows.select(
        F.col("window.start").alias("window_start"), *[c for c in rows.columns if c != "window"]
    )


#: Upper ends of duration buckets in milliseconds, each included; one more bucket has what is above.
BOUNDARIES = (5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10_000)


def retrieval_histogram(
    log: DataFrame,
    window: str | None = None,
    watermark: str | None = None,
    boundaries: tuple[float, ...] = BOUNDARIES,
) -> DataFrame:
    """Requests and the distribution of their durations, by gateway, store type and status.

    ``buckets`` counts the durations up to each boundary and above the one before; the last counts
    those above all, and a missing duration is in none. With ``window`` the rows are a state that
    ``merge_histograms`` rolls up to longer windows: counts, sums and extremes all merge, so the log
    is read once, however many windows are made of it. A stream also needs a ``watermark``.
    """
    if list(boundaries) != sorted(set(boundaries)) or not boundaries:
        raise ValueError("Boundaries of buckets must rise.")
    if watermark:
        log = log.withWatermark("ts", watermark)
    labelled = log.withColumn("status", retrieval_status(F.col("message")))
    by = [F.window("ts", window).alias("window")] if window else []
    duration = F.nanvl(F.col("duration_ms").cast("double"), F.lit(None).cast("double"))
    edges = [None, *boundaries, None]
    counts = []
    for low, high in zip(edges, edges[1:]):
        inside = F.lit(True) if low is None else duration > F.lit(float(low))
        counts.append(F.count_if(inside if high is None else inside & (duration <= F.lit(float(high)))))
    rows = labelled.groupBy(*by, *LABELS).agg(
        F.count("*").alias("requests"),
        F.count(duration).alias("measured"),
        F.min(duration).alias("min_ms"),
        F.max(duration).alias("max_ms"),
        F.sum(duration).alias("sum_ms"),
        F.array(*counts).alias("buckets"),
    )
    if not window:
        return rows
    return rows.select(F.col("window.start").alias("window_start"), *[c for c in rows.columns if c != "window"])


def merge_histograms(state: DataFrame, window: str | None = None, boundaries: tuple[float, ...] = BOUNDARIES) -> DataFrame:
    """Rows of ``retrieval_histogram`` summed over longer windows, or over all time.

    ``window`` must be whole windows of the state; then the result is what the log would give.
    """
    by = [F.window("window_start", window).alias("window")] if window else []
    rows = state.groupBy(*by, *LABELS).agg(
        F.sum("requests").alias("requests"),
        F.sum("measured").alias("measured"),
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        F.sum("sum_ms").alias("sum_ms"),
        F.array(*[F.sum(F.get("buckets", F.lit(i))) for i in range(len(boundaries) + 1)]).alias("buckets"),
    )
    if not window:
        return rows
    return rows.select(F.col("window.start").alias("window_start"), *[c for c in rows.columns if c != "window"])


def histogram_quantile(q: float, boundaries: tuple[float, ...] = BOUNDARIES) -> Column:
    """Estimate of a quantile from ``buckets``: even within the bucket that holds it, and never
    outside the lowest and highest duration. NULL without durations."""
    if not 0 <= q <= 1:
        raise ValueError("A quantile lies between 0 and 1.")
    n = len(boundaries) + 1
    upto = [sum((F.get("buckets", F.lit(i)) for i in range(k + 1)), F.lit(0).cast("long")) for k in range(n)]
    rank = F.col("measured") * F.lit(float(q))
    found = F.lit(None).cast("double")
    for k in reversed(range(n)):
        low = F.col("min_ms") if k == 0 else F.greatest(F.col("min_ms"), F.lit(float(boundaries[k - 1])))
        high = F.col("max_ms") if k == n - 1 else F.least(F.col("max_ms"), F.lit(float(boundaries[k])))
        before = upto[k - 1] if k else F.lit(0).cast("long")
        inside = F.get("buckets", F.lit(k))
        here = low + (high - low) * (rank - before) / inside
        found = F.when((inside > 0) & (upto[k] >= rank), here).otherwise(found)
    return F.when(F.col("measured") > 0, found)
