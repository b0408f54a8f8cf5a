"""Observation of a stream: counters, gauges, rates, histograms, quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Upper bounds of the latency histograms.
BATCH_MICROS = (100, 500, 1000, 5000, 10000, 50000, 100000)
TRANSFORM_NANOS = (100, 500, 1000, 5000, 10000, 50000)


def bucket(value: Column, bounds: tuple) -> Column:
    """Number of the first bound that isn't below value; len(bounds) above all."""
    out = F.lit(len(bounds))
    for i, b in reversed(list(enumerate(bounds))):
        out = F.when(value <= b, i).otherwise(out)
    return out


def histogram(df: DataFrame, value: str, bounds: tuple, by: tuple[str, ...] = ()) -> DataFrame:
    """by, bucket, le (null for the overflow) and n, without the buckets that are empty; counts aren't cumulative."""
    b = bucket(F.col(value), bounds)
    le = F.get(F.array(*[F.lit(float(x)) for x in bounds]), F.col("bucket"))
    return df.groupBy(*by, b.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).withColumn("le", le)


def histogram_quantile(hist: DataFrame, q: float, bounds: tuple, by: tuple[str, ...] = ()) -> DataFrame:
    """The q-quantile as read off cumulative buckets: linear within the bucket, the last bound in the overflow."""
    n = [F.sum(F.when(F.col("bucket") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(bounds) + 1)]
    h = hist.groupBy(*by).agg(*n)
    total = sum((F.col(f"n{i}") for i in range(1, len(bounds) + 1)), F.col("n0"))
    rank, below, out = total * q, F.lit(0), F.lit(float(bounds[-1]))
    steps = []
    for i, b in enumerate(bounds):
        low = float(bounds[i - 1]) if i else 0.0
        steps.append((below + F.col(f"n{i}") >= rank, low + (b - low) * (rank - below) / F.nullif(F.col(f"n{i}"), F.lit(0)), low))
        below = below + F.col(f"n{i}")
    for hit, inside, low in reversed(steps):
        out = F.when(hit, F.coalesce(inside, F.lit(low))).otherwise(out)
    return h.select(*by, F.when(total > 0, out).alias("value"))


def mean(value: str) -> Column:
    return F.coalesce(F.avg(value), F.lit(0.0))


def rate(df: DataFrame, time: str, every: str = "1 minute", seconds: int = 60, by: tuple[str, ...] = ()) -> DataFrame:
    """by, start, n and per_second of each window with events."""
    w = df.groupBy(*by, F.window(time, every).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(*by, F.col("w.start").alias("start"), "n", (F.col("n") / F.lit(float(seconds))).alias("per_second"))


def counter_rate(samples: DataFrame, series: str, at: str, count: str) -> DataFrame:
    """samples with rate: the count's growth a second since the series' last sample, null for the first."""
    w = Window.partitionBy(series).orderBy(at)
    seconds = (F.unix_micros(at) - F.lag(F.unix_micros(at)).over(w)) / F.lit(1e6)
    return samples.withColumn("rate", (F.col(count) - F.lag(count).over(w)) / F.nullif(seconds, F.lit(0.0)))


def last_value(df: DataFrame, value: str, at: str, by: tuple[str, ...] = ()) -> DataFrame:
    """A gauge: the value with the greatest at."""
    return df.groupBy(*by).agg(F.max_by(value, at).alias("value"))


def lag_ms(ingested: Column, committed: Column) -> Column:
    return F.floor((F.unix_micros(ingested) - F.unix_micros(committed)) / 1000).cast("long")


#: The registry's series.
SERIES = {
    "cdc_engine_events_total": "counter",
    "cdc_engine_batches_published_total": "counter",
    "cdc_engine_batch_latency_microseconds": "histogram",
    "cdc_engine_transform_latency_nanoseconds": "histogram",
    "cdc_engine_partial_batch_failures_total": "counter",
    "cdc_engine_events_quarantined_total": "counter",
    "cdc_publisher_jetstream_published_total": "counter",
    "cdc_publisher_jetstream_ack_failures_total": "counter",
    "cdc_publisher_publish_retries_total": "counter",
    "cdc_parser_replication_lag_milliseconds": "gauge",
    "cdc_parser_decode_errors_total": "counter",
    "cdc_parser_tx_buffer_size": "gauge",
    "cdc_parser_tx_buffer_overflows_total": "counter",
    "cdc_wal_replication_errors_total": "counter",
    "cdc_engine_events_per_second": "gauge",
}


class Registry:
    """Driver-side values of SERIES, rendered in the text exposition format."""

    def __init__(self) -> None:
        self.values = {k: 0.0 for k, kind in SERIES.items() if kind != "histogram"}
        bounds = {"cdc_engine_batch_latency_microseconds": BATCH_MICROS, "cdc_engine_transform_latency_nanoseconds": TRANSFORM_NANOS}
        self.histograms = {k: {"bounds": b, "counts": [0] * (len(b) + 1), "sum": 0.0} for k, b in bounds.items()}

    def add(self, name: str, n: float = 1.0) -> None:
        self.values[name] += n

    def put(self, name: str, value: float) -> None:
        self.values[name] = value

    def observe(self, name: str, value: float) -> None:
        h = self.histograms[name]
        h["counts"][next((i for i, b in enumerate(h["bounds"]) if value <= b), len(h["bounds"]))] += 1
        h["sum"] += value

    def text(self) -> str:
        out = []
        for name, kind in SERIES.items():
            out.append(f"# TYPE {name} {kind}")
            if kind != "histogram":
                out.append(f"{name} {self.values[name]:g}")
                continue
            h, total = self.histograms[name], 0
            for b, n in zip([*h["bounds"], "+Inf"], h["counts"]):
                total += n
                out.append(f'{name}_bucket{{le="{b}"}} {total}')
            out += [f"{name}_sum {h['sum']:g}", f"{name}_count {total}"]
        return "\n".join(out) + "\n"
