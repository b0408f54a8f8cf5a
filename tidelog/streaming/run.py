"""Streaming runs: transform, publish with a failure policy, checkpoint after both sinks are written."""

from __future__ import annotations

import inspect
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.config import Config
from tidelog.operators.metrics import Registry
from tidelog.operators.normalize import normalize, publishable, serialized
from tidelog.operators.publish import DELIVERED, Client, ack_tally, dead_letters, deliver, ordered, poison_error, split_by_policy


class BatchStore:
    """A Parquet sink whose rows lie under their batch's number: a repeated batch replaces what it wrote before."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark, schema: str) -> DataFrame:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(self.path)


class PublishError(Exception):
    """A batch wasn't delivered whole; its offset isn't committed, so it is repeated with the same ids."""


class Delivery:
    """A sink that hands rows to each task's client and keeps their fates by batch number.

    What can't be delivered at all is dead-lettered or skipped by policy; any other failure fails the batch. When a batch is
    repeated, only what isn't acknowledged in the stored results is sent again.
    """

    def __init__(self, client: Callable[[], Client], config: Config, path: str, letters: Callable[[DataFrame, int], None], wait=None, registry: Registry | None = None):
        self.client, self.config, self.results, self.letters, self.registry = client, config, path.rstrip("/"), letters, registry
        self.wait = wait

    def _attempts(self, spark, batch_id: int) -> list[str]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.results}/batch={batch_id}")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return sorted(str(f.getPath()) for f in files.listStatus(path)) if files.exists(path) else []

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark, c = rows.sparkSession, self.config
        done = self._attempts(spark, batch_id)
        todo = rows
        if done:
            todo = rows.join(spark.read.schema(DELIVERED).parquet(*done).where("outcome in ('acked', 'permanent')").select("event_id"), "event_id", "left_anti")
        more = {} if self.wait is None else {"wait": self.wait}
        sent = deliver(todo, self.client, c.max_publish_retries, c.nats_timeout, not c.unsafe_unordered_async_publish, c.max_pending, **more)
        path = f"{self.results}/batch={batch_id}/try={len(done):06d}"
        sent.write.parquet(path)
        sent = spark.read.schema(DELIVERED).parquet(path)
        tally = ack_tally(sent).first()
        poison = sent.where("outcome = 'permanent'")
        stuck = sent.where("outcome in ('transient', 'held')" + (" or outcome = 'permanent'" if c.publish_failure_policy in ("", "crash") else ""))
        if self.registry is not None:
            self.registry.add("cdc_publisher_jetstream_published_total", tally.acked)
            self.registry.add("cdc_publisher_jetstream_ack_failures_total", tally.failed)
            self.registry.add("cdc_publisher_publish_retries_total", tally.retries)
        if c.publish_failure_policy == "dlq":
            lost = rows.join(poison.select("event_id", "error"), "event_id")
            if not poison.isEmpty():
                self.letters(dead_letters(lost, c.dlq_subject_prefix, c.database), batch_id)
        if self.registry is not None and c.publish_failure_policy in ("dlq", "skip"):
            self.registry.add("cdc_engine_events_quarantined_total", poison.count())
        first = stuck.orderBy(F.col("outcome") == "held", "subject", "event_id").select("event_id", "error").first()
        if first is not None:
            if self.registry is not None:
                self.registry.add("cdc_engine_partial_batch_failures_total")
            raise PublishError(f"publish failed: {first.event_id}: {first.error}")


def publish_batch(
    events: DataFrame,
    config: Config,
    sink: Callable[[DataFrame, int], None],
    letters: Callable[[DataFrame, int], None],
    max_bytes: int = 1 << 20,
    batch_id: int = 0,
    registry: Registry | None = None,
) -> None:
    """One micro-batch: normalize, split off poison events, write the dead letters first and then the rest, in order by subject.

    The sinks get the batch's number, by which a repeated batch replaces its rows. Spark commits the batch's offset when this
    returns, so a failure of either sink leaves the checkpoint where it was; the batch is then repeated with the same ids. The
    serialized batch is kept for both sinks (on disk where memory is short), so that it is made once.
    """
    policy = config.publish_failure_policy or "crash"
    began = time.time()
    out = serialized(normalize(publishable(events), config.database))
    out = out.withColumn("error", poison_error(F.col("payload"), F.col("subject"), max_bytes)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, poison = split_by_policy(out, policy)
        if policy == "dlq":
            letters(dead_letters(poison, config.dlq_subject_prefix, config.database), batch_id)
        good = good.drop("error")
        sink(good if config.unsafe_unordered_async_publish else ordered(good), batch_id)
        if registry is not None:
            n = out.agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("bad"), F.max(F.unix_millis("commit_time")).alias("at")).first()
            if policy != "crash":
                registry.add("cdc_engine_events_quarantined_total", n.bad)
            registry.put("cdc_parser_tx_buffer_size", 0)
            if n.n:
                registry.observe("cdc_engine_transform_latency_nanoseconds", 1e9 * (time.time() - began) / n.n)
            if n.at is not None:
                registry.put("cdc_parser_replication_lag_milliseconds", int(time.time() * 1000) - n.at)
    finally:
        out.unpersist()


def start(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame] | Callable[[DataFrame, int], DataFrame],
    config: Config,
    sink: Callable[[DataFrame, int], None],
    letters: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    registry: Registry | None = None,
):
    """Runs publish_batch over a stream of whole transactions (transform runs on a plain batch, so windows are allowed). A
    transform of two arguments gets the batch's number as well, for a RelationStore."""
    numbered = len(inspect.signature(transform).parameters) > 1

    def run(batch: DataFrame, batch_id: int) -> None:
        events = transform(batch, batch_id) if numbered else transform(batch)
        publish_batch(events, config, sink, letters, batch_id=batch_id, registry=registry)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{int(config.batch_timeout * 1000)} milliseconds")
    return writer.start()


def shut_down(query, seconds: float = 30.0) -> bool:
    """Stops a run between two batches, so that what was begun is published and committed; whether that took at most seconds.

    A batch that takes longer is cut off; its offset isn't committed and the next start repeats it.
    """
    end = time.time() + seconds
    while query.isActive and query.status["isTriggerActive"] and time.time() < end:
        time.sleep(0.05)
    whole = not (query.isActive and query.status["isTriggerActive"])
    query.stop()
    return whole


def deduplicated(stream: DataFrame, key: str, at: str, window: str = "2 minutes") -> DataFrame:
    """Duplicates of an id within the window are dropped; the state of older ids goes with the watermark."""
    return stream.withWatermark(at, window).dropDuplicatesWithinWatermark([key])


class Observer(StreamingQueryListener):
    """Keeps a Registry up to date from a query's progress."""

    def __init__(self, registry: Registry | None = None):
        self.registry = registry or Registry()
        self.ready = False

    def onQueryStarted(self, event) -> None:
        self.ready = True

    def onQueryProgress(self, event) -> None:
        p, r = event.progress, self.registry
        r.add("cdc_engine_events_total", p.numInputRows)
        r.put("cdc_engine_events_per_second", p.processedRowsPerSecond or 0.0)
        if p.numInputRows:
            r.add("cdc_engine_batches_published_total")
            r.observe("cdc_engine_batch_latency_microseconds", 1000.0 * (p.durationMs or {}).get("triggerExecution", 0))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ready = False
        fault = event.exception or ""
        if "malformed change message" in fault or "cut short" in fault:
            self.registry.add("cdc_parser_decode_errors_total")
        if "ReplicationError" in fault:
            self.registry.add("cdc_wal_replication_errors_total")


def readiness(checks: dict[str, str]) -> tuple[int, str]:
    """(status, text) of a readiness probe: 503 with the failures joined, else 200. checks: name -> failure or empty."""
    failed = [f"{k}: {v}" for k, v in checks.items() if v]
    return (503, "; ".join(failed)) if failed else (200, "ok")
