"""Publishing: poison events, failure policies, dead letters, ordered and unordered delivery with retries and acknowledgements."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.names import dead_letter_subject, payload_prefix

#: Publish errors that no retry mends; every other error is transient.
PERMANENT = ("max payload", "bad subject", "10054")


def is_permanent(error: Column) -> Column:
    return F.coalesce(error.isin(*PERMANENT), F.lit(False))


def poison_error(payload: Column, subject: Column, max_bytes: int) -> Column:
    """Why an event can never be published, or null: its payload is too large or its subject isn't one."""
    bad = subject.isNull() | subject.rlike(r"[\s*>]") | subject.rlike(r"(^|\.)(\.|$)")
    return F.when(F.octet_length(payload) > max_bytes, F.lit("max payload")).when(bad, F.lit("bad subject"))


def dead_letters(poison: DataFrame, prefix: str, database: str, at: Column | None = None) -> DataFrame:
    """Dead-letter records of poison events (with error, payload, lsn_num optional)."""
    c = F.col
    return poison.select(
        "event_id",
        dead_letter_subject(F.lit(prefix), F.lit(database), c("schema"), c("table")).alias("subject"),
        F.lit(database).alias("database"),
        "schema",
        "table",
        "operation",
        "lsn",
        "txid",
        "error",
        *payload_prefix(c("payload")),
        (F.current_timestamp() if at is None else at).alias("quarantined_at"),
        F.when(c("event_id").isNotNull(), F.concat(F.lit("dlq-"), c("event_id"))).alias("msg_id"),
    )


def split_by_policy(events: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """(to publish, to quarantine) of events with error (null: none). Transient errors always stop the batch, permanent ones
    with the crash policy; dlq and skip take poison events out and go on."""
    if policy not in ("crash", "dlq", "skip"):
        raise ValueError(f"no such policy: {policy}")
    stops = F.col("error").isNotNull() & ((F.lit(policy) == "crash") | ~is_permanent(F.col("error")))
    good = events.where(F.col("error").isNull() | stops)
    good = good.withColumn("event_id", F.when(stops, F.raise_error(F.concat(F.lit("publish failed: "), "error"))).otherwise(F.col("event_id")))
    return good, events.where(F.col("error").isNotNull() & ~stops)


def ordered(events: DataFrame, key: str = "subject", order: tuple[str, ...] = ("lsn_num", "seq"), partitions: int | None = None) -> DataFrame:
    """events so that a writer's task sees each key's in order. Keys of one stream order can't be split: use order only where needed."""
    dealt = events.repartition(partitions, key) if partitions else events.repartition(key)
    return dealt.sortWithinPartitions(key, *order)


def with_retries(send: Callable[[], None], attempts: int, permanent: Callable[[Exception], bool], wait: Callable[[float], None] = time.sleep) -> int:
    """Calls send until it succeeds, attempts more times at most; a permanent error isn't tried again. Returns the retries."""
    for n in range(attempts + 1):
        try:
            send()
            return n
        except Exception as e:
            if permanent(e) or n == attempts:
                raise
            wait(min(2.0**n, 8.0))
    return attempts


class PermanentError(Exception):
    """What a client raises for a message that no retry can deliver."""


def permanent_error(error: Exception) -> bool:
    return isinstance(error, PermanentError) or str(error) in PERMANENT


class Client:
    """What a task delivers to. send() hands over a batch and returns an acknowledgement for each message: a callable that waits
    timeout seconds at most and raises what went wrong. Message ids let a broker drop what it got before."""

    def send(self, messages: list[tuple[str, str, str]]) -> list[Callable[[float], None]]:
        """messages: (subject, payload, message id)."""
        raise NotImplementedError

    def ready(self) -> str:
        """Why nothing can be delivered, or an empty text."""
        return ""

    def close(self) -> None:
        pass


class NoopClient(Client):
    """Acknowledges everything and keeps the last subject alone; it is never ready, so that a probe shows it."""

    last_subject = ""

    def send(self, messages):
        self.last_subject = messages[-1][0] if messages else self.last_subject
        return [lambda timeout: None for _ in messages]

    def ready(self) -> str:
        return "noop publisher: nothing is published"


class FolderClient(Client):
    """Writes each task's messages as a file of JSON lines to a folder that all executors share. The file gets its name when the
    client is closed, so a task that fails leaves none."""

    def __init__(self, path: str):
        self.path, self.lines = path.rstrip("/"), []

    def send(self, messages):
        self.lines += [json.dumps({"subject": s, "payload": p, "msg_id": m}) for s, p, m in messages]
        return [lambda timeout: None for _ in messages]

    def close(self) -> None:
        from pyarrow import fs

        if self.lines:
            system, inner = fs.FileSystem.from_uri(self.path)
            system.create_dir(inner, recursive=True)
            with system.open_output_stream(f"{inner}/{uuid.uuid4().hex}.json") as f:
                f.write(("\n".join(self.lines) + "\n").encode())
            self.lines = []


def choose_client(urls: tuple[str, ...], allow_noop: bool, connect: Callable[[tuple[str, ...]], Client] | None = None) -> Callable[[], Client]:
    """What makes a task's client: connect(urls), by default a folder; without urls the noop client, if that is allowed."""
    urls = tuple(u.strip() for u in urls if u.strip())
    if urls:
        return lambda: (connect or (lambda u: FolderClient(u[0])))(urls)
    if not allow_noop:
        raise ValueError("a publisher's url is missing, and the noop publisher isn't allowed")
    return NoopClient


#: A message's fate. place: its number among the task's messages of its subject that were acknowledged; outcome: acked,
#: permanent, transient, or held (an earlier message of its subject wasn't delivered).
DELIVERED = "event_id string, subject string, place long, tries int, outcome string, error string"


def _deliver_ordered(client: Client, rows: list, retries: int, timeout: float, wait, places: dict, stopped: set) -> Iterator[tuple]:
    """One message at a time, each tried again until it is acknowledged; after one that isn't, its subject's later ones are held."""
    for event_id, subject, payload, msg_id in rows:
        if subject in stopped:
            yield event_id, subject, None, 0, "held", "an earlier message of the subject wasn't delivered"
            continue
        tries, fault = 0, None

        def send():
            nonlocal tries
            tries += 1
            client.send([(subject, payload, msg_id)])[0](timeout)

        try:
            with_retries(send, retries, permanent_error, wait)
        except Exception as e:
            fault = e
        if fault is None:
            places[subject] = places.get(subject, 0) + 1
            yield event_id, subject, places[subject] - 1, tries, "acked", None
            continue
        poison = permanent_error(fault)
        if not poison:
            stopped.add(subject)
        yield event_id, subject, None, tries, "permanent" if poison else "transient", str(fault)


def _deliver_unordered(client: Client, rows: list, retries: int, timeout: float, wait, places: dict) -> Iterator[tuple]:
    """All at once, then those that weren't acknowledged again; a message that can't be delivered isn't tried again."""
    todo, faults = rows, {}
    for n in range(retries + 1):
        if n:
            wait(min(2.0 ** (n - 1), 8.0))
        try:
            acks = client.send([r[1:] for r in todo])
        except Exception as e:
            fault = e

            def failed(timeout, fault=fault):
                raise fault

            acks = [failed] * len(todo)
        again = []
        for row, ack in zip(todo, acks):
            try:
                ack(timeout)
                places[row[1]] = places.get(row[1], 0) + 1
                yield row[0], row[1], places[row[1]] - 1, n + 1, "acked", None
            except Exception as e:
                if permanent_error(e):
                    yield row[0], row[1], None, n + 1, "permanent", str(e)
                else:
                    faults[id(row)] = str(e)
                    again.append(row)
        todo = again
        if not todo:
            return
    for row in todo:
        yield row[0], row[1], None, retries + 1, "transient", faults[id(row)]


def deliver(events: DataFrame, client: Callable[[], Client], retries: int = 3, timeout: float = 5.0, in_order: bool = True, batch: int = 256, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """DELIVERED rows of events (event_id, subject, payload; lsn_num and seq in order): each task makes a client and delivers its rows.

    In order, a subject's events lie in one task, sorted by position and sequence. The result is to be saved before it is looked
    at, as reading it anew delivers anew; message ids make that harmless with a client that knows them.
    """
    dealt = ordered(events) if in_order else events

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, places, stopped = None, {}, set()
        names = [f.split()[0] for f in DELIVERED.split(", ")]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())
        for b in batches:
            c = c or client()
            rows = list(zip(*(x.to_pylist() for x in b.columns)))
            done: list[tuple] = []
            for at in range(0, len(rows), batch):
                some = rows[at : at + batch]
                done += _deliver_ordered(c, some, retries, timeout, wait, places, stopped) if in_order else _deliver_unordered(c, some, retries, timeout, wait, places)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(list(zip(*done)) or [[]] * 6, kinds)], names=names)
        if c is not None:
            c.close()

    return dealt.select("event_id", "subject", "payload", F.col("event_id").alias("msg_id")).mapInArrow(run, DELIVERED)


def ack_tally(delivered: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """by, acked, failed, retries: counts over DELIVERED rows, combined before the shuffle."""
    return delivered.groupBy(*by).agg(
        F.count_if(F.col("outcome") == "acked").alias("acked"), F.count_if(F.col("outcome") != "acked").alias("failed"), F.coalesce(F.sum(F.greatest(F.col("tries") - 1, F.lit(0))), F.lit(0)).alias("retries")
    )


def ensure_table(spark, path: str, wanted: dict[str, str]) -> None:
    """Makes a sink's description at path if there is none, and fails if the one there differs."""
    if not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        spark.createDataFrame(sorted(wanted.items()), "k string, v string").coalesce(1).write.json(path)
    there = {r.k: r.v for r in spark.read.schema("k string, v string").json(path).collect()}
    differ = sorted(k for k in {*wanted, *there} if wanted.get(k) != there.get(k))
    if differ:
        raise ValueError(f"the sink at {path} differs in {', '.join(differ)}")
