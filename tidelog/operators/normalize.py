"""Change events into the normalized envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.names import event_id, event_type, subject


def normalize(events: DataFrame, database: str) -> DataFrame:
    """The envelope's fields, with subject, and what of lsn_num and seq events has, which order it. Markers are left out by the
    caller (publishable)."""
    c = F.col
    order = [n for n in ("lsn_num", "seq") if n in events.columns]
    return events.select(
        event_id(c("lsn"), c("txid"), c("op"), c("schema"), c("table"), c("seq")).alias("event_id"),
        event_type(c("op")).alias("event_type"),
        F.lit(database).alias("source"),
        "timestamp",
        "commit_time",
        "lsn",
        "txid",
        "schema",
        "table",
        c("op").alias("operation"),
        c("old_values").alias("before"),
        c("new_values").alias("after"),
        F.create_map(F.lit("txid"), c("txid").cast("string")).alias("metadata"),
        subject(database, c("schema"), c("table")).alias("subject"),
        *order,
    )


def publishable(events: DataFrame) -> DataFrame:
    """events without the markers, where there are any."""
    for marker in ("begin", "commit"):
        if marker in events.columns:
            events = events.where(~F.coalesce(marker, F.lit(False)))
    return events


ENVELOPE = ["event_id", "event_type", "source", "timestamp", "commit_time", "lsn", "txid", "schema", "table", "operation", "before", "after", "metadata"]


def _in_key_order(image: str):
    keys = F.array_sort(F.map_keys(image))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.col(image), k)))


def _time(name: str):
    """A time with no more digits of a second than it needs; no time is the first day of the first year."""
    fraction = F.regexp_replace(F.date_format(name, ".SSSSSS"), r"\.?0+$", "")
    return F.coalesce(F.concat(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z")), F.lit("0001-01-01T00:00:00Z"))


#: Characters that the envelope's text escapes, which can only stand within its strings.
ESCAPES = {"<": "\\u003c", ">": "\\u003e", "&": "\\u0026", "\u2028": "\\u2028", "\u2029": "\\u2029"}


def serialized(normalized: DataFrame) -> DataFrame:
    """normalized with payload, the envelope as JSON: fields in their order, images with sorted names and their nulls, no empty
    images, times in UTC (the session's zone)."""
    def shown(n: str):
        if n in ("before", "after"):
            return F.when(F.size(n) > 0, _in_key_order(n)).alias(n)
        return (_time(n) if n in ("timestamp", "commit_time") else F.col(n)).alias(n)

    payload = F.to_json(F.struct(*[shown(n) for n in ENVELOPE]))
    for c, escaped in ESCAPES.items():
        payload = F.replace(payload, F.lit(c), F.lit(escaped))
    return normalized.withColumn("payload", payload)
