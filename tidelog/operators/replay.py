"""Replays: de-duplication within a window, gaps, retention, current state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_window(deliveries: DataFrame, key: str, at: str, window_s: int) -> DataFrame:
    """The deliveries that a broker with a duplicate window keeps: one whose id was last kept more than window_s before.

    Greedy and sequential for each id, over the (few) deliveries of one id as an array, without leaving the JVM.
    """
    per = deliveries.groupBy(key).agg(F.array_sort(F.collect_list(F.unix_micros(at))).alias("t"))
    kept = F.aggregate(
        "t",
        F.array().cast("array<bigint>"),
        lambda a, t: F.when((F.size(a) == 0) | (t - F.element_at(a, -1) > window_s * 1000000), F.concat(a, F.array(t))).otherwise(a),
    )
    return per.select(key, F.explode(kept).alias("micros")).select(key, F.timestamp_micros("micros").alias(at))


def reconcile(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """key and state (missing, duplicate, ok, unexpected) over both runs' keys."""
    e = expected.select(key).distinct().withColumn("e", F.lit(1))
    g = got.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    state = (
        F.when(F.col("n").isNull(), "missing").when(F.col("e").isNull(), "unexpected").when(F.col("n") > 1, "duplicate").otherwise("ok")
    )
    return e.join(g, key, "full").select(key, state.alias("state"), F.coalesce("n", F.lit(0)).alias("n"))


def retained(df: DataFrame, at: str, now, max_age_s: int) -> DataFrame:
    return df.where(F.col(at) > now - F.expr(f"interval {max_age_s} seconds"))


def current_state(log: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """An extension: the last change of each key that isn't a deletion, by a mergeable max_by."""
    value = F.struct(*[c for c in log.columns if c not in key])
    last = log.groupBy(*key).agg(F.max_by(value, F.struct(*order)).alias("v"))
    return last.select(*key, "v.*").where("op <> 'DELETE'")


def history(log: DataFrame, key: tuple[str, ...], order: tuple[str, ...], at: str) -> DataFrame:
    """An extension: log with valid_from and valid_to of each version of a key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return log.withColumns({"valid_from": F.col(at), "valid_to": F.lead(at).over(w)})
