"""Order-dependent values of a log: sequence in transaction, batches, positions.

Each is a window over one transaction, so a cluster works on all transactions at once; only those that are global
by nature (the acknowledged position, flush throttling) work per stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def sequenced(log: DataFrame, tx: str = "txid", order: str = "ordinal") -> DataFrame:
    """log with seq, zero-based within the transaction. Filter tables first: only what is emitted is counted."""
    return log.withColumn("seq", (F.row_number().over(Window.partitionBy(tx).orderBy(order)) - 1).cast("long"))


def batch_in_tx(seq: Column, batch_size: int) -> Column:
    """Number of the flush, within its transaction, that publishes an event: a flush at batch_size events, markers included."""
    return F.floor((seq + 1) / batch_size).cast("long") if batch_size > 0 else F.lit(0).cast("long")


def with_commit(rows: DataFrame, commits: DataFrame, tx: str = "txid") -> DataFrame:
    """rows with their transaction's commit_lsn, position and commit_time; rows without a commit stay buffered (absent)."""
    from tidelog.functions.lsn import checkpoint_position

    c = commits.select(tx, "commit_lsn", checkpoint_position(F.col("commit_lsn"), F.col("end_lsn")).alias("position"), "commit_time")
    return rows.join(c, tx)


#: Parts of what comes after the last definition of all.
AFTER = 64


def relation_as_of(rows: DataFrame, relations: DataFrame, key: str = "rel", order: str = "ordinal") -> DataFrame:
    """rows with the columns of the last definition of their relation at or before them; rows of unknown relations go.

    relations (key, order, definition columns) is a history of table definitions; a null order is before all others. order is a
    number, or a struct whose first field is one. The span of the definitions is cut into as many ranges as there are definitions;
    rows and definitions of a key and range are sorted together, and each range begins with the definition that holds there. So the
    work is a sort, however often a relation is sent, and no row is compared with all definitions. The history is stored once.
    """
    from tidelog.plans.folders import stored

    cols, kind = [c for c in relations.columns if c not in (key, order)], relations.schema[order].dataType
    relations = stored(relations, "definitions")
    place = F.col(order)[kind.fields[0].name] if isinstance(kind, StructType) else F.col(order)
    low, high, n = relations.agg(F.min(place), F.max(place), F.count(F.lit(1))).first()
    low, high = (0, 0) if low is None else (low, high)
    width = (high - low) // max(1, n) + 1
    steps = (high - low) // width + 1
    # what comes after all definitions needs no order and is dealt evenly
    part = F.when(place > high, steps + F.pmod(F.xxhash64(order), F.lit(AFTER))).otherwise(F.greatest(F.floor((place - low) / F.lit(width)), F.lit(0))).cast("long")
    definition = F.struct(*cols)
    begun = relations.select(key, order, F.when(place.isNull(), F.lit(-1)).otherwise(part).cast("long").alias("_part"), definition.alias("_definition"))
    until = F.coalesce(F.lead("_part").over(Window.partitionBy(key).orderBy(F.col(order).asc_nulls_first())), F.lit(steps + AFTER - 1))
    carried = begun.withColumn("_until", until).where("_part < _until").select(key, F.explode(F.sequence(F.col("_part") + 1, F.col("_until"))).alias("_part"), "_definition")
    both = rows.withColumns({"_part": part, "_row": F.lit(True)})
    for more in (begun.where(F.col(order).isNotNull()), carried):
        both = both.unionByName(more.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(key, "_part").orderBy(F.col(order).asc_nulls_first(), "_row").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_definition", F.last("_definition", ignorenulls=True).over(w)).where("_row and _definition is not null")
    return found.select(*rows.columns, "_definition.*")


def truncations(rows: DataFrame, rels: str = "rels") -> DataFrame:
    """One row for each relation of a truncation, in the listed order (place)."""
    return rows.select("*", F.posexplode(rels).alias("place", "rel")).drop(rels)


def contiguous(results: DataFrame, batch: str = "batch", order: str = "idx") -> DataFrame:
    """For each batch: total, succeeded, failed, failed_idx and the position of the last item before the first failure."""
    before = Window.partitionBy(batch).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    r = results.withColumn("_failed", F.sum(F.when(F.col("ok"), 0).otherwise(1)).over(before))
    return r.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col(order)))).alias("failed_idx"),
        F.max_by("position", F.when(F.col("_failed") == 0, F.col(order))).alias("last_position"),
    )


def acked_positions(acks: DataFrame, stream: str, order: str, position: str) -> DataFrame:
    """acks with acked: the greatest position so far in each stream; a late smaller one doesn't move it back."""
    w = Window.partitionBy(stream).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return acks.withColumn("acked", F.max(position).over(w))


def throttled_flushes(acks: DataFrame, stream: str, interval_ms: int) -> DataFrame:
    """The acknowledgements (stream, at, position; at in ms) that flush a checkpoint: the first, then each that comes at
    least interval_ms after the last flush. Greedy and sequential, so each stream is one task's state."""

    def run(batches):
        import pyarrow as pa

        table = batches.sort_by([("at", "ascending"), ("position", "ascending")])
        last, keep = None, []
        for at, position in zip(table.column("at").to_pylist(), table.column("position").to_pylist()):
            if last is None or at - last >= interval_ms:
                last = at
                keep.append((at, position))
        key = table.column(stream)[:1].to_pylist() * len(keep)
        return pa.table({stream: pa.array(key, table.column(stream).type), "at": pa.array([a for a, _ in keep], pa.int64()), "position": pa.array([p for _, p in keep], pa.int64())})

    kind = dict(acks.dtypes)[stream]
    return acks.select(stream, "at", "position").groupBy(stream).applyInArrow(run, f"{stream} {kind}, at long, position long")
