"""JSON change messages (format version 2) into change events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.lsn import lsn_number
from tidelog.functions.times import change_time

_COLUMNS = "array<struct<name:string,type:string,value:variant>>"
MESSAGE = f"action string, xid bigint, timestamp string, schema string, table string, columns {_COLUMNS}, identity {_COLUMNS}, _bad string"
#: Actions and operations; B and C only mark a transaction's ends.
OPERATIONS = {"I": "INSERT", "U": "UPDATE", "D": "DELETE", "T": "DDL"}
MARKERS = ("B", "C")


def _image(columns: str):
    """Name -> value; of repeated names the last counts. Null for no columns."""
    last = F.filter(
        F.col(columns),
        lambda c, i: ~F.exists(F.slice(F.col(columns), i + 2, F.size(columns)), lambda d: d["name"] == c["name"]),
    )
    image = F.map_from_entries(F.transform(last, lambda c: F.struct(c["name"], c["value"])))
    return F.when(F.size(F.coalesce(F.col(columns), F.array())) > 0, image)


def decode(messages: DataFrame, tables: tuple[str, ...] = (), fail: bool = True) -> DataFrame:
    """Change events of messages (plugin, wal_start, ordinal, data).

    Messages of another plugin are dropped, those of none pass; unknown actions are skipped; tables (schema.table; none: all)
    filters rows but never markers. A message that can't be read stops the query, or with fail=False is flagged in malformed.
    """
    m = messages.where(F.coalesce("plugin", F.lit("")).isin("wal2json", ""))
    m = m.withColumn("m", F.from_json(F.col("data").cast("string"), MESSAGE, {"columnNameOfCorruptRecord": "_bad"}))
    time, bad_time = change_time(F.col("m.timestamp"))
    malformed = F.col("m._bad").isNotNull() | bad_time
    if fail:
        malformed = F.when(malformed, F.raise_error(F.concat(F.lit("malformed change message: "), F.col("data").cast("string")))).otherwise(F.lit(False))
    e = m.select("ordinal", "wal_start", "m.*", time.alias("time"), malformed.alias("malformed"))
    wanted = F.col("action").isin(*OPERATIONS, *MARKERS) | F.col("malformed")
    if tables:
        wanted &= F.col("action").isin(*MARKERS) | F.col("malformed") | F.concat_ws(".", "schema", "table").isin(*tables)
    op = F.create_map(*[F.lit(x) for kv in OPERATIONS.items() for x in kv])
    return e.where(wanted).select(
        "ordinal",
        F.col("wal_start").alias("lsn"),
        lsn_number(F.col("wal_start")).alias("lsn_num"),
        F.col("xid").alias("txid"),
        F.lit(0).cast("long").alias("seq"),
        F.col("time").alias("timestamp"),
        F.col("time").alias("commit_time"),
        F.try_element_at(op, F.col("action")).alias("op"),
        (F.col("action") == "B").alias("begin"),
        (F.col("action") == "C").alias("commit"),
        "schema",
        "table",
        F.when(F.col("action").isin("U", "D"), _image("identity")).alias("old_values"),
        F.when(F.col("action").isin("I", "U"), _image("columns")).alias("new_values"),
        "malformed",
    )
