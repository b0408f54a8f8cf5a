"""A deterministic change log from an events table, and its rendering in both wire formats.

Seven events make a transaction; of ten events six are inserts, three updates and one is a delete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DATABASE, SCHEMA = "shop", "public"
EPOCH_2000 = 946684800


def changes(events: DataFrame) -> DataFrame:
    """ordinal, txid, op, table, lsn_num, ts, commit_time and the row's columns (id, user_id, value, props)."""
    rest = F.col("event_id") % 10
    rows = events.select(
        F.col("event_id").alias("ordinal"),
        (1000 + F.floor(F.col("event_id") / F.lit(7.0)).cast("long")).alias("txid"),
        F.when(rest < 6, "INSERT").when(rest < 9, "UPDATE").otherwise("DELETE").alias("op"),
        F.lit(SCHEMA).alias("schema"),
        F.col("event_type").alias("table"),
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "value",
        "props",
    )
    of_tx = Window.partitionBy("txid")
    return rows.withColumns(
        {"lsn_num": 23803648 + F.col("txid") * 256, "commit_time": F.max("ts").over(of_tx)}
    )


def _triple(name: str, kind: str, value: Column) -> Column:
    return F.concat(F.lit(f'{{"name":"{name}","type":"{kind}","value":'), F.coalesce(value, F.lit("null")), F.lit("}"))


def as_json_messages(log: DataFrame) -> DataFrame:
    """plugin, wal_start, ordinal, data: one JSON message (format version 2) for each change."""
    number = lambda c: F.col(c).cast("string")
    text = lambda c: F.regexp_replace(F.to_json(F.struct(F.col(c).alias("x"))), r'^\{"x":(.*)\}$', "$1")
    row = F.concat_ws(",", _triple("id", "bigint", number("ordinal")), _triple("user_id", "bigint", number("user_id")), _triple("value", "double precision", number("value")), _triple("props", "text", text("props")))
    key = _triple("id", "bigint", number("ordinal"))
    data = F.concat(
        F.lit('{"action":"'),
        F.substring("op", 1, 1),
        F.lit('","xid":'),
        number("txid"),
        F.lit(',"timestamp":"'),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.lit('+00","schema":"'),
        F.col("schema"),
        F.lit('","table":"'),
        F.col("table"),
        F.lit('"'),
        F.when(F.col("op") != "DELETE", F.concat(F.lit(',"columns":['), row, F.lit("]"))).otherwise(F.lit("")),
        F.when(F.col("op") != "INSERT", F.concat(F.lit(',"identity":['), key, F.lit("]"))).otherwise(F.lit("")),
        F.lit("}"),
    )
    from tidelog.functions.lsn import lsn_text

    return log.select(F.lit("wal2json").alias("plugin"), lsn_text(F.col("lsn_num")).alias("wal_start"), "ordinal", data.alias("data"))


def _int(value: Column, bytes_: int) -> Column:
    return F.unhex(F.substring(F.lpad(F.hex(value.cast("long")), 16, "0"), 17 - 2 * bytes_, 2 * bytes_))


def _text(value: Column) -> Column:
    raw = F.encode(value, "utf-8")
    return F.when(value.isNull(), F.encode(F.lit("n"), "utf-8")).otherwise(F.concat(F.encode(F.lit("t"), "utf-8"), _int(F.octet_length(value), 4), raw))


#: The wire's numbers of the columns' types (bigint, double precision, text).
OIDS = {"id": 20, "user_id": 20, "value": 701, "props": 25}


#: A table's relation changes (its columns are sent in another order) every so many events.
RELATION_EPOCH = 400


def as_binary_messages(log: DataFrame, truncated: DataFrame | None = None) -> DataFrame:
    """plugin, txid, ordinal, step, data: each transaction's Begin, its rows and Commit, as a stream sends them.

    A table's Relation stands once before its first row, and again where it changes: every RELATION_EPOCH events its columns
    change places. Relation numbers are crc32 of the table's name. Order is (ordinal, step). truncated (txid, ordinal, tables)
    adds a Truncate of the listed tables after the row of that ordinal.
    """
    ascii_ = lambda x: F.encode(F.lit(x), "utf-8")
    number = lambda t: _int(F.crc32(F.encode(t, "utf-8")) % (1 << 31), 4)
    rel, nul = number(F.col("table")), F.lit(b"\x00")
    epoch = F.floor(F.col("ordinal") / F.lit(float(RELATION_EPOCH))) % 2
    orders = [list(OIDS), ["id", "props", "value", "user_id"]]
    by_epoch = lambda made: F.when(epoch == 0, made(orders[0])).otherwise(made(orders[1]))
    text = {"id": _text(F.col("ordinal").cast("string"))} | {c: _text(F.col(c).cast("string")) for c in OIDS if c != "id"}
    cells = by_epoch(lambda names: F.concat(_int(F.lit(4), 2), *[text[c] for c in names]))
    key = F.concat(_int(F.lit(4), 2), text["id"], *[ascii_("n")] * 3)
    row = (
        F.when(F.col("op") == "INSERT", F.concat(ascii_("I"), rel, ascii_("N"), cells))
        .when(F.col("op") == "UPDATE", F.concat(ascii_("U"), rel, ascii_("K"), key, ascii_("N"), cells))
        .otherwise(F.concat(ascii_("D"), rel, ascii_("K"), key))
    )
    column = lambda c: F.concat(F.lit(b"\x01" if c == "id" else b"\x00"), ascii_(c), nul, _int(F.lit(OIDS[c]), 4), F.lit(b"\xff\xff\xff\xff"))
    columns = by_epoch(lambda names: F.concat(*[column(c) for c in names]))
    relation = F.concat(ascii_("R"), rel, F.encode("schema", "utf-8"), nul, F.encode("table", "utf-8"), nul, ascii_("d"), _int(F.lit(4), 2), columns)
    micros = F.unix_micros("commit_time") - EPOCH_2000 * 1000000
    begin = F.concat(ascii_("B"), _int(F.col("lsn_num"), 8), _int(micros, 8), _int(F.col("txid"), 4))
    commit = F.concat(ascii_("C"), nul, _int(F.col("lsn_num"), 8), _int(F.col("lsn_num") + 64, 8), _int(micros, 8))
    tx = log.groupBy("txid", "lsn_num", "commit_time").agg(F.min("ordinal").alias("first"), F.max("ordinal").alias("last"))
    sent = log.groupBy("schema", "table", F.floor(F.col("ordinal") / F.lit(float(RELATION_EPOCH))).alias("_e")).agg(F.min(F.struct("ordinal", "txid")).alias("f"))
    sent = sent.select("schema", "table", F.col("f.ordinal").alias("ordinal"), F.col("f.txid").alias("txid"))
    head = ["txid", F.lit("pgoutput").alias("plugin")]
    out = sent.select(*head, "ordinal", F.lit(1).alias("step"), relation.alias("data"))
    out = out.unionByName(log.select(*head, "ordinal", F.lit(2).alias("step"), row.alias("data")))
    if truncated is not None:
        listed = F.aggregate(F.transform("tables", number), F.lit(b""), lambda a, x: F.concat(a, x))
        data = F.concat(ascii_("T"), _int(F.size("tables"), 4), nul, listed)
        out = out.unionByName(truncated.select(*head, "ordinal", F.lit(3).alias("step"), data.alias("data")))
    out = out.unionByName(tx.select(*head, F.col("first").alias("ordinal"), F.lit(0).alias("step"), begin.alias("data")))
    return out.unionByName(tx.select(*head, F.col("last").alias("ordinal"), F.lit(4).alias("step"), commit.alias("data")))
