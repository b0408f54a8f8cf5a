"""Binary change messages: rows and relations decoded in Arrow batches, the rest on the JVM.

A stream sends a table's Relation once and again when it changes, in whichever transaction comes first. So the relations of the
whole log are a history, and each row gets the definition that holds at its place, by a sort of rows and definitions together
(relation_as_of). A micro-batch gets the definitions of earlier ones (RelationStore).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.lsn import lsn_text
from tidelog.operators.transactions import relation_as_of
from tidelog.sources.changes import EPOCH_2000

_CELL = pa.struct([("kind", pa.string()), ("text", pa.string())])
_TUPLE = pa.list_(_CELL)
#: (field, Arrow type, SQL type) of a decoded message.
FIELDS = [
    ("tag", pa.string(), "string"),
    ("xid", pa.int64(), "long"),
    ("commit_lsn", pa.int64(), "long"),
    ("end_lsn", pa.int64(), "long"),
    ("commit_micros", pa.int64(), "long"),
    ("rel", pa.int64(), "long"),
    ("rels", pa.list_(pa.int64()), "array<long>"),
    ("schema", pa.string(), "string"),
    ("table", pa.string(), "string"),
    ("columns", pa.list_(pa.string()), "array<string>"),
    ("oids", pa.list_(pa.int64()), "array<long>"),
    ("old_tuple", _TUPLE, "array<struct<kind:string,text:string>>"),
    ("new_tuple", _TUPLE, "array<struct<kind:string,text:string>>"),
]


def _zero_ended(data: bytes, at: int) -> tuple[str, int]:
    end = data.index(b"\0", at)
    return data[at:end].decode(), end + 1


def _cells(data: bytes, at: int) -> tuple[list[dict], int]:
    (n,), at, out = struct.unpack_from(">H", data, at), at + 2, []
    for _ in range(n):
        kind, at, text = chr(data[at]), at + 1, None
        if kind not in "nu":
            (size,) = struct.unpack_from(">I", data, at)
            text, at = data[at + 4 : at + 4 + size].decode("utf-8", "replace"), at + 4 + size
        out.append({"kind": kind, "text": text})
    return out, at


def parse(data: bytes) -> dict:
    """The fields of one message; types that carry nothing here have only their tag. A message that is cut short raises."""
    tag, m = chr(data[0]), {}
    if tag == "B":
        m["commit_lsn"], micros, m["xid"] = struct.unpack_from(">QqI", data, 1)
        m["commit_micros"] = micros + EPOCH_2000 * 1000000
    elif tag == "C":
        m["commit_lsn"], m["end_lsn"], micros = struct.unpack_from(">QQq", data, 2)
        m["commit_micros"] = micros + EPOCH_2000 * 1000000
    elif tag == "R":
        (m["rel"],) = struct.unpack_from(">I", data, 1)
        m["schema"], at = _zero_ended(data, 5)
        m["table"], at = _zero_ended(data, at)
        (n,) = struct.unpack_from(">H", data, at + 1)
        at, m["columns"], m["oids"] = at + 3, [], []
        for _ in range(n):
            name, at = _zero_ended(data, at + 1)
            m["columns"].append(name)
            m["oids"].append(struct.unpack_from(">I", data, at)[0])
            at += 8
    elif tag in "IUD":
        (m["rel"],) = struct.unpack_from(">I", data, 1)
        at = 5
        while at < len(data):
            which = chr(data[at])
            cells, at = _cells(data, at + 1)
            m["new_tuple" if which == "N" else "old_tuple"] = cells
    elif tag == "T":
        n, _ = struct.unpack_from(">IB", data, 1)
        m["rels"] = list(struct.unpack_from(f">{n}I", data, 6))
    return m | {"tag": tag}


class _Odd(Exception):
    """A batch has a message that parse() alone reads (or refuses)."""


def _big_endian(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(at), np.int64)
    for i in range(size):
        out = out << 8 | data[at + i]
    return out


def _tuples(data: np.ndarray, at: np.ndarray, end: np.ndarray):
    """The tuples that begin at these places: (columns of each, kind, start and size of each cell, size -1: no text), and where they end."""
    if (at + 2 > end).any():
        raise _Odd
    n, at = _big_endian(data, at, 2), at + 2
    base, total = np.cumsum(n) - n, int(n.sum())
    kind, start, size = np.empty(total, np.uint8), np.zeros(total, np.int64), np.full(total, -1)
    for j in range(int(n.max(initial=0))):
        i = np.flatnonzero(n > j)
        if (at[i] + 1 > end[i]).any():
            raise _Odd
        kind[base[i] + j] = k = data[at[i]]
        at[i] += 1
        i = i[(k != ord("n")) & (k != ord("u"))]
        if (at[i] + 4 > end[i]).any():
            raise _Odd
        size[base[i] + j] = z = _big_endian(data, at[i], 4)
        start[base[i] + j] = at[i] + 4
        at[i] += 4 + z
        if (at[i] > end[i]).any():
            raise _Odd
    if (kind > 127).any():
        raise _Odd
    return (n, kind, start, size), at


def _lists(data: np.ndarray, rows: int, found: list[tuple]) -> pa.Array:
    """A tuple for each row, null where found (row numbers, what _tuples gave) has none."""
    at = np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)])
    if len(np.unique(at)) < len(at):
        raise _Odd
    n = np.concatenate([f[1][0] for f in found] or [np.empty(0, np.int64)])
    kind, start, size = (np.concatenate([f[1][i] for f in found] or [np.empty(0, t)]) for i, t in ((1, np.uint8), (2, np.int64), (3, np.int64)))
    order = np.argsort(at, kind="stable")
    begin, m = (np.cumsum(n) - n)[order], n[order]
    cells = np.repeat(begin - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
    kind, start, size = kind[cells], start[cells], size[cells]
    there = size >= 0
    length = np.where(there, size, 0)
    ends = np.append(0, np.cumsum(length))
    if ends[-1] >= 1 << 31:
        raise _Odd
    text = data[np.repeat(start - ends[:-1], length) + np.arange(int(ends[-1]))]
    buffer = lambda x: pa.py_buffer(np.ascontiguousarray(x))
    texts = pa.StringArray.from_buffers(len(size), buffer(ends.astype(np.int32)), buffer(text), buffer(np.packbits(there, bitorder="little")), -1)
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        raise _Odd from None
    kinds = pa.StringArray.from_buffers(len(size), buffer(np.arange(len(size) + 1, dtype=np.int32)), buffer(kind))
    columns, none = np.zeros(rows, np.int64), np.ones(rows, bool)
    columns[at], none[at] = n, False
    offsets = pa.array(np.append(0, np.cumsum(columns)).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([kinds, texts], fields=list(_CELL)), type=_TUPLE, mask=pa.array(none))


def parsed(column: pa.Array) -> dict[str, pa.Array]:
    """parse() of a whole array of messages, as arrays of FIELDS. Rows' cells are found for all messages at once; relations,
    truncations and markers, and whole batches that hold anything unusual, go message by message."""
    try:
        ends = np.append(0, np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)))
        begin, end = ends[:-1].astype(np.int64), ends[1:].astype(np.int64)
        data = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
        if not len(begin) or (end == begin).any():
            raise _Odd
        tag = data[begin]
        rows = np.flatnonzero(np.isin(tag, [ord(t) for t in "IUD"]))
        others = np.setdiff1d(np.arange(len(begin)), rows)
        if (begin[rows] + 5 > end[rows]).any():
            raise _Odd
        rel, at, tuples = _big_endian(data, begin[rows] + 1, 4), begin[rows] + 5, {"new_tuple": [], "old_tuple": []}
        busy = np.flatnonzero(at < end[rows])
        while len(busy):
            which = data[at[busy]] == ord("N")
            for name, some in (("new_tuple", busy[which]), ("old_tuple", busy[~which])):
                found, at[some] = _tuples(data, at[some] + 1, end[rows][some])
                tuples[name].append((rows[some], found))
            busy = busy[at[busy] < end[rows][busy]]
        out = {name: _lists(data, len(begin), found) for name, found in tuples.items()}
        rest = {int(i): parse(column[int(i)].as_py()) for i in others}
        for name, kind, _ in FIELDS:
            if name == "rel":
                number, none = np.zeros(len(begin), np.int64), np.ones(len(begin), bool)
                number[rows], none[rows] = rel, False
                for i, m in rest.items():
                    if "rel" in m:
                        number[i], none[i] = m["rel"], False
                out[name] = pa.array(number, kind, mask=none)
            elif name == "tag":
                out[name] = pa.array([chr(t) for t in tag.tolist()], kind)
            elif name not in out:
                values = [None] * len(begin)
                for i, m in rest.items():
                    values[i] = m.get(name)
                out[name] = pa.array(values, kind) if rest else pa.nulls(len(begin), kind)
        return out
    except _Odd:
        decoded = [parse(x.as_py()) for x in column]
        return {n: pa.array([d.get(n) for d in decoded], t) for n, t, _ in FIELDS}


def _own(raw: DataFrame, tags: str) -> DataFrame:
    """The messages of this plugin with one of the tags; data is binary."""
    own = raw.where(F.coalesce("plugin", F.lit("")).isin("pgoutput", "")).withColumn("data", F.col("data").cast("binary"))
    return own.where(F.substring("data", 1, 1).isin(*[F.lit(t.encode()) for t in tags]))


def messages(raw: DataFrame, order: list[str], keep: list[str], tags: str = "RIUDT") -> DataFrame:
    """keep, order and the decoded FIELDS of raw (plugin, data) with these tags. Messages of another plugin are dropped."""
    held = list(dict.fromkeys([*keep, *order]))
    source = _own(raw, tags).select(*held, "data")
    schema = ", ".join([f"{n} {t}" for n, t in source.dtypes if n != "data"] + [f"{n} {t}" for n, _, t in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            decoded = parsed(b.column(b.num_columns - 1))
            arrays = [b.column(i) for i in range(b.num_columns - 1)] + [decoded[n] for n, _, _ in FIELDS]
            yield pa.RecordBatch.from_arrays(arrays, names=[*held, *[n for n, _, _ in FIELDS]])

    return source.mapInArrow(run, schema)


def _number(at: int, size: int):
    """The big-endian number (signed if it has 8 bytes) in data from byte at (0-based) on; a message that is cut short raises."""
    short = F.octet_length("data") < at + size
    number = F.conv(F.hex(F.substring("data", at + 1, size)), 16, -10).cast("long")
    return F.when(short, F.raise_error(F.lit("a change message is cut short")).cast("long")).otherwise(number)


def transactions(raw: DataFrame, order: list[str], tx: list[str]) -> DataFrame:
    """tx and, of each transaction that has a Commit, xid (0 without a Begin), commit_lsn, end_lsn, commit_micros, and the places
    of both ends (begins, ends). Read on the JVM and combined before the shuffle."""
    tag, place = F.substring("data", 1, 1).cast("string"), F.struct(*order)
    m = _own(raw, "BC").select(*tx, place.alias("place"), tag.alias("tag"), "data")
    begin, commit = F.col("tag") == "B", F.col("tag") == "C"
    ends = F.struct("place", _number(2, 8).alias("commit_lsn"), _number(10, 8).alias("end_lsn"), (_number(18, 8) + EPOCH_2000 * 1000000).alias("commit_micros"))
    starts = F.struct("place", _number(17, 4).alias("xid"), _number(1, 8).alias("final_lsn"))
    found = m.groupBy(*tx).agg(F.max(F.when(commit, ends)).alias("c"), F.max(F.when(begin, starts)).alias("b")).where("c is not null")
    return found.select(
        *tx, F.coalesce("b.xid", F.lit(0)).alias("tx_xid"), "c.commit_lsn", "c.end_lsn", "c.commit_micros", F.col("b.final_lsn").alias("begin_lsn"), F.col("b.place").alias("begins"), F.col("c.place").alias("ends")
    )


HISTORY = ["rel", "place", "schema", "table", "columns", "oids"]


def relations(raw: DataFrame, order: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """The history of relation definitions: HISTORY, place being the struct of order. A definition sent again unchanged is left out."""
    found = messages(raw, list(order), [], "R").select("rel", F.struct(*order).alias("place"), "schema", "table", "columns", "oids")
    w = Window.partitionBy("rel").orderBy("place")
    now = F.struct("schema", "table", "columns", "oids")
    return found.withColumn("_before", F.lag(now).over(w)).where(~now.eqNullSafe(F.col("_before"))).drop("_before")


class RelationStore:
    """The last definition of each relation after each micro-batch, in a folder that all executors share.

    A batch's state is written under its number, so a repeated batch starts from the same definitions and writes the same ones.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def known(self, spark, batch_id: int) -> DataFrame | None:
        """The definitions before a batch, or None before the first."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        before = [int(n[6:]) for n in names if n.startswith("batch=") and int(n[6:]) < batch_id]
        return spark.read.parquet(f"{self.path}/batch={max(before)}") if before else None

    def keep(self, history: DataFrame, batch_id: int) -> DataFrame:
        """Stores the last definition of each relation of history as the state after a batch, and returns it."""
        last = history.groupBy("rel").agg(F.max_by(F.struct(*HISTORY[1:]), "place").alias("d")).select("rel", "d.*")
        last.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return last


def _image(cells: str):
    """Name -> value as text; unchanged values are absent, nulls are null, the shorter list decides."""
    n = F.least(F.size(cells), F.size("columns"))
    pairs = F.arrays_zip(F.slice("columns", 1, n).alias("name"), F.slice(F.col(cells), 1, n).alias("cell"), F.slice("oids", 1, n).alias("oid"))
    there = F.filter(pairs, lambda p: p["cell"]["kind"] != "u")
    return F.when(F.col(cells).isNotNull(), F.map_from_entries(F.transform(there, lambda p: F.struct(p["name"], typed(p["cell"]["text"], p["oid"])))))


#: Type numbers and the types their texts are read as.
TYPES = {16: "boolean", 20: "bigint", 21: "bigint", 23: "bigint", 700: "double", 701: "double", 1700: "numeric", 1082: "date", 1184: "timestamp"}


def typed(text, oid):
    """A value's text in its type, as a variant; a text that its type can't read, or of another type, stays text.

    A number of at most 38 digits is a decimal of its own scale, so that it is kept exactly; a longer one and NaN stay text.
    """
    out = text.cast("variant")
    for number, kind in TYPES.items():
        if kind == "boolean":
            own = F.when(text.isin("t", "f"), text == "t").cast("variant")
        elif kind == "numeric":
            exact = text.rlike(r"^-?(0|[1-9]\d*)(\.\d+)?$") & (F.length(F.regexp_replace(text, "[-.]", "")) <= 38)
            own = F.when(exact, F.try_parse_json(text))
        else:
            own = text.try_cast(kind).cast("variant")
        out = F.when(F.coalesce(oid == number, F.lit(False)) & own.isNotNull(), own).otherwise(out)
    return F.when(text.isNotNull(), out)


def decode(
    raw: DataFrame,
    order: tuple[str, ...] = ("ordinal", "step"),
    tx: tuple[str, ...] = ("txid",),
    tables: tuple[str, ...] = (),
    known: DataFrame | None = None,
    markers: bool = False,
) -> DataFrame:
    """Change events of a log in which each value of tx is one transaction's messages, ordered by order.

    A row's relation is the last one of its number before it in the log, or in known (HISTORY of what came before the log).
    Rows of unknown relations and of transactions without a Commit are dropped, and filtered tables are dropped before the rows
    are numbered. A truncation makes a row for each of its relations, in the listed order. With markers, each transaction
    has a row with begin and one with commit beside its events.
    """
    place = F.struct(*order)
    m = messages(raw, list(order), list(tx), "IUDT").withColumn("place", place)
    # the listed order of a truncation's relations numbers its rows
    m = m.select("*", F.posexplode(F.when(F.col("tag") == "T", F.col("rels")).otherwise(F.array("rel"))).alias("listed", "_rel"))
    m = m.where("tag = 'D' or tag = 'T' or new_tuple is not null").select(*dict.fromkeys([*tx, *order]), "place", "listed", "tag", F.col("_rel").alias("rel"), "old_tuple", "new_tuple")
    history = relations(raw, order)
    if known is not None:
        # whatever place they had, they were there before
        history = known.select(*HISTORY).withColumn("place", F.lit(None).cast(dict(history.dtypes)["place"])).union(history.select(*HISTORY))
    if tables:
        history = history.withColumn("wanted", F.concat_ws(".", "schema", "table").isin(*tables))
    rows = relation_as_of(m, history, order="place")
    if tables:
        rows = rows.where("wanted").drop("wanted")
    done = transactions(raw, list(order), list(tx))
    rows = rows.join(done, list(tx))
    seq = (F.row_number().over(Window.partitionBy(*tx).orderBy("place", "listed")) - 1).cast("long")
    time = F.timestamp_micros("commit_micros")
    op = F.create_map(*[F.lit(x) for kv in {"I": "INSERT", "U": "UPDATE", "D": "DELETE", "T": "DDL"}.items() for x in kv])
    position = F.coalesce(F.nullif(F.col("end_lsn"), F.lit(0)), F.col("commit_lsn"))

    def shown(lsn: str, columns: dict) -> list:
        """The columns of an event (or of a marker, which has no row's values)."""
        nothing = F.lit(None)
        image = lambda n: columns.get(n, nothing.cast("map<string,variant>")).alias(n)
        flags = [columns.get(n, F.lit(False)).alias(n) for n in ("begin", "commit")] if markers else []
        return [
            *[F.col(o) if "place" not in columns else columns["place"][o].alias(o) for o in order],
            lsn_text(F.col(lsn)).alias("lsn"),
            F.col(lsn).alias("lsn_num"),
            columns.get("position", position).alias("position"),
            F.col("tx_xid").alias("txid"),
            columns.get("seq", nothing.cast("long")).alias("seq"),
            columns.get("timestamp", time).alias("timestamp"),
            columns.get("timestamp", time).alias("commit_time"),
            *[columns.get(n, nothing.cast("string")).alias(n) for n in ("op", "schema", "table")],
            image("old_values"),
            image("new_values"),
            *flags,
        ]

    old, new = F.when(F.col("tag").isin("U", "D"), _image("old_tuple")), F.when(F.col("tag").isin("I", "U"), _image("new_tuple"))
    event = {"seq": seq, "op": op[F.col("tag")], "schema": F.col("schema"), "table": F.col("table"), "old_values": old, "new_values": new}
    events = rows.select(*shown("commit_lsn", event))
    if not markers:
        return events
    no_time = F.lit(None).cast("timestamp")
    begins = done.where("begins is not null").select(*shown("begin_lsn", {"place": F.col("begins"), "begin": F.lit(True), "timestamp": no_time, "position": F.lit(None).cast("long")}))
    return events.unionByName(begins).unionByName(done.select(*shown("commit_lsn", {"place": F.col("ends"), "commit": F.lit(True)})))
