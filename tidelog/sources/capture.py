"""A streaming source over captured messages, whose offsets are commit positions.

A capture is a folder of JSON-lines files that are written once, in the order of their names. A line is {plugin, wal_start,
ordinal, data or data64, commit}; data64 is a binary message in base 64. Lines {"keepalive": position} carry no message, a line
that can't be read is counted and left out, and {"error": text, "sqlstate": code} is the server's, which ends the stream. Offsets
advance to commits only, so every micro-batch holds whole transactions (each message has its transaction's first ordinal as tx)
and per-transaction windows can run in foreachBatch.

Each file is looked through once for the index of its ordinals and commits, new files alone at a trigger, and a batch reads the
files that overlap its range, small ones together in a task. The acknowledged position never moves back. With ackPath it is stored there after each batch and
again when the stream is idle for heartbeatSeconds, and a stream without a checkpoint of its own goes on from it.
"""

from __future__ import annotations

import base64
import json
import random
import time
import warnings
from collections.abc import Iterator

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidelog.functions.backoff import reconnect_backoff
from tidelog.functions.lsn import lsn_number

#: SQLSTATEs after which a reader doesn't try again (class 28, missing privilege, missing object).
FATAL_CLASSES, FATAL_STATES = ("28",), ("42501", "42704")
SCHEMA = "plugin string, wal_start string, ordinal long, data binary, commit boolean, tx long"


class ReplicationError(Exception):
    def __init__(self, message: str, sqlstate: str = "", from_server: bool = False):
        super().__init__(message)
        self.sqlstate, self.from_server = sqlstate, from_server


def is_fatal(error: Exception) -> bool:
    state = getattr(error, "sqlstate", "")
    return getattr(error, "from_server", False) or state[:2] in FATAL_CLASSES or state in FATAL_STATES


def position(lsn: str | None) -> int:
    """A position as a number; 0 if it is empty or can't be read."""
    try:
        high, low = (lsn or "").split("/")
        return (int(high, 16) << 32) + int(low, 16)
    except ValueError:
        return 0


def attempt(read, tries: int = 5, wait=time.sleep):
    for n in range(tries):
        try:
            return read()
        except Exception as e:
            if is_fatal(e) or n == tries - 1:
                raise
            wait(reconnect_backoff(n))


#: A task's files hold about as many lines (or are one file).
TASK_LINES = 50_000


class _Range(InputPartition):
    """files: (path, the transaction that is open at its begin) of each."""

    def __init__(self, files: list[tuple[str, int | None]], start: int, end: int):
        self.files, self.start, self.end = files, start, end


class _File:
    """What the index keeps of a file: its first and last ordinal, its lines, its commits after start, and where the transaction that
    is open at its begin and at its end has begun."""

    def __init__(self, rows: Iterator[dict], start: int, tx: int | None):
        self.tx, self.low, self.high, self.lines, self.commits = tx, None, None, 0, []
        for r in rows:
            n = r["ordinal"]
            self.lines += 1
            self.low, self.high = n if self.low is None else self.low, n
            tx = n if tx is None else tx
            if r["commit"]:
                tx = None
                if n > start:
                    self.commits.append(n)
        self.tx_after = tx


class CaptureReader(DataSourceStreamReader):
    """Offsets are {"ordinal": n}: all messages up to the commit with that ordinal."""

    def __init__(self, options: dict, clock=time.time):
        if not options.get("path"):
            raise ValueError("the capture's path is missing")
        if options.get("plugin", "wal2json") not in ("", "wal2json", "pgoutput"):
            raise ValueError(f"no such plugin: {options['plugin']}")
        self.path, self.clock, self.bad_lines = options["path"], clock, 0
        self.ack_path, self.heartbeat = options.get("ackpath") or options.get("ackPath"), float(options.get("heartbeatseconds") or options.get("heartbeatSeconds") or 45)
        self.most = int(options.get("maxtransactions") or options.get("maxTransactions") or 0)
        self.acked, self.told = self._recovered(), clock()
        if self.most and not self.ack_path:
            raise ValueError("maxTransactions needs ackPath, where the stream finds again how far it was")
        given = options.get("startordinal") or options.get("startOrdinal")
        self.start = int(given) if given is not None else self.acked
        # Spark doesn't say where it goes on from, and an offset may not go back: what was offered last is stored too
        self.last = max(self.start, self._stored(".offered", -1)) if self.most else self.start
        self.index: dict[str, _File] = {}

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def _files(self) -> list[str]:
        from pyarrow import fs

        system, inner = self._system()
        found = system.get_file_info(fs.FileSelector(inner, recursive=False))
        return sorted(f.path for f in found if f.is_file and f.base_name.endswith(".json"))

    def _rows(self, path: str) -> Iterator[dict]:
        system, _ = self._system()
        with system.open_input_stream(path) as f:
            rest = b""
            while chunk := f.read(1 << 20):
                *lines, rest = (rest + chunk).split(b"\n")
                yield from filter(None, map(self._message, lines))
            if (last := self._message(rest)) is not None:
                yield last

    def _message(self, line: bytes) -> dict | None:
        if not line.strip():
            return None
        try:
            m = json.loads(line)
            if "error" in m:
                raise ReplicationError(str(m["error"]), str(m.get("sqlstate", "")), from_server=True)
            if "keepalive" in m:
                return None
            data = base64.b64decode(m["data64"]) if "data64" in m else m["data"].encode()
            return {"plugin": m.get("plugin", ""), "wal_start": m.get("wal_start"), "ordinal": int(m["ordinal"]), "data": data, "commit": bool(m.get("commit"))}
        except (ValueError, KeyError, TypeError, AttributeError):
            self.bad_lines += 1
            return None

    def _indexed(self) -> None:
        """Looks through the files that aren't in the index yet; a file that is over before the start is forgotten but for its end."""
        tx = None
        for path in self._files():
            if path not in self.index:
                self.index[path] = attempt(lambda path=path, tx=tx: _File(self._rows(path), self.start, tx), wait=self._wait)
            tx = self.index[path].tx_after

    def _wait(self, seconds: float) -> None:
        # up to half as much again, so that readers that lost the same server don't come back at once
        time.sleep(seconds * (1 + 0.5 * random.random()))

    def initialOffset(self) -> dict:
        return {"ordinal": self.start}

    def latestOffset(self) -> dict:
        self._indexed()
        found = sorted(n for f in self.index.values() for n in f.commits if n > self.last)
        if found:
            self.last = found[self.most - 1] if 0 < self.most < len(found) else found[-1]
            if self.most:
                self._store(".offered", {"ordinal": self.last})
        elif self.clock() - self.told >= self.heartbeat:
            self._tell()
        return {"ordinal": self.last}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        self._indexed()
        self.last = max(self.last, end["ordinal"])
        low, high = start["ordinal"], end["ordinal"]
        out, lines = [], 0
        for path, f in self.index.items():
            if f.low is not None and f.high > low and f.low <= high:
                if not out or lines + f.lines > TASK_LINES:
                    out.append(_Range([], low, high))
                    lines = 0
                out[-1].files.append((path, f.tx))
                lines += f.lines
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        for path, tx in partition.files:
            for r in self._rows(path):
                tx = r["ordinal"] if tx is None else tx
                if partition.start < r["ordinal"] <= partition.end:
                    yield r["plugin"], r["wal_start"], r["ordinal"], r["data"], r["commit"], tx
                if r["commit"]:
                    tx = None

    def commit(self, end: dict) -> None:
        self.acked = max(self.acked, end["ordinal"])
        for f in self.index.values():
            f.commits = [n for n in f.commits if n > self.acked]
        self._tell()

    def _tell(self) -> None:
        self.told = self.clock()
        if self.ack_path:
            self._store("", {"ordinal": self.acked, "at": self.told})

    def _store(self, suffix: str, value: dict) -> None:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(self.ack_path)
        with system.open_output_stream(f"{inner}{suffix}.new") as f:
            f.write(json.dumps(value).encode())
        system.move(f"{inner}{suffix}.new", f"{inner}{suffix}")

    def _stored(self, suffix: str, default: int | None = None) -> int:
        from pyarrow import fs

        try:
            system, inner = fs.FileSystem.from_uri(self.ack_path)
            with system.open_input_stream(inner + suffix) as f:
                return int(json.loads(f.read())["ordinal"])
        except (OSError, ValueError, KeyError, TypeError):
            if default is None:
                raise
            return default

    def _recovered(self) -> int:
        """The acknowledged ordinal; -1, with a warning, where it can't be read."""
        if not self.ack_path:
            return -1
        try:
            return self._stored("")
        except (OSError, ValueError, KeyError, TypeError) as e:
            warnings.warn(f"no acknowledged position, the capture is read from its begin: {e}", stacklevel=2)
            return -1


class CaptureSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelog_capture"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> CaptureReader:
        return CaptureReader(self.options)


def write_lines(lines, path: str) -> None:
    """Writes lines (file, ordinal, line) as a capture: each file's lines in order, a file in one task."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(inner, recursive=True)
        name = out = None
        for b in batches:
            for file, line in zip(*(b.column(c).to_pylist() for c in ("file", "line"))):
                if file != name:
                    if out is not None:
                        out.close()
                        system.move(f"{inner}/{name}.new", f"{inner}/{name}.json")
                    name, out = file, system.open_output_stream(f"{inner}/{file}.new")
                out.write(line.encode() + b"\n")
        if out is not None:
            out.close()
            system.move(f"{inner}/{name}.new", f"{inner}/{name}.json")
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], names=["file"])

    lines.repartition("file").sortWithinPartitions("file", "ordinal").mapInArrow(run, "file string").collect()


def slot_position(spark, jdbc_url: str, slot: str, **options: str):
    """The slot's confirmed position by JDBC (slot, lsn): one row, or none for a slot that doesn't exist."""
    quoted = slot.replace(chr(39), chr(39) * 2)
    query = f"SELECT slot_name AS slot, confirmed_flush_lsn::text AS lsn FROM pg_replication_slots WHERE slot_name = '{quoted}'"
    return spark.read.format("jdbc").options(url=jdbc_url, query=query, **options).load()


def confirmed(rows):
    """slot and the position to resume from, of rows (slot, lsn): the greatest as a number, the empty text where there is none."""
    best = F.max_by("lsn", lsn_number(F.col("lsn")))
    return rows.groupBy("slot").agg(F.coalesce(best, F.lit("")).alias("lsn"))


def slot_checkpoint(rows, slot: str) -> str:
    """The position to resume from: empty for a slot without one; a slot that doesn't exist is an error."""
    found = confirmed(rows.where(F.col("slot") == slot)).take(1)
    if not found:
        raise LookupError(f"no such slot: {slot}")
    return found[0]["lsn"]
