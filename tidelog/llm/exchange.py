"""Sums by key over blocks: every block sends its distinct keys with a number each and gets back, for each key, the sum over all blocks.

Keys are 64-bit hashes, spread evenly. A bucket is a range of them, and there are as many buckets as blocks. A block sends its
keys in order, in pieces of one bucket each; a bucket answers each piece with a number a key, in the same order, so that no key
travels back and an answer of a byte is common. Of the blocks that sent a key with a number above 0, one owns it, so that each
distinct key is counted once where something is to be summed up over distinct keys.

Keys of a piece are sent as distances, in as few bytes as they need. Rows hold the pieces for one of at most FAN ranges of destinations. Up to FAN blocks a range is one bucket (or one block). Beyond
that a second shuffle splits each range into its destinations, whose pieces are put together from SPLIT bytes at a time. So the
rows that travel grow with the data, not with blocks times buckets. A key of a third of all documents is one entry a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

FAN, SPLIT = 1024, 32 << 20
_U = np.uint64
#: dest, frm and size: each piece's destination, origin and number of keys.
SENT = "to long, dest binary, frm binary, size binary, keys binary, vals binary"
ANSWER = SENT + ", total long, n_distinct long"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.empty(0, np.int64)


def packed(x: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, first bytes first, so that they compress."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(x: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(x) // n] = np.frombuffer(x, np.uint8).reshape(-1, n).T
    return out.view("<u8").ravel().view(np.int64)


def _packed_keys(keys: np.ndarray, size: np.ndarray) -> bytes:
    """Sorted keys of pieces: the first one of each, and the distances of the others."""
    begin = np.cumsum(size) - size
    step = np.diff(keys, prepend=_U(0))
    return keys[begin].tobytes() + packed(np.delete(step, begin))


def _unpacked_keys(x: bytes, size: np.ndarray) -> np.ndarray:
    begin, n = np.cumsum(size) - size, int(size.sum())
    step = np.empty(n, _U)
    first = np.zeros(n, bool)
    first[begin] = True
    step[begin] = np.frombuffer(x, _U, len(size))
    step[~first] = unpacked(x[8 * len(size) :], n - len(size)).view(_U)
    sums = np.cumsum(step, dtype=_U)
    # modulo 2 ** 64, so that what came before a piece can be taken off
    return sums - np.repeat(sums[begin] - step[begin], size)


def _inside(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of ranges of these starts and sizes, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    types = {"long": pa.int64(), "binary": pa.binary()}
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.table({n: pa.array(c, types[k]) for n, k, c in zip(names, kinds, zip(*rows) if rows else [[]] * len(names))})


def _range(dest: np.ndarray, n: int) -> np.ndarray:
    return dest if n <= FAN else dest * FAN // n


def _rows(to: np.ndarray, dest: np.ndarray, frm: np.ndarray, size: np.ndarray, keys: np.ndarray, vals: np.ndarray) -> Iterator[tuple]:
    """A SENT row for each value of to; pieces come sorted by it, keys (maybe none) and vals in the pieces' order."""
    begin, at = runs(to), np.append(0, np.cumsum(size))
    for i, j in zip(begin, np.append(begin[1:], len(to))):
        s = slice(at[i], at[j])
        code = _packed_keys(keys[s], size[i:j]) if len(keys) else b""
        yield int(to[i]), dest[i:j].astype(np.int64).tobytes(), frm[i:j].astype(np.int64).tobytes(), size[i:j].astype(np.int32).tobytes(), code, packed(vals[s])


def _pieces(columns: dict[str, list]) -> tuple[np.ndarray, ...]:
    """dest, frm, size, keys and vals of all rows' pieces."""
    join = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in columns[name]] or [np.empty(0, kind)])
    sizes = [np.frombuffer(s, np.int32).astype(np.int64) for s in columns["size"]]
    vals = [unpacked(v, int(s.sum())) for v, s in zip(columns["vals"], sizes)]
    keys = [_unpacked_keys(k, s) for k, s in zip(columns["keys"], sizes) if k]
    flat = lambda x, kind: np.concatenate(x or [np.empty(0, kind)])
    return join("dest", np.int64), join("frm", np.int64), flat(sizes, np.int64), flat(keys, _U), flat(vals, np.int64)


def sent(part: int, keys: np.ndarray, vals: np.ndarray, n: int) -> pa.Table:
    """SENT rows of a block's distinct keys, for n buckets."""
    order = np.argsort(keys)
    keys, vals = keys[order], vals[order]
    bucket = ((keys >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)
    begin = runs(bucket)
    dest, size = bucket[begin], np.diff(np.append(begin, len(bucket)))
    return _table(list(_rows(_range(dest, n), dest, np.full(len(dest), part), size, keys, vals)), SENT)


def answers(answered: dict[str, list], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's answers, in the order of its keys: sums, and whether the block owns the key."""
    _, bucket, size, _, vals = _pieces(answered)
    order = np.argsort(bucket, kind="stable")
    begin = np.cumsum(size) - size
    out = np.empty(len(keys), np.int64)
    out[np.argsort(keys)] = vals[_inside(begin[order], size[order])]
    return out >> 1, (out & 1).astype(bool)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one destination each from rows of a range of them."""
    held: dict[str, list] = {}

    def made():
        dest, frm, size, keys, vals = _pieces(held)
        order = np.argsort(dest, kind="stable")
        at = _inside((np.cumsum(size) - size)[order], size[order])
        rows = _rows(dest[order], dest[order], frm[order], size[order], keys[at] if len(keys) else keys, vals[at])
        return _table(list(rows), SENT).combine_chunks().to_batches()

    n = 0
    for b in batches:
        for name in ("dest", "frm", "size", "keys", "vals"):
            held.setdefault(name, []).extend(b.column(name).to_pylist())
        n += b.nbytes
        if n >= SPLIT:
            yield from made()
            held, n = {}, 0
    if held:
        yield from made()


def _routed(rows: DataFrame, n: int) -> DataFrame:
    """rows whose to is their destination."""
    rows = rows.where("to >= 0").select(*[c.split()[0] for c in SENT.split(", ")])
    return rows if n <= FAN else rows.repartition(FAN, "to").mapInArrow(_split, SENT)


def _sums(table: pa.Table, n: int) -> pa.Table:
    """A bucket's ANSWER rows, and one with to -1: sum and number of its even keys with a sum above 0."""
    _, frm, size, keys, vals = _pieces({c: table.column(c).to_pylist() for c in table.column_names})
    order = np.argsort(keys, kind="stable")
    begin = runs(keys[order])
    group = np.zeros(len(keys), np.int64)
    group[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(keys))))
    sums = np.add.reduceat(vals[order], begin)
    # the first that has something owns a key
    owner = np.minimum.reduceat(np.where(vals[order] > 0, order, len(keys)), begin)
    out = sums[group] << 1
    out[owner[owner < len(keys)]] |= 1
    start, back = np.cumsum(size) - size, np.argsort(frm, kind="stable")
    bucket = np.frombuffer(table.column("dest")[0].as_py(), np.int64)[0]
    own = np.full(len(frm), bucket)
    none = np.empty(0, _U)
    rows = [(*r, None, None) for r in _rows(_range(frm[back], n), frm[back], own, size[back], none, out[_inside(start[back], size[back])])]
    even = sums[keys[order][begin] & _U(1) == 0]
    rows.append((-1, b"", b"", b"", b"", b"", int(even.sum()), int((even > 0).sum())))
    return _table(rows, ANSWER)


def exchanged(rows: DataFrame, n: int, name: str) -> DataFrame:
    """The saved answers to SENT rows of n blocks: see answered() and totals()."""
    sums = lambda table: _sums(table, n)
    return saved(_routed(rows, n).groupBy("to").applyInArrow(sums, ANSWER), name)


def answered(kept: list[DataFrame], n: int) -> DataFrame:
    """The SENT rows of several exchanges' answers, grouped with their blocks by to; round is the exchange's place in the list."""
    out = None
    for i, k in enumerate(kept):
        rows = _routed(k, n).withColumn("round", F.lit(i))
        out = rows if out is None else out.unionByName(rows)
    return out


def of_round(table: pa.Table, i: int) -> dict[str, list]:
    mine = [k for k, r in enumerate(table.column("round").to_pylist()) if r == i]
    rows = table.take(pa.array(mine, pa.int64()))
    return {c: rows.column(c).to_pylist() for c in ("dest", "frm", "size", "keys", "vals")}


def totals(kept: DataFrame) -> tuple[int, int]:
    """Of the even keys: the sum of all sums, and how many are above 0. One row reaches the driver."""
    r = kept.where("to = -1").agg(F.sum("total"), F.sum("n_distinct")).first()
    return r[0] or 0, r[1] or 0
