"""Suffix-array dedup: bytes covered by a LENGTH-byte string that also starts in an earlier document.

Every LENGTH-byte window of a text is named by the least hash of the K-byte
strings in it; equal windows have equal names wherever they stand. Neighbouring
windows of one name form a run, whose bytes are its context.

1. A block of documents sends its distinct names, each with its number of
   documents, and gets the sums over all blocks (exchange.py): names with a sum of
   one stand in one document.
2. The block sends the contexts of runs with such names, each once with its
   smallest document, to the name's bucket. There, equal contexts are joined. The
   windows of names that have several contexts are suffix-sorted, so that equal
   windows stand together and get their smallest document.
3. The block gets each context's smallest documents back, window by window, and
   removes the bytes of windows with a smaller document than their own.

A passage of a third of all documents is one entry a block in every step.

The suffix sort is a radix sort over the bytes themselves, eight at a step. Before it, windows whose prefix polynomial hash
(mod 2^64) no other window of the names at hand has are set aside: they equal none, and a collision only keeps a window in the sort.

A bucket is a range of names' hashes. There are as many as blocks, up to exchange.FAN; beyond that a bucket takes the contexts
of up to WIDE blocks. So the rows between blocks and buckets grow with the data up to FAN * WIDE blocks (34 GB of text), and from
there on with its square, an eighth of the blocks a block.

Defined cases: null and empty texts have no bytes; a null doc_id ranks after all
others; rows that repeat an id aren't smaller than each other; of equal windows in
documents of the smallest id none goes; matches never cross documents; texts may
be of any length; an empty table gives no rows; columns other than doc_id and text
aren't looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import exchange
from .common import block_table, n_blocks, saved
from .exchange import SENT, answered, answers, exchanged, mixed, of_round, sent

LENGTH, K = 50, 26
#: Windows of one run at most, and positions hashed at once.
RUN, CHUNK = 64, 1 << 19
#: Bytes of text in a block: its arrays and a bucket's contexts have to fit a worker.
BLOCK = 4 << 20
#: Blocks whose share of contexts a bucket takes at most: about 40 MB of bytes.
WIDE = 8
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, _U)
    out[0], made = 1, 1
    while made < n:
        some = min(made, n - made)
        out[made : made + some] = out[:some] * _U(pow(base, made, 1 << 64))
        made += some
    return out


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and its inverse's."""
    size = 1 << max(0, n - 1).bit_length()
    if size not in _tables:
        _tables[size] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _tables[size]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h[i]: hash of the first i bytes; that of data[a:b] is (h[b] - h[a]) * inverse ** a."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=out[1:])
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each width consecutive values."""
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, windows) of each run; data holds documents that end at ends."""
    names, firsts, sizes = [], [], []
    begins = np.append(0, ends[:-1]) if len(ends) else ends
    last = ends - length  # the last window of a document, if any
    for c0 in range(0, max(0, len(data) - length + 1), CHUNK):
        piece = data[c0 : c0 + CHUNK + length - 1]
        h = prefix_hashes(piece)
        _, down = powers(len(piece) + 1)
        grams = mixed((h[k:] - h[:-k]) * down[: len(piece) - k + 1])
        name = _least(grams, length - k + 1)
        n = len(name)
        change = np.zeros(n + 1, np.int32)
        a = np.clip(begins - c0, 0, n)
        b = np.clip(last + 1 - c0, 0, n)
        ok = b > a
        np.add.at(change, a[ok], 1)
        np.add.at(change, b[ok], -1)
        valid = np.cumsum(change[:-1]) > 0
        new = np.ones(n, bool)
        new[1:] = (name[1:] != name[:-1]) | ~valid[:-1]
        new[a[ok]] = True
        at = np.flatnonzero(valid)
        if not len(at):
            continue
        start = np.flatnonzero(new & valid)
        # runs over RUN windows are cut
        where = np.searchsorted(at, start)
        size = np.diff(np.append(where, len(at)))
        long = np.flatnonzero(size > RUN)
        if len(long):
            more = np.concatenate([np.arange(start[i] + RUN, start[i] + size[i], RUN) for i in long])
            start = np.sort(np.concatenate([start, more]))
            where = np.searchsorted(at, start)
            size = np.diff(np.append(where, len(at)))
        names.append(name[start])
        firsts.append(start + c0)
        sizes.append(size)
    if not names:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(names), np.concatenate(firsts).astype(np.int64), np.concatenate(sizes).astype(np.int64)


class Suffixes:
    """Suffixes of data, sorted up to limit bytes (8 or more). Every start has limit bytes after it."""

    def __init__(self, data: np.ndarray, limit: int = LENGTH):
        self.data, self.limit = data, limit
        self.h, (_, self.down) = prefix_hashes(data), powers(len(data) + 1)
        # the eight bytes from each place on as a number, which compares as they do
        self.eight = np.zeros(max(0, len(data) - 7), _U)
        for i in range(8):
            self.eight = self.eight << _U(8) | data[i : i + len(self.eight)]
        # the last eight overlap those before, so that no suffix is looked at beyond the limit
        self.steps = [*range(0, limit - 8, 8), limit - 8]

    def hashes(self, starts: np.ndarray) -> np.ndarray:
        """A hash of each suffix's first limit bytes."""
        return (self.h[starts + self.limit] - self.h[starts]) * self.down[starts]

    def sort(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """The order that sorts starts by suffix within each group: a radix sort, eight bytes a step, from the last to the first."""
        return np.lexsort((*(self.eight[starts + k] for k in reversed(self.steps)), groups))

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for k in self.steps:
            out &= self.eight[a + k] == self.eight[b + k]
        return out


class Block:
    """A block's documents in one array, their runs, and the runs' contexts as keys."""

    def __init__(self, table: pa.Table):
        order = table.column("doc_id").to_pylist()
        self.ids = order
        texts = [x.as_py() for x in table.column("text")]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.rank = np.array([_LAST if i is None else i for i in order], np.int64)
        self.names, self.first, self.windows = runs(self.data, self.ends)
        self.docs = self.rank[np.searchsorted(self.ends, self.first, "right")]

    def distinct_names(self) -> tuple[np.ndarray, np.ndarray]:
        """The block's distinct names in order, and how many documents have each."""
        order = np.lexsort((self.docs, self.names))
        names, docs = self.names[order], self.docs[order]
        new = np.append(True, names[1:] != names[:-1])[: len(names)]
        begin = np.flatnonzero(new)
        another = new | np.append(True, docs[1:] != docs[:-1])[: len(names)]
        return names[begin], np.add.reduceat(another.astype(np.int64), begin) if len(begin) else begin

    def narrowed(self, at: np.ndarray) -> None:
        self.names, self.first, self.windows, self.docs = self.names[at], self.first[at], self.windows[at], self.docs[at]

    def keys(self) -> np.ndarray:
        """A hash of each run's context and name."""
        end = self.first + self.windows - 1 + LENGTH
        out = np.empty(len(self.first), _U)
        # hashed chunk by chunk, as the prefix hashes of a long array need as long tables of powers
        for c in range(0, len(self.data), CHUNK):
            i = slice(*np.searchsorted(self.first, [c, c + CHUNK]))
            piece = self.data[c : c + CHUNK + LENGTH + RUN]
            h, (_, down) = prefix_hashes(piece), powers(len(piece) + 1)
            a, b = self.first[i] - c, end[i] - c
            out[i] = mixed(((h[b] - h[a]) * down[a]) ^ mixed(self.names[i] + self.windows[i].astype(_U)))
        return out


def n_buckets(n: int) -> int:
    """How many buckets take the contexts of n blocks. Each block sends a row to each of them and gets one back."""
    return min(n, max(exchange.FAN, -(-n // WIDE)))


def _bucket(names: np.ndarray, n: int) -> np.ndarray:
    # names are minima and so crowd near 0: deal them by another hash
    return ((mixed(names + _U(1)) >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)


def _dealt(part: int, bucket: np.ndarray, columns: dict[str, list]) -> pa.Table:
    """A row for each bucket, with each column's bytes of the bucket's entries (arrays, or lists of bytes)."""
    order = np.argsort(bucket, kind="stable")
    used, begin = np.unique(bucket[order], return_index=True)
    groups = np.split(order, begin[1:]) if len(used) else []
    blob = lambda v, g: v[g].tobytes() if isinstance(v, np.ndarray) else b"".join([v[i] for i in g])
    return pa.table(
        {"bucket": pa.array(used, pa.int64()), "part": pa.array([part] * len(used), pa.int64())}
        | {k: pa.array([blob(v, g) for g in groups], pa.binary()) for k, v in columns.items()}
    )


def _arrays(column, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in column]


def _answer(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 4
    return pa.table({k: pa.array(c, t) for k, c, t in zip(("part", "keys", "sizes", "docs"), cols, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))})


ANSWER = "part long, keys binary, sizes binary, docs binary"


def _slices(order: np.ndarray, names: np.ndarray, size: np.ndarray):
    """order, in pieces of about CHUNK bytes that hold whole names."""
    if len(order):
        piece = np.cumsum(size[order]) // CHUNK
        new = np.append(True, names[order][1:] != names[order][:-1])
        # a name belongs to the piece in which it begins
        piece = piece[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        yield from np.split(order, np.flatnonzero(piece[1:] != piece[:-1]) + 1)


def _repeated(x: np.ndarray) -> np.ndarray:
    """The places of the values that x holds several times."""
    order = np.argsort(x)
    same = x[order][1:] == x[order][:-1]
    out = np.zeros(len(x), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return np.flatnonzero(out)


def _joined_windows(contexts, names, start, n, begin, data, least) -> None:
    """Sorts the contexts' windows within each name and gives equal ones their smallest document, in least."""
    size = n[contexts] - 1 + LENGTH
    own = np.cumsum(size) - size
    text = data[np.repeat(start[contexts] - own, size) + np.arange(size.sum())]
    m = n[contexts]
    inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    places, group = np.repeat(own, m) + inside, np.repeat(names[contexts], m)
    at = np.repeat(begin[contexts], m) + inside
    s = Suffixes(text)
    # a window whose hash no other window has equals none
    some = _repeated(s.hashes(places))
    if not len(some):
        return
    places, group, at = places[some], group[some], at[some]
    sort = s.sort(places, group)
    places, group, at = places[sort], group[sort], at[sort]
    new = np.append(True, (group[1:] != group[:-1]) | ~s.equal(places[1:], places[:-1]))
    klass = np.cumsum(new) - 1
    best = np.full(klass[-1] + 1, _LAST)
    np.minimum.at(best, klass, least[at])
    least[at] = best[klass]


def _smallest(table: pa.Table) -> pa.Table:
    """For every context that a block sent, the smallest document of each of its windows."""
    parts = table.column("part").to_pylist()
    per = {k: _arrays(table.column(k), t) for k, t in (("names", _U), ("keys", _U), ("windows", np.uint8), ("docs", np.int64), ("more", np.uint8))}
    names, keys, windows, docs = (np.concatenate(per[k]) for k in ("names", "keys", "windows", "docs"))
    windows = windows.astype(np.int64)
    raw = b"".join(x.as_py() for x in table.column("bytes"))
    data = np.frombuffer(raw, np.uint8)
    size = windows - 1 + LENGTH
    start = np.cumsum(size) - size
    # equal contexts, by their bytes
    index: dict[bytes, int] = {}
    which = np.fromiter((index.setdefault(raw[a : a + n], len(index)) for a, n in zip(start.tolist(), size.tolist())), np.int64, len(start))
    one = np.unique(which, return_index=True)[1]
    doc = np.full(len(index), _LAST)
    np.minimum.at(doc, which, docs)
    del raw, index
    # their windows, with the context's document to begin with
    n = windows[one]
    begin = np.cumsum(n) - n
    least = np.repeat(doc, n)
    # names with several contexts: sort their windows
    order = np.argsort(names[one], kind="stable")
    sorted_names = names[one][order]
    several = np.zeros(len(one), bool)
    same = sorted_names[1:] == sorted_names[:-1]
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    own = np.flatnonzero(several)
    own = own[np.argsort(names[one][own], kind="stable")]
    for some in _slices(own, names[one], size[one]):
        _joined_windows(some, names[one], start[one], n, begin, data, least)
    # a context of one document that is the smallest of all its windows has nothing to remove
    more, part = np.concatenate(per["more"]), np.repeat(np.arange(len(parts)), [len(k) for k in per["keys"]])
    lows = np.minimum.reduceat(least, begin) if len(begin) else least
    need = np.flatnonzero((more > 0) | (lows[which] < docs))
    u, part = which[need], part[need]
    flat = np.append(0, np.cumsum(n[u]))
    found, sizes, back = keys[need], n[u].astype(np.uint8), least[np.repeat(begin[u] - flat[:-1], n[u]) + np.arange(flat[-1])]
    edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else part
    rows = [(parts[part[i]], found[i:j].tobytes(), sizes[i:j].tobytes(), back[flat[i] : flat[j]].tobytes()) for i, j in zip(edges, np.append(edges[1:], len(part)))]
    return _answer(rows)


def _joined(answers: pa.Table, column: str, kind) -> np.ndarray:
    found = _arrays(answers.column(column), kind)
    return np.concatenate(found) if found else np.empty(0, kind)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of docs (doc_id, text)."""
    n = n_blocks(docs, block_bytes=BLOCK)
    blocks, buckets = block_table(docs, n), n_buckets(n)

    def send_names(table: pa.Table) -> pa.Table:
        names, documents = Block(table).distinct_names()
        return sent(table.column("part")[0].as_py(), mixed(names), documents, n)

    shared = exchanged(blocks.groupBy("part").applyInArrow(send_names, SENT), n, "suffix-names")

    def send_contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = ("names", "keys", "windows", "docs", "more", "bytes")
        b = Block(left)
        names, _ = b.distinct_names()
        names = names[answers(of_round(right, 0), mixed(names))[0] > 1]
        if not len(names):
            return _dealt(0, np.empty(0, np.int64), {k: [] for k in columns})
        b.narrowed(np.flatnonzero(names[np.minimum(np.searchsorted(names, b.names), len(names) - 1)] == b.names))
        keys = b.keys()
        order = np.lexsort((b.docs, keys))
        new = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(keys) else np.empty(0, np.int64)
        one = order[new]
        last = order[np.append(new[1:], len(order)) - 1]
        raw = b.data.tobytes()
        return _dealt(
            left.column("part")[0].as_py(),
            _bucket(b.names[one], buckets),
            {
                "names": b.names[one],
                "keys": keys[one],
                "windows": b.windows[one].astype(np.uint8),
                "docs": b.docs[one],
                "more": (b.docs[one] < b.docs[last]).astype(np.uint8),
                "bytes": [raw[f : f + w - 1 + LENGTH] for f, w in zip(b.first[one].tolist(), b.windows[one].tolist())],
            },
        )

    smallest = saved(
        blocks.groupBy("part")
        .cogroup(answered([shared], n).groupBy("to"))
        .applyInArrow(send_contexts, "bucket long, part long, names binary, keys binary, windows binary, docs binary, more binary, bytes binary")
        .groupBy("bucket")
        .applyInArrow(_smallest, ANSWER),
        "suffix-contexts",
    )

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left)
        keys, sizes, least = _joined(right, "keys", _U), _joined(right, "sizes", np.uint8).astype(np.int64), _joined(right, "docs", np.int64)
        change = np.zeros(len(b.data) + 1, np.int32)
        if len(keys):
            begin = np.cumsum(sizes) - sizes
            order = np.argsort(keys)
            own = b.keys()
            found = order[np.minimum(np.searchsorted(keys, own, sorter=order), len(keys) - 1)]
            hit = np.flatnonzero((keys[found] == own) & (sizes[found] == b.windows))
            found = found[hit]
            m = b.windows[hit]
            inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            go = least[np.repeat(begin[found], m) + inside] < np.repeat(b.docs[hit], m)
            place = (np.repeat(b.first[hit], m) + inside)[go]
            np.add.at(change, place, 1)
            np.add.at(change, place + LENGTH, -1)
        gone = np.cumsum(change[:-1]) > 0
        out, at = [], 0
        for doc_id, size in zip(b.ids, b.sizes.tolist()):
            g, d = gone[at : at + size], b.data[at : at + size]
            at += size
            spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if size else 0
            out.append((doc_id, size, int(g.sum()), spans, hashlib.sha256((d[~g] if spans else d).tobytes()).hexdigest()))
        cols = list(zip(*out)) if out else [[]] * 5
        types = (*[pa.int64()] * 4, pa.string())
        return pa.table({k: pa.array(c, t) for k, c, t in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), cols, types)})

    return (
        blocks.groupBy("part")
        .cogroup(smallest.groupBy("part"))
        .applyInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
