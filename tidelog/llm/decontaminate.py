"""Benchmark decontamination over a distributed positional inverted index.

Training texts are indexed block by block: a block's postings are, for each
term, the sorted positions at which it occurs (document boundaries leave a gap
in the positions). The postings are written as Parquet to the shared folder,
one row a block, and any number of test sets can be looked up in them. Only the
terms that some test item uses are stored when terms are given.

A lookup sends the test windows to the blocks in chunks of at most CHUNK_WINDOWS,
so that the driver and a worker hold one chunk whatever the test set's size, and
intersects offset-adjusted posting lists, beginning with the window's rarest term
in that block: a window whose terms don't all occur in the block costs nothing.
What survives all terms is an exact phrase match; with slop >= 0, windows all of
whose terms lie within slop words of the window's extent around its rarest term
are proximity matches. Several chunks are united by the document's row (its block
and place there), whatever its id.

Words are runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after lower-casing A-Z. A
window is width consecutive words of an item; an item of fewer words, but not
none, is one window.

Defined cases: null and empty texts have no words; items without words never
match; a null item_id or doc_id stays null (a null item counts but isn't
listed); repeated items are one item if their ids agree; documents that repeat an
id or have none are separate rows, in keep_clean too, which goes by the text; of
equally rare terms the first leads; texts may be of any length; an empty table of
documents gives no rows, one of items no hits; keep_clean passes columns of any
names through.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, fresh_path, saved

WIDTH = 10
#: Windows of one lookup pass; larger test sets are looked up chunk by chunk. Distinct test terms beyond which all are indexed.
CHUNK_WINDOWS, TERMS = 200_000, 1_000_000
#: Bytes of text in a block.
BLOCK = 4 << 20
GAP = 1
#: What keep_clean knows a text by.
DIGEST = "unhex(md5(cast(text as binary)))"

INDEX = "block string, doc_ids binary, null_ids binary, digests array<binary>, starts binary, n_words binary, terms array<binary>, ends binary, positions binary"


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LETTERS).split()


def _index_rows(batches: Iterator[pa.RecordBatch], terms: frozenset | None) -> Iterator[pa.RecordBatch]:
    ids, digests, texts, size = [], [], [], 0

    def row():
        known: dict[bytes, int] = {}
        if terms is not None:
            known = {t: i for i, t in enumerate(sorted(terms))}
        parts, starts, counts, at = [], [], [], 0
        for t in texts:
            w = words(t)
            if terms is None:
                codes = np.fromiter((known.setdefault(x, len(known)) for x in w), np.int32, len(w))
            else:
                get = known.get
                codes = np.fromiter((get(x, -1) for x in w), np.int32, len(w))
            starts.append(at)
            counts.append(len(w))
            parts += [codes, np.full(GAP, -1, np.int32)]
            at += len(w) + GAP
        codes = np.concatenate(parts) if parts else np.empty(0, np.int32)
        places = np.flatnonzero(codes >= 0)
        codes = codes[places]
        order = np.argsort(codes, kind="stable")
        codes, places = codes[order], places[order].astype(np.int32)
        used, begin = np.unique(codes, return_index=True)
        names = sorted(known, key=known.get)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([uuid.uuid4().hex]),  # the index is written once, so a block keeps its name
                pa.array([np.array([i or 0 for i in ids], np.int64).tobytes()], pa.binary()),
                pa.array([np.array([i is None for i in ids], np.bool_).tobytes()], pa.binary()),
                pa.array([digests], pa.list_(pa.binary())),
                pa.array([np.array(starts, np.int32).tobytes()], pa.binary()),
                pa.array([np.array(counts, np.int32).tobytes()], pa.binary()),
                pa.array([[names[i] for i in used]], pa.list_(pa.binary())),
                pa.array([np.append(begin[1:], len(codes)).astype(np.int64).tobytes()], pa.binary()),
                pa.array([places.tobytes()], pa.binary()),
            ],
            names=[f.split()[0] for f in INDEX.split(", ")],
        )

    for b in batches:
        for i, x, t in zip(b.column(0), b.column(1), b.column(2)):
            text = t.as_py()
            ids.append(i.as_py())
            digests.append(x.as_py())
            texts.append(text)
            size += len(text or b"")
            if size >= BLOCK:
                yield row()
                ids, digests, texts, size = [], [], [], 0
    if ids:
        yield row()


def build_index(docs: DataFrame, terms: frozenset | None = None, path: str | None = None) -> DataFrame:
    """The stored index of docs (doc_id, text), read back from its files."""
    spark, path = docs.sparkSession, path or fresh_path(docs.sparkSession, "postings")
    docs.selectExpr("cast(doc_id as long) doc_id", f"{DIGEST} digest", "cast(text as binary) text").mapInArrow(
        lambda batches: _index_rows(batches, terms), INDEX
    ).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


class Windows:
    """Test windows as rows of term numbers, -1 where a window is shorter than width, and the item ids (as text) of each."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], width: int = WIDTH):
        self.terms = sorted({w for _, ws in items for w in ws})
        code = {t: i for i, t in enumerate(self.terms)}
        rows: dict[tuple, set] = {}
        for item, ws in items:
            c = [code[w] for w in ws]
            for k in range(max(1, len(c) - width + 1) if c else 0):
                rows.setdefault(tuple(c[k : k + width]), set()).add(item)
        self.codes = np.full((len(rows), width), -1, np.int32)
        for k, r in enumerate(rows):
            self.codes[k, : len(r)] = r
        self.length = (self.codes >= 0).sum(1).astype(np.int64)
        self.items = list(rows.values())


class Block:
    """One row of the index. key holds term * span + position, sorted: membership in a posting list is a binary search."""

    def __init__(self, row: dict, terms: list[bytes]):
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.nulls = np.frombuffer(row["null_ids"], np.bool_)
        self.starts = np.frombuffer(row["starts"], np.int32).astype(np.int64)
        self.n_words = np.frombuffer(row["n_words"], np.int32).astype(np.int64)
        here = {t: i for i, t in enumerate(row["terms"])}
        ends = np.frombuffer(row["ends"], np.int64)
        positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        at = np.array([here.get(t, -1) for t in terms], np.int64)
        first = np.append(0, ends)
        self.begin = np.where(at >= 0, first[at], 0)
        self.count = np.where(at >= 0, first[at + 1] - first[at], 0)
        self.span = int(self.starts[-1] + self.n_words[-1] + 2) if len(self.starts) else 1
        self.positions = positions
        term = np.repeat(np.arange(len(here)), np.diff(first)) if len(here) else np.empty(0, np.int64)
        self.key, self.local = term * self.span + positions, at

    def _from_rarest(self, w: Windows):
        """The windows all of whose terms occur, their terms from rarest to most frequent and those terms' offsets."""
        counts = np.where(w.codes >= 0, self.count[w.codes], np.iinfo(np.int64).max)
        alive = np.flatnonzero(counts.min(1) > 0) if len(counts) else np.empty(0, np.int64)
        order = np.argsort(counts[alive], axis=1, kind="stable")
        return alive, np.take_along_axis(w.codes[alive], order, 1), order

    def _candidates(self, alive, rare):
        n = self.count[rare]
        which = np.repeat(np.arange(len(alive)), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, self.positions[np.repeat(self.begin[rare], n) + inside]

    def phrases(self, w: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its first word) of every exact match."""
        alive, codes, offsets = self._from_rarest(w)
        if not len(alive):
            return alive, alive
        which, start = self._candidates(alive, codes[:, 0])
        start = start - offsets[which, 0]
        for k in range(1, codes.shape[1]):
            if not len(which):
                break
            c = codes[which, k]
            want = self.local[c] * self.span + start + offsets[which, k]
            at = np.searchsorted(self.key, want)
            ok = (c < 0) | ((at < len(self.key)) & (self.key[np.minimum(at, len(self.key) - 1)] == want))
            which, start = which[ok], start[ok]
        return alive[which], start

    def near(self, w: Windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its rarest word) where every term lies within the window's length + slop of that word, in its document."""
        alive, codes, _ = self._from_rarest(w)
        if not len(alive):
            return alive, alive
        which, place = self._candidates(alive, codes[:, 0])
        for k in range(1, codes.shape[1]):
            if not len(which):
                break
            c, reach = codes[which, k], w.length[alive[which]] - 1 + slop
            doc = np.searchsorted(self.starts, place, "right") - 1
            low = np.maximum(place - reach, self.starts[doc])
            high = np.minimum(place + reach, self.starts[doc] + self.n_words[doc] - 1)
            base = self.local[c] * self.span
            at = np.searchsorted(self.key, base + low)
            ok = (c < 0) | ((at < len(self.key)) & (self.key[np.minimum(at, len(self.key) - 1)] <= base + high))
            which, place = which[ok], place[ok]
        return alive[which], place


#: block and row number a document's row, whatever its id. items and near: ids as text, null for items without one.
FOUND = "block string, row int, doc_id long, digest binary, n_words long, n_hit long, items array<string>, near array<string>, hits binary"


def _lookup(batches: Iterator[pa.RecordBatch], w: Windows, slop: int, all_rows: bool) -> Iterator[pa.RecordBatch]:
    """FOUND rows of an index's rows: every document's, or only those with a match."""
    ids = lambda x: sorted(x, key=lambda i: (i is None, i or ""))
    for batch in batches:
        for row in batch.to_pylist():
            b = Block(row, w.terms)
            which, start = b.phrases(w)
            cover = np.zeros(b.span + 1, np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + w.length[which], -1)
            hit = np.cumsum(cover) > 0
            sums = np.append(0, np.cumsum(hit))
            n_hit = sums[b.starts + b.n_words] - sums[b.starts] if len(b.starts) else []

            def per_doc(which, place):
                found: dict[int, set] = {}
                for d, k in {*zip((np.searchsorted(b.starts, place, "right") - 1).tolist(), which.tolist())}:
                    found.setdefault(d, set()).update(w.items[k])
                return found

            items = per_doc(which, start)
            close = per_doc(*b.near(w, slop)) if slop >= 0 else {}
            rows = range(len(b.starts)) if all_rows else sorted({*items, *close})
            cols = zip(
                *(
                    (
                        row["block"],
                        r,
                        None if b.nulls[r] else int(b.doc_ids[r]),
                        row["digests"][r],
                        int(b.n_words[r]),
                        int(n_hit[r]),
                        ids(items.get(r, ())),
                        ids(close.get(r, ())),
                        np.packbits(hit[b.starts[r] : b.starts[r] + b.n_words[r]]).tobytes() if n_hit[r] else None,
                    )
                    for r in rows
                )
            )
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(list(cols) or [[]] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in FOUND.split(", ")])


def _item_words(items: DataFrame) -> Iterator[tuple[str | None, list[bytes]]]:
    """(item id as text, words) of the distinct items, which pass the driver one partition at a time."""
    for i, t in items.selectExpr("cast(cast(item_id as long) as string) item_id", "cast(text as binary) text").distinct().toLocalIterator():
        yield i, words(bytes(t) if t is not None else None)


def chunks(items: DataFrame, width: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The test set in lists of at most CHUNK_WINDOWS windows (and one item's); a longer item is cut into pieces that share width - 1 words."""
    out, size = [], 0
    for i, w in _item_words(items):
        for at in range(0, max(1, len(w) - width + 1), CHUNK_WINDOWS):
            piece = w[at : at + CHUNK_WINDOWS + width - 1]
            n = max(1, len(piece) - width + 1)
            if out and size + n > CHUNK_WINDOWS:
                yield out
                out, size = [], 0
            out.append((i, piece))
            size += n
    if out:
        yield out


def _terms(items: DataFrame) -> frozenset | None:
    """The test set's terms, or None (all are indexed then) if there are over TERMS."""
    found: set[bytes] = set()
    for _, w in _item_words(items):
        found.update(w)
        if len(found) > TERMS:
            return None
    return frozenset(found)


def matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = -1, all_rows: bool = True) -> DataFrame:
    """FOUND rows with all_hits (the hit words' bits of each chunk) instead of hits and n_hit: of every row of docs, or of those with a match."""
    index = build_index(docs, _terms(items))
    context, first, found = index.sparkSession.sparkContext, None, []

    def looked_up(chunk, every: bool) -> DataFrame:
        w = context.broadcast(Windows(chunk, width))
        return index.mapInArrow(lambda batches: _lookup(batches, w.value, slop, every), FOUND)

    for c in chunks(items, width):
        if first is not None:
            # more than one chunk: each is looked up before the next one is read
            if not found:
                found.append(saved(looked_up(first, False), "matches"))
            found.append(saved(looked_up(c, False), "matches"))
        first = first or c
    if not found:
        return looked_up(first or [], all_rows).withColumn("all_hits", F.array("hits")).drop("hits", "n_hit")
    several = found[0]
    for f in found[1:]:
        several = several.union(f)
    # a document's matches are in one row a chunk
    united = several.groupBy("block", "row", "doc_id", "digest", "n_words").agg(
        F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("near")).alias("near"), F.collect_list("hits").alias("all_hits")
    )
    if not all_rows:
        return united
    rows = looked_up([], True).select("block", "row", "doc_id", "digest", "n_words")
    nothing = F.array().cast("array<string>")
    lists = {"items": F.coalesce("items", nothing), "near": F.coalesce("near", nothing), "all_hits": F.coalesce("all_hits", F.array().cast("array<binary>"))}
    return rows.join(united.drop("doc_id", "digest", "n_words"), ["block", "row"], "left").withColumns(lists)


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and n_near (items with a proximity match) of each row of docs."""
    found = matches(docs, items, width, slop)

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                union = None
                for h in r["all_hits"]:
                    if h is not None:
                        bits = np.unpackbits(np.frombuffer(h, np.uint8))
                        union = bits if union is None else union | bits
                n_hit, hit = int(union.sum()) if union is not None else 0, set(r["items"])
                listed = ",".join(sorted(i for i in hit if i is not None))
                out.append((r["doc_id"], r["n_words"], n_hit, len(hit), hashlib.sha256(listed.encode()).hexdigest(), n_hit > 0, len(set(r["near"]))))
            cols = list(zip(*out)) if out else [[]] * 7
            types = [pa.int64()] * 4 + [pa.string(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near"]
    return found.select("doc_id", "n_words", "all_hits", "items", "near").mapInArrow(
        run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_near long"
    )


def keep_clean(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of docs, with their columns, in which no window of any item occurs."""
    bad = saved(matches(docs, items, width, all_rows=False).select(F.col("digest").alias("_digest")).distinct(), "contaminated")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.expr(DIGEST).alias("_digest"))
    return row.join(bad, "_digest", "left_anti").select("_row.*")
