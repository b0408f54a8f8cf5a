"""MinHash near-dedup by BagMinHash over multisets of word shingles.

A document is the multiset of its shingles of WIDTH words. The weight axis is
cut into dyadic intervals (0,1], (1,2], (2,4], ...; each shingle and interval
has a Poisson process of points in time, seeded by both, at a rate of the
interval's length. Every point has a register and a place in its interval, and
counts for a shingle of weight w if its place is at most w. A register keeps its
earliest point. Two documents agree in a register with the probability of their
weighted Jaccard similarity, and since points of a process come in order, a
process is left as soon as it is later than all registers, and a weight costs its
logarithm.

Registers are banded (BANDS x ROWS); texts that share a band are candidates, and
their multisets are compared exactly: similarity >= MIN_SIMILARITY makes a link,
and classes are the links' components, named by their smallest document. Copies
of a text are one text, numbered in the order of their smallest documents. Each
band's group is compared with its smallest text, which joins most of them. Where
groups still lie in several components, the method's bands are helped by an exact
prefix filter: candidates come from their texts' rarest shingles, which misses
none: first with one pivot each, then in pairs across what is still apart. A pair
is made only where both can still share enough after their first common shingle.
Candidates of 0.8 are missed with probability 5e-8.

Everything after the signatures is joins and aggregations of narrow saved rows,
so that Spark can split a hot group's rows.

Defined cases: documents without words (null and empty texts too) are their own
class; fewer words than WIDTH make one shingle; a null doc_id has a null class and
stays; rows that repeat an id are one document, which unites the classes of all its
texts; of equally small texts the one with the smaller digest is the pivot; texts
may be of any length; an empty table gives no rows; columns other than doc_id and
text aren't looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, discard, saved
from .exchange import mixed

WIDTH, BANDS, ROWS = 5, 32, 4
M = BANDS * ROWS
#: Similarity as a fraction, so that it is compared in integers.
MIN_SIMILARITY = (4, 5)
#: Elements whose processes are run at once, and words of at most LONGEST bytes that a worker remembers.
BATCH, REMEMBERED, LONGEST = 1 << 17, 1 << 17, 64
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST:
            self[word] = h
        return h


def shingles(text: bytes, known: _Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of a text, as 64-bit hashes, and how often each occurs."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, _U), np.empty(0, np.int64)
    h = np.fromiter(map(known.__getitem__, words), _U, len(words))
    if len(known) > REMEMBERED:
        known.clear()
    k = min(width, len(h))
    out = np.zeros(len(h) - k + 1, _U)
    for i in range(k):
        out = mixed(out * _U(_STEP) + h[i : i + len(out)])
    return np.unique(out + _U(k), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int = M) -> np.ndarray:
    """The registers' earliest times, a row for each multiset; sets without elements have infinite ones."""
    sig = np.full((len(sets), m), np.inf)
    flat = sig.reshape(-1)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    if not len(doc):
        return sig
    item, weight = np.concatenate([s for s, _ in sets]), np.concatenate([c for _, c in sets])
    docs, items, weights, levels = [doc], [item], [weight], [np.zeros(len(doc), np.int64)]
    level = 1
    while (more := weight > (1 << level - 1)).any():
        docs.append(doc[more])
        items.append(item[more])
        weights.append(weight[more])
        levels.append(np.full(int(more.sum()), level))
        level += 1
    doc, item, weight, level = map(np.concatenate, (docs, items, weights, levels))
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0).astype(np.float64)
    length = np.maximum(low, 1.0)
    seed = mixed(item + mixed(level.astype(_U) + _U(1)))
    time, n = np.zeros(len(doc)), 0
    while len(doc):
        n += 1
        x = mixed(seed + _U(n * _STEP & _MASK))
        time = time - np.log(((x >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)) / length
        y = mixed(x + _U(_STEP))
        place = low + (y >> _U(32)).astype(np.float64) / (1 << 32) * length
        latest = sig.max(1)
        live = time <= latest[doc]
        counts = live & (place < weight)
        np.minimum.at(flat, doc[counts] * m + ((y[counts] & _U(0xFFFFFFFF)) * _U(m) >> _U(32)).astype(np.int64), time[counts])
        latest = sig.max(1)
        live &= time <= latest[doc]
        doc, seed, weight, low, length, time = (v[live] for v in (doc, seed, weight, low, length, time))
    return sig


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A hash of each band, which holds its number."""
    x = sig.view(_U).reshape(len(sig), bands, -1)
    out = np.arange(bands, dtype=_U)[None, :] + np.zeros((len(sig), 1), _U)
    for i in range(x.shape[2]):
        out = mixed(out * _U(_STEP) + x[:, :, i])
    return out.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, name, n and bands of doc, name, text; no name, n 0 and no bands for a text without words."""
    known = _Words()

    def made(rows, sets):
        keys = band_keys(signatures(sets)) if rows else np.empty((0, BANDS), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in rows], pa.int64()),
                pa.array([x if len(s) else None for (_, x), (s, _) in zip(rows, sets)], pa.binary()),
                pa.array([int(c.sum()) for _, c in sets], pa.int64()),
                pa.array([k.tolist() if len(s) else None for k, (s, _) in zip(keys, sets)], pa.list_(pa.int64())),
            ],
            names=["doc", "name", "n", "bands"],
        )

    rows, sets, size = [], [], 0
    for b in batches:
        for i, x, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            sets.append(shingles(t.as_py() or b"", known))
            rows.append((i, x))
            size += len(sets[-1][0])
            if size >= BATCH:
                yield made(rows, sets)
                rows, sets, size = [], [], 0
    if rows:
        yield made(rows, sets)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, name, items and counts of doc, name, text."""
    known = _Words()
    for b in batches:
        sets = [shingles(t.as_py() or b"", known) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([s.tobytes() for s, _ in sets], pa.binary()), pa.array([c.astype(np.uint32).tobytes() for _, c in sets], pa.binary())],
            names=["doc", "name", "items", "counts"],
        )


def similar(a: tuple, b: tuple, least: tuple[int, int] = MIN_SIMILARITY) -> bool:
    """Whether the multisets' weighted Jaccard similarity is at least least."""
    total = int(a[1].sum(dtype=np.int64) + b[1].sum(dtype=np.int64))
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum(dtype=np.int64))
    return both * least[1] >= least[0] * (total - both)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, sets = [c.to_pylist() for c in b.columns[:2]], b.columns[2:]
        keep = []
        for row in range(b.num_rows):
            x = [np.frombuffer(c[row].as_py(), t) for c, t in zip(sets, (_U, np.uint32) * 2)]
            if similar((x[0], x[1]), (x[2], x[3])):
                keep.append(row)
        yield pa.RecordBatch.from_arrays([pa.array([c[r] for r in keep], pa.int64()) for c in ids], names=["a", "b"])


def _ends(names: DataFrame) -> DataFrame:
    """names (node, to) with to replaced by the end of its chain: pointer doubling, a round for each doubling of the longest one."""
    while True:
        up = names.select(F.col("node").alias("to"), F.col("to").alias("far"))
        further = saved(names.select("node", "to").join(up, "to").select("node", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")), "names")
        discard(names)
        names = further
        if names.where("moved").isEmpty():
            return names


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node of its component) for every node of edges (a, b).

    On each level every node points to the first of itself and its neighbours, all nodes of a tree of pointers take its root's
    name, the edges are renamed, and what still differs is solved in the same way. Nodes are ordered by their numbers on the
    first level (which ends stars and sorted paths at once) and by fresh hashes on the later ones, where a node with
    neighbours is a root with a chance of one half at most: so levels are as many as the logarithm of a component's nodes.
    """
    levels = []
    now = saved(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    while not now.isEmpty():
        rank = lambda c: F.struct((F.xxhash64(F.col(c), F.lit(len(levels))) if levels else F.col(c)).alias("r"), F.col(c).alias("v"))
        names = _ends(saved(now.groupBy("a").agg(F.least(F.min(rank("b")), F.min(rank("a")))["v"].alias("to")).withColumnRenamed("a", "node"), "names"))
        levels.append(names)
        renamed = now.join(names.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        renamed = renamed.join(names.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        left = saved(renamed.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        discard(now)
        now = left
    if not levels:
        return now.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = levels[0].select("node", F.col("to").alias("comp"))
    if len(levels) == 1:
        return out  # the first level's roots are their trees' smallest nodes
    for names in levels[1:]:
        up = names.select(F.col("node").alias("comp"), "to")
        out = out.join(up, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    out = saved(out, "roots")
    least = saved(out.groupBy("comp").agg(F.min("node").alias("least")), "least")
    named = saved(out.join(least, "comp").select("node", F.col("least").alias("comp")), "components")
    discard(out, least, *levels)
    return named


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    side = lambda c: sets.select(F.col("doc").alias(c), F.col("items").alias(f"items_{c}"), F.col("counts").alias(f"counts_{c}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "items_a", "counts_a", "items_b", "counts_b")
    return joined.mapInArrow(_linked, "a long, b long")


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in range(b.num_rows):
            items, counts = np.frombuffer(b.column(2)[row].as_py(), np.int64), np.frombuffer(b.column(3)[row].as_py(), np.uint32)
            same = lambda v: pa.array(np.full(len(items), v, np.int64))
            yield pa.RecordBatch.from_arrays(
                [same(b.column(0)[row].as_py()), same(b.column(1)[row].as_py()), pa.array(items), pa.array(counts.astype(np.int64))],
                names=["doc", "n", "item", "c"],
            )


def _rarest(left: DataFrame, sets: DataFrame) -> DataFrame:
    """item, doc, n, before, alone: the rarest shingles of each of left (doc, n) up to a fifth of its elements, with the
    elements that stand before them and, of all elements, those that no other document of left has."""
    items = saved(left.join(sets, "doc").select("doc", "n", "items", "counts").mapInArrow(_items, "doc long, n long, item long, c long"), "items")
    df = saved(items.groupBy("item").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    known = items.join(df, "item", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    of_doc = Window.partitionBy("doc")
    before = F.sum("c").over(of_doc.orderBy("df", "item").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")
    alone = F.sum(F.when(F.col("df") == 1, F.col("c")).otherwise(0)).over(of_doc)
    ranked = known.withColumns({"before": before, "alone": alone})
    return saved(ranked.where("df > 1 and before * 5 <= n").select("item", "doc", "n", "before", "alone"), "rarest")


def _links(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links (a, b) that join all of a component. groups: key, doc, n of documents that share a band.

    First each group's members are compared with its smallest. Where groups still lie in several components, their documents'
    rarest shingles are the groups instead: similar multisets of sizes m <= n share (m + n) 4/9 >= 8/9 m elements and at least
    4/5 n, so the first common shingle, from rare to frequent, lies among the first ninth of the smaller and the first fifth of the
    larger. Their members are compared with the one that has fewest elements of its own, as most of its copies are similar to
    it; what then is in different components is compared in pairs.
    """
    pivots = saved(groups.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("p")).select("key", F.col("p.doc").alias("pivot"), F.col("p.n").alias("m")), "pivots")
    num, den = MIN_SIMILARITY
    fits = F.least("n", "m") * den >= F.greatest("n", "m") * num
    as_pair = (F.least("doc", "d").alias("a"), F.greatest("doc", "d").alias("b"))
    pairs = groups.join(pivots.withColumnRenamed("pivot", "d"), "key").where("doc <> d").where(fits).select(*as_pair).distinct()
    tested = saved(pairs, "pairs")
    links = saved(_verified(tested, sets), "links")
    rarest = None
    for stage in ("groups", "rarest", "rest"):
        comps = components(links).withColumnRenamed("node", "doc")
        rows = (groups if rarest is None else rarest).join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        key = "key" if rarest is None else "item"
        rows = saved(rows, "in-components")
        apart = rows.groupBy(key).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
        # a band's group of two is settled
        apart = saved(apart.where("lo <> hi" + (" and size > 2" if rarest is None else "")).select(key), "apart")
        rows = saved(rows.join(apart, key), "left")
        if rows.isEmpty():
            break
        if stage == "groups":
            rarest = _rarest(rows.select("doc", "n").distinct(), sets)
            continue
        if stage == "rarest":
            least = rows.groupBy("item").agg(F.min(F.struct("alone", "doc", "n", "comp")).alias("p"))
            other = saved(least.select("item", F.col("p.doc").alias("d"), F.col("p.n").alias("m"), F.col("p.comp").alias("c")), "pivots")
            pairs = rows.join(other, "item").where("comp <> c").where(fits)
        else:
            other = rows.where("before * 9 <= n").select("item", F.col("doc").alias("d"), F.col("n").alias("m"), F.col("comp").alias("c"), F.col("before").alias("b"))
            # of the first common shingle on, both have to hold all that they share
            pairs = rows.join(other, "item").where("m <= n and comp <> c").where(fits).where("least(n - before, m - b) * 9 >= (n + m) * 4")
        pairs = saved(pairs.select(*as_pair).distinct().join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.union(pairs)
        links = links.union(saved(_verified(pairs, sets), "links"))
    return links


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the smallest document of the class), kept (it is that document), a row for each row of docs."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("binary").alias("text"))
    source = source.withColumn("name", F.unhex(F.md5("text"))).select("doc", "name", "text")
    signed = saved(source.mapInArrow(_signed, "doc long, name binary, n long, bands array<long>"), "signatures")
    named = signed.where("doc is not null and name is not null")
    # texts are numbered in the order of their smallest documents, so that a smaller number is a smaller document
    firsts = saved(named.groupBy("name").agg(F.min("doc").alias("rep")), "first-documents")
    numbered = firsts.repartitionByRange("rep", "name").sortWithinPartitions("rep", "name").withColumn("t", F.monotonically_increasing_id())
    texts = saved(numbered, "texts")
    discard(firsts)
    members = saved(named.select("doc", "name").join(texts, "name").select("doc", "t").distinct(), "members")
    reps = named.select("doc", "name", "n", "bands").join(texts, "name").where("doc = rep").dropDuplicates(["name"])
    banded = saved(reps.select(F.col("t").alias("doc"), "n", F.explode("bands").alias("key")), "bands")
    discard(signed)
    shared = saved(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "shared-bands")
    groups = saved(banded.join(shared, "key").select("key", "doc", "n"), "groups")
    discard(banded, shared)
    wanted = saved(groups.select(F.col("doc").alias("t")).distinct().join(texts, "t").select(F.col("rep").alias("doc"), "name", "t"), "candidates")
    # shuffled at every size, so that the plan of a small run is that of a large one
    sets = source.join(wanted.select("doc").distinct().hint("shuffle_hash"), "doc", "left_semi").select("doc", "name", "text")
    sets = sets.mapInArrow(_shingled, "doc long, name binary, items binary, counts binary").join(wanted, ["doc", "name"])
    # rows that repeat an id and its text give equal sets
    sets = saved(sets.dropDuplicates(["doc", "name"]).select(F.col("t").alias("doc"), "items", "counts"), "shingles")
    links = _links(groups, sets)
    # a document with several texts unites their classes
    own = saved(members.groupBy("doc").agg(F.min("t").alias("t"), (F.max("t") > F.min("t")).alias("several")), "documents")
    several = members.withColumnRenamed("t", "b").join(own.where("several"), "doc").where("b <> t").select(F.col("t").alias("a"), "b")
    comps = components(several.union(links))
    discard(groups, sets, wanted)
    classes = own.select("doc", "t").join(comps.withColumnRenamed("node", "t"), "t", "left").select("doc", F.coalesce("comp", "t").alias("t"))
    classes = saved(classes.join(texts.select("t", F.col("rep").alias("class_id")), "t").select("doc", "class_id"), "classes")
    discard(members, own, texts, comps)
    return (
        source.select("doc").join(classes, "doc", "left")
        .select(F.col("doc").alias("doc_id"), F.coalesce("class_id", "doc").alias("class_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs, with their columns, that are the first of their class; rows that repeat an id stay together, those without one stay."""
    others = saved(near_classes(docs).where("not kept").select("doc_id").distinct(), "others")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id")
    return row.join(others, "doc_id", "left_anti").select("_row.*")
