"""Operators over whole tables against brute force, on a small table with the odd cases."""

import base64
import collections
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import lm, near, suffixes, warc
from tidelog.llm.common import LOWER


def test_warc(spark, empty):
    pages = [(5, "http://a", "<p>é</p>"), (3, "http://b", "<p>é</p>"), (7, None, None), (8, "http://c\r\nX: y", ""), (None, "http://d", "<p>é</p>"), (9, "u", "z" * 300_000), (9, "u", "z" * 300_000), (None, "u", "alone")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, sha string").repartition(3)
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, _, h in pages:
        k = digest(h)
        first[k] = i if first.get(k) is None else first[k] if i is None else min(i, first[k])
    want = collections.Counter()
    for i, u, h in pages:
        lead = first[digest(h)]
        revisit = i != lead and lead is not None
        want[i, u.replace("\r\n", "%0D%0A") if u else None, len((h or "").encode()), digest(h), "revisit" if revisit else "response", lead if revisit else None] += 1
    index = warc.write(df)
    cols = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    got = warc.read(index)
    assert collections.Counter(tuple(r[c] for c in cols) for r in got.collect()) == want
    payloads = {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response' and page_id is not null").collect()}
    assert payloads == {3: "<p>é</p>".encode(), 7: b"", 9: b"z" * 300_000}
    assert [r.page_id for r in warc.read(index.where("page_id = 5")).collect()] == [5]
    assert len("<p>é</p>".encode()) == 9
    assert warc.read(warc.write(df, min_bytes=9)).where("page_id = 5").first().refers_to == 3
    assert warc.read(warc.write(df, min_bytes=10)).where("page_id = 5").first().refers_to is None
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_ranges():
    got = [(o, n, len(m)) for o, n, m in warc._ranges([(0, 10), (10, 5), (warc.GAP + 15, 1), (3 * warc.GAP, 2), (3 * warc.GAP + 2, warc.READ)])]
    assert got == [(0, warc.GAP + 16, 3), (3 * warc.GAP, 2, 1), (3 * warc.GAP + 2, warc.READ, 1)]


def plain_scores(words):
    """words: (id, tokens) -> (counts, total, base score and model score of (id, tokens)) by the model's definition."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts, pairs, triples = collections.Counter(), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for i, w in words:
        if not held(i):
            counts.update(w)
            for a, b in zip(["begin", *w], w):
                pairs[a][b] += 1
            for a, b, c in zip(["begin", *w], w, w[1:]):
                triples[a, b][c] += 1
    total, distinct, d = sum(counts.values()), len(counts), lm.D[0] / lm.D[1]

    def p1(w):
        return (counts[w] + 1) / (total + distinct + 1)

    def p2(a, w):
        n = sum(pairs[a].values())
        return max(pairs[a][w] - d, 0) / n + d * len(pairs[a]) / n * p1(w) if n else p1(w)

    def p3(a, b, w):
        arcs = {k: v for k, v in triples[a, b].items() if v >= lm.MIN_COUNT}
        if not arcs:
            return p2(b, w)
        n = sum(triples[a, b].values())
        assert n == pairs[a][b]
        return max(arcs.get(w, 0) - d, 0) / n + (1 - sum(v - d for v in arcs.values()) / n) * p2(b, w)

    def model(w):
        return sum(math.log10(p3(w[k - 2] if k > 1 else "begin", w[k - 1], x) if k else p2("begin", x)) for k, x in enumerate(w))

    busy = max(triples, key=lambda k: sum(triples[k].values()), default=None)
    if busy:  # a state's probabilities sum to one over the vocabulary and one unknown word
        assert sum(p3(*busy, w) for w in [*counts, b"never seen"]) == pytest.approx(1, rel=1e-9)
    return held, counts, total, lambda w: sum(math.log10(p1(x)) for x in w), model


@pytest.mark.parametrize("fan", [1024, 2])
def test_lm(spark, docs, monkeypatch, fan):
    """All counts and both scores; with more blocks than a row's ranges, messages are split a second time and stay the same."""
    from tidelog.llm import common, exchange

    if fan == 2:
        monkeypatch.setattr(common, "MIN_BLOCKS", 9)
        monkeypatch.setattr(common, "MAX_BUCKETS", 4)
        monkeypatch.setattr(exchange, "FAN", 2)
    out = collections.defaultdict(list)
    for r in lm.score(docs).collect():
        out[r.doc_id].append(r)
    words = [(r.doc_id, (r.text or "").encode().translate(LOWER).split() + [None]) for r in docs.collect()]
    held, counts, total, base, model = plain_scores(words)
    assert len(words) == sum(map(len, out.values()))
    for i, w in words:
        for r in out[i]:
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(counts[x] > 0 for x in w), total)
            assert r.base_score == pytest.approx(base(w), rel=1e-9)
            assert r.score == pytest.approx(model(w), rel=1e-9)


def test_lm_rare_histories(spark):
    """Words and pairs far under any share of the tokens are states, frequent ones too."""
    filler = " ".join(f"f{i * i % 97}" for i in range(60_000))
    texts = [(0, filler)] + [(i, "rare bird sings. rare bird flies " + f"only{i % 4} here") for i in range(1, 14)]
    words = [(i, [*t.split(), None]) for i, t in texts]
    held, counts, total, _, model = plain_scores(words)
    assert not held(0) and any(held(i) for i, _ in words) and counts["only1"] / total < 1e-4
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()}
    for i, w in words:
        assert got[i].score == pytest.approx(model(w), rel=1e-9)


def test_packed_numbers():
    from tidelog.llm import exchange

    r = np.random.default_rng(1)
    for top in (1, 255, 256, 1 << 24, 1 << 47, 1 << 62):
        x = r.integers(0, top, 1000, endpoint=True)
        assert (exchange.unpacked(exchange.packed(x), 1000) == x).all()
    size = np.array([3, 1, 500, 1])
    keys = np.concatenate([np.sort(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)) for n in size])
    code = exchange._packed_keys(keys, size)
    assert (exchange._unpacked_keys(code, size) == keys).all()
    assert len(exchange.unpacked(exchange.packed(keys[:0]), 0)) == 0


def test_messages_grow_with_the_keys():
    """A block sends no more rows than ranges, whatever the number of buckets, and no more pieces than keys."""
    from tidelog.llm import exchange

    keys = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64) << np.uint64(1)
    for n in (7, 10**6, 10**9):
        t = exchange.sent(3, keys, np.ones(5000, np.int64), n)
        assert t.num_rows <= min(n, exchange.FAN) and sum(len(x.as_py()) // 4 for x in t.column("size")) <= 5000


def test_lm_odd_tables(nulls, empty):
    assert lm.score(empty).count() == 0
    assert sorted((r.doc_id or -1, r.n_tokens) for r in lm.score(nulls).collect()) == [(-1, 1), (-1, 7), (1, 7)]


def brute_removed(texts):
    """(id, text) -> (bytes, removed, spans, digest of the rest)."""
    first, last, out = {}, float("inf"), {}
    rank = lambda i: last if i is None else i
    for i, t in texts:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(rank(i), first.get(t[k : k + 50], last))
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < rank(i):
                gone[k : k + 50] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int)])) == 1
        out[i, t] = (len(t), int(gone.sum()), int(edge.sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
    return out


def test_suffixes(spark, docs, empty, nulls):
    shifted = [(900, "q" + "ab " * 300), (901, "é" * 80), (902, "zé" + "é" * 70), (None, "ab " * 60), (903, "a" * 49), (904, "a" * 50), (905, "b" * 50 + "a" * 50)]
    extra = spark.createDataFrame(shifted, "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra)
    texts = [(r.doc_id, (r.text or "").encode()) for r in both.collect()]
    want = collections.Counter((i, *v) for (i, t) in texts for v in [brute_of[i, t]]) if (brute_of := brute_removed(texts)) else None
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = collections.Counter(tuple(r[c] for c in cols) for r in suffixes.suffix_dedup(both).collect())
    assert got == want and sum(k[2] > 0 for k in want) > 20
    assert suffixes.suffix_dedup(empty).count() == 0 and suffixes.suffix_dedup(nulls).count() == 3


def test_suffixes_in_more_blocks_than_buckets(spark, docs, monkeypatch):
    """More blocks than a block table's buckets and a message's ranges give the same rows."""
    from tidelog.llm import common, exchange

    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    bag = lambda: collections.Counter(tuple(r[c] for c in cols) for r in suffixes.suffix_dedup(docs).collect())
    want = bag()
    monkeypatch.setattr(common, "MIN_BLOCKS", 9)
    monkeypatch.setattr(common, "MAX_BUCKETS", 4)
    monkeypatch.setattr(exchange, "FAN", 2)
    assert bag() == want


def test_contexts_of_many_blocks_go_in_few_rows(spark, docs, monkeypatch):
    """Blocks beyond a message's ranges don't each have a bucket of contexts, which would be rows by the square of the blocks."""
    from tidelog.llm import common, exchange

    kept, saved = {}, suffixes.saved
    monkeypatch.setattr(suffixes, "saved", lambda df, name: kept.setdefault(name, saved(df, name)))
    monkeypatch.setattr(common, "MIN_BLOCKS", 9)
    monkeypatch.setattr(exchange, "FAN", 2)
    suffixes.suffix_dedup(docs)
    assert 0 < kept["suffix-contexts"].count() <= 9 * 2


def test_a_bucket_is_gone_through_once_for_all_blocks(monkeypatch):
    """The work on a bucket grows with its contexts, not with contexts times blocks."""
    looked = []

    class Minimum:
        at = np.minimum.at

        def reduceat(self, x, begin):
            looked.append(len(x))
            return np.minimum.reduceat(x, begin)

    class Numpy:
        minimum = Minimum()

        def __getattr__(self, name):
            return getattr(np, name)

    text, blocks = "".join(f"passage {i} of all blocks, " for i in range(100)), 40
    parts = [suffixes.Block(pa.table({"doc_id": [i], "text": [text.encode()]})) for i in range(blocks)]
    rows = []
    for i, b in enumerate(parts):
        raw = b.data.tobytes()
        contexts = [raw[f : f + w + 49] for f, w in zip(b.first.tolist(), b.windows.tolist())]
        more = np.zeros(len(b.first), np.uint8)
        columns = {"names": b.names, "keys": b.keys(), "windows": b.windows.astype(np.uint8), "docs": b.docs, "more": more, "bytes": contexts}
        rows.append(suffixes._dealt(i, np.zeros(len(b.first), np.int64), columns))
    monkeypatch.setattr(suffixes, "np", Numpy())
    out = suffixes._smallest(pa.concat_tables(rows))
    # all but the first block's document lose what it has
    assert out.column("part").to_pylist() == list(range(1, blocks))
    assert all(not any(x.as_py()) for x in out.column("docs"))
    assert sum(looked) <= parts[0].windows.sum()


def test_suffixes_in_pieces(monkeypatch):
    """Runs don't depend on how a long text is cut into pieces: the same windows get the same names."""
    r = np.random.default_rng(2)
    data = r.integers(97, 100, 5000).astype(np.uint8)
    ends = np.array([10, 60, 60, 2000, 5000])

    def windows():
        n, f, s = suffixes.runs(data, ends)
        return {int(a) + k: int(x) for x, a, m in zip(n, f, s) for k in range(m)}

    whole = windows()
    monkeypatch.setattr(suffixes, "CHUNK", 173)
    assert windows() == whole and len(whole) == 1 + 1940 - 49 + 3000 - 49


def test_suffix_order():
    """The mergesort against Python's, with many ties, and with hashes that all collide."""
    r = np.random.default_rng(1)
    data = r.integers(97, 99, 1500).astype(np.uint8)
    starts, groups = r.permutation(1400), np.sort(r.integers(0, 9, 1400))
    text = data.tobytes()
    key = lambda i: (groups[i], text[starts[i] : starts[i] + 50])
    for collide in (False, True):
        s = suffixes.Suffixes(data)
        if collide:
            s.h = np.zeros_like(s.h)
        assert [key(i) for i in s.sort(starts, groups)] == sorted(map(key, range(1400)))


def multisets(texts):
    out = {}
    for i, t in texts:
        w = (t or "").encode().translate(LOWER).split()
        if w:
            out[i] = collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
    return out


def brute_classes(texts):
    sets, parent = multisets(texts), {i: i for i, _ in texts}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = sum((sets[a] & sets[b]).values())
            if both * 5 >= 4 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i, _ in texts}


def test_near(spark, docs, nulls, empty):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").distinct().collect()]
    want = brute_classes(texts)
    got = near.near_classes(docs)
    assert {r.doc_id: r.class_id for r in got.collect()} == want and got.count() == docs.count()
    assert len(set(want.values())) < len(want) - 15
    kept = near.keep_first(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(want.values())
    assert near.near_classes(empty).count() == 0
    assert sorted((r.doc_id or -1, r.class_id, r.kept) for r in near.near_classes(nulls).collect()) == [(-1, None, True), (-1, None, True), (1, 1, True)]


def test_near_chain(spark):
    """A chain of texts whose neighbours alone are similar is one class, and so is a large group of near copies."""
    words = [f"w{i}" for i in range(200)]
    chain = [(i, " ".join(words[:100] if not i else [*words[3 * i : 100 + 3 * i]])) for i in range(25)]
    star = [(100 + i, " ".join("x" + w if k != 7 * i % 100 else f"new{i}" for k, w in enumerate(words[:100]))) for i in range(40)]
    df = spark.createDataFrame(chain + star, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near.near_classes(df).collect()}
    assert got == brute_classes(chain + star) and set(got.values()) == {0, 100}


def test_near_of_repeated_ids(spark, nulls, empty):
    """Rows of one id with different texts: near copies of either text are in the id's class, whichever row comes first."""
    r = np.random.default_rng(3)
    a, b, c = ([f"w{x}" for x in r.integers(0, 10**6, 100)] for _ in range(3))
    near_copy = lambda w: " ".join([*w[:50], "other", *w[51:]])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, near_copy(a)), (8, near_copy(b)), (9, " ".join(c)), (5, " ".join(a)), (None, " ".join(a))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for order in (df, df.orderBy("text"), df.orderBy(F.desc("text"))):
        got = {x.doc_id: x.class_id for x in near.near_classes(order).collect()}
        assert got == {5: 5, 7: 5, 8: 5, 9: 9, None: None}
    kept = near.keep_first(df)
    assert sorted((x.doc_id or -1) for x in kept.collect()) == [-1, 5, 5, 5, 9]
    assert near.keep_first(empty).count() == 0 and near.keep_first(nulls).columns == nulls.columns and near.keep_first(nulls).count() == 3


def test_long_paths_take_few_levels(spark, monkeypatch):
    """A sorted path and a shuffled one of a thousand edges."""
    made = collections.Counter()
    real = near.saved
    monkeypatch.setattr(near, "saved", lambda df, name: made.update([name]) or real(df, name))
    shuffled = [int(x) for x in np.random.default_rng(0).permutation(1001) + 5000]
    df = spark.createDataFrame([(i, i + 1) for i in range(1000)] + list(zip(shuffled, shuffled[1:])), "a long, b long").repartition(2)
    assert {x.comp for x in near.components(df).collect()} == {0, 5000}
    assert made["edges"] <= 12


def test_signatures_are_unbiased():
    r = np.random.default_rng(0)
    items = np.sort(r.integers(0, 1 << 62, 300)).astype(np.uint64)
    a = r.integers(1, 12, 300)
    b = np.maximum(1, a - r.integers(0, 5, 300))
    sig = near.signatures([(items, a), (items, b), (items[:0], a[:0])], m=8192)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert (sig[0] == sig[1]).mean() == pytest.approx(true, abs=0.02) and np.isinf(sig[2]).all()


def test_components(spark):
    r = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2)) if a != b] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {x.node: x.comp for x in near.components(df).collect()} == {x: root(x) for x in parent}


def test_pipeline(spark, docs, tmp_path):
    """Near dedup against a plain version on its own input, and what the stages have in common; the other operators have theirs above."""
    import corpus_pipeline

    table = docs.dropDuplicates(["doc_id"])
    labels = spark.createDataFrame([(r.doc_id, 1, 0) for r in table.collect()], "doc_id long, quality int, toxic int")
    text = max((r.text or "" for r in table.collect()), key=lambda t: 50 < len(t.split()) < 140)
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    d = f"file://{tmp_path}"
    table.write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    bench.write.parquet(f"{d}/benchmark.parquet")
    now = spark.read.parquet(f"{d}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, d)
        if name != "packing":
            assert out.columns == table.columns
        out.write.parquet(f"{d}/{name}")
        now = spark.read.parquet(f"{d}/{name}")
        ids.append({r.doc_id for r in now.collect()})
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[3] == ids[4]
    assert len(ids[0]) < table.count() and len(ids[2]) < len(ids[1]) and len(ids[3]) < len(ids[2])
    near_in = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/line_dedup").collect()]
    assert ids[2] == set(brute_classes(near_in).values())
    rows = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert {r[0] for r in rows(corpus_pipeline.run(spark, d))} == ids[4]
