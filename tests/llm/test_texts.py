"""Operators on single texts and lines against plain versions."""

import collections
import hashlib
import math
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, lines, packing, quality, spans, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
P = pytest.importorskip("public_tokenizers")


def bag(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_token_counts(spark, docs, nulls, empty):
    pieces = tokens.piece_list(P.path("piece_bpe_32k.model"))
    known, most = set(pieces), max(map(len, pieces))

    def greedy(word):
        word, at, n = tokens.MARK + word, 0, 0
        while at < len(word):
            end = next((e for e in range(min(len(word), at + most), at, -1) if word[at:e] in known), None)
            if end is None:
                return 1, 1
            at, n = end, n + 1
        return n, 0

    memo: dict = {}
    want = collections.Counter()
    for r in docs.collect():
        words = WORD.findall(r.text or "")
        got = [memo.setdefault(w, greedy(w)) for w in words]
        want[r.doc_id, len(words), sum(n for n, _ in got), sum(u for _, u in got)] += 1
    cols = ("doc_id", "n_words", "n_tokens", "n_unknown")
    assert bag(tokens.token_counts(docs, pieces), *cols) == want
    assert tokens.token_counts(empty, pieces).count() == 0 and tokens.token_counts(nulls, pieces).count() == 3
    tiny = tokens.Automaton(["a", "ab", "abcd", "c", "bcx"])
    assert [tiny.count(w) for w in ("abc", "abcd", "abcx", "abcab", "")] == [(2, 0), (1, 0), (1, 1), (3, 0), (0, 0)]


def base(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if n[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_quality(spark, docs, nulls, empty):
    labels = spark.createDataFrame([(r.doc_id, 1, 0) for r in docs.collect()] + [(None, 1, 0), (3, None, 0), (10**6, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality(docs, labels)
    want = collections.Counter()
    for r in docs.collect():
        b = base(r.text)
        failed = b[0] < 20 or 100 * b[4] > 30 * b[0]
        want[(r.doc_id, *b, failed, not failed)] += 1
    assert bag(out, "doc_id", *quality.COUNTS, "base_failed", "kept") == want
    assert quality.quality(empty, labels).count() == 0
    assert quality.quality(nulls, labels.limit(0)).count() == 3
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and bag(kept, "doc_id") == {k[:1]: v for k, v in want.items() if k[-1]}
    no_lang = quality.keep_good(docs.drop("lang"), labels)
    assert no_lang.columns == docs.drop("lang").columns and no_lang.count() == kept.count()
    assert quality.keep_good(empty, labels).count() == 0 and quality.keep_good(nulls, labels).count() == 0
    long = nulls.withColumn("text", F.lit(max((r.text or "" for r in docs.collect()), key=lambda t: len(set(t.split())))))
    assert quality.keep_good(long, labels).count() == 3  # rows without ids are judged as all others


def test_cutoffs_bound_false_rejections(spark):
    """Strata of many good documents certify a cutoff, small ones none, and good documents beyond the risk forbid it."""
    # no window repeats, so that the base rules let it pass
    junk = " ".join(f"#*#*#{i}#*#*" for i in range(40))
    good = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 1 + "lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi"
    rows = [(i, f"{good} w{i}", "big", 1) for i in range(900)] + [(1000 + i, f"{good} {junk} w{i}", "big", 0) for i in range(50)]
    rows += [(3000 + i, f"{good} w{i}", "small", 1) for i in range(50)] + [(4000 + i, f"{good} {junk} w{i}", "small", 0) for i in range(9)]
    rows += [(5000 + i, f"{good} w{i}" + (" " + junk if i % 20 == 0 else ""), "odd", 1) for i in range(900)] + [(6000 + i, f"{good} {junk} w{i}", "odd", 0) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    cuts = {r["_stratum"]: r for r in quality.cutoffs(quality.with_features(df, ["doc_id"]), df).collect()}
    assert cuts["big"].cut_symbol_ratio is not None and "small" not in cuts
    assert "odd" not in cuts or cuts["odd"].cut_symbol_ratio is None or cuts["odd"].cut_symbol_ratio == 0.4
    kept = {r.doc_id: r.kept for r in quality.quality(df, df).collect()}
    assert all(kept[i] for i in range(900)) and not any(kept[1000 + i] for i in range(50)) and all(kept[4000 + i] for i in range(9))


@pytest.mark.parametrize("n, k", [(1, 0), (50, 0), (900, 3), (900, 0), (2000, 15), (40000, 350)])
def test_binomial_cdf(spark, n, k):
    from pyspark.sql import functions as F

    p = 0.0125
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    want = sum(map(math.exp, logs)) if k <= n * p else 1.0
    got = spark.range(1).select(quality.binomial_cdf(F.lit(k), F.lit(n), p)).first()[0]
    assert got == pytest.approx(want, rel=1e-6)


def test_packing(spark, docs, nulls, empty):
    path = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    texts = docs.select("doc_id", "text").distinct().collect()
    ids = {r.doc_id: t.encode(r.text or "", add_special_tokens=False).ids + [1] for r in texts}
    copies = collections.Counter(r.doc_id for r in docs.collect())
    got = packing.pack(docs, path).collect()
    covered, sequences = collections.Counter(), collections.defaultdict(list)
    for r in got:
        x = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and len(x) == r.length > 0
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(x)}I", *x))
        covered.update((r.doc_id, i) for i in range(r.start, r.start + r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert covered == {(d, i): n for d, n in copies.items() for i in range(len(ids[d]))}
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.02 * sum(covered.values())
    assert packing.pack(empty, path).count() == 0
    assert set(bag(packing.pack(nulls, path), "doc_id", "doc_tokens")) == {(None, 7), (None, 1), (1, 7)}


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_ids_are_the_tokenizers(docs, file):
    t = packing.WordIds(P.path(file))
    assert t.by_word == (file[0] == "w")
    odd = ["Straße, ÉCOLE! don't I'M it's naïve; ª º µ İ ſ Ω ﬁ é <|endoftext|> a<|startoftext|>b x y 12ab3 ... ¡hola! \x00 � ''' ' s's"]
    for text in odd + [r.text or "" for r in docs.collect()]:
        want = t.tokenizer.encode(text, add_special_tokens=False).ids
        assert t.ids(text.encode()) == struct.pack(f"<{len(want)}I", *want)


def test_lines(spark, docs, nulls, empty):
    unique = docs.dropDuplicates()
    spread, first = collections.defaultdict(set), {}
    for r in unique.collect():
        for i, x in enumerate((r.text or "").split("\n") if r.text is not None else []):
            if len(re.sub(r"[\x20\x09-\x0D]", "", x)) >= lines.MIN_CHARS:
                spread[x].add(r.source)
                first[x] = min(first.get(x, (10**9, 0)), (r.doc_id, i))
    assert any(len(s) >= 10 for s in spread.values())
    want = {}
    for r in unique.collect():
        own = r.text.split("\n") if r.text is not None else []
        left = [x for i, x in enumerate(own) if len(spread.get(x, ())) < 10 or first[x] == (r.doc_id, i)]
        want[r.doc_id] = (len(own), len(own) - len(left), None if r.text is None else "\n".join(left))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in lines.line_dedup(docs).collect()}
    assert got == want and lines.line_dedup(docs).count() == docs.count()
    kept = lines.dedup_lines(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert lines.dedup_lines(empty).count() == 0 and lines.dedup_lines(nulls).count() == 3
    assert lines.line_dedup(empty).count() == 0 and lines.line_dedup(nulls).count() == 3


def test_sketch_estimates(spark):
    from pyspark.sql import functions as F

    for n in (1, 4, 10, 40, 1000):
        longs = [f"r{i}" for i in range(-(-lines.M // lines.PER))]
        d = spark.range(n).select(*[c.alias(x) for x, c in zip(longs, lines._sketch(F.concat(F.lit("site"), F.col("id"))))])
        e = d.agg(*[F.bit_or(x).alias(x) for x in longs]).select(lines._estimate(longs)).first()[0]
        assert n / lines.NEAR < e < n * lines.NEAR


def test_spans(spark, docs, nulls, empty):
    first, want = {}, {}
    texts = sorted({(r.doc_id, r.text) for r in docs.collect() if r.text is not None})
    for i, t in texts:
        found = spans.sentences(t.encode())
        assert b"".join(s for s, _ in found) == t.encode()
        places = [k for k, (_, w) in enumerate(found) if w]
        go = set()
        for a, b in zip(places, places[1:]):
            key = (tuple(found[a][1]), tuple(found[b][1]))
            if sum(map(len, key)) >= spans.MIN_WORDS:
                if key in first:
                    go |= {a, b}
                first.setdefault(key, i)
        want[i] = (len(places), len(go), b"".join(s for k, (s, _) in enumerate(found) if k not in go).decode())
    got = {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in spans.dedup_spans(docs).collect() if r.text is not None}
    assert got == want and sum(v[1] > 0 for v in want.values()) > 10
    assert spans.dedup_spans(docs).count() == docs.count() and spans.dedup_spans(empty).count() == 0
    assert bag(spans.dedup_spans(nulls), "doc_id", "n_removed") == {(None, 0): 2, (1, 0): 1}


def test_spans_of_rows_without_ids_and_of_one_sentence(spark):
    """Rows without ids are one document, after all others; a single sentence is in no run."""
    a, b = ("".join(f"{x} words of sentence {i} are here. " for i in range(4)) for x in "ab")
    one = "a single sentence of well over ten words that some documents have in common."
    texts = [(None, a), (None, a), (None, b), (7, b), (3, one), (4, one), (5, one)]
    got = bag(spans.dedup_spans(spark.createDataFrame(texts, "doc_id long, text string"), extend=True), "doc_id", "n_sentences", "n_removed", "text")
    assert got == {(None, 4, 0, a): 2, (None, 4, 4, ""): 1, (7, 4, 0, b): 1, **{(i, 1, 0, one): 1 for i in (3, 4, 5)}}


def test_spans_in_long_sentences(spark):
    """A passage without .!? is found behind lead-ins of any length, all but the words at its ends."""
    passage = " ".join(f"w{i * i * 7919 % 1009}" for i in range(500))
    texts = [(i, " ".join(f"lead{i}x{k}" for k in range(3 + 2 * i)) + " " + passage + f" tail{i} end") for i in range(4)]
    got = {r.doc_id: r.text for r in spans.dedup_spans(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[0] == texts[0][1] and all(len(got[i].split()) < 5 + 2 * i + 60 for i in range(1, 4))


def test_spans_of_short_sentences(spark, tmp_path):
    """Repeated lines of few words, and paragraphs of a script without spaces, go whole."""
    from tidelog.llm import queries

    verse = "".join(f"line {i} is\n" for i in range(50)) + "the end\n"
    han = "".join(chr(0x4E00 + i * i * 31 % 5000) for i in range(300))
    texts = [(1, "One lead of a text.\n" + verse), (2, "Some other lead here.\n" + verse), (3, "前" + han), (4, "後段" + han), (5, "one. two. three."), (6, "one. two. three.")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in queries.op4_sentence_spans(spark, f"file://{tmp_path}").collect()}
    assert got[2] == "Some other lead here.\n" and len(got[4]) < 40
    assert all(got[i] == t for i, t in texts if i not in (2, 4))
    assert b"".join(s for s, _ in spans.sentences(f"a {han} b".encode())) == f"a {han} b".encode()
    assert spans.runs([3, 3, 3, 3, 1], True) == [(0, 4), (1, 5)] and spans.runs([12, 3, 4], True) == [(0, 2), (0, 3)]


@pytest.mark.parametrize("chunk", [10**6, 3])
def test_decontamination(spark, docs, nulls, empty, monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK_WINDOWS", chunk)
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    texts = {r.doc_id: r.text for r in docs.collect()}
    long = [t for t in texts.values() if t and 60 < len(t.split()) < 200]
    some = lambda t: t if chunk > 3 else " ".join(t.split()[:16])
    items = [(1, " ".join(long[0].split()[3:16])), (2, " ".join(long[1].split()[:4])), (3, ""), (4, None), (10, some(long[2].upper())), (11, "nowhere to be found at all in these texts of ours"), (None, some(long[3])), (1, " ".join(long[0].split()[3:16]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    want = {}
    for d, t in texts.items():
        w = word.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        listed = ",".join(sorted(str(i) for i in found if i is not None))
        want[d] = (len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit))
    copies = collections.Counter(r.doc_id for r in docs.collect())
    out = decontaminate.contamination(docs, bench)
    got = bag(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == {(d, *v): copies[d] for d, v in want.items()} and all(r.n_near >= r.n_items for r in out.collect())
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and bag(kept, "doc_id") == {(d,): copies[d] for d, v in want.items() if not v[4]}
    odd = spark.createDataFrame([(None, texts[d]) for d in texts] + [(5, texts[d]) for d in texts], "doc_id long, text string")
    clean = collections.Counter(t for d, t in texts.items() if not want[d][4])
    left = decontaminate.keep_clean(odd, bench).collect()
    for one in (None, 5):
        assert collections.Counter(r.text for r in left if r.doc_id == one) == clean
    if chunk == 3:
        return
    assert decontaminate.keep_clean(empty, bench).count() == 0 and decontaminate.keep_clean(nulls, bench).count() == 3
    assert decontaminate.keep_clean(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(nulls, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_of_repeated_ids_in_chunks(spark, docs, monkeypatch):
    """Chunks of a large benchmark are united by row: rows that repeat an id or have none stay separate."""
    odd = [(1, "one two three four"), (1, "five six seven eight"), (1, "one two three four"), (None, "five six seven eight"), (None, "no hit in this"), (None, None)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string"))
    bench = spark.createDataFrame([(1, "one two"), (2, "three four"), (3, "six seven eight")], "item_id long, text string")
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near")
    whole = bag(decontaminate.contamination(both, bench), *cols)
    monkeypatch.setattr(decontaminate, "CHUNK_WINDOWS", 1)
    assert bag(decontaminate.contamination(both, bench), *cols) == whole
    assert sum(whole.values()) == docs.count() + 6
    short = collections.Counter(k[:4] for k in whole.elements() if k[1] == 4 and k[0] in (1, None))
    assert short == {(1, 4, 4, 2): 2, (1, 4, 3, 1): 1, (None, 4, 3, 1): 1, (None, 4, 0, 0): 1}


def test_proximity(spark):
    d = spark.createDataFrame([(1, "red x green blue"), (2, "blue green x x x x x x x x x red"), (3, "red green"), (4, "red green blue")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "red green blue")], "item_id long, text string")
    got = {r.doc_id: (r.n_near, r.contaminated) for r in decontaminate.contamination(d, b, slop=2).collect()}
    assert got == {1: (1, False), 2: (0, False), 3: (0, False), 4: (1, True)}
