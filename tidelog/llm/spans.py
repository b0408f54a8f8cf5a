"""Substring dedup by sliding sentence spans.

Runs of SPAN consecutive sentences are hashed (96 bits over lower-cased words),
and where they have under MIN_WORDS words, with extend, longer runs: from each
sentence on, and back from each sentence, as many as give MIN_WORDS words. Runs with equal hashes are joined over the corpus: the first, by doc_id
and place, stays, and all sentences that any other one covers are removed. A
span is joined only with its group's smallest document, so a passage that a
third of all documents share makes one partial row a task before the shuffle
and a join side that Spark can split.

A sentence ends with its .!? and the white space after it, or with a line. One of
more than LONGEST words is cut where its content says so: between two words
if the hash of the two before is the least of REACH places to either side. Equal
passages are thus cut alike, but for REACH + 2 words at their ends, wherever they
begin, about every 2 REACH + 1 words. Runs of under MIN_WORDS words aren't hashed,
so that short common sentences stay. Of scripts without spaces between words
(Han, Kana, Thai, Lao, Khmer, Burmese) each character counts as a word.

Defined cases: null text stays null and has no sentences; a null doc_id ranks
after all others; rows that repeat an id, or have none, count as one document:
each is cleaned by itself, and what only they share stays in all of them; a text
of one sentence has no run and stays; texts may be empty or of any length; an
empty table gives an empty one; columns other than doc_id and text aren't looked
at, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, saved

SPAN, MIN_WORDS, LONGEST, REACH = 2, 10, 24, 4
_END = re.compile(rb"[.!?\n](?:(?<=\n)[\x20\x09-\x0D]*|[\x20\x09-\x0D]+)")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
#: A character of a script without spaces between words.
_ALONE = rb"(?:\xE0[\xB8-\xBB][\x80-\xBF]|\xE1[\x80-\x82\x9E\x9F][\x80-\xBF]|[\xE3-\xE9][\x80-\xBF]{2}|\xEF[\xA4-\xAB][\x80-\xBF]|\xF0[\xA0-\xB3][\x80-\xBF]{2})"
_CHARACTER = re.compile(_ALONE)
_WORD_OR_CHARACTER = re.compile(rb"(?:" + _ALONE + rb"|(?:(?!" + _ALONE + rb")[^\x20\x09-\x0D])+)[\x20\x09-\x0D]*")


def _words(part: bytes) -> list[bytes]:
    low = part.translate(LOWER)
    return (low if low.isascii() else _CHARACTER.sub(rb" \g<0> ", low)).split()


def _cuts(words: list[bytes]) -> list[int]:
    """How many words of a long sentence stand before each of its cuts."""
    h = [xxhash.xxh32_intdigest(a + b" " + b) for a, b in zip(words, words[1:])]
    return [j + 2 for j in range(REACH, len(h) - REACH) if h[j - 1] >= h[j] <= h[j + 1] and h[j] == min(h[j - REACH : j + REACH + 1])]


def sentences(text: bytes) -> list[tuple[bytes, list[bytes]]]:
    """(bytes, lower-cased words) of each sentence; the bytes join to text."""
    out, at = [], 0
    for m in [*_END.finditer(text), None]:
        end = m.end() if m else len(text)
        part = text[at:end]
        at = end
        words = _words(part)
        if len(words) <= LONGEST:
            if part:
                out.append((part, words))
            continue
        ends = [m.end() for m in (_WORD if part.isascii() else _WORD_OR_CHARACTER).finditer(part)]
        ends[-1] = len(part)
        cut = first = 0
        for n in [*_cuts(words), len(words)]:
            out.append((part[cut : ends[n - 1]], words[first:n]))
            cut, first = ends[n - 1], n
    return out


def runs(sizes: list[int], extend: bool) -> list[tuple[int, int]]:
    """(first, end) of each run of sentences of these sizes that is hashed."""
    n, at = len(sizes), [0]
    for x in sizes:
        at.append(at[-1] + x)
    if not extend:
        return [(k, k + SPAN) for k in range(n - SPAN + 1) if at[k + SPAN] - at[k] >= MIN_WORDS]
    out, e = set(), 0
    for k in range(n - SPAN + 1):
        e = max(e, k + SPAN)
        while e <= n and at[e] - at[k] < MIN_WORDS:
            e += 1
        if e > n:
            break
        out.add((k, e))
    k = 0
    for e in range(SPAN, n + 1):
        while k < e - SPAN and at[e] - at[k + 1] >= MIN_WORDS:
            k += 1
        if at[e] - at[k] >= MIN_WORDS:
            out.add((k, e))
    return sorted(out)


def span_hashes(found: list[tuple[bytes, list[bytes]]], extend: bool = False) -> Iterator[tuple[int, int, int, int]]:
    """(first sentence, end, 64-bit and 32-bit hash) of each run. Sentences without words are in no run and aren't counted."""
    own = [b" ".join(w) for _, w in found if w]
    for k, e in runs([len(w) for _, w in found if w], extend):
        d = xxhash.xxh3_128_intdigest(b"\n".join(own[k:e]))
        yield k, e, (d & (1 << 64) - 1) - (1 << 63), (d >> 64) & 0x7FFFFFFF


def _emit(batches: Iterator[pa.RecordBatch], extend: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h, g, ids, again = [], [], [], []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            seen = set()
            for _, _, x, y in span_hashes(sentences(text.as_py() or b""), extend):
                h.append(x)
                g.append(y)
                ids.append(doc_id)
                again.append((x, y) in seen)
                seen.add((x, y))
        yield pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(g, pa.int32()), pa.array(ids, pa.int64()), pa.array(again, pa.bool_())],
            names=["h", "g", "doc", "again"],
        )


_LAST = (1 << 63) - 1


def _removals(docs: DataFrame, extend: bool) -> DataFrame:
    """doc and, for its spans with a copy elsewhere or before, their hashes: later (all go) and twice (all but the first go)."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.col("text").cast("binary").alias("text"))
    # saved, so that texts are split once for both passes over the spans
    spans = saved(keyed.mapInArrow(lambda batches: _emit(batches, extend), "h long, g int, doc long, again boolean"), "spans")
    groups = spans.groupBy("h", "g").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = saved(groups.where("n > 1").drop("n"), "repeated-spans")
    gone = spans.join(repeated, ["h", "g"]).where("doc > first or again")
    return gone.groupBy("doc").agg(
        F.collect_set(F.when(F.col("doc") > F.col("first"), F.struct("h", "g"))).alias("later"),
        F.collect_set(F.when(F.col("doc") == F.col("first"), F.struct("h", "g"))).alias("twice"),
    )


def clean(text: bytes, later: set, twice: set, extend: bool = False) -> tuple[bytes, int, int]:
    """The text without covered sentences, how many it had and how many went."""
    found = sentences(text)
    places = [i for i, (_, w) in enumerate(found) if w]
    go, seen = set(), set()
    for k, e, x, y in span_hashes(found, extend):
        if (x, y) in later or (x, y) in twice and (x, y) in seen:
            go.update(places[k:e])
        seen.add((x, y))
    return b"".join(s for i, (s, _) in enumerate(found) if i not in go), len(places), len(go)


def dedup_spans(docs: DataFrame, extend: bool = False) -> DataFrame:
    """doc_id, n_sentences, n_removed and the text that is left, a row for each row of docs.

    Without extend, runs of SPAN sentences that have under MIN_WORDS words are left alone.
    """
    gone = _removals(docs, extend).withColumnRenamed("doc", "_doc")
    d = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text, later, twice in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                t = text.as_py()
                if not later and not twice:
                    out.append((doc_id, sum(bool(w) for _, w in sentences(t)) if t else 0, 0, t))
                    continue
                left, n, went = clean(t or b"", *({(x["h"], x["g"]) for x in s or ()} for s in (later, twice)), extend)
                out.append((doc_id, n, went, None if t is None else left))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                names=["doc_id", "n_sentences", "n_removed", "text"],
            )

    return (
        d.join(gone, "_doc", "left")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "later", "twice")
        .mapInArrow(run, "doc_id long, n_sentences long, n_removed long, text string")
    )
