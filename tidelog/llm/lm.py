"""Language-model scores from a weighted backoff automaton.

The model has histories of two words, of one and of none, with absolute discounting over an add-one unigram model. As an
automaton: the root's arcs are the unigrams; a word v (or the begin of a text) that training has followers for is a state, with an
arc for each word w that followed it, of log10 of (c(vw) - D) / c(v) + D T(v) / c(v) p(w), T(v) being its distinct followers, and
a failure arc to the root of log10(D T(v) / c(v)); a pair uv is a state if words w followed it MIN_COUNT times or more, with arcs
for these, of log10 of (c(uvw) - D) / c(uv) + b(uv) p(w | v), and a failure arc to v of log10 b(uv), where b(uv) is what the arcs
leave of 1. The probabilities of all words after a state sum to 1.

A text is traversed from left to right: from the state that the words so far lead to (the longest of their ends that is one), the
arc of the next word is taken, or failure arcs are followed until a state has it. The state that a traversal carries to a
position depends on the two words before alone, so all positions of a block are traversed at once, failure arc by failure arc.

Counts are taken over all training documents, block by block. A block's texts are read once and stored as word numbers; sums by
key (exchange.py) give each block what its texts can reach: first the counts of its words and pairs; then the followers of its
words, from pairs that one block owns each, and the counts of its triples both of whose pairs occur MIN_COUNT times (no other triple
can); then what its pairs' arcs hold, from triples that one block owns each. No task holds more than a block or a bucket, and
nothing but two sums reaches the driver. Words are keyed by 64-bit hashes.

Defined cases: null and empty texts are the end token alone; a null doc_id counts as the empty string when it is drawn for
training; repeated rows and repeated ids count each; a text of any length is one row of its block; of equal keys any block may own
one, which changes no sum; without training documents every token has the add-one probability; an empty table gives no rows;
columns other than doc_id and text aren't looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bucketed, in_blocks, n_blocks
from .exchange import SENT, answered, answers, exchanged, mixed, of_round, packed, sent, totals, unpacked

#: The discount as a fraction, so that sums of discounted counts are whole numbers; a pair's arcs are words that followed it so often.
D, MIN_COUNT = (3, 4), 2
_U = np.uint64
_END, _BEGIN, _STEP, _TYPES = 0x9E3779B97F4A7C15, 0xA0761D6478BD642F, _U(0xD1342543DE82EF95), _U(0xE7037ED1A0B428DB)
BLOCK = "part long, ids binary, nulls binary, held binary, lengths binary, tokens binary, words binary"


def tokenized(table: pa.Table) -> pa.Table:
    """A block's BLOCK row: its tokens as numbers of its distinct words, whose hashes are words; number 0 is the end."""
    number: dict[bytes, int] = {b"": 0}  # no word is empty
    parts, lengths = [], []
    for t in table.column("text"):
        w = t.as_py().translate(LOWER).split()
        w.append(b"")
        parts.append(np.fromiter([number.setdefault(x, len(number)) for x in w], np.int64, len(w)))
        lengths.append(len(w))
    ids, held = table.column("doc_id").to_pylist(), table.column("held_out").to_pylist()
    words = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else _END for w in number), _U, len(number))
    row = {
        "ids": np.array([i or 0 for i in ids], np.int64).tobytes(),
        "nulls": np.array([i is None for i in ids], np.bool_).tobytes(),
        "held": np.array(held, np.bool_).tobytes(),
        "lengths": np.array(lengths, np.int64).tobytes(),
        "tokens": packed(np.concatenate(parts)),
        "words": words.tobytes(),
    }
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int64())} | {k: pa.array([v], pa.binary()) for k, v in row.items()})


class Texts:
    """A block's tokens and its distinct pairs. Word number n, after the words', stands for the begin of a text."""

    def __init__(self, table: pa.Table):
        get = lambda c, kind: np.frombuffer(table.column(c)[0].as_py(), kind)
        self.part = table.column("part")[0].as_py()
        self.ids, self.nulls, self.held, self.lengths, self.words = get("ids", np.int64), get("nulls", np.bool_), get("held", np.bool_), get("lengths", np.int64), get("words", _U)
        self.tokens = unpacked(table.column("tokens")[0].as_py(), int(self.lengths.sum()))
        self.n = len(self.words)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~self.held, self.lengths)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.begins] = self.n
        pairs, self.pair = np.unique(before * (self.n + 1) + self.tokens, return_inverse=True)
        self.first, self.second = pairs // (self.n + 1), pairs % (self.n + 1)
        hashes = np.append(self.words, _U(_BEGIN))
        self.histories = mixed(hashes ^ _TYPES) & ~_U(1)
        self.pair_keys = mixed(hashes[self.first] * _STEP + self.words[self.second]) | _U(1)

    def first_keys(self) -> np.ndarray:
        """Words (even) and pairs (odd)."""
        return np.concatenate([mixed(self.words) & ~_U(1), self.pair_keys])

    def first_counts(self) -> np.ndarray:
        count = lambda x, n: np.bincount(x[self.train], minlength=n)
        return np.concatenate([count(self.tokens, self.n), count(self.pair, len(self.first))])

    def read_first(self, got: dict) -> None:
        sums, owned = answers(got, self.first_keys())
        self.c1, self.c2, self.owned = sums[: self.n], sums[self.n :], owned[self.n :]
        # positions whose triple can occur MIN_COUNT times: the pair before and their own do
        often = self.c2 >= MIN_COUNT
        inside = np.ones(len(self.tokens), bool)
        inside[self.begins] = False
        at = np.flatnonzero(inside)
        at = at[often[self.pair[at - 1]] & often[self.pair[at]]]
        triples, self.one, triple = np.unique(self.pair[at - 1] * (self.n + 1) + self.tokens[at], return_index=True, return_inverse=True)
        self.history, word = triples // (self.n + 1), triples % (self.n + 1)
        self.one = at[self.one]
        self.triple = np.full(len(self.tokens), -1)
        self.triple[at] = triple
        self.triple_keys = mixed(self.pair_keys[self.history] * _STEP + self.words[word]) | _U(1)
        #: pairs that may be states
        self.asked = np.flatnonzero(often & (self.second != 0))

    def second_keys(self) -> np.ndarray:
        """Histories of one word (even) and triples (odd)."""
        return np.concatenate([self.histories, self.triple_keys])

    def second_counts(self) -> np.ndarray:
        followers = np.bincount(self.first[self.owned], minlength=self.n + 1)
        counted = self.triple[self.train & (self.triple >= 0)]
        return np.concatenate([followers, np.bincount(counted, minlength=len(self.history))])

    def read_second(self, got: dict) -> None:
        sums, owned = answers(got, self.second_keys())
        self.types, self.c3, self.owned3 = sums[: self.n + 1], sums[self.n + 1 :], owned[self.n + 1 :]

    def held_by_arcs(self, d: tuple[int, int]) -> np.ndarray:
        """Of the asked pairs: the discounted counts of the arcs that this block owns, times the discount's denominator."""
        own = self.owned3 & (self.c3 >= MIN_COUNT)
        held = np.bincount(self.history[own], (self.c3[own] * d[1] - d[0]).astype(np.float64), len(self.first))
        return np.rint(held).astype(np.int64)[self.asked]


def _scores(t: Texts, held: np.ndarray, total: int, distinct: int, d: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(the add-one log10 probability, the automaton's) of each token; held: what the asked pairs' arcs hold."""
    discount = d[0] / d[1]
    p1 = (t.c1 + 1) / (total + distinct + 1)
    # states of one word: number 1 + word; the begin has occurred as often as the end
    seen = np.append(t.c1, t.c1[0] if t.n else 0)
    one = t.types > 0
    back1 = np.where(one, discount * t.types / np.maximum(seen, 1), 1.0)
    p2 = np.maximum(t.c2 - discount, 0) / np.maximum(seen[t.first], 1) + back1[t.first] * p1[t.second]
    # states of two words: number n + 2 + pair
    back2, two = np.ones(len(t.first)), np.zeros(len(t.first), bool)
    back2[t.asked] = 1 - held / (d[1] * t.c2[t.asked])
    two[t.asked] = held > 0
    p3 = np.maximum(t.c3 - discount, 0) / t.c2[t.history] + back2[t.history] * p2[t.pair[t.one]]
    with np.errstate(divide="ignore"):
        root = np.log10(p1)
        arcs2 = np.where(t.c2 > 0, np.log10(p2), np.nan)
        arcs3 = np.append(np.where(t.c3 >= MIN_COUNT, np.log10(p3), np.nan), np.nan)  # the last one stands for no triple
        fails = np.concatenate([[0.0], np.log10(back1), np.log10(back2)])
    goes_to = np.concatenate([np.zeros(t.n + 2, np.int64), np.where(one[t.second], 1 + t.second, 0)])
    # the state that is carried to each position: the longest history that is one
    before = t.first[t.pair]
    state = np.where(one[before], 1 + before, 0)
    later = np.ones(len(t.tokens), bool)
    later[t.begins] = False
    at = np.flatnonzero(later)
    at = at[two[t.pair[at - 1]]]
    state[at] = t.n + 2 + t.pair[at - 1]
    logs, todo = np.zeros(len(t.tokens)), np.arange(len(t.tokens))
    while len(todo):
        s = state[todo]
        arc = np.where(s == 0, root[t.tokens[todo]], np.where(s < t.n + 2, arcs2[t.pair[todo]], arcs3[t.triple[todo]]))
        taken = ~np.isnan(arc)
        logs[todo[taken]] += arc[taken]
        todo, s = todo[~taken], s[~taken]
        logs[todo] += fails[s]
        state[todo] = goes_to[s]
    return root[t.tokens], logs


def score(docs: DataFrame, discount: tuple[int, int] = D) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs (doc_id, text)."""
    n = n_blocks(docs)
    held_out = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2).alias("held_out")
    stored = in_blocks(docs, n, [held_out]).groupBy("part").applyInArrow(tokenized, BLOCK)
    blocks = bucketed(stored, n).groupBy("part")

    def send_first(block: pa.Table) -> pa.Table:
        t = Texts(block)
        return sent(t.part, t.first_keys(), t.first_counts(), n)

    first = exchanged(blocks.applyInArrow(send_first, SENT), n, "lm-words")
    total, distinct = totals(first)

    def send_second(block: pa.Table, got: pa.Table) -> pa.Table:
        t = Texts(block)
        t.read_first(of_round(got, 0))
        return sent(t.part, t.second_keys(), t.second_counts(), n)

    second = exchanged(blocks.cogroup(answered([first], n).groupBy("to")).applyInArrow(send_second, SENT), n, "lm-triples")

    def send_third(block: pa.Table, got: pa.Table) -> pa.Table:
        t = Texts(block)
        t.read_first(of_round(got, 0))
        t.read_second(of_round(got, 1))
        return sent(t.part, t.pair_keys[t.asked], t.held_by_arcs(discount), n)

    third = exchanged(blocks.cogroup(answered([first, second], n).groupBy("to")).applyInArrow(send_third, SENT), n, "lm-arcs")

    def scored(block: pa.Table, got: pa.Table) -> pa.Table:
        t = Texts(block)
        t.read_first(of_round(got, 0))
        t.read_second(of_round(got, 1))
        held, _ = answers(of_round(got, 2), t.pair_keys[t.asked])
        base, logs = _scores(t, held, total, distinct, discount)
        per = lambda x: np.add.reduceat(x, t.begins)
        return pa.table(
            {
                "doc_id": pa.array(t.ids, pa.int64(), mask=t.nulls),
                "held_out": pa.array(t.held),
                "n_tokens": pa.array(t.lengths),
                "n_known": pa.array(per((t.c1[t.tokens] > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(t.ids), total)),
                "base_score": pa.array(per(base)),
                "score": pa.array(per(logs)),
            }
        )

    return blocks.cogroup(answered([first, second, third], n).groupBy("to")).applyInArrow(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
