"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie. A node's failure link leads to the node that remains
after the longest pieces have been popped off the node's string, and the number
of pieces popped on the way is precomputed, so one pass over a word's characters
adds up its greedy piece count; no piece is ever built. A word starts with the
boundary mark, as the pieces of the vocabulary do. A word that the vocabulary
can't cover counts as one unknown token.

Words are runs of [^\\x20\\x09-\\x0D]. Distinct words of a worker are counted once
and kept in a bounded table (the counts repeat, the table only saves work).

Defined cases: null and empty texts have no words and no tokens; a null doc_id
stays null; repeated rows are separate, and of equally long pieces there is one;
a text may be of any length, since only its words are looked up; an empty table
gives no rows; columns other than doc_id and text aren't looked at.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
#: Words of at most LONGEST bytes that a worker remembers before it starts anew.
REMEMBERED, LONGEST = 1 << 19, 64


class Automaton:
    """nxt[s]: char -> state; fail[s]: state after popping, or -1; pops[s]: pieces popped on that way."""

    def __init__(self, pieces: Iterable[str]):
        self.nxt: list[dict[str, int]] = [{}]
        ends: list[bool] = [False]
        for piece in pieces:
            s = 0
            for ch in piece:
                t = self.nxt[s].get(ch)
                if t is None:
                    t = self.nxt[s][ch] = len(self.nxt)
                    self.nxt.append({})
                    ends.append(False)
                s = t
            ends[s] = s > 0
        n = len(self.nxt)
        self.fail, self.pops = [-1] * n, [0] * n
        todo = deque([0])
        while todo:
            s = todo.popleft()
            for ch, t in self.nxt[s].items():
                todo.append(t)
                if ends[t]:
                    self.fail[t], self.pops[t] = 0, 1
                    continue
                # pop from the parent's string until the rest can be followed by ch
                z, popped = self.fail[s], self.pops[s]
                while z >= 0 and ch not in self.nxt[z]:
                    popped += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[t], self.pops[t] = self.nxt[z][ch], popped

    def count(self, word: str) -> tuple[int, int]:
        """The greedy piece count of word, and 1 if it is one unknown token, else 0."""
        nxt, fail, pops, s, n = self.nxt, self.fail, self.pops, 0, 0
        for ch in word:
            t = nxt[s].get(ch)
            while t is None:
                n += pops[s]
                s = fail[s]
                if s < 0:
                    return 1, 1
                # at the root, a character that starts no piece ends the word as unknown
                t = nxt[s].get(ch)
                if t is None and s == 0:
                    return 1, 1
            s = t
        while s > 0:
            n += pops[s]
            s = fail[s]
        return (1, 1) if s < 0 else (n, 0)


def piece_list(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece vocabulary file (tens of thousands, fixed with the file)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        """Pieces, with bit 40 set for an unknown word, so that a sum holds both."""
        n, unknown = self.automaton.count(MARK + word.decode("utf-8", "replace"))
        n += unknown << 40
        if len(word) <= LONGEST:
            self[word] = n
        return n


def token_counts(docs: DataFrame, pieces: list[str]) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown (of the tokens) for each row; narrow work without a shuffle.

    pieces is a tokenizer's vocabulary: its size is fixed by the file, not by the data, and it goes to the workers by a broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(Automaton(shared.value))
        low = (1 << 40) - 1
        for b in batches:
            n_words, sums = [], []
            for x in b.column(1):
                words = (x.as_py() or b"").split()
                n_words.append(len(words))
                sums.append(sum(map(counts.__getitem__, words)))
                if len(counts) > REMEMBERED:
                    counts.clear()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array([s & low for s in sums], pa.int64()), pa.array([s >> 40 for s in sums], pa.int64())],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as binary) text").mapInArrow(
        run, "doc_id long, n_words long, n_tokens long, n_unknown long"
    )
