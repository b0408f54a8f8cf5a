"""Harmonic packing of token streams into fixed-capacity sequences.

Full-capacity pieces of a document are sequences of their own. The rest of a
document, of r tokens, belongs to the reciprocal class j with
capacity/(j+1) < r <= capacity/j, and a bin of class j takes exactly j pieces.
A rest that would fill its bin too badly is cut at the next reciprocal below
(capacity/(j+1), one whole share of class j+1) and what remains is classed
again, so every bin is filled to at least MIN_FILL (bins of tiny pieces aside,
which are handled below). Every worker fills its bins alone, in one pass over
its documents, and holds fewer than j pieces of class j.

When a worker ends, the pieces of unfinished bins, fewer than capacity tokens a
class, are laid end to end, cut at the capacity, and the last cut is split into
powers of two, which need no padding.

Tokens come from the tokenizer file word by word where by_word() finds that its
splitting never joins characters across the white space [\\x20\\x09-\\x0D]: a
word's ids then don't depend on its neighbours and a bounded table keeps those of
frequent words. With any other file whole texts go through the tokenizer.

Defined cases: null text is empty and yields the end id alone; a document of any
length is cut freely; a null doc_id stays null; repeated rows are packed as rows
of their own; an empty table yields no pieces; columns other than doc_id and text
aren't looked at. A retried task repeats its partition's packing.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

END = 1
CAPACITY = 2048
MIN_FILL = 0.98
#: Classes beyond this one share its bins' handling: their tiny pieces are laid end to end with the unfinished bins.
LAST_CLASS = 64
#: Words of at most LONGEST bytes that a worker remembers before it starts anew: about 100 MB with their ids.
REMEMBERED, LONGEST = 1 << 17, 64
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Marks that may close a word; the tokenizer splits them off letters.
TAIL = ".,!?;:|#*%&$"


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the characters below U+0180: printable bytes as themselves, others moved up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = iter(range(256, 512))
    letter = {b: chr(b) if b in plain else chr(next(moved)) for b in range(256)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x180)}


#: Fixed value: a splitting that drops white space and never joins what it parts.
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def by_word(file: dict) -> bool:
    """Whether a tokenizer file's ids of a text are its words' ids one after the other: lower case, this splitting, byte letters, word ends."""
    steps = (file["normalizer"] or {}).get("normalizers", [])
    splits = (file["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
        and [x["type"] for x in splits] == ["Split", "ByteLevel"]
        and (splits[0]["pattern"], splits[0]["behavior"], splits[0]["invert"]) == ({"Regex": _PATTERN}, "Removed", True)
        and not splits[1]["add_prefix_space"]
        and not splits[1]["use_regex"]
        and file["post_processor"] is None
        and bool(file["model"]["end_of_word_suffix"])
        and not any(set(t["content"]) & set(" \t\n\x0b\x0c\r") or t["lstrip"] or t["rstrip"] for t in file["added_tokens"])
    )


class WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes.

    A new word of letters below U+0180 (composed already, and lower-cased alike everywhere) with closing marks goes straight
    to the vocabulary's merges, its marks apart; any other new word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters, self.cores, self.tails = _byte_letters(), {}, {"": b""}
        # words stand alone, and go to the merges without the whole tokenizer, only where the file is known to allow it
        with open(path, encoding="utf-8") as f:
            self.by_word = by_word(json.load(f))

    def _whole(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        core = text.rstrip(TAIL)
        if core.isalpha() and max(core) < "\u0180" and "\u0130" not in core:
            tail = text[len(core) :]
            core = core.lower()
            ids = self.cores.get(core)
            if ids is None:
                made = self.merge(core if core.isascii() else core.translate(self.letters))
                ids = b"".join([t.id.to_bytes(4, "little") for t in made])
                if len(word) <= LONGEST:
                    self.cores[core] = ids
            end = self.tails.get(tail)
            if end is None:
                end = self._whole(tail)
                if len(tail) <= LONGEST:
                    self.tails[tail] = end
            ids += end
        else:
            ids = self._whole(text)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        if not self.by_word:
            return self._whole(text.decode("utf-8", "replace"))
        out = b"".join(map(self.__getitem__, text.split()))
        for table in (self, self.cores, self.tails):
            if len(table) > REMEMBERED:
                table.clear()
        self.tails[""] = b""
        return out


_tables: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's table for a tokenizer file; it outlives a task."""
    if path not in _tables:
        _tables[path] = WordIds(path)
    return _tables[path]


def pieces_of(n: int, capacity: int = CAPACITY, min_fill: float = MIN_FILL) -> list[tuple[int, int, int]]:
    """(start, length, class) of a document of n tokens. Class 0: to be laid end to end."""
    out, at = [], 0
    while n - at >= capacity:
        out.append((at, capacity, 1))
        at += capacity
    while (r := n - at) > 0:
        j = capacity // r
        if j >= LAST_CLASS:
            out.append((at, r, 0))
            break
        if r * j < min_fill * capacity:
            j += 1
            r = capacity // j
        out.append((at, r, j))
        at += r
    return out


class Packer:
    """Bins of one worker. add() and finish() yield (piece, sequence number, offset); a piece is (doc, start, length)."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.open, self.sequence = capacity, {}, 0
        self.tail, self.tail_n = [], 0

    def _close(self, pieces) -> Iterator:
        at = 0
        for p in pieces:
            yield p, self.sequence, at
            at += p[2]
        self.sequence += 1

    def add(self, piece, klass: int) -> Iterator:
        if klass == 0:
            yield from self._lay(piece)
            return
        held = self.open.setdefault(klass, [])
        held.append(piece)
        if len(held) == klass:
            self.open[klass] = []
            yield from self._close(held)

    def _lay(self, piece) -> Iterator:
        doc, start, n = piece
        while self.tail_n + n >= self.capacity:
            room = self.capacity - self.tail_n
            held, self.tail, self.tail_n = [*self.tail, (doc, start, room)], [], 0
            yield from self._close(held)
            start, n = start + room, n - room
        if n:
            self.tail.append((doc, start, n))
            self.tail_n += n

    def finish(self) -> Iterator:
        for klass in sorted(self.open):
            for piece in self.open[klass]:
                yield from self._lay(piece)
        size, held, room = self.tail_n, [], 0
        for doc, start, n in self.tail:
            while n:
                if not room:
                    room = 1 << (size.bit_length() - 1)
                    size -= room
                some = min(room, n)
                held.append((doc, start, some))
                start, n, room = start + some, n - some, room - some
                if not room:
                    yield from self._close(held)
                    held = []
        self.open, self.tail, self.tail_n = {}, [], 0


class _Part:
    """A piece's ids and where they stand in their document, so that an unfinished bin keeps no whole document."""

    __slots__ = ("doc_id", "ids", "start", "doc_tokens")

    def __init__(self, doc_id, ids, start, doc_tokens):
        self.doc_id, self.ids, self.start, self.doc_tokens = doc_id, ids, start, doc_tokens


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, min_fill: float = MIN_FILL) -> DataFrame:
    """A row for each piece of each row of docs (doc_id, text). No shuffle: partitions are packed independently."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = word_ids(path), Packer(capacity)
        base = TaskContext.get().partitionId() << 40
        end = END.to_bytes(4, "little")
        cols: list[list] = [[] for _ in range(7)]

        def put(made):
            for (part, start, n), sequence, offset in made:
                crc = zlib.crc32(part.ids[4 * start : 4 * (start + n)])
                row = (part.doc_id, part.start + start, n, crc, part.doc_tokens, base + sequence, offset)
                for c, v in zip(cols, row):
                    c.append(v)

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[f.split()[0] for f in SCHEMA.split(", ")])
            for c in cols:
                c.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                ids = words.ids(text.as_py() or b"") + end
                total = len(ids) // 4
                for start, n, klass in pieces_of(total, capacity, min_fill):
                    part = _Part(doc_id.as_py(), ids[4 * start : 4 * (start + n)], start, total)
                    put(packer.add((part, 0, n), klass))
            if cols[0]:
                yield flush()
        put(packer.finish())
        if cols[0]:
            yield flush()

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as binary) text").mapInArrow(run, SCHEMA)
