"""Exact merge-type subword encoding by backtracking, and decoding.

A text is cut before each run of spaces (no piece holds a space after another character, which
is checked when the vocabulary is read), so each word is encoded by itself. A word is walked from
left to right: an Aho-Corasick automaton gives the longest pieces; a piece may follow another only
if merging the two pieces' characters again gives just these two. If not, the next shorter piece
is tried; a place from which no piece fits is marked in a bitfield and never tried again. This is
the encoding that merging the best adjacent pair again and again ends with.

One pass over whole texts and no shuffle. Repeated words come from a bounded cache.
A null or empty text encodes to the end id alone and decodes to an empty text.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from profilespark.llm.text import per_text, sliced

SPACE = "▁"
CACHE_WORDS = 150_000
CACHE_PAIRS = 400_000
LONG_WORD = 64
_CUT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """The pieces of a model file, and encoding and decoding with them."""

    def __init__(self, model: str) -> None:
        processor = sentencepiece.SentencePieceProcessor(model_file=model)  # read for its table only
        self.end = processor.eos_id()
        self.bytes_of: list[bytes] = []
        self.byte_id: dict[int, int] = {}
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.id_of[piece] = i
                self.score[piece] = processor.get_score(i)
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.runs = sorted((len(p) for p in self.id_of if not p.strip(SPACE)), reverse=True)
        for piece in self.id_of:
            inner = piece.lstrip(SPACE)
            if SPACE in inner or (inner and piece.startswith(SPACE * 2)) or any(c not in self.id_of for c in piece):
                raise ValueError(f"piece {piece!r}: spaces must come first and alone, and its characters be pieces")
        # a piece that merging its own characters never reaches can't be in any encoding
        usable = [p for p in self.id_of if not (p.startswith(SPACE * 2)) and self.merged(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for piece in usable:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.usable = set(usable)
        self.shorter = {p: self._prefix(p) for p in usable}
        self.chars = {c for c in self.id_of if len(c) == 1}
        self.cut = re.compile("([^" + "".join(map(re.escape, sorted(self.chars))) + "])", re.S)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def _prefix(self, piece: str) -> str | None:
        """The longest usable piece that a piece starts with, itself left out."""
        return next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.usable), None)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging the best adjacent pair, leftmost first, ends with."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(-self.score[a + b], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < len(parts):
                    pair = parts[left] + parts[right]
                    if pair in self.score:
                        heapq.heappush(heap, (-self.score[pair], left, parts[left], parts[right]))
        return [p for p in parts if p is not None]

    def fits(self, a: str, b: str) -> bool:
        """Whether merging the characters of both again gives just a and b."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return known

    def longest(self, text: str) -> list[str | None]:
        """For each place, the longest usable piece that starts there."""
        best: list[str | None] = [None] * (len(text) + 1)
        for last, piece in self.automaton.iter(text):  # of the pieces with one start, the longest ends last
            best[last + 1 - len(piece)] = piece
        return best

    def segment(self, text: str) -> list[str]:
        """The encoding of a text of known characters with at most one leading space.

        The search begins with longest matches throughout; if they all fit, that is the encoding.
        """
        out: list[str] = []
        place = 0
        pairs, last = self.pairs, None
        for _, piece in self.automaton.iter_long(text):
            if last is not None:
                known = pairs.get((last, piece))
                if not (self.fits(last, piece) if known is None else known):
                    return self.backtrack(text, out, place)
            out.append(piece)
            place += len(piece)
            last = piece
        return out if place == len(text) else self.backtrack(text, [], 0)

    def backtrack(self, text: str, out: list[str], place: int) -> list[str]:
        """Goes on from some pieces that fit, with a bitfield of failed places."""
        best, size = self.longest(text), len(text)
        failed = bytearray(size + 1)
        pairs, shorter = self.pairs, self.shorter
        piece = best[place]
        while place < size:
            last = out[-1] if out else None
            while piece is not None:
                end = place + len(piece)
                if not failed[end]:
                    if last is None:
                        break
                    known = pairs.get((last, piece))
                    if self.fits(last, piece) if known is None else known:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                place, piece = end, best[end]
            else:  # nothing fits here: mark the place, go back, and try the next shorter piece there
                if last is None:
                    raise ValueError(f"no encoding of {text[:80]!r}")
                failed[place] = 1
                out.pop()
                place -= len(last)
                piece = shorter[last]
        return out

    def word_ids(self, word: str) -> list[int]:
        """Ids of a run of spaces and what follows it up to the next."""
        spaces = 0
        if word.startswith(SPACE * 2):
            body = word.lstrip(SPACE)
            spaces = len(word) - len(body) - 1
            word = word[spaces:]
        ids: list[int] = []
        if self.chars.issuperset(word):
            ids = [self.id_of[p] for p in self.segment(word)]
        else:  # an unknown character merges with nothing
            for part in self.cut.split(word):
                if part in self.id_of or self.chars.issuperset(part):
                    ids += [self.id_of[p] for p in self.segment(part)]
                else:
                    ids += [self.byte_id[b] for b in part.encode("utf-8")]
        if spaces and ids[0] == self.id_of[SPACE]:  # the last space joined nothing and so is part of the run
            spaces, ids = spaces + 1, ids[1:]
        return self._run_ids(spaces) + ids if spaces else ids

    def _run_ids(self, spaces: int) -> list[int]:
        """Pieces of a run of spaces: they merge last, from the left, each into the longest run there is."""
        ids = []
        while spaces:
            size = next(n for n in self.runs if n <= spaces)
            ids.append(self.id_of[SPACE * size])
            spaces -= size
        return ids

    def words_of(self, text: str) -> list[str]:
        return _CUT.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str | None) -> list[int]:
        """All ids, the end id last."""
        return self.encoded(text).tolist()

    def encoded(self, text: str | None) -> np.ndarray:
        """The same as 32-bit numbers."""
        words = b"".join([self.known(w)[0] for w in self.words_of(text or "")])
        return np.fromstring(words + b" %d" % self.end, dtype=np.int32, sep=" ")

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; the space put before the text is taken off again."""
        data = b"".join([self.bytes_of[i] for i in ids])
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")

    def known(self, word: str) -> tuple[bytes, bytes]:
        """A word's ids as decimal text, each after a space, and the bytes that they decode to."""
        found = self.words.get(word)
        if found is not None:
            return found
        found = self.older.get(word)
        if found is None:
            ids = self.word_ids(word)
            found = b" " + b" ".join([b"%d" % i for i in ids]), b"".join([self.bytes_of[i] for i in ids])
        if len(word) <= LONG_WORD:
            if len(self.words) >= CACHE_WORDS:  # words not met since the last time are forgotten
                self.older, self.words = self.words, {}
            self.words[word] = found
        return found

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, hash of the ids, hash of the decoded text."""
        words = []
        for word in self.words_of(text or ""):
            found = self.words.get(word)
            words.append(self.known(word) if found is None else found)
        ids = b"".join([w[0] for w in words]) + b" %d" % self.end
        decoded = b"".join([w[1] for w in words])
        decoded = decoded[1:] if decoded[:1] == b" " else decoded
        return ids.count(b" "), hashlib.sha256(ids[1:]).hexdigest(), hashlib.sha256(decoded).hexdigest()


@functools.cache
def pieces(model: str) -> Pieces:
    """One table per Python worker."""
    return Pieces(model)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and `ids array<int>`, the end id last."""
    return per_text(docs, lambda: lambda texts, _: ([pieces(model).encode(t) for t in texts],), "ids array<int>", id_col, text_col)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per encoded row: its id and `text`; control ids, and a null list, decode to nothing."""
    return per_text(encoded, lambda: lambda lists, _: ([pieces(model).decode(ids or []) for ids in lists],), "text string", id_col, ids_col)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """Encoding and decoding of every whole text as counts and hashes; long id lists never leave the task."""

    def columns(texts: list[str | None], _ids) -> list[tuple]:
        table = pieces(model)
        return list(zip(*[table.digests(t) for t in texts]))

    return per_text(docs, lambda: columns, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def with_ids(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """The rows and columns with `ids array<int>` and `n_tokens` added; each text decodes from its ids.

    A table that has a column of either name already is refused.
    """
    if clash := {"ids", "n_tokens"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"The table has columns named as the result's: {sorted(clash)}")
    place, names = docs.columns.index(text_col), [*docs.columns, "ids", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, place, 2 << 20):  # ids take several times a text's bytes
            ids = [pieces(model).encoded(t) for t in batch.column(place).to_pylist()]
            cuts = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(np.diff(cuts).astype(np.int64))], names)

    schema = StructType([*docs.schema.fields, *StructType.fromDDL("ids array<int>, n_tokens bigint").fields])
    return docs.mapInArrow(run, schema)
