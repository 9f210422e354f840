"""Words of whole texts as arrays: shared by the operators that count, shingle or hash words.

A word is `[^\\x20\\x09-\\x0D]+`. A word's identity is a 64-bit hash of its bytes, which is
the same on every machine and in every run.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

CHUNK_BYTES = 1 << 20
SLICE_BYTES = 4 << 20

def _stream(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit numbers from a seed (splitmix64 of a counter)."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _stream(7, 256)
_PLACE = _stream(11, 1 << 16)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: the hash that stands for the end of a text where it counts as a token
END = np.uint64(0x5EED0FE11D0C0E4D)


def encoded(texts: Iterable[str | None], lower: bool = False) -> list[bytes]:
    """UTF-8 bytes of the texts; a null is empty. lower: A-Z only."""
    out = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    return [t.lower() for t in out] if lower else out


def chunks(docs: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `size` bytes together; a longer text is a range of its own."""
    start = total = 0
    for i, doc in enumerate(docs):
        if total and total + len(doc) > size:
            yield start, i
            start, total = i, 0
        total += len(doc) + 1
    if start < len(docs):
        yield start, len(docs)


def sliced(batches: Iterable[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about `most` bytes of text or binary data, so that Python objects stay few at a time."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        pieces = np.cumsum(sizes, dtype=np.int64) // most
        cuts = np.flatnonzero(np.diff(pieces, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(sizes))):
            yield batch.slice(int(a), int(b - a))
        pa.default_memory_pool().release_unused()  # a worker lives on after its task


class Words:
    """All words of some documents, in order: `hash`, byte range [`start`, `end`) in `buffer`.

    Document d has the words first[d] to first[d + 1].
    """

    def __init__(self, docs: list[bytes]) -> None:
        self.buffer = b"\n".join(docs) + b"\n"
        data = np.frombuffer(self.buffer, dtype=np.uint8)
        space = _SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edges = np.concatenate(([0], edges))
        self.start, self.end = edges[0::2], edges[1::2]  # the buffer ends with a space
        self.offset = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs], dtype=np.int64)))
        self.first = np.searchsorted(self.start, self.offset)
        if len(self.start):
            body = data[self.start[0]:]
            sizes = np.diff(np.append(self.start, len(data)))
            place = np.arange(len(body)) - np.repeat(self.start - self.start[0], sizes)
            values = _BYTE[body] * _PLACE[place & 0xFFFF]
            values[space[self.start[0]:]] = 0
            sums = np.add.reduceat(values, self.start - self.start[0])
            self.hash = mix(sums + (self.end - self.start).astype(np.uint64))
        else:
            self.hash = np.zeros(0, dtype=np.uint64)

    def document(self) -> np.ndarray:
        """For each word, the document it is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_FACTOR = 0x2545F4914F6CDD1D
_INVERSE = pow(_FACTOR, -1, 1 << 64)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.full(n, factor, dtype=np.uint64)) for factor in (_FACTOR, _INVERSE))


def run_hash(values: np.ndarray, n: int, mixed: bool = False) -> np.ndarray:
    """A hash of every run of n consecutive values: element i stands for values[i : i + n]."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(1 << max(16, (len(values) - 1).bit_length()))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values if mixed else mix(values)) * up[:len(values)], out=sums[1:])
    return mix((sums[n:] - sums[:count]) * down[:count] + np.uint64(n))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A fixed random number for each byte, for `run_hash(..., mixed=True)`."""
    return _BYTE[data]


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """Start places of the runs of n values that stay within one document."""
    sizes = np.diff(first)
    keep = np.maximum(sizes - (n - 1), 0)
    return np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(keep)[:-1])), keep) + np.arange(keep.sum())


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as keep it apart from `columns`, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def crc_fold(doc_id: int | None, folds: int) -> int:
    """crc32 of the id's decimal text, modulo `folds`; a null id counts as an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(int(doc_id)).encode()) % folds


def per_text(
    docs: DataFrame, start: Callable[[], Callable], columns: str, id_col: str = "doc_id", text_col: str = "text", out_id: str | None = None
) -> DataFrame:
    """One row per document: its id, untouched, and the columns that a function makes of a batch of texts.

    start() is called once per task and returns the function: (texts, ids) -> one list or array per column.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    is_text = rows.schema["text"].dataType.simpleString() in ("string", "binary")
    added = StructType.fromDDL(columns)
    types = [f.type for f in to_arrow_schema(added)]
    names = [out_id or id_col, *added.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in sliced(batches, 1) if is_text else batches:
            if batch.num_rows:
                made = function(batch.column(1).to_pylist(), batch.column(0).to_pylist())
                arrays = [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    schema = StructType([StructField(names[0], rows.schema["id"].dataType), *added.fields])
    return rows.mapInArrow(run, schema)
