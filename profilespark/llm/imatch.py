"""I-Match fingerprints: hashes of a document's mid-frequency terms under several randomised lexicons.

A term is a word with A-Z lowered. The lexicon holds the terms that occur in a share of all documents between
two bounds, counted over the whole corpus; as the mean document has D distinct terms, there are at most
D / MIN_SHARE of them, however many documents there are, and that bound is checked. A document's terms in the
lexicon are sorted and made distinct, and each randomised lexicon keeps a random part of them; what it keeps is
hashed. Random lexicons come in densities 1, 1/2, 1/4, ...; a document uses the two that keep about one term of
its own, so a long document's hashes survive an edit as well as a short one's.

A fingerprint is `t:hashes/hashes`: the tier t = floor(log2(terms)) and the hashes at densities 2^-t and 2^-(t+1),
six hex digits for each lexicon, or dashes for one that keeps nothing. A text without terms in the lexicon has
`text:` and a hash of itself. Equal texts have equal fingerprints. The likeness of two fingerprints is the share of
lexicons with equal hashes, of those that keep something of either, at the best density that both use.

Counting document frequencies shuffles one row per distinct term and task. Comparing neighbours shuffles each
text once, compressed, by ranges of ids, and then streams through each range with one row of look-ahead.
Null and empty texts are equal. Ties of ids are put in order of a hash of the text; a null id comes first.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.llm.text import Words, chunks, encoded, mix

MIN_SHARE, MAX_SHARE = 0.001, 0.02
#: checked before the lexicon goes to every task
LEXICON_TERMS = 2_000_000
LEXICONS = 16
_SEEDS = mix(np.arange(1, LEXICONS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_EMPTY = -1
_FIRST_ID = -(1 << 63)


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, term) without repeats, by document, then term."""
    document = words.document()
    order = np.lexsort((words.hash, document))
    document, terms = document[order], words.hash[order]
    new = np.ones(len(terms), dtype=bool)
    new[1:] = (terms[1:] != terms[:-1]) | (document[1:] != document[:-1])
    return document[new], terms[new]


def document_frequency(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, documents): the hash of every term of the corpus and the number of documents it is in."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = encoded(batch["text"], lower=True)
            found = [_distinct(Words(texts[a:b]))[1] for a, b in chunks(texts)]
            if found:
                terms, n = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"term": terms.view(np.int64), "n": n})

    rows = docs.select(docs[text_col].alias("text")).mapInPandas(count, "term bigint, n bigint")
    return rows.groupBy("term").agg(F.sum("n").alias("documents"))


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> np.ndarray:
    """Sorted hashes of the terms within the band; a term of one document alone is never one."""
    n = docs.count()
    low, high = max(2, min_share * n), max(2, max_share * n)
    rows = document_frequency(docs).filter(F.col("documents").between(low, high)).select("term")
    terms = rows.limit(LEXICON_TERMS + 1).toPandas()["term"].to_numpy(dtype=np.int64)
    if len(terms) > LEXICON_TERMS:
        raise ValueError(f"more than {LEXICON_TERMS} terms in the band: documents are very long; raise min_share")
    return np.sort(terms.view(np.uint64))


class Fingerprints:
    """Fingerprints of some texts: `tier` (-1: no term), and hashes (texts, 2, LEXICONS), -1 where nothing is kept."""

    def __init__(self, texts: list[bytes], known: np.ndarray) -> None:
        parts = [_hashes(texts[a:b], known) for a, b in chunks(texts)]
        self.texts = texts
        self.tier = np.concatenate([t for t, _ in parts]) if parts else np.zeros(0, dtype=np.int64)
        self.hashes = np.concatenate([h for _, h in parts]) if parts else np.zeros((0, 2, LEXICONS), dtype=np.int64)

    def as_text(self) -> list[str]:
        out = []
        for text, tier, pair in zip(self.texts, self.tier.tolist(), self.hashes.tolist()):
            if tier < 0:
                out.append("text:" + hashlib.sha256(text).hexdigest()[:32])
            else:
                out.append(f"{tier}:" + "/".join("".join("------" if h < 0 else f"{h:06x}" for h in row) for row in pair))
        return out


def _hashes(texts: list[bytes], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = Words([t.lower() for t in texts])
    if len(known):
        at = np.minimum(np.searchsorted(known, words.hash), len(known) - 1)
        keep = known[at] == words.hash
    else:
        keep = np.zeros(len(words.hash), dtype=bool)
    document, terms = words.document()[keep], words.hash[keep]
    order = np.lexsort((terms, document))
    document, terms = document[order], terms[order]
    new = np.ones(len(terms), dtype=bool)
    new[1:] = (terms[1:] != terms[:-1]) | (document[1:] != document[:-1])
    document, terms = document[new], terms[new]
    n = np.bincount(document, minlength=len(texts))
    tier = np.where(n > 0, np.floor(np.log2(np.maximum(n, 1))).astype(np.int64), -1)
    hashes = np.full((len(texts), 2, LEXICONS), _EMPTY, dtype=np.int64)
    if len(terms):
        start = np.flatnonzero(np.diff(document, prepend=-1))
        held = document[start]
        for k, seed in enumerate(_SEEDS):
            draw = mix(terms + seed)
            value = mix(draw)
            for step in range(2):
                kept = (draw & ((np.uint64(1) << (tier[document] + step).astype(np.uint64)) - np.uint64(1))) == 0
                sums = np.add.reduceat(np.where(kept, value, np.uint64(0)), start)
                some = np.add.reduceat(kept.astype(np.int64), start) > 0
                hashes[held[some], step, k] = (mix(sums[some]) >> np.uint64(40)).astype(np.int64)
    return tier, hashes


def likeness(tier_a: np.ndarray, a: np.ndarray, tier_b: np.ndarray, b: np.ndarray, same_text: np.ndarray) -> np.ndarray:
    """Row by row; texts without terms are alike only if they are the same."""
    out = np.where(same_text, 1.0, 0.0)
    shift = tier_b - tier_a  # densities of a: tier, tier + 1; they meet b's if the tiers differ by at most one
    for i in range(2):
        for k in range(2):
            meet = (tier_a >= 0) & (tier_b >= 0) & (shift == i - k)
            x, y = a[meet, i], b[meet, k]
            either = ((x >= 0) | (y >= 0)).sum(axis=1)
            equal = ((x == y) & (x >= 0)).sum(axis=1)
            out[meet] = np.maximum(out[meet], equal / np.maximum(either, 1))
    return out


def edit(text: str, following: str) -> str:
    """The last quarter of a text's code points replaced by the first as many of the next text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _ranges(docs: DataFrame) -> tuple[list[int], list[int | None]]:
    """(upper bounds, first id of each range): a few ranges per shuffle partition, from the ids alone."""
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("doc_id", F.lit(_FIRST_ID))
    shares = F.array(*[F.lit((i + 1) / n) for i in range(n - 1)])
    bounds = docs.agg(F.percentile_approx(key, shares, F.lit(20 * n))).first()[0] or []
    bounds = sorted(set(bounds))
    firsts: list[int | None] = [None] * (len(bounds) + 1)
    for row in docs.select(key.alias("key")).select("key", _range_of(bounds)("key").alias("range")).groupBy("range").agg(F.min("key").alias("key")).collect():
        firsts[row["range"]] = row["key"]
    return bounds, firsts


def _range_of(bounds: list[int]):
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(dtype=np.int64)).astype(np.int32))

    return place


def _places_of(bounds: list[int], firsts: list[int | None]):
    """A function that gives the range of an id, and for the first of a range also the range before, as -1 - that range."""
    filled = [r for r, first in enumerate(firsts) if first is not None]
    before = {firsts[r]: filled[i - 1] for i, r in enumerate(filled)}

    def places(key: int) -> list[int]:
        return [bisect.bisect_left(bounds, key)] + ([-1 - before[key]] if key in before else [])

    return places


COLUMNS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_neighbours(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """Each document against its edited text and against the next document by id."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    places = _places_of(*_ranges(docs))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            rows = []
            for doc_id, version, text in zip(*[c.to_pylist() for c in batch.columns]):
                packed = pack(text.encode("utf-8", "surrogatepass"))
                for place in places(_FIRST_ID if doc_id is None else doc_id):
                    rows.append((place if place >= 0 else -1 - place, place < 0, doc_id, version, packed))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["range", "ahead", "doc_id", "version", "packed"])

    kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
    sent = docs.select("doc_id", F.xxhash64("text").alias("version"), "text").mapInArrow(
        spread, "range int, ahead boolean, doc_id bigint, version bigint, packed binary")
    ordered = sent.repartition("range").sortWithinPartitions("range", "ahead", "doc_id", "version")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            of, ahead, ids, _, packed = [c.to_pylist() for c in batch.columns]
            held += zip(of, ahead, ids, [unpack(p).decode("utf-8", "surrogatepass") for p in packed])
            yield from compared(held[:-1], held[1:])
            held = held[-1:]

    def compared(rows: list[tuple], following: list[tuple]) -> Iterator[pa.RecordBatch]:
        pairs = [(a, b) for a, b in zip(rows, following) if not a[1]]
        for start in range(0, len(pairs), 1000):
            part = pairs[start:start + 1000]
            texts, after = [a[3] for a, _ in part], [b[3] for _, b in part]
            own, nxt = encoded(texts), encoded(after)
            changed = encoded([edit(t, n) for t, n in zip(texts, after)])
            p, q, r = Fingerprints(own, known), Fingerprints(changed, known), Fingerprints(nxt, known)
            columns = [
                [a[2] for a, _ in part], [len(t) for t in texts], [hashlib.sha256(t).hexdigest() for t in changed],
                p.as_text(), q.as_text(),
                likeness(p.tier, p.hashes, q.tier, q.hashes, np.array([a == b for a, b in zip(own, changed)])),
                likeness(p.tier, p.hashes, r.tier, r.hashes, np.array([a == b for a, b in zip(own, nxt)])),
            ]
            yield pa.RecordBatch.from_pydict(dict(zip(_ARROW.names, columns)), schema=_ARROW)

    return ordered.mapInArrow(run, COLUMNS)


_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
