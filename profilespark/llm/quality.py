"""Quality rules: base statistics, and a hashed n-gram log-likelihood ratio against the raw corpus.

Two multinomials over hashed words and word pairs: one of trusted documents, one of all documents.
A document's score is the mean over its n-grams of log p_trusted - log p_raw; it is kept if the
score reaches a threshold that all but a small share of held-out trusted documents reach. Every trusted
document takes part: half of them in the ratios, the others in the threshold.

Counting sums arrays inside each task, so the shuffle has at most BUCKETS rows per task, and the table of ratios has
BUCKETS numbers whatever the corpus. Beside them only the texts of trusted documents are shuffled. Scoring is a second pass.

Null and empty texts have no words and fail the base rules. Without trusted rows all ratios are 0 and
every document that passes the base rules is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.llm.anchors import BITMAP_BITS, bitmap_of
from profilespark.llm.sampling import labelled
from profilespark.llm.text import Words, chunks, encoded, inside, mix, per_text, run_hash
from profilespark.session import materialize

BUCKETS = 1 << 16
#: share of the trusted rows that may fall below the threshold
TRUSTED_LOSS = 0.002
#: the threshold lies this far below that share's score, for documents unlike the trusted ones
MARGIN = 0.05
SMOOTHING = 1.0
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class QualityModel:
    ratio: np.ndarray
    threshold: float


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of each word and each pair of neighbours."""
    pair_at = inside(words.first, 2)
    pairs = run_hash(words.hash, 2)[pair_at]
    document = words.document()
    buckets = np.concatenate((mix(words.hash), pairs)) & np.uint64(BUCKETS - 1)
    return buckets.astype(np.int64), np.concatenate((document, document[pair_at]))


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """`text` of the documents whose id is among `ids`, distinct ones.

    A bitmap of the ids leaves out most other documents where they are read, so the exact join shuffles about as much text as it keeps; the ids
    themselves, which grow with the corpus, go to no worker as a whole. The kind of join is fixed: its cost does not jump with the size.
    """
    known = materialize(ids.select("doc_id"))
    bits = min(BITMAP_BITS, max(1 << 12, 32 * (known.count() // 2 + 1)))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(bits))
    bitmap = bitmap_of(known.select(place.alias("bit")), bits)

    @F.arrow_udf("boolean")
    def may_be(bit: pa.Array) -> pa.Array:
        at = bit.to_numpy(zero_copy_only=False)
        return pa.array((bitmap[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)

    marked = docs.select("doc_id", "text").filter(may_be(place))
    return marked.join(known.hint("merge"), "doc_id", "left_semi").select("text")


def gram_counts(docs: DataFrame, trusted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all documents, and over those whose id is in `trusted`."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            texts = encoded(batch["text"])
            for a, b in chunks(texts):
                counts += np.bincount(_grams(Words(texts[a:b]))[0], minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": used, "n": counts[used]})

    def total(texts: DataFrame) -> np.ndarray:
        sums = texts.mapInPandas(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
        out = np.zeros(BUCKETS)
        out[sums["bucket"]] = sums["n"]
        return out

    return total(docs.select("text")), total(texts_of(docs, trusted))


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)) - np.log(
        (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    )


def _scores(texts: list[bytes], ratio: np.ndarray) -> np.ndarray:
    """Mean log ratio per text, rounded so that the order of summation can't decide; 0 without words."""
    out = np.zeros(len(texts))
    for a, b in chunks(texts):
        buckets, document = _grams(Words(texts[a:b]))
        sums = np.bincount(document, weights=ratio[buckets], minlength=b - a)
        out[a:b] = sums / np.maximum(np.bincount(document, minlength=b - a), 1)
    return np.round(out, 9)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from all documents labelled `quality = 1`: half of them set the ratios, half the threshold."""
    trusted = labelled(labels.select("doc_id", "quality").filter("quality = 1"))
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    ratio = log_ratio(*gram_counts(docs, trusted.filter(half == 0)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"score": _scores(encoded(batch["text"]), ratio)})

    scores = materialize(texts_of(docs, trusted.filter(half == 1)).mapInPandas(score, "score double"))
    return QualityModel(ratio, lower_quantile(scores, TRUSTED_LOSS) - MARGIN)


def lower_quantile(scores: DataFrame, share: float) -> float:
    """The score that `share` of all rows lie below, rounded down to one that occurs; -inf without rows."""
    least = scores.orderBy("score").limit(int(np.floor(share * max(scores.count() - 1, 0))) + 1)
    found = least.agg(F.max("score")).first()[0]
    return -np.inf if found is None else float(found)


def _per_text(mask: np.ndarray, words: Words) -> np.ndarray:
    return np.add.reduceat(mask.astype(np.int64), words.offset[:-1])


def statistics(texts: list[bytes]) -> pd.DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    parts = []
    for a, b in chunks(texts):
        words = Words(texts[a:b])
        data = np.frombuffer(words.buffer, dtype=np.uint8)
        document = words.document()
        at = inside(words.first, 3)
        keys = mix(run_hash(words.hash, 3)[at] + document[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), dtype=bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        repeated = np.zeros(len(words.hash), dtype=bool)
        for k in range(3):
            repeated[at[again] + k] = True
        lines = [[line for line in t.split(b"\n") if line.strip()] for t in texts[a:b]]
        parts.append(pd.DataFrame({
            "n_words": np.diff(words.first),
            "word_chars": _per_text(~_SPACE[data] & ((data & 0xC0) != 0x80), words),
            "n_symbols": _per_text(_SYMBOL[data], words),
            "n_dup_lines": [len(x) - len(set(x)) for x in lines],
            "n_repeat_words": np.bincount(document[repeated], minlength=b - a),
        }))
    return pd.concat(parts, ignore_index=True)


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double"
)


def judge(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Every document with its statistics, its mean log ratio and the verdict."""
    ratio, threshold = model.ratio, model.threshold

    def columns(texts: list[str | None], _ids) -> list:
        data = encoded(texts)
        out = statistics(data)
        failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
        scores = _scores(data, ratio)
        return [*[out[c] for c in out.columns], failed, ~failed & (scores >= threshold), scores]

    return per_text(docs, lambda: columns, COLUMNS)
