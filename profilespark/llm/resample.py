"""Importance resampling towards a target distribution of hashed word n-grams.

Every feature (a word, or two consecutive words) falls into one of BUCKETS buckets. Feature counts of all documents and of all
target texts, summed per task and then per bucket, give one array of gains; a document's weight is the mean gain of its features.
Gumbel noise drawn from the id is added, so the highest scores are a draw without replacement in proportion to the
exponential of the weights.

The cutoff: a quantile sketch of the scores brackets it; exact counts of the rows on both sides say whether it lies inside,
and widen the bracket until it does; only the rows of the bracket are sorted.

Whole texts of whole tables. Null and empty texts have no features, weight 0, and too few words to be drawn. Copies of a row are
rows of their own; a null id is an empty id text and loses ties. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from profilespark.llm.text import chunks, encoded, per_text, sliced
from profilespark.session import materialize

BUCKETS = 10_000
#: documents with fewer words are never drawn
MIN_WORDS = 20
#: per cent of them that is drawn
PERCENT = 25
#: names the noise
SEED = 7
#: accuracy of the sketch, and the first bracket's share of the rows on each side of the cutoff
SKETCH = 10_000
MARGIN = 4 / SKETCH
#: rows that one sorting task should hold at most, about
TASK_ROWS = 1_000_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: words up to this many bytes are joined through tables
LONGEST = 64


@functools.cache
def _shifts() -> np.ndarray:
    """[k, i, byte]: what k zero bytes make of a CRC-32 whose i-th byte is `byte`, the rest 0."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    out = np.zeros((LONGEST + 2, 4, 256), dtype=np.uint32)
    for i in range(4):
        out[0, i] = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
    for k in range(LONGEST + 1):
        out[k + 1] = (out[k] >> np.uint32(8)) ^ table[out[k] & np.uint32(0xFF)]
    return out


def _shifted(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    tables = _shifts()
    out = tables[zeros, 0, crc & np.uint32(0xFF)]
    for i in range(1, 4):
        out ^= tables[zeros, i, (crc >> np.uint32(8 * i)) & np.uint32(0xFF)]
    return out


def pair_crcs(words: list[bytes], crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, a space and the next word, from the words' own."""
    before, after, size = crcs[:-1], crcs[1:], sizes[1:]
    short = np.minimum(size, LONGEST)
    out = _shifted(before, short + 1) ^ _shifted(np.full(len(after), zlib.crc32(b" "), dtype=np.uint32), short) ^ after
    for i in np.flatnonzero(size > LONGEST).tolist():
        out[i] = zlib.crc32(b" " + words[i + 1], int(before[i]))
    return out


def feature_buckets(docs: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per document, buckets, document) of all words, then of all pairs, of lower-cased documents."""
    listed = [_WORD.findall(d) for d in docs]
    counts = np.array([len(w) for w in listed], dtype=np.int64)
    words = list(itertools.chain.from_iterable(listed))
    crcs = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    document = np.repeat(np.arange(len(docs)), counts)
    both = np.flatnonzero(document[1:] == document[:-1])
    pairs = pair_crcs(words, crcs, sizes)[both] if len(words) > 1 else np.zeros(0, dtype=np.uint32)
    return counts, np.concatenate((crcs, pairs)) % np.uint32(buckets), np.concatenate((document, document[both]))


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Number of features in each bucket over all texts; at most `buckets` numbers a task and on the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in sliced(batches, 0):
            lowered = encoded(batch.column(0).to_pylist(), lower=True)
            for a, b in chunks(lowered):
                total += np.bincount(feature_buckets(lowered[a:b], buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    counted = docs.select(docs[text_col].alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: floored thousandths of the log ratio of its smoothed shares in target and source."""
    s_all, t_all, size = float(source.sum()), float(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (s_all + size) / ((float(s) + 1) * (t_all + size))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Floored thousandths of a Gumbel variate that depends on the id alone."""
    text = f"{seed}:" if doc_id is None else f"{seed}:{int(doc_id)}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Per document: n_words, n_features, weight and score."""

    def start():
        def function(texts: list[str | None], ids: list) -> list[list]:
            lowered = encoded(texts, lower=True)
            n_words, n_features, weights = [], [], []
            for a, b in chunks(lowered):
                words, features, document = feature_buckets(lowered[a:b], len(gain))
                # sums of whole numbers far below 2^53: exact as doubles
                sums = np.bincount(document, weights=gain[features], minlength=b - a).astype(np.int64)
                n = np.bincount(document, minlength=b - a)
                n_words += words.tolist()
                n_features += n.tolist()
                weights += np.where(n > 0, sums // np.maximum(n, 1), 0).tolist()
            return [n_words, n_features, weights, [w + noise(i, seed) for w, i in zip(weights, ids, strict=True)]]

        return function

    return per_text(docs, start, "n_words bigint, n_features bigint, weight bigint, score bigint", id_col, text_col)


ORDER = ("score", "id", "row")


def _order() -> list:
    return [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]


def ranked(rows: DataFrame, n: int) -> DataFrame:
    """`rows` with `rank` from 1 in the drawing order: ranges sorted apart, each after the rows of those before it.

    The sorted ranges are written once, so that the number of a row in its range is the same in both uses.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // TASK_ROWS + 1)
    ranges = rows.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
    # the number of the partition in the upper bits, that of the row in it in the lower 33
    written = materialize(ranges.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = {p: size for p, size in written.groupBy(part.alias("part")).count().collect()}  # one number a range
    before = dict(zip(sorted(sizes), itertools.accumulate([0, *[sizes[p] for p in sorted(sizes)]]), strict=False))
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "part bigint, before bigint")
    return written.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        *rows.columns, (F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).alias("rank")
    )


def cutoff(rows: DataFrame, n: int, wanted: int, margin: float = MARGIN) -> tuple:
    """(score, id, row) of the last of the `wanted` first of `n` rows in the drawing order."""
    share = 1 - wanted / n
    while True:
        shares = [max(share - margin, 0.0), min(share + margin, 1.0)]
        low, high = rows.agg(F.percentile_approx("score", shares, F.lit(SKETCH))).first()[0]
        low, high = (None if shares[0] <= 0 else low), (None if shares[1] >= 1 else high)
        score = F.col("score")
        above = F.lit(False) if high is None else score > high
        below = F.lit(False) if low is None else score < low
        n_above, n_below = rows.agg(F.count_if(above), F.count_if(below)).first()
        if n_above < wanted <= n - n_below:
            break
        margin *= 8
    inside = ranked(rows.filter(~above & ~below), n - n_above - n_below)
    return tuple(inside.filter(F.col("rank") == wanted - n_above).select(*ORDER).first())


def at_or_before(last: tuple) -> Column:
    """Whether a row comes no later than `last` in the drawing order."""
    score, doc_id, row = (F.lit(v) for v in last)
    score_tie = F.col("score") == score
    if last[1] is None:
        earlier_id, id_tie = F.col("id").isNotNull(), F.col("id").isNull()
    else:
        earlier_id, id_tie = F.coalesce(F.col("id") < doc_id, F.lit(False)), F.col("id").eqNullSafe(doc_id)
    return (F.col("score") > score) | (score_tie & (earlier_id | (id_tie & (F.col("row") <= row))))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    percent: int = PERCENT, seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """Every document: its features, weight and score, and its rank among the drawn ones (null: not drawn)."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    weighed = weigh(docs, gain, id_col, text_col, seed).withColumnRenamed(id_col, "id")
    rows = materialize(weighed.withColumn("row", F.monotonically_increasing_id()))
    eligible = rows.filter(F.col("n_words") >= MIN_WORDS)
    n = eligible.count()
    wanted = percent * n // 100
    is_drawn = F.lit(False)
    if wanted:
        is_drawn = (F.col("n_words") >= MIN_WORDS) & at_or_before(cutoff(eligible, n, wanted))
    out = rows.filter(~is_drawn).withColumn("rank", F.lit(None).cast(LongType()))
    if wanted:
        out = out.unionByName(ranked(rows.filter(is_drawn), wanted))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words")
