"""Toxicity by compression distance: two zstandard dictionaries, one score per text.

A dictionary is trained on ordinary labelled texts, another on what sets toxic ones apart: the stretches
whose short byte sequences are in many more toxic texts than ordinary ones. Each text is cut
into windows at spaces, and each window is compressed twice: with the ordinary dictionary, and with the
toxic one put before it. Ordinary prose takes as many bytes either way, so what a window gains is due to
toxic text. The gains over several thresholds, per window, go through a logistic curve
that is calibrated on labelled rows which neither dictionary has seen.

Fitting reads a bounded sample of labelled rows; scoring is one pass over whole texts, without a shuffle.
If the sample's texts are over its byte bound, all of its rows stay, and of the longest texts pieces that are spread over the whole text.
Of rows that share an id, one is read. Null and empty texts have no gain. Where no text has a label, there is no model and every score
is 0; with labels of one kind only, or with too few texts of either kind to fit on, fitting fails.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.llm.sampling import labelled_sample
from profilespark.llm.text import crc_fold, encoded, per_text, sliced

#: bounds on the labelled rows, and on the bytes of their texts, that the model is fitted on
TOXIC_ROWS, ORDINARY_ROWS = 2500, 4000
SAMPLE_BYTES = 24 << 20
ORDINARY_DICTIONARY, TOXIC_DICTIONARY = 32 << 10, 2 << 10
WINDOW = 64
GRAM = 6
#: a byte sequence marks toxic text if it is in this share of the toxic sample (in three texts at least), in so many times
#: the texts that ordinary text lets expect, and by so many deviations more
GRAM_SHARE, GRAM_LIFT, GRAM_DEVIATIONS = 0.03, 4.0, 6.0
PREDICTED_AT = 0.7
_LONGEST_SAMPLE = 400


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2, min_match=4, search_log=4, target_length=32, window_log=17, hash_log=15, chain_log=16,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text in pieces of at most `size` bytes, cut before a space where there is one."""
    out, start, end = [], 0, len(text)
    while end - start > size:
        cut = text.rfind(b" ", start + 1, start + size + 1)
        cut = start + size if cut <= start else cut
        out.append(text[start:cut])
        start = cut
    return [*out, text[start:]] if start < end else out


class Gains:
    """Bytes saved by the toxic dictionary, window by window."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.plain = _compressor(ordinary).compress
        # put first, so that the distances to ordinary text stay the same
        self.joint = _compressor(toxic + ordinary).compress

    def features(self, text: bytes) -> list[float]:
        plain, joint = self.plain, self.joint
        saved = [len(plain(w)) - len(joint(w)) for w in windows(text)]
        n = max(1, len(saved))
        above = [sum(s - least for s in saved if s > least) for least in range(3)]
        # rates, two of them held down in short texts; none grows with the length of a text
        rates = [above[0] / n, above[1] / n, above[2] / n, sum(s > 2 for s in saved) / n, sum(s > 3 for s in saved) / n]
        return [*rates, above[1] / (n + 10), above[1] / (n + 30)]


def _grams(text: bytes) -> np.ndarray:
    """Distinct short byte sequences, packed into numbers."""
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint64)
    if len(data) < GRAM:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(_packed(data))


def _packed(data: np.ndarray) -> np.ndarray:
    n = len(data) - GRAM + 1
    return sum((data[k:k + n] << np.uint64(8 * k) for k in range(GRAM)), np.zeros(n, dtype=np.uint64))


def _marked_stretches(text: bytes, marks: np.ndarray) -> bytes:
    """The parts of a text that marking sequences cover, joined."""
    if len(text) < GRAM or not len(marks):
        return b""
    grams = _packed(np.frombuffer(text, dtype=np.uint8).astype(np.uint64))
    places = np.searchsorted(marks, grams)
    hit = marks[np.minimum(places, len(marks) - 1)] == grams
    covered = np.zeros(len(text), dtype=bool)
    for k in range(GRAM):
        covered[k:k + len(hit)] |= hit
    return np.frombuffer(text, dtype=np.uint8)[covered].tobytes()


def _trained(samples: list[bytes], size: int) -> bytes:
    """Dictionary content; of samples too few to train on, their text itself."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary content."""
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))  # copies prove nothing
    marks = _marks(toxic, ordinary)
    stretches = [s for s in (_marked_stretches(t, marks) for t in toxic) if s]
    # ordinary text that holds marks is left out, so that marked stretches are cheap for one dictionary only
    plain = [w for t in ordinary for w in windows(t, _LONGEST_SAMPLE) if not _marked_stretches(w, marks)]
    return _trained(plain, ORDINARY_DICTIONARY), _trained(stretches, TOXIC_DICTIONARY) if stretches else b""


def _marks(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """Sorted byte sequences that are in many more toxic texts than their share of ordinary texts lets expect."""
    usual, usual_texts = np.unique(np.concatenate([_grams(t) for t in ordinary]), return_counts=True)
    seen, texts = np.unique(np.concatenate([_grams(t) for t in toxic]), return_counts=True)
    often = texts >= max(3, GRAM_SHARE * len(toxic))
    seen, texts = seen[often], texts[often]
    if not len(usual) or not len(seen):
        return seen
    at = np.minimum(np.searchsorted(usual, seen), len(usual) - 1)
    expected = np.where(usual[at] == seen, usual_texts[at], 0) * len(toxic) / len(ordinary)
    return seen[(texts >= GRAM_LIFT * expected) & (texts - expected >= GRAM_DEVIATIONS * np.sqrt(expected))]


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Weights of a logistic curve, the last one the bias, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    keep = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - p) - keep @ weights
        weights = weights + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, gradient)
    return weights


def fit_texts(texts: list[bytes], toxic: list[bool], part: list[int]) -> ToxicityModel | None:
    """Fit on some texts: those of part 0 calibrate, the others make the dictionaries."""
    groups = {(y, calibrate): [t for t, z, p in zip(texts, toxic, part) if z == y and (p == 0) == calibrate]
              for y in (True, False) for calibrate in (True, False)}
    if not all(groups.values()):
        return None
    ordinary, own = dictionaries(groups[True, False], groups[False, False])
    gains = Gains(ordinary, own)
    x = np.array([gains.features(t) for y in (True, False) for t in groups[y, True]])
    y = np.array([1.0] * len(groups[True, True]) + [0.0] * len(groups[False, True]))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights = _logistic((x - mean) / scale, y)
    return ToxicityModel(ordinary, own, tuple(mean), tuple(scale), tuple(weights[:-1]), float(weights[-1]))


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> ToxicityModel | None:
    """Fit on a bounded sample of the labelled rows whose id is not in the held-out fold."""
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    known = labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull() & (F.crc32(text_id) % 3 != 1))
    sample = labelled_sample(known, toxic_rows, "toxic = 1").unionByName(labelled_sample(known, ordinary_rows, "toxic <> 1"))
    rows = docs.select("doc_id", F.lower("text").alias("text")).filter("text is not null").join(F.broadcast(sample), "doc_id")
    rows = rows.select("doc_id", "toxic", "text", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))
    # bounded rows, one for each id
    ones = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct("hash", "size")).alias("one")).select("doc_id", "toxic", "one.*").toPandas()
    if ones.empty:
        return None
    if ones["toxic"].eq(1).nunique() < 2:
        raise ValueError(f"All {len(ones)} labelled texts to fit on are {'toxic' if ones['toxic'].iloc[0] == 1 else 'ordinary'}: both kinds are needed.")
    limit = _longest(ones["size"].to_numpy(), SAMPLE_BYTES)
    chosen = docs.sparkSession.createDataFrame(ones[["doc_id", "hash"]].astype("int64"), "doc_id bigint, hash bigint")
    found = rows.join(F.broadcast(chosen), ["doc_id", "hash"], "left_semi").select("doc_id", "toxic", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2):
            texts = [spread_pieces(t, limit) for t in encoded(batch.column(2).to_pylist(), lower=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "toxic", "text"])

    fitted = found.mapInArrow(cut, "doc_id bigint, toxic bigint, text binary").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    fitted = fitted.toPandas().sort_values("doc_id")
    part = [zlib.crc32(f"part {i}".encode()) % 3 for i in fitted["doc_id"]]
    model = fit_texts([bytes(t) for t in fitted["text"]], [t == 1 for t in fitted["toxic"]], part)
    if model is None:
        raise ValueError(f"{len(fitted)} labelled texts are too few to fit on: both labels need texts for the dictionaries and for calibration.")
    return model


def _longest(sizes: np.ndarray, total: int) -> int:
    """The largest bound on each size with which all sizes together stay within `total`."""
    sizes = np.sort(sizes.astype(np.int64))
    left = total - np.concatenate(([0], np.cumsum(sizes)[:-1]))  # for a size and all larger ones
    bounds = left // np.arange(len(sizes), 0, -1)
    over = np.flatnonzero(sizes > bounds)
    return int(bounds[over[0]]) if len(over) else int(sizes[-1])


def spread_pieces(text: bytes, most: int) -> bytes:
    """A text of at most `most` bytes whole; of a longer one, pieces spread evenly from its start to its end."""
    if len(text) <= most:
        return text
    pieces = windows(text, _LONGEST_SAMPLE)
    n = max(1, most // _LONGEST_SAMPLE)
    return b"".join(pieces[i] for i in np.linspace(0, len(pieces) - 1, n).astype(int))[:most]


def score(docs: DataFrame, model: ToxicityModel | None, threshold: float = PREDICTED_AT) -> DataFrame:
    """doc_id, held_out, score, predicted for every whole text."""

    def start():
        judge = Scorer(model)

        def columns(texts: list[str | None], ids: list[int | None]) -> list[list]:
            scores = judge(texts)
            return [[crc_fold(i, 3) == 1 for i in ids], scores, [int(s >= threshold) for s in scores]]

        return columns

    return per_text(docs, start, "held_out boolean, score double, predicted int")


class Scorer:
    """Scores of texts; repeated texts of a batch are scored once."""

    def __init__(self, model: ToxicityModel | None) -> None:
        self.model = model
        self.gains = Gains(model.ordinary, model.toxic) if model else None

    def __call__(self, texts) -> list[float]:
        if not self.model:
            return [0.0] * len(texts)
        known: dict[str, float] = {}
        out = []
        for text in texts:
            text = text or ""
            if text not in known:
                known[text] = self._one(text)
            out.append(known[text])
        return out

    def _one(self, text: str) -> float:
        x = (np.array(self.gains.features(encoded([text.lower()])[0])) - self.model.mean) / self.model.scale
        return float(np.round(1 / (1 + np.exp(-np.clip(x @ np.array(self.model.weights) + self.model.bias, -30, 30))), 9))


def without_toxic(docs: DataFrame, model: ToxicityModel | None, threshold: float = PREDICTED_AT, text_col: str = "text") -> DataFrame:
    """The rows, columns unchanged, whose score stays below the threshold."""

    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Scorer(model)
        for batch in sliced(batches, place):
            yield batch.filter(pa.array([s < threshold for s in judge(batch.column(place).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
