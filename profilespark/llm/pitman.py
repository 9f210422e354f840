"""A hierarchical Pitman-Yor bigram model over words, its seating sampled by Gibbs sweeps.

Every training token is a customer of the restaurant of the word before it, whatever the two words. The tables of all
these restaurants are the customers of one that all share, whose base is uniform over the vocabulary and one word
never seen. So
    p(word | before) = (n - discount * tables) / (strength + customers) + backoff(before) * p(word).

A sweep takes all customers of a dish out of a restaurant and seats them again, given the tables there
and the shared restaurant of the sweep before; all pairs of words are seated in parallel. Long runs of
customers of one dish are seated in batches that grow with those already seated. After BURN sweeps, the discounted counts,
the backoff weights and the shared restaurant are averaged over KEPT sweeps. Discounts come from the counts of counts.

Counts cover all training documents: words and pairs are summed in batches and tasks before the shuffle, and pairs of two
classes (words with at least CLASS_SHARE of all tokens, so at most 1 / CLASS_SHARE of them, and the end of text) once per
task. What tasks get whole is bounded: the matrix of the classes, and words with at least COMMON_SHARE of
all tokens. All rarer words are joined by their hash, none of which is hot, because hot ones are common; pairs are joined
by a hash of both words, and none but those of two classes is hot.

Lower-casing is A-Z only; a text's end counts as a token. Null and empty texts are the end alone. Rows that are
equal are scored each by itself. Words, and pairs of words, are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profilespark.llm.text import END, Words, chunks, crc_fold, encoded
from profilespark.session import materialize

FOLDS, HELD_OUT = 7, 2
CLASS_SHARE = 2.0**-11
COMMON_SHARE = 2.0**-22
BURN, KEPT = 2, 4
STRENGTH = 1.0
#: of customers of one dish, as many are seated at once as this share of those already seated
BATCH = 1 / 8


@dataclass(frozen=True)
class Vocabulary:
    tokens: int
    words: int
    classes: np.ndarray  # sorted hashes; class i is classes[i], and `other` is len(classes)
    class_counts: np.ndarray

    @property
    def other(self) -> int:
        return len(self.classes)


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    pair: np.ndarray  # log10 p(class | class before), [before, class]; the last row is a word never met, the last column all other words
    common: np.ndarray  # sorted hashes of common words of `other`
    common_counts: np.ndarray
    unseen_log: float
    words: DataFrame  # (token, c, log_p) of every word of `other`; log_p is log10 p(word | other) in the shared restaurant
    known: DataFrame  # (token) of the classes and common words
    shared: DataFrame  # (token, p) of every word, in the shared restaurant
    unseen: float  # p of a word never seen there
    contexts: DataFrame  # (before, spread, customers): the weight of the shared restaurant after each word
    pairs: DataFrame  # (key, log_p) of all pairs met but those of two classes


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document) of the words and one end of each text, in order."""
    words = Words(texts)
    ends = words.first[1:]
    hashes = np.insert(words.hash, ends, END)
    document = np.insert(words.document(), ends, np.arange(len(texts)))
    return hashes, document


def _training(batch: pa.RecordBatch) -> list[bytes]:
    ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    return encoded([t for i, t in zip(ids, texts) if crc_fold(i, FOLDS) != HELD_OUT], lower=True)


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, c) over the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _training(batch)
            found = [_tokens(texts[a:b])[0] for a, b in chunks(texts)]
            if found:
                token, c = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(c.astype(np.int64))], ["token", "c"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "token bigint, c bigint")
    return rows.groupBy("token").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    tokens, words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    end = int(END.view(np.int64))
    often = counts.filter((F.col("c") >= max(1.0, CLASS_SHARE * tokens)) | (F.col("token") == end)).toPandas()
    if end not in set(often["token"]):
        often = pd.concat([often, pd.DataFrame({"token": [end], "c": [0]})])
    hashes = often["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Vocabulary(int(tokens), int(words), hashes[order], often["c"].to_numpy(dtype=np.int64)[order])


def _classes(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, len(known))


def _before(values: np.ndarray, document: np.ndarray, end) -> np.ndarray:
    """What is before each token; before the first one of a text, the end of a text."""
    before = np.concatenate((np.array([end], dtype=values.dtype), values[:-1]))
    before[np.flatnonzero(np.diff(document, prepend=-1))] = end
    return before


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one, number) of each distinct combination of keys, sorted, the first key last."""
    order = np.lexsort(keys)
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    start = np.flatnonzero(new)
    return order[start], np.diff(np.append(start, len(order)))


PAIRS = "before bigint, token bigint, n bigint"


def pair_counts(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """(before, token, n) of every two words in a row over the training documents."""
    classes, size = known.classes, known.other

    def packed(before: np.ndarray, token: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        arrays = [before.view(np.int64), token.view(np.int64), n.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["before", "token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            texts = _training(batch)
            for a, b in chunks(texts):
                token, document = _tokens(texts[a:b])
                before = _before(token, document, END)
                own = _classes(token, classes)
                above = _before(own, document, int(np.searchsorted(classes, END)))
                hot = (own < size) & (above < size)
                keys, n = np.unique(above[hot] * size + own[hot], return_counts=True)
                sums[keys] += n
                before, token = before[~hot], token[~hot]
                one, n = _runs(token, before)
                yield packed(before[one], token[one], n)
        used = np.flatnonzero(sums)
        yield packed(classes[used // size], classes[used % size], sums[used])

    rows = docs.select("doc_id", "text").mapInArrow(run, PAIRS)
    return rows.groupBy("before", "token").agg(F.sum("n").alias("n"))


def seat(customers: np.ndarray, parent: np.ndarray, tables: float | np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables that each dish's customers take when they are seated again, given the tables of the sweep before:
    those of one restaurant that holds all these dishes, or those of each dish's own restaurant.

    A customer opens a table in proportion to (strength + discount * tables) * parent, or joins one in
    proportion to its dish's customers less discount * its dish's tables.
    """
    out = (customers > 0).astype(np.int64)
    if np.ndim(tables) == 0:
        tables = np.full(len(customers), max(tables, np.count_nonzero(customers)) if len(customers) > 1 else tables)
    active = np.flatnonzero(customers > 1)
    seated = np.ones(len(customers), dtype=np.int64)
    while len(active):
        n, t = seated[active], out[active]
        opening = (STRENGTH + discount * np.maximum(tables[active], t)) * parent[active]
        batch = np.minimum(np.maximum(1, (n * BATCH).astype(np.int64)), customers[active] - n)
        opened = random.binomial(batch, opening / (opening + n - discount * t))
        out[active] += opened
        seated[active] += batch
        active = active[seated[active] < customers[active]]
    return out


def discount_of(singles: float, doubles: float) -> float:
    return float(np.clip(singles / max(1.0, singles + 2 * doubles), 0.1, 0.9))


def _key(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The hash of a pair: that of the word before, turned, with that of the word."""
    return (before << np.uint64(57) | before >> np.uint64(7)) ^ token


def _key_column():
    """The same of signed columns."""
    before = F.col("before")
    return F.shiftleft(before, 57).bitwiseOR(F.shiftrightunsigned(before, 7)).bitwiseXOR(F.col("token"))


def _looked_up(rows: DataFrame, key: str, table: DataFrame, known: DataFrame, how: str = "inner") -> DataFrame:
    """`rows` with the columns of `table` of their key: those of known words from every task's copy, the rest by a join."""
    known = F.broadcast(known.withColumnRenamed("token", key))
    near = rows.join(F.broadcast(table.join(known, key, "left_semi")), key)
    far = rows.join(known, key, "left_anti").join(table, key, how)
    if how == "left":  # known words that the table lacks
        lacking = F.broadcast(known.join(table, key, "left_anti"))
        near = near.unionByName(rows.join(lacking, key, "left_semi"), allowMissingColumns=True)
    return near.unionByName(far)


def _seated(rows: DataFrame, discount: float, seed: int, sweep: int) -> DataFrame:
    """(before, token, n, t, kept) of rows with p and tables: t tables in this sweep, `kept` over the kept ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                before, token, n, kept, p, tables = (np.asarray(c) for c in batch.columns)
                random = np.random.default_rng((seed, sweep, len(n), int(before[0]) & 0xFFFFFFFF, int(token[0]) & 0xFFFFFFFF))
                t = seat(n.astype(np.int64), p, tables, discount, random)
                columns = [before, token, n, t, kept + (t if sweep >= BURN else 0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["before", "token", "n", "t", "kept"])

    return rows.select("before", "token", "n", "kept", "p", "tables").mapInArrow(run, f"{PAIRS}, t bigint, kept bigint")


def _shared(words: DataFrame, tables: float, size: int, seed: int, sweep: int) -> tuple[DataFrame, float, float]:
    """((token, p) of the shared restaurant, whose customers are `words`, p of a word never seen, its tables)."""
    one, two, customers = words.agg(
        F.count_if(F.col("customers") == 1), F.count_if(F.col("customers") == 2), F.coalesce(F.sum("customers"), F.lit(0))).first()
    discount, uniform = discount_of(one, two), 1.0 / size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                token, c = (np.asarray(x).astype(np.int64) for x in batch.columns)
                random = np.random.default_rng((seed, sweep, len(c), int(token[0]) & 0xFFFFFFFF))
                t = seat(c, np.full(len(c), uniform), np.full(len(c), float(tables)), discount, random)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(t)], ["token", "customers", "t"])

    found = materialize(words.select("token", "customers").mapInArrow(run, "token bigint, customers bigint, t bigint"))
    total = found.agg(F.coalesce(F.sum("t"), F.lit(0))).first()[0]
    unseen = (STRENGTH + discount * total) * uniform / (STRENGTH + customers)
    return found.select("token", ((F.col("customers") - discount * F.col("t")) / (STRENGTH + customers) + unseen).alias("p")), unseen, total


def fit(docs: DataFrame, seed: int = 0) -> Model:
    counts = materialize(token_counts(docs))
    known = vocabulary(counts)
    spark = docs.sparkSession
    classes = spark.createDataFrame([(int(t),) for t in known.classes.view(np.int64)], "token bigint")
    words = counts.join(F.broadcast(classes), "token", "left_anti")
    # at most 1 / COMMON_SHARE rows, whatever the corpus
    common = words.filter(F.col("c") >= max(2.0, COMMON_SHARE * known.tokens)).toPandas()
    met = counts.filter(F.col("c") >= max(2.0, COMMON_SHARE * known.tokens)).select("token").unionByName(classes).distinct()
    met = materialize(met)
    pairs = materialize(pair_counts(docs, known))

    # a dish with one customer has one table in every sweep: only its number is needed
    one, two = pairs.agg(F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    discount, size = discount_of(one, two), known.words + 1
    contexts = materialize(pairs.groupBy("before").agg(F.sum("n").alias("customers"), F.count(F.lit(1)).alias("dishes")))
    after = materialize(pairs.groupBy("token").agg(F.count(F.lit(1)).alias("contexts")))
    rows = pairs.filter("n > 1").withColumn("kept", F.lit(0).cast("bigint"))
    tables = contexts.select("before", F.col("dishes").cast("double").alias("tables"))
    shared = after.select("token", F.lit(1.0 / size).alias("p"))
    total, history = float(known.words), []
    for sweep in range(BURN + KEPT):
        placed = _looked_up(_looked_up(rows, "token", shared, met), "before", tables, met)
        rows = materialize(_seated(placed, discount, seed, sweep))
        more = rows.groupBy("before").agg(F.sum(F.col("t") - 1).alias("more"))
        tables = contexts.join(more, "before", "left").select("before", (F.col("dishes") + F.coalesce("more", F.lit(0))).cast("double").alias("tables"))
        more = rows.groupBy("token").agg(F.sum(F.col("t") - 1).alias("more"))
        customers = materialize(after.join(more, "token", "left").select("token", (F.col("contexts") + F.coalesce("more", F.lit(0))).alias("customers")))
        shared, unseen, total = _shared(customers, total, size, seed, sweep)
        if sweep >= BURN:
            history.append((shared, unseen))

    means = history[0][0]
    for k, (table, _) in enumerate(history[1:]):
        means = means.join(table.withColumnRenamed("p", f"p{k}"), "token").select("token", (F.col("p") + F.col(f"p{k}")).alias("p"))
    means = materialize(means.select("token", (F.col("p") / KEPT).alias("p")))
    unseen = float(np.mean([u for _, u in history]))
    more = rows.groupBy("before").agg((F.sum(F.col("kept") - KEPT) / KEPT).alias("more"))
    spread = (STRENGTH + discount * (F.col("dishes") + F.coalesce("more", F.lit(0.0)))) / (STRENGTH + F.col("customers"))
    contexts = materialize(contexts.join(more, "before", "left").select("before", spread.alias("spread"), "customers"))

    single = pairs.filter("n = 1").select("before", "token", "n", F.lit(KEPT).cast("bigint").alias("kept"))
    whole = _looked_up(_looked_up(single.unionByName(rows.select("before", "token", "n", "kept")), "token", means, met), "before", contexts, met)
    p = (F.col("n") - discount * F.col("kept") / KEPT) / (STRENGTH + F.col("customers")) + F.col("spread") * F.col("p")
    of_classes = F.broadcast(classes.withColumn("is_class", F.lit(True)))
    whole = whole.join(of_classes, "token", "left").withColumnRenamed("is_class", "own").join(
        of_classes.withColumnRenamed("token", "before"), "before", "left")
    both = F.col("own") & F.col("is_class")
    whole = materialize(whole.select(
        _key_column().alias("key"), F.log10(p).alias("log_p"), F.when(both, F.col("before")).alias("before"), F.when(both, F.col("token")).alias("token")))

    pair, other = _matrix(
        known, whole.filter("before is not null").select("before", "token", "log_p").toPandas(),
        contexts.join(F.broadcast(classes.withColumnRenamed("token", "before")), "before", "left_semi").select("before", "spread").toPandas(),
        means.join(F.broadcast(classes), "token", "left_semi").toPandas(), unseen)
    # for every word of `other`, its share of what classes leave in the shared restaurant
    scored = materialize(words.join(means, "token").select("token", "c", F.log10(F.col("p") / other).alias("log_p")))
    hashes = common["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Model(known, pair, hashes[order], common["c"].to_numpy(dtype=np.int64)[order], float(np.log10(unseen / other)), scored,
                 met, means, unseen, contexts, whole.filter("before is null").select("key", "log_p"))


def _matrix(known: Vocabulary, pairs: pd.DataFrame, contexts: pd.DataFrame, shared: pd.DataFrame, unseen: float) -> tuple[np.ndarray, float]:
    """(log10 p(class | class before), p of all other words in the shared restaurant)."""

    def at(tokens: pd.Series) -> np.ndarray:
        return np.searchsorted(known.classes, tokens.to_numpy(dtype=np.int64).view(np.uint64))

    size = known.other
    own, spread = np.full(size, unseen), np.ones(size + 1)
    own[at(shared["token"])] = shared["p"]
    spread[at(contexts["before"])] = contexts["spread"]
    p = np.empty((size + 1, size + 1))
    p[:, :size] = spread[:, None] * own
    p[at(pairs["before"]), at(pairs["token"])] = 10.0 ** pairs["log_p"].to_numpy(dtype=float)
    p[:, size] = np.maximum(1 - p[:, :size].sum(axis=1), np.finfo(float).tiny)
    return np.log10(p), float(p[size, size])


PARTIAL = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
    "rare array<struct<token:bigint,n:bigint>>, pairs array<struct<key:bigint,before:bigint,token:bigint,n:bigint>>"
)


def _partial(docs: DataFrame, model: Model, fitted: bool) -> DataFrame:
    """Sums over what tasks know, and the others as lists of distinct tokens, and pairs, per document."""
    known = model.vocabulary
    pair, common = model.pair, model.common
    floor = np.log10(known.tokens + known.words + 1)
    class_base = np.append(np.log10(known.class_counts + 1.0) - floor, 0.0)
    class_known = np.append(known.class_counts > 0, False)
    common_base = np.log10(model.common_counts + 1.0) - floor
    end, other, classes = int(np.searchsorted(known.classes, END)), known.other, known.classes
    rare_kind = pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))
    pair_kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("key", "before", "token", "n")]))

    def sums(texts: list[bytes]) -> tuple[list[np.ndarray], tuple, tuple]:
        hashes, document = _tokens(texts)
        n = len(texts)
        own = _classes(hashes, classes)
        above = _before(own, document, end)
        joined = (own == other) | (above == other)
        score = np.where(joined, 0.0, pair[above, own])
        base, is_known = class_base[own], class_known[own]
        rest = np.flatnonzero(own == other)
        if len(common):
            at = np.minimum(np.searchsorted(common, hashes[rest]), len(common) - 1)
            found = common[at] == hashes[rest]
            base[rest[found]] = common_base[at[found]]
            is_known[rest[found]] = True
            rest = rest[~found]
        one, times = _runs(hashes[rest], document[rest])
        rare = document[rest][one], hashes[rest][one], times
        before = _before(hashes, document, END)
        before, token, place = before[joined], hashes[joined], document[joined]
        one, times = _runs(token, before, place)
        pairs = place[one], before[one], token[one], times
        return [np.bincount(document, weights=w, minlength=n) for w in (np.ones(len(document)), is_known, base, score)], rare, pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), encoded(batch.column(1).to_pylist(), lower=True)
            for a, b in chunks(texts):
                (tokens, n_known, base, score), (of_rare, rare, rare_n), (of_pair, before, token, n) = sums(texts[a:b])
                held = np.array([crc_fold(i, FOLDS) == HELD_OUT for i in ids[a:b]], dtype=bool)
                places = np.arange(b - a + 1)
                met = ~held[of_pair] if fitted else np.zeros(len(of_pair), dtype=bool)  # whose words nothing needs
                rares = pa.StructArray.from_arrays([pa.array(rare.view(np.int64)), pa.array(rare_n.astype(np.int64))], ["token", "n"])
                pairs = pa.StructArray.from_arrays([
                    pa.array(_key(before, token).view(np.int64)), pa.array(before.view(np.int64), mask=met),
                    pa.array(token.view(np.int64), mask=met), pa.array(n.astype(np.int64))], ["key", "before", "token", "n"])
                arrays = [
                    pa.array(np.arange(row, row + b - a)), pa.array(ids[a:b], pa.int64()), pa.array(held), pa.array(tokens.astype(np.int64)),
                    pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(of_rare, places).astype(np.int32)), rares).cast(rare_kind),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(of_pair, places).astype(np.int32)), pairs).cast(pair_kind),
                ]
                row += b - a
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PARTIAL.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, PARTIAL)


def _pair_scores(part: DataFrame, model: Model) -> DataFrame:
    """(row, more_score): the sum over the pairs that are joined."""
    pairs = part.select("row", F.explode("pairs").alias("r")).select("row", "r.key", "r.before", "r.token", "r.n")
    met = pairs.filter("before is null").select("row", "key", "n", F.lit(None).cast("double").alias("backoff"))
    perhaps = pairs.filter("before is not null")
    perhaps = _looked_up(perhaps, "token", model.shared, model.known, "left")
    perhaps = _looked_up(perhaps, "before", model.contexts.select("before", "spread"), model.known, "left")
    backoff = F.log10(F.coalesce("spread", F.lit(1.0)) * F.coalesce("p", F.lit(model.unseen)))
    found = met.unionByName(perhaps.select("row", "key", "n", backoff.alias("backoff"))).join(model.pairs, "key", "left")
    unmet = F.raise_error(F.lit("A training row holds two words in a row that the model was not fitted on.")).cast("double")
    return found.groupBy("row").agg(F.sum(F.col("n") * F.coalesce("log_p", "backoff", unmet)).alias("more_score"))


def score(docs: DataFrame, model: Model, fitted: bool = True) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every whole text.

    `fitted`: these are the documents the model was fitted on, so all pairs of the training rows are known to it.
    """
    known = model.vocabulary
    floor = F.lit(float(np.log10(known.tokens + known.words + 1)))
    part = materialize(_partial(docs, model, fitted))  # written, so that row numbers are the same for all readers
    rare = part.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n").join(model.words, "token", "left")
    seen = F.col("c").isNotNull()
    sums = rare.groupBy("row").agg(
        F.sum(F.when(seen, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 1.0) - floor)).alias("more_base"),
    )
    whole = part.drop("rare", "pairs").join(sums, "row", "left").join(_pair_scores(part, model), "row", "left")
    nothing = F.lit(0.0)
    total = (F.col("score") + F.coalesce("more_score", nothing))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"), (F.col("base_score") + F.coalesce("more_base", nothing)).alias("base_score"),
        total.alias("score"), F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )
