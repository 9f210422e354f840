"""Mixing sources to target weights: temperature by bisection, realised as budgeted block permutations.

A source's share of all tokens is raised to an exponent between 0 and 1 and the result is normalised. The
exponent is bisected: to a target entropy of the weights, or to the smallest one that repeats no source
more often than a limit when every document of every source is drawn at least once.

A source draws whole epochs while its budget lasts. An epoch is a permutation of the source's documents:
blocks in hash order, and the documents of a block in hash order. Of the last epoch, the documents are taken
whose tokens begin before the budget ends. Block sums are added up first; only in the block where a budget
ends are single documents put in order, and a block has about BLOCK_ROWS documents, whatever the source's
share. So no source is ever in one task, and the plan moves only ids and token counts, not texts.

A budget that draws every source at least once in whole keeps every document.

Tokens are words. A null source is a source of its own, named by an empty text in the result; a null or empty
text has no tokens and is drawn once in each epoch, at its place. Rows that are equal in id and source are
drawn together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profilespark.functions.clean import quoted
from profilespark.llm.text import free_names
from profilespark.session import materialize

BLOCK_ROWS = 4096
#: sources that are listed, with their weights, in every task; of more, the largest are, and the others are joined
MOST_SOURCES = 100_000
#: no source is repeated more often than this
MOST_EPOCHS = 2.0


@dataclass(frozen=True)
class Mix:
    """Per source: weight and token budget, in order of `sources`."""

    exponent: float
    sources: tuple[str, ...]
    rows: tuple[int, ...]
    tokens: tuple[int, ...]
    weights: tuple[float, ...]
    budgets: tuple[int, ...]


def tempered(shares: np.ndarray, exponent: float) -> np.ndarray:
    """Shares to a power, normalised; an empty source keeps weight 0."""
    powers = np.where(shares > 0, np.power(np.where(shares > 0, shares, 1.0), exponent), 0.0)
    return powers / powers.sum() if powers.sum() else powers


def entropy(weights: np.ndarray) -> float:
    used = weights[weights > 0]
    return float(-(used * np.log(used)).sum())


def most_epochs(shares: np.ndarray, exponent: float) -> float:
    """How often the most repeated source is drawn if the least repeated one is drawn once."""
    ratio = (tempered(shares, exponent) / np.where(shares > 0, shares, 1.0))[shares > 0]
    return float(ratio.max() / ratio.min()) if len(ratio) else 1.0


def bisect(holds, low: float = 0.0, high: float = 1.0, steps: int = 50) -> float:
    """The smallest exponent at which `holds`, which is true at `high` and stays true above where it begins."""
    if holds(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def exponent_for_repeats(shares: np.ndarray, limit: float) -> float:
    return bisect(lambda a: most_epochs(shares, a) <= limit)


def exponent_for_entropy(shares: np.ndarray, target: float) -> float:
    """The exponent whose weights have the target entropy; 1 or 0 if it lies outside what mixing can reach."""
    return bisect(lambda a: entropy(tempered(shares, a)) <= target) if entropy(shares) <= target else 1.0


def plan(counts: list[tuple[str, int, int]], repeats: float | None = MOST_EPOCHS, target_entropy: float | None = None,
         budget: int | None = None) -> Mix:
    """Weights and budgets from (source, rows, tokens). Without `budget`, every source is drawn at least once in whole."""
    counts = sorted(counts)
    tokens = np.array([t for _, _, t in counts], dtype=float)
    if not tokens.sum():
        none = tuple(0 for _ in counts)
        return Mix(1.0, tuple(s for s, _, _ in counts), tuple(r for _, r, _ in counts), none, tuple(0.0 for _ in counts), none)
    shares = tokens / tokens.sum()
    exponent = exponent_for_entropy(shares, target_entropy) if target_entropy is not None else exponent_for_repeats(shares, repeats)
    weights = tempered(shares, exponent)
    used = tokens > 0
    total = float((tokens[used] / weights[used]).max()) if budget is None else float(budget)
    # rounded before ceil, so that a source drawn exactly once isn't drawn one token more
    budgets = tuple(math.ceil(round(w * total, 3)) for w in weights)
    return Mix(exponent, tuple(s for s, _, _ in counts), tuple(r for _, r, _ in counts), tuple(int(t) for t in tokens),
               tuple(float(w) for w in weights), budgets)


def with_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, n_tokens) of every document."""
    words = F.expr(f"regexp_count(coalesce(`{text_col}`, ''), '[^\\\\x20\\\\x09-\\\\x0D]+')")
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"),
                       words.cast("bigint").alias("n_tokens"))


def counts_of(rows: DataFrame) -> list[tuple[str, int, int]] | None:
    """Rows and tokens of each source; None if there are more than MOST_SOURCES, which `wide_plan` is for."""
    found = _sums(rows).limit(MOST_SOURCES + 1).collect()
    return [(r["source"], r["rows"], r["tokens"]) for r in found] if len(found) <= MOST_SOURCES else None


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("tokens"))


def wide_plan(rows: DataFrame, repeats: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The same plan as a table (source, rows, blocks, whole, rest) of any number of sources.

    How often the most repeated source is drawn depends on the smallest and the largest share alone, so the exponent is bisected on
    these two, and one more sum over the sources gives the weights.
    """
    sums = materialize(_sums(rows))
    total, least, most = sums.filter("tokens > 0").agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    if not total:
        return sums.select("source", "rows", F.lit(1).cast("bigint").alias("blocks"), F.lit(1).cast("bigint").alias("whole"), F.lit(0).cast("bigint").alias("rest"))
    ends = np.array([least, most]) / total
    exponent = exponent_for_repeats(ends, repeats)
    power = F.pow(F.col("tokens") / float(total), F.lit(exponent))
    norm = sums.filter("tokens > 0").agg(F.sum(power)).first()[0]
    # of the largest source each document is drawn once: it is repeated the least
    budget = F.ceil(F.round(power / norm * (float(most) / (ends[1] ** exponent / norm)), 3)).cast("bigint")
    drawn = F.col("tokens") > 0
    return sums.select(
        "source", "rows", F.greatest(F.lit(1), F.ceil(F.col("rows") / block_rows)).cast("bigint").alias("blocks"),
        F.when(drawn, F.floor(budget / F.col("tokens"))).otherwise(1).cast("bigint").alias("whole"),
        F.when(drawn, budget % F.col("tokens")).otherwise(0).cast("bigint").alias("rest"),
    )


def _with_plan(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """`rows` with their source's plan: the largest sources', at most MOST_SOURCES, are in every task, and no other one is hot."""
    sources = materialize(sources)
    least = sources.agg(F.sum("rows")).first()[0] / MOST_SOURCES
    large, small = sources.filter(F.col("rows") >= least).drop("rows"), sources.filter(F.col("rows") < least).drop("rows")
    near = rows.join(F.broadcast(large), "source")
    return near.unionByName(rows.join(F.broadcast(large.select("source")), "source", "left_anti").join(small, "source"))


def realise(rows: DataFrame, mix: Mix | DataFrame, block_rows: int = BLOCK_ROWS, seed: int = 0) -> DataFrame:
    """Every drawn (doc_id, source, n_tokens, epoch, block): a document appears once for each epoch that draws it.

    `mix` is a plan, or the table of `wide_plan`. In each block, documents are in the order of `place`, a hash; blocks are in order of their number.
    """
    if isinstance(mix, Mix):
        per_source = []
        for source, n, tokens, budget in zip(mix.sources, mix.rows, mix.tokens, mix.budgets):
            whole, rest = divmod(budget, tokens) if tokens else (1, 0)
            per_source.append((source, max(1, math.ceil(n / block_rows)), int(whole), int(rest)))
        sources = rows.sparkSession.createDataFrame(per_source, "source string, blocks bigint, whole bigint, rest bigint")
        # one row per source, so no larger than the list that the driver made it from
        known = rows.join(F.broadcast(sources), "source")
    else:
        known = _with_plan(rows, mix)
    known = known.withColumn("epoch", F.explode(F.expr("sequence(cast(1 as bigint), whole + if(rest > 0, 1, 0))")))
    known = known.withColumn("place", F.xxhash64(F.lit(seed), "source", "epoch", "doc_id"))
    known = known.withColumn("block", F.pmod(F.shiftright("place", 20), F.col("blocks"))).drop("blocks")
    whole = known.filter("epoch <= whole")
    part = known.filter("epoch > whole")
    sums = part.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    # a row per block; cut the running sum into stretches so that it isn't one task either
    stretch = F.floor(F.col("block") / 1024)
    by_stretch = sums.groupBy("source", stretch.alias("stretch")).agg(F.sum("tokens").alias("tokens"))
    earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    by_stretch = by_stretch.select("source", "stretch", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before_stretch"))
    inside = Window.partitionBy("source", "stretch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("stretch", stretch).withColumn("in_stretch", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    starts = sums.join(by_stretch, ["source", "stretch"]).select(
        "source", "block", "tokens", (F.col("in_stretch") + F.col("before_stretch")).alias("before"))
    part = part.join(starts, ["source", "block"]).filter("before < rest")
    sure = part.filter("before + tokens <= rest")
    # at most one block of each source; one that several epochs end in can't be
    order = Window.partitionBy("source", "block").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = part.filter("before + tokens > rest").withColumn("so_far", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    edge = edge.filter("before + so_far < rest")
    names = ["doc_id", "source", "n_tokens", "epoch", "block", "place"]
    return whole.select(*names).unionByName(sure.select(*names)).unionByName(edge.select(*names))


def mixed(docs: DataFrame, repeats: float = MOST_EPOCHS) -> DataFrame:
    """All draws of the documents, weights from the corpus itself."""
    rows = materialize(with_tokens(docs))  # read by four jobs: words are counted once
    return realise(rows, planned(rows, repeats))


def planned(rows: DataFrame, repeats: float) -> Mix | DataFrame:
    """The plan of few sources as a list, of many as a table."""
    counts = counts_of(rows)
    return wide_plan(rows, repeats) if counts is None else plan(counts, repeats=repeats)


def repeated_rows(docs: DataFrame, repeats: float = MOST_EPOCHS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows, columns unchanged, each as often as the mix draws it, and each at least once.

    Only draws after the first are looked up by id, so a table whose sources all get one epoch isn't shuffled.
    Columns of any name pass through.
    """
    rows = materialize(with_tokens(docs, id_col, text_col, source_col))
    again = realise(rows, planned(rows, repeats)).filter("epoch > 1")
    again = again.groupBy("doc_id", "source", "epoch").agg(F.lit(1).alias("one")).groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("times"))
    own_source, drawn_id, drawn_source, times, copy = free_names(docs.columns, "own_source", "drawn_id", "drawn_source", "times", "copy")
    keyed = docs.withColumn(own_source, F.coalesce(docs[source_col], F.lit("")))
    drawn = again.select(F.col("doc_id").alias(drawn_id), F.col("source").alias(drawn_source), F.col("times").alias(times))
    met = keyed.join(drawn, F.col(quoted(id_col)).eqNullSafe(F.col(drawn_id)) & (F.col(own_source) == F.col(drawn_source)), "left")
    copies = met.withColumn(copy, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(times, F.lit(0).cast("bigint")))))
    return copies.select(*[quoted(c) for c in docs.columns])
