"""Mixing sources to target weights: which documents to take, and how often.

A source's target is met by subset sums over lengths: whole passes over the source first, then
a random share of the documents of each length, then a bounded knapsack over the words that
are still missing. Which documents of a length are taken follows from a seeded hash of the id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.naming import unused
from cardwarden.llm.ordering import with_running_totals
from cardwarden.llm.storage import stored

#: Weights of the sources in the order of their names, again from the first after the last.
WEIGHTS = (3, 1, 2)
#: Words to take as a share of all words.
SHARE = 1.5
#: A document is taken so many times at most.
MOST = 2
#: The documents of one source and length are ranked in so many parts, so that no task ranks many copies alone.
PARTS = 4096
#: The knapsack looks at budgets up to so many words (more if a document is longer).
WINDOW = 1 << 14


def word_count(text: Column) -> Column:
    """Number of runs of other than white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _name(source: Column) -> Column:
    """Text that tells sources apart, also null from others, and is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows (source, source_size), one for each source.

    The budget is ``share`` of all words, dealt by weight. A target stops at ``most`` times the
    source's size, and what is cut goes to the others by weight until none is above. With the
    sources in the order in which they reach their limit, the final words per weight are the
    largest value that (budget - limits before) / (weights left) takes.
    """
    numbered = with_running_totals(sizes.withColumn("_one", F.lit(1).cast("bigint")), [F.col("source").asc_nulls_last()], {"_index": "_one"})
    place = F.col("_index") % len(weights) + 1
    weighed = numbered.withColumns({"_weight": F.element_at(F.array(*map(F.lit, weights)), place.cast("int")).cast("bigint"), "_limit": F.col("source_size") * most})
    ranked = stored(with_running_totals(weighed, [F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last()], {"_limits": "_limit", "_weights": "_weight"}), "sources")
    whole = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * share, F.sum("_weight")).first()
    rate = ranked.agg(F.max((F.lit(float(whole[0])) - F.col("_limits")) / (F.lit(int(whole[1] or 0)) - F.col("_weights")))).first()[0]
    target = F.least(F.col("_limit").cast("double"), F.lit(float(rate or 0.0)) * F.col("_weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def fitted_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each distinct positive length to take so that their words come nearest to the budget.

    Each length first gives its share, rounded at random. Then documents go or come in random
    order until less is missing than any that is left, and some more go, so that the knapsack
    has room. It sets a bit for every sum that the free documents reach, and notes the step
    that reached it first, which is all that is needed to walk back from the best sum.
    """
    total = int((lengths * counts).sum())
    if budget >= total or total == 0:
        return counts.copy()
    if budget <= 0:
        return np.zeros_like(counts)
    draw = np.random.default_rng(seed)
    share = counts * (budget / total)
    taken = np.minimum(counts, np.floor(share + draw.random(len(counts))).astype(np.int64))
    order = draw.permutation(len(lengths))
    missing = budget - int((lengths * taken).sum())
    for i in order:  # give back
        if missing >= 0:
            break
        n = min(int(taken[i]), -(missing // int(lengths[i])))
        taken[i] -= n
        missing += n * int(lengths[i])
    for i in order:  # fill up
        n = min(int(counts[i] - taken[i]), missing // int(lengths[i]))
        taken[i] += n
        missing -= n * int(lengths[i])
    for i in order[::-1]:  # make room
        if missing >= WINDOW:
            break
        n = min(int(taken[i]), -(-(WINDOW - missing) // int(lengths[i])), 4)
        taken[i] -= n
        missing += n * int(lengths[i])
    return taken + _knapsack(lengths, counts - taken, missing)


def _knapsack(lengths: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """Counts, at most ``free``, whose words come nearest to the budget; the smaller of two equally near sums."""
    top = 2 * budget  # a sum beyond is farther off than none at all
    mask, reached, steps = (1 << (top + 1)) - 1, 1, []
    first = np.full(top + 1, -1, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        length, left, piece = int(lengths[i]), min(int(free[i]), top // int(lengths[i])), 1
        while left > 0:
            n = min(piece, left)
            new = (reached << (n * length)) & mask & ~reached
            if new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little")
                first[np.flatnonzero(bits)] = len(steps)
                reached |= new
            steps.append((i, n))
            left, piece = left - n, piece * 2
        if reached >> budget & 1:
            break
    sums = np.flatnonzero(np.unpackbits(np.frombuffer(reached.to_bytes(top // 8 + 1, "little"), np.uint8), bitorder="little"))
    at = int(sums[np.argmin(np.abs(sums - budget))])
    out = np.zeros_like(free)
    while at > 0:
        i, n = steps[first[at]]
        out[i] += n
        at -= n * int(lengths[i])
    return out


def _length_plan(rows: pd.DataFrame) -> pd.DataFrame:
    """For the lengths of one source: copies that each document gives, and how many give one more."""
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    base = int(target // size) if size else 0
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    more = np.zeros_like(counts)
    solid = lengths > 0
    more[solid] = fitted_counts(lengths[solid], counts[solid], round(target - base * size), int(rows["seed"].iloc[0]))
    return pd.DataFrame({"source": rows["source"], "size": lengths, "base": base, "more": more, "source_size": size, "target": target})


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 11) -> DataFrame:
    """The documents' columns and ``mix``, a struct of size, source_size, target and copies.

    ``docs`` has doc_id, source and text; an extra column of the name ``mix`` is replaced, others
    are kept. A null or blank text has no words; it counts as often as the whole passes over
    its source say. A null source is a source like any other, the last in order. Rows with the
    same id are ranked like others; which of two equal rows is taken can't be told. An empty
    table stays empty. ``share`` may not exceed ``most``.

    Shuffled are (source, length, part) with their counts, and the rows once, by these keys,
    with the columns that the caller reads.
    """
    if not 0 <= share <= most:
        raise ValueError("share must lie between 0 and most")
    size, mark, part, name = unused(docs, "_size", "_mark", "_part", "_name")
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"))
    keyed = docs.drop("mix").withColumns(
        {size: word_count(F.col("text")), mark: hashed, part: F.pmod(F.shiftrightunsigned(hashed, 20), F.lit(PARTS)).cast("int"), name: _name(F.col("source"))}
    )
    parts = stored(keyed.groupBy("source", F.col(size).alias("size"), F.col(part).alias("part")).agg(F.count("*").alias("n")), "lengths")
    lengths = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most)
    sized = lengths.join(targets, lengths["source"].eqNullSafe(targets["source"])).select(lengths["*"], "source_size", "target")
    plan = stored(
        sized.withColumn("seed", F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 31)))
        .groupBy("source")
        .applyInPandas(
            lambda rows: _length_plan(rows.sort_values("size", ignore_index=True)),
            "source string, size bigint, base bigint, more bigint, source_size bigint, target double",
        ),
        "length-plan",
    )
    earlier = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    p, q = parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("p"), plan.alias("q")
    quotas = stored(
        p.join(q, F.expr("p.source <=> q.source and p.size = q.size")).select(
            _name(F.col("p.source")).alias(name),
            F.col("p.size").alias(size),
            F.col("p.part").alias(part),
            F.struct(F.col("p.size").alias("size"), "source_size", "target").alias("mix"),
            "base",
            (F.col("more") - F.col("before")).alias("quota"),
        ),
        "quotas",
    ).select(name, size, part, F.struct("mix.*", "base", "quota").alias("mix"))
    keys = [name, size, part]  # none is null, so that one shuffle serves both the join and the ranks
    found = keyed.join(quotas, keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(mark, "doc_id"))
    copies = F.col("mix.base") + (rank <= F.col("mix.quota")).cast("bigint")
    return found.select(*[c for c in docs.columns if c != "mix"], F.struct("mix.size", "mix.source_size", "mix.target", copies.alias("copies")).alias("mix"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    taken = mix(docs, **options)
    (again,) = unused(taken, "_again")
    numbers = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("mix.copies")))
    return taken.where("mix.copies > 0").withColumn(again, numbers).select(*docs.columns)
