"""Mixing sources to target weights by fitting budgets with subset sums.

Per source the budget is met by whole copies of every document plus a remainder.  For the
remainder the documents are counted by exact length; counts are taken in proportion, then
from the longest length down while they fit, and a bounded-knapsack dynamic program over
the last, bounded budget picks the lengths that come nearest, above it or below.  Which documents of a length
are taken follows from a seeded digest, so reruns agree.

What reaches one task is a source's table of lengths (one row per distinct length), never
its documents; choosing documents of a length ranks only those in one digest bucket.

Defined cases: null and empty texts have size 0 and are never taken; a null source is a
source of its own, last in the order; null or repeated ids are rows like any other (equal
rows are interchangeable); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetstream.llm.common import words, written

# Weights by order of the sources, repeating; most copies of a document.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Words of budget that the dynamic program fits exactly.
FIT_WORDS = 4096
BUCKETS = 4096


def sized(docs: DataFrame, keep: Sequence[str] = ("doc_id",), seed: int = 0) -> DataFrame:
    """``keep``, source, size in words and a seeded digest per row."""
    return docs.select(
        *keep,
        F.col("source").cast("string").alias("source"),
        F.size(words(F.col("text"))).cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", F.length("text"), F.crc32(F.coalesce("text", F.lit("")))).alias("draw"),
    )


def ordered_weights(totals: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``totals`` (source, source_size) with the weight of each source's place in the order.

    The sources are sorted over partitions; only the partitions' row counts, as many as
    shuffle partitions, come to the driver.
    """
    place = written(
        totals.orderBy(F.col("source").asc_nulls_last()).withColumn(
            "_at", F.monotonically_increasing_id()
        ),
        "mix-sources",
    )
    part = F.shiftright("_at", 33).cast("int")
    sizes = place.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, total = {}, 0
    for row in sorted(sizes):
        before[row["p"]] = total
        total += row["n"]
    start = F.create_map(*(F.lit(x) for p, n in before.items() for x in (p, n))) if before else None
    if start is None:
        return totals.withColumn("weight", F.lit(0.0))
    rank = F.element_at(start, part) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    pick = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    return place.select("source", "source_size", pick.cast("double").alias("weight"))


def targets(totals: DataFrame, budget: int | None = None) -> DataFrame:
    """``source, source_size, target``: shares by weight, none above its cap.

    Sources at their cap are set aside and the rest of the budget is shared again until
    no source is above; each round is one aggregate over the table of sources.
    """
    shares = ordered_weights(totals)
    cap = F.col("source_size") * F.lit(float(MOST_COPIES))
    whole, weight = shares.agg(F.sum("source_size"), F.sum("weight")).first()
    whole = float(budget if budget is not None else whole or 0)
    level = whole / weight if weight else 0.0
    while True:
        above = F.col("weight") * level > cap
        full, free = shares.agg(
            F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if not free:
            break
        higher = (whole - (full or 0.0)) / free
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return shares.select(
        "source", "source_size", F.least(F.col("weight") * F.lit(level), cap).alias("target")
    )


def fitted(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that the sum comes nearest to ``budget``, from either side."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if total <= budget:
        return counts
    order = np.argsort(-lengths, kind="stable")
    take = np.zeros_like(counts)
    # In proportion first, so that every length is represented.
    share = np.floor(counts * (budget / total)).astype(np.int64) if total else counts
    take[:] = share
    left = budget - int((lengths * take).sum())
    for i in order:
        if lengths[i] <= left:
            more = min(counts[i] - take[i], left // lengths[i])
            take[i] += more
            left -= int(more * lengths[i])
    # Give back short documents until the program has a budget worth fitting, and, if the sum is
    # not met, until several of the longest ones could be taken instead.
    for least in (FIT_WORDS, max(FIT_WORDS, 8 * int(lengths.max()))):
        for i in order[::-1]:
            if left >= least:
                break
            if lengths[i] and take[i]:
                back = min(take[i], -(-(least - left) // lengths[i]))
                take[i] -= back
                left += int(back * lengths[i])
        more = knapsack(lengths, counts - take, left)
        if (gap := left - int((lengths * more).sum())) > 1:
            more = knapsack(lengths, counts - take, left, gap - 1)
            gap = abs(left - int((lengths * more).sum()))
        if not gap:
            break
    return take + more


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, over: int = 0) -> np.ndarray:
    """Bounded knapsack: counts per length whose sum is the nearest one to the budget.

    Sums may exceed it by ``over``; without that it is the largest one within.  Reachable sums are the bits of an integer; counts are split into powers of two.
    """
    most = budget + over
    reach, steps, full = 1, [], (1 << (most + 1)) - 1
    for i in np.argsort(lengths, kind="stable"):
        length, left = int(lengths[i]), int(counts[i])
        if not 0 < length <= most:
            continue
        left, many = min(left, most // length), 1
        while left > 0 and not reach >> budget & 1:
            n = min(many, left)
            steps.append((i, n, n * length, reach))
            reach |= reach << n * length & full
            left, many = left - n, many * 2
        if reach >> budget & 1:
            break
    at, above = (reach & (1 << (budget + 1)) - 1).bit_length() - 1, reach >> (budget + 1)
    # The lowest bit above is the nearest sum that exceeds the budget.
    if above and (more := (above & -above).bit_length()) < budget - at:
        at = budget + more
    take = np.zeros(len(lengths), dtype=np.int64)
    for i, n, size, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= size
    return take


def _fit_group(frame):
    import pandas as pd

    budget = int(round(frame["remainder"].iloc[0]))
    take = fitted(frame["size"].to_numpy(), frame["n"].to_numpy(), budget)
    return pd.DataFrame({"skey": frame["skey"], "size": frame["size"], "take": take})


def source_key(source: Column) -> Column:
    """A text that is never null and tells null from every source."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def mixed(docs: DataFrame, keep: Sequence[str] = ("doc_id",), seed: int = 0) -> DataFrame:
    """``keep``, size, source_size, target and ``taken`` (words, repeats counted) per row."""
    rows = written(
        sized(docs, keep, seed).withColumn("skey", source_key(F.col("source"))), "mix-sizes"
    )
    lengths = rows.groupBy("skey", "size").agg(F.count(F.lit(1)).alias("n"))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = written(
        targets(totals).withColumn("skey", source_key(F.col("source"))).select(
            "skey",
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(F.lit(0))
            .cast("bigint")
            .alias("copies"),
        ),
        "mix-targets",
    )
    asked = lengths.join(
        aims.select(
            "skey", (F.col("target") - F.col("copies") * F.col("source_size")).alias("remainder")
        ),
        "skey",
    )
    chosen = written(
        asked.groupBy("skey").applyInPandas(_fit_group, "skey string, size bigint, take bigint"),
        "mix-counts",
    )
    # The seeded choice: whole digest buckets below the one where the count is reached,
    # and a rank only inside that one.
    bucket = F.pmod("draw", F.lit(BUCKETS)).cast("int")
    histogram = rows.select("skey", "size", bucket.alias("bucket")).groupBy("skey", "size", "bucket").count()
    running = Window.partitionBy("skey", "size").orderBy("bucket")
    edges = (
        histogram.withColumn("upto", F.sum("count").over(running))
        .join(chosen, ["skey", "size"])
        .select(
            "skey",
            "size",
            "bucket",
            F.least(
                F.greatest(F.col("take") - (F.col("upto") - F.col("count")), F.lit(0)), F.col("count")
            ).alias("quota"),
            "count",
        )
    )
    marked = rows.withColumn("bucket", bucket).join(edges, ["skey", "size", "bucket"])
    in_part = (F.col("quota") > 0) & (F.col("quota") < F.col("count"))
    rank = F.row_number().over(Window.partitionBy("skey", "size", "bucket").orderBy("draw", *keep))
    sure = marked.where(~in_part).withColumn("extra", (F.col("quota") > 0).cast("int"))
    ranked = marked.where(in_part).withColumn("extra", (rank <= F.col("quota")).cast("int"))
    both = sure.unionByName(ranked)
    return both.join(aims, "skey").select(
        *keep,
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("copies") + F.col("extra"))).alias("taken"),
    )
