"""Mixing sources to target weights by Pareto order sampling.

Targets. Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share a budget of
words. A target never exceeds ``cap`` times the words of its source; the excess is shared again by
weight among the others until none is above. That fixed point is target = min(cap * size,
level * weight), and the level comes from one running sum over the sources in order of
cap * size / weight.

Sampling. A document of a source with ratio r = target / size takes floor(r) certain whole copies, which
leaves words open. For one more copy, document i has the inclusion probability f_i = min(1, c * priority_i),
with c such that the expected words, the sum of f_i * size_i, are the open ones; documents with f_i = 1 are
certain. Documents are ranked by random odds over inclusion odds, (U / (1 - U)) / (f_i / (1 - f_i)), with U drawn
from a hash of seed, id and text, so reruns agree. Without ``priority`` f_i is the open share of the source, and
documents of different sources have different odds. The sample is of fixed size in words: the prefix of the
ranking whose words come nearest to the open ones (off by at most half of one document).

c is found like the level of the targets: words and priority-weighted words are summed by source and by steps of
the priority (64 to a doubling), and the steps become certain from the highest on until c times the highest of the
others is at most 1.

The prefix is found without sorting a source: ranks fall into ``rank_bins`` bins, the words of each
(source, bin) are summed with map-side combine, and only the one bin in which the prefix ends is
ordered row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, cut


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: float = 3.0, share: float = 1.0) -> DataFrame:
    """(src, source_size) -> the same and ``target``; one row per source, src null for rows without one."""
    by_name = Window.orderBy(F.col("src").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighed = sizes.withColumn("weight", F.get(w, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    weighed = weighed.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("src").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = (F.sum("source_size").over(all_rows) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    rest = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the first source in this order that stays below its cap has the highest of the levels that hold
    level = F.max(F.when(F.col("most") > F.col("level_here") * F.col("weight"), F.col("level_here"))).over(all_rows)
    return (
        weighed.withColumn("level_here", left / rest)
        .withColumn("level", level)
        .select("src", "source_size", F.coalesce(F.least("most", F.col("level") * F.col("weight")), "most").alias("target"))
    )


def inclusion_scale(steps: DataFrame) -> DataFrame:
    """(src, step, words, weighed, most, open): the sums of one step of priorities, its largest priority and the
    source's open words -> (src, scale), the c of the module's text. Few steps to a source: at most the doublings
    between the smallest and the largest priority times 64."""
    down = Window.partitionBy("src").orderBy(F.col("step").desc())
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weighed").over(Window.partitionBy("src").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    c = F.when((rest > 0) & (F.col("open") > above), (F.col("open") - above) / rest).otherwise(F.lit(0.0))
    tried = steps.select("src", "step", "most", c.alias("c"))
    # the highest step that holds; where no step holds, everything that is open is certain
    return tried.groupBy("src").agg(
        F.coalesce(F.max_by("c", F.when(F.col("c") * F.col("most") <= 1, F.col("step"))), F.max("c")).alias("scale"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (1, 2, 3),
    cap: float = 3.0, share: float = 1.0, seed: int = 42, rank_bins: int = 4096, priority: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id_col``, ``keep``, size, source_size, target, copies, taken, inclusion (f_i).

    A null or empty text has size 0 and takes 0 words; a null source is one source of its own.
    Inclusion probabilities are proportional to ``priority`` as long as they are below 1; null, NaN or no column
    means 1, and priorities count as lying between 2 ** -60 and 2 ** 60. Repeated rows are separate documents with
    equal ranks (which of them is taken does not matter, they are equal). An empty table gives an empty result.
    """
    cols = [id_col, *keep]
    t = F.col(f"`{text}`")
    h = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), t)
    p = F.lit(1.0)
    if priority:
        p = F.coalesce(F.nanvl(F.col(f"`{priority}`").cast("double"), F.lit(None)), p)
        p = F.greatest(F.lit(2.0 ** -60), F.least(F.lit(2.0 ** 60), p))
    base = cut(docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(cols)], F.col(f"`{source}`").alias("src"),
        word_count(t).alias("size"), ((F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)).alias("u"),
        p.alias("p")))
    steps = cut(base.groupBy("src", F.floor(F.log2("p") * 64).alias("step")).agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("p")).alias("weighed"), F.max("p").alias("most")))
    targets = source_targets(steps.groupBy("src").agg(F.sum("words").alias("source_size")), weights, cap, share)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(ratio)).withColumn(
        "open", F.col("target") - F.col("whole") * F.col("source_size"))
    opened = targets.select(F.col("src").alias("osrc"), "open")
    scales = inclusion_scale(steps.join(opened, F.col("src").eqNullSafe(F.col("osrc"))))
    named = cut(targets.join(scales.withColumnRenamed("src", "csrc"), F.col("src").eqNullSafe(F.col("csrc"))).drop("csrc"))
    named = named.withColumnRenamed("src", "src2")  # one row per source
    f, u = F.col("f"), F.col("u")
    # rank = q / (1 + q) for the odds ratio q; also right where f is 0 or 1
    ranked = base.join(named.select("src2", "scale"), F.col("src").eqNullSafe(F.col("src2"))).withColumn(
        "f", F.least(F.lit(1.0), F.col("scale") * F.col("p"))).withColumn("rank", u * (1 - f) / (u * (1 - f) + (1 - u) * f))
    certain = F.lit(-1).cast("long")  # a bin of their own, never ordered
    ranked = ranked.withColumn("bin", F.when(f >= 1, certain).otherwise(F.floor(F.least(
        F.col("rank") * rank_bins, F.lit(rank_bins - 1.0))))).drop("src2", "scale")
    sizes = ranked.groupBy("src", "bin").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("src").orderBy("bin")
    bins = (
        sizes.join(named, F.col("src").eqNullSafe(F.col("src2")))
        .withColumn("upto", F.sum("words").over(up_to))
        .select(
            F.col("src").alias("bsrc"), F.col("bin").alias("bbin"), "source_size", "target", "whole",
            (F.col("open") - (F.col("upto") - F.col("words"))).alias("open"), "words",
        )
    )
    rows = ranked.join(bins, F.col("src").eqNullSafe(F.col("bsrc")) & (F.col("bin") == F.col("bbin")))
    ends_here = (F.col("bin") >= 0) & (F.col("open") > 0) & (F.col("open") < F.col("words"))
    clear = rows.filter(~ends_here).withColumn("extra", ((F.col("bin") < 0) | (F.col("open") > 0)).cast("long"))
    order = Window.partitionBy("src").orderBy("rank", "size", "k0").rowsBetween(Window.unboundedPreceding, 0)
    edge = rows.filter(ends_here).withColumn("run", F.sum("size").over(order))
    edge = edge.withColumn("extra", (F.col("run") - F.col("open") <= F.col("open") - (F.col("run") - F.col("size"))).cast("long"))
    out = clear.unionByName(edge.drop("run"))
    return out.withColumn("copies", F.col("whole") + F.col("extra")).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(cols)], "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), f.alias("inclusion"))
