"""Mixing sources to target weights by entropy balancing.

Every document gets a rate between 0 and `cap` that stays as close to 1 as the token constraint of its source
allows (relative entropy). The solution is an exponential tilt: rate = cap / (1 + (cap - 1) * e) with
e = exp(-dual * size / mean size), which stays finite for every size. One dual per source solves the convex dual; Newton steps run on Spark for all
sources at once, over how many documents each (source, size) has. Rates become whole copies by a hash of the
document, with one rounding threshold per source that brings its words nearest to the target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogway.sources.staging import stage

# Fixed values of the mixture: weights of the sources in code-point order, and the largest repetition.
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
NEWTON_STEPS = 100
TOLERANCE = 1e-9
_BINS = 4096
_SEEDS = 8


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """`source, source_size, mean_size, target` from rows of (source, size).

    The weights repeat over the sources by code point, NULL last. A target above `cap` times its source's size
    stops there and the excess is shared again by weight: all targets are min(cap * size, level * weight).
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.avg(F.when(F.col("size") > 0, F.col("size"))).alias("mean_size")
    )
    ranked = totals.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("n") % len(weights) + 1).cast("int"))
    ratio = F.lit(cap) * F.col("source_size") / F.col("weight")
    by_ratio = Window.orderBy("ratio", "n")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("weight", weight)
        .withColumn("ratio", ratio)
        .withColumn("all", F.sum("source_size").over(everything))
        .withColumn(
            "level",
            (F.col("all") - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0.0)))
            / F.sum("weight").over(onward),
        )
    )
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "n", "level"))).over(everything)
    target = F.least(cap * F.col("source_size"), F.coalesce(level["level"], F.lit(0.0)) * F.col("weight"))
    return levels.select(
        "source", "source_size", F.coalesce("mean_size", F.lit(1.0)).alias("mean_size"), target.alias("target")
    )


def _rate(cap: float) -> Column:
    """The tilted rate; an unreachable target (no words wanted, or all that the cap allows) takes the limit."""
    tilted = cap / (1 + (cap - 1) * F.exp(-F.col("dual") * F.col("size") / F.col("mean_size")))
    return (
        F.when(F.col("target") >= cap * (1 - 1e-9) * F.col("source_size"), F.lit(cap))
        .when(F.col("target") <= 0, F.lit(0.0))
        .otherwise(tilted)
    )


def solve_duals(counts: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """`targets` with `dual`: Newton's method, falling back to halving the bracket where a step leaves it.

    `counts` has (source, size, n). A step is one join and one aggregation over it. The bracket reaches as far as the
    rates of the smallest documents of a source change; a source that is not solved after `NEWTON_STEPS` raises.
    """
    smallest = counts.groupBy(F.col("source").alias("c_source")).agg(F.min("size").alias("smallest"))
    reach = F.coalesce(F.lit(750.0) * F.col("mean_size") / F.col("smallest"), F.lit(1.0))
    state = targets.join(smallest, F.col("source").eqNullSafe(F.col("c_source")), "left").select(
        *targets.columns, F.lit(0.0).alias("dual"), (-reach).alias("lo"), reach.alias("hi")
    )
    state = stage(state, "duals")
    names = ["source", "source_size", "mean_size", "target", "dual", "lo", "hi"]
    x = F.col("size") / F.col("mean_size")
    slope = _rate(cap) * (cap - _rate(cap)) / cap * x
    open_ = (F.col("target") > 0) & (F.col("target") < cap * (1 - 1e-9) * F.col("source_size"))
    for _ in range(NEWTON_STEPS):
        joined = counts.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        sums = joined.groupBy(*(F.col(f"s.{n}").alias(n) for n in names)).agg(
            F.sum(F.col("n") * F.col("size") * _rate(cap)).alias("got"),
            F.sum(F.col("n") * F.col("size") * slope).alias("slope"),
        )
        over = F.col("got") > F.col("target")
        step = F.col("dual") - (F.col("got") - F.col("target")) / F.col("slope")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("dual")), F.when(over, F.col("dual")).otherwise(F.col("hi"))
        moved = F.when((F.col("slope") > 1e-12) & (step > lo) & (step < hi), step).otherwise((lo + hi) / 2)
        off = open_ & (F.abs(F.col("got") - F.col("target")) > TOLERANCE * F.col("target")) & (hi - lo > 1e-12 * F.abs(hi))
        state = stage(
            sums.select(
                "source", "source_size", "mean_size", "target",
                F.when(off, moved).otherwise(F.col("dual")).alias("dual"), lo.alias("lo"), hi.alias("hi"), off.alias("off"),
            ),
            "duals",
        )
        if state.where("off").isEmpty():
            break
        state = state.drop("off")
    else:
        raise RuntimeError(f"the mixture did not converge in {NEWTON_STEPS} steps")
    return state.select("source", "source_size", "mean_size", "target", "dual")


def _draw() -> Column:
    """A number in [0, 1) that depends on the document and the column `seed` alone, less its rate's fraction."""
    u = F.shiftrightunsigned(F.xxhash64("doc_id", "size", "seed"), 11) / F.lit(float(1 << 53))
    return u - (F.col("rate") - F.floor("rate"))


def _with_params(rows: DataFrame, params: DataFrame) -> DataFrame:
    p = params.withColumnRenamed("source", "p_source")
    return rows.join(p, F.col("source").eqNullSafe(F.col("p_source")), "left").drop("p_source")


def mixture(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """One row per source: `source, source_size, mean_size, target, dual, seed, threshold` from (doc_id, source, size).

    The threshold shifts the rounding of all documents of a source alike, to the end of that of 4096 bins
    where the words taken come nearest to the target, under the best of eight seeds of the draw.
    """
    counts = stage(sizes.where(F.col("size") > 0).groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "size-counts")
    targets = stage(source_targets(sizes, weights, cap), "targets")
    solved = solve_duals(counts, targets, cap)
    solved = targets.alias("t").join(solved.alias("d"), F.col("t.source").eqNullSafe(F.col("d.source")), "left").select(
        "t.*", F.coalesce("d.dual", F.lit(0.0)).alias("dual")
    )
    solved = stage(solved, "duals")
    rated = _with_params(sizes, solved).withColumn("rate", _rate(cap))
    rated = rated.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(_SEEDS - 1)))).withColumn("draw", _draw())
    bins = rated.groupBy("source", "seed", "target", F.floor((F.col("draw") + 1) * (_BINS / 2)).alias("bin")).agg(
        F.sum(F.col("size") * F.floor("rate")).alias("sure"),
        F.sum(F.when(F.floor("rate") < cap, F.col("size")).otherwise(0)).alias("more"),
    )
    so_far = Window.partitionBy("source", "seed").orderBy("bin")
    all_bins = Window.partitionBy("source", "seed")
    taken = F.sum("sure").over(all_bins) + F.sum("more").over(so_far)
    none = F.sum("sure").over(all_bins)
    edges = bins.select(
        "source", "seed", ((F.col("bin") + 1) / (_BINS / 2) - 1).alias("edge"), F.abs(taken - F.col("target")).alias("miss"),
        F.abs(none - F.col("target")).alias("without"),
    )
    best = edges.groupBy("source").agg(
        F.min(F.struct("miss", "edge", "seed")).alias("best"), F.min("without").alias("without")
    ).select("source", "best.seed", F.when(F.col("without") < F.col("best.miss"), -1.0).otherwise(F.col("best.edge")).alias("threshold"))
    return stage(
        solved.alias("t").join(best.alias("b"), F.col("t.source").eqNullSafe(F.col("b.source")), "left").select(
            "t.*", F.coalesce("b.seed", F.lit(0)).alias("seed"), F.coalesce("b.threshold", F.lit(0.0)).alias("threshold")
        ),
        "mixture",
    )


def with_copies(rows: DataFrame, params: DataFrame, cap: float = CAP) -> DataFrame:
    """`rows` (doc_id, source, size, ...) with `source_size, target, rate, copies`; NULL doc_ids draw alike."""
    up = (F.col("draw") < F.col("threshold")).cast("long")
    copies = F.least(F.lit(int(cap)).cast("long"), F.floor("rate") + up)
    return (
        _with_params(rows, params)
        .withColumn("rate", _rate(cap))
        .withColumn("draw", _draw())
        .withColumn("copies", copies)
        .drop("draw", "dual", "mean_size", "seed", "threshold")
    )


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """`doc_id, source, size, source_size, target, rate, copies, taken` for every row of `docs`.

    Sizes are words, 0 for NULL texts. A NULL source is a source of its own. Reruns and row order do not
    matter; repeated rows draw alike. Empty documents and sources take 0 words. No rows give no rows.
    """
    sizes = stage(sized(docs), "sizes")
    out = with_copies(sizes, mixture(sizes, weights, cap), cap)
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def repeat_by_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The rows of `docs`, each as often as its copies say; columns as given, texts are not shuffled.

    Repeated rows and NULL doc_ids of a source and size draw alike, so all of them get the same copies. No rows give none.
    """
    params = mixture(stage(sized(docs), "sizes"), weights, cap)
    whole = docs.select(
        F.struct(*docs.columns).alias("whole"), F.col("doc_id").cast("long").alias("doc_id"), "source",
        word_count(F.col("text")).alias("size"),
    )
    rated = with_copies(whole, params, cap).where(F.col("copies") > 0)
    return rated.select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("whole.*")
