"""Exact quantiles and order statistics without unbounded aggregation state.

Spark's exact `percentile` keeps every distinct value in one reducer. Here a
mergeable sketch first brackets each wanted rank; a second pass counts the rows
below the bracket and groups the few values inside it. Both passes combine on the
map side, so a hot value or a hot group never reaches one task row by row. Where the
bracket is too wide to list, or missed its rank, it is narrowed round by round.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.session import cut_counted, cut_lineage, one_row

# At n rows the bracket holds about 4n / SKETCH_ACCURACY of them; groups up to
# SMALL_GROUP rows need no bracket.
SKETCH_ACCURACY = 10_000
SMALL_GROUP = 100_000
BROADCAST_GROUPS = 20_000
# Brackets of up to FEW rows are listed by one task; wider ones are narrowed first, by about GRID / 3 a round.
FEW = 100_000
GRID = 256


def listed_up_to(accuracy: int) -> float:
    """Rows of a group whose first bracket is expected to hold FEW."""
    return max(FEW * accuracy / 4, SMALL_GROUP)


def order_statistics(
    df: DataFrame,
    value: str,
    targets: Sequence[tuple[str, float, Callable[[Column], Column]]],
    by: Sequence[str] = (),
    accuracy: int = SKETCH_ACCURACY,
    max_groups: int | None = None,
) -> DataFrame:
    """Interpolated order statistics of `value` per group.

    Each target is (name, p, rank): `rank(n)` gives the wanted 0-based, possibly
    fractional rank among the n non-null values, and p is that rank as a share of
    n, used only to place the bracket. Result: `by` columns, `n`, one double per
    target.

    The per-group brackets are broadcast when there are provably few: `max_groups`
    is the caller's bound by construction (labels, columns); without it they are
    checkpointed and counted, and beyond the limit joined by an ordinary join.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    inf = F.lit(float("inf"))
    eps = 2.0 / accuracy
    probs = [q for _, p, _ in targets for q in (max(p - eps, 0.0), min(p + eps, 1.0))]
    sketch = rows.groupBy(*by).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", probs, accuracy).alias("_q"),
    )
    if by:
        small = F.col("_n") <= SMALL_GROUP
        specs = F.array(*[
            F.struct(
                F.lit(i).alias("_t"),
                rank(F.col("_n")).cast("double").alias("_h"),
                F.when(small | F.lit(p - eps <= 0.0), -inf).otherwise(F.col("_q")[2 * i]).alias("_lo"),
                F.when(small | F.lit(p + eps >= 1.0), inf).otherwise(F.col("_q")[2 * i + 1]).alias("_hi"),
            )
            for i, (_, p, rank) in enumerate(targets)
        ])
        wanted = cut_lineage(sketch.select(*by, "_n", specs.alias("_specs")))
        wide_targets = wanted.filter(F.col("_n") > listed_up_to(accuracy)).select(*by, "_n", F.inline("_specs")).drop("_lo", "_hi")
        wide = not wide_targets.isEmpty()
        wanted = wanted.filter(F.col("_n") <= listed_up_to(accuracy))
        keyed = rows
        for c in by:
            keyed = keyed.withColumnRenamed(c, f"_k_{c}")
        cond = [F.col(f"_k_{c}").eqNullSafe(F.col(c)) for c in by]
        if max_groups is None:
            few = wanted.count() <= BROADCAST_GROUPS
        else:
            few = max_groups <= BROADCAST_GROUPS
        joined = keyed.join(F.broadcast(wanted) if few else wanted, cond)
    else:
        found = one_row(sketch)
        n, q = found["_n"], found["_q"]
        whole = n <= SMALL_GROUP
        specs = F.array(*[
            F.struct(
                F.lit(i).alias("_t"),
                rank(F.lit(n)).cast("double").alias("_h"),
                (-inf if whole or p - eps <= 0.0 else F.lit(q[2 * i])).alias("_lo"),
                (inf if whole or p + eps >= 1.0 else F.lit(q[2 * i + 1])).alias("_hi"),
            )
            for i, (_, p, rank) in enumerate(targets)
        ])
        wide = n > listed_up_to(accuracy)
        wide_targets = rows.sparkSession.range(1).select(F.lit(n).alias("_n"), specs.alias("_specs")).select("_n", F.inline("_specs")).drop("_lo", "_hi")
        joined = rows.select("_v", F.lit(n).alias("_n"), specs.alias("_specs"))
        if wide:
            joined = joined.filter(F.lit(False))
    inside = F.col("_v") >= F.col("_s._lo")
    counted = (
        joined.select(*by, "_n", "_v", F.explode("_specs").alias("_s"))
        .filter(F.col("_v") <= F.col("_s._hi"))
        .select(*by, "_n", F.col("_s._t").alias("_t"), F.col("_s._h").alias("_h"),
                inside.alias("_in"), F.when(inside, F.col("_v")).alias("_v"))
        .groupBy(*by, "_n", "_t", "_h", "_in", "_v").agg(F.count(F.lit(1)).alias("_c"))
    )
    w = Window.partitionBy(*by, "_t").orderBy("_in", "_v")
    running = counted.withColumn("_cum", F.sum("_c").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    below = F.coalesce(F.max(F.when(~F.col("_in"), F.col("_c"))), F.lit(0))
    k = F.floor("_h")
    picked = running.groupBy(*by, "_n", "_t", "_h").agg(
        below.alias("_below"),
        F.min(F.when(F.col("_in") & (F.col("_cum") > k), F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_in") & (F.col("_cum") > F.ceil("_h")), F.col("_v"))).alias("_b"),
    )
    missed = (F.col("_below") > k) | F.col("_a").isNull() | F.col("_b").isNull()
    answer = F.when(~missed, F.col("_a") + (F.col("_h") - k) * (F.col("_b") - F.col("_a")))
    answered, n_open = cut_counted(picked.select(*by, "_n", "_t", "_h", answer.alias("_x")), F.count_if(F.col("_x").isNull() & (F.col("_n") > 0)))
    if wide:
        answered = answered.unionByName(wide_targets.select(*by, "_n", "_t", "_h", F.lit(None).cast("double").alias("_x")))
    if wide or n_open:
        solved = narrowed(rows, answered.filter("_x IS NULL AND _n > 0").drop("_x"), by, accuracy)
        answered = answered.filter("_x IS NOT NULL OR _n = 0").unionByName(solved)
    out = answered.groupBy(*by).agg(
        F.max("_n").alias("n"),
        *[F.max(F.when(F.col("_t") == i, F.col("_x"))).alias(name) for i, (name, _, _) in enumerate(targets)],
    )
    return out


def narrowed(rows: DataFrame, todo: DataFrame, by: Sequence[str], accuracy: int) -> DataFrame:
    """(by, _n, _t, _h, _x): exact order statistics by repeated bracketing, for groups of any size and any sketch.

    Every round counts, for each wanted rank, the values below, at and above the two ends of its bracket, which settles in which part the
    rank lies whatever the sketch said, and sketches the parts for the next, narrower bracket. The ends themselves drop out of it, so it
    shrinks even where values repeat. Brackets of at most FEW rows are then listed.
    """
    by, grid = list(by), [i / GRID for i in range(GRID + 1)]
    keys = [*by, "_one"]
    rows = rows.withColumn("_one", F.lit(0)).withColumnsRenamed({c: f"_k_{c}" for c in keys})
    ranks = F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h"))))
    nothing = F.lit(None).cast("double")
    asked = ["_n", "_t", "_h", "_k"]
    state = todo.withColumn("_one", F.lit(0)).select(*keys, "_n", "_t", "_h", ranks.alias("_k")).withColumns({
        "_from": nothing, "_to": nothing, "_base": F.lit(0).cast("long"), "_lo": nothing, "_hi": nothing, "_x": nothing, "_m": F.col("_n").cast("long")})
    state, left = cut_counted(state, F.count(F.lit(1)))

    def met(wanted: DataFrame) -> DataFrame:
        """Rows inside the open bracket of each wanted rank of their group."""
        few = wanted.count() <= BROADCAST_GROUPS
        cond = [F.col(f"_k_{c}").eqNullSafe(F.col(c)) for c in keys]
        inside = (F.col("_from").isNull() | (F.col("_v") > F.col("_from"))) & (F.col("_to").isNull() | (F.col("_v") < F.col("_to")))
        return rows.join(F.broadcast(wanted) if few else wanted, cond).filter(inside)

    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    finished = None
    while left:
        wide = state.filter((F.col("_x").isNull()) & (F.col("_m") > FEW))
        still = state.filter((F.col("_x").isNotNull()) | (F.col("_m") <= FEW))
        finished = still if finished is None else finished.unionByName(still)
        inner = lo.isNull() | ((v > lo) & (v < hi))
        seen = met(wide).groupBy(*keys, *asked, "_from", "_to", "_base", "_lo", "_hi").agg(
            F.count_if(v < lo).alias("a"), F.count_if(v <= lo).alias("b"), F.count_if(lo.isNull() | (v < hi)).alias("c"),
            F.count_if(lo.isNull() | (v <= hi)).alias("d"), F.count(F.lit(1)).alias("e"),
            F.percentile_approx(F.when(v < lo, v), grid, accuracy).alias("q0"), F.percentile_approx(F.when(inner, v), grid, accuracy).alias("q1"),
            F.percentile_approx(F.when(v > hi, v), grid, accuracy).alias("q2"))
        r = F.col("_k") - F.col("_base")

        def part(low: str, high: str, below: Column, size: Column, sketch: str) -> Column:
            slot = F.floor((r - below) / size * GRID).cast("int")
            q = F.col(sketch)
            return F.struct(F.col(low).alias("_from"), F.col(high).alias("_to"), (F.col("_base") + below).alias("_base"),
                            F.get(q, F.greatest(slot - 1, F.lit(0))).alias("_lo"), F.get(q, F.least(slot + 2, F.lit(GRID))).alias("_hi"),
                            nothing.alias("_x"), size.alias("_m"))

        def value(c: Column) -> Column:
            return F.struct(nothing.alias("_from"), nothing.alias("_to"), F.col("_base").alias("_base"), nothing.alias("_lo"), nothing.alias("_hi"),
                            c.alias("_x"), F.lit(0).cast("long").alias("_m"))

        zero = F.lit(0).cast("long")
        step = (F.when(r < F.col("a"), part("_from", "_lo", zero, F.col("a"), "q0")).when(r < F.col("b"), value(lo))
                .when(lo.isNull(), part("_from", "_to", zero, F.col("c"), "q1"))
                .when(r < F.col("c"), part("_lo", "_hi", F.col("b"), F.col("c") - F.col("b"), "q1")).when(r < F.col("d"), value(hi))
                .otherwise(part("_hi", "_to", F.col("d"), F.col("e") - F.col("d"), "q2")))
        state, left = cut_counted(seen.select(*keys, *asked, step.alias("s")).select(*keys, *asked, "s.*"),
                                  F.count_if(F.col("_x").isNull() & (F.col("_m") > FEW)))
    finished = state if finished is None else finished.unionByName(state)
    short = cut_lineage(finished.filter("_x IS NULL"))
    listed = met(short).groupBy(*keys, *asked, "_base", "_v").agg(F.count(F.lit(1)).alias("_c"))
    # At most FEW rows per rank.
    w = Window.partitionBy(*keys, *asked).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    picked = (listed.withColumn("_cum", F.sum("_c").over(w)).filter(F.col("_cum") > F.col("_k") - F.col("_base"))
              .groupBy(*keys, *asked).agg(F.min("_v").alias("_x")))
    found = finished.filter("_x IS NOT NULL").select(*keys, *asked, "_x").unionByName(picked)
    k = F.floor("_h")
    return found.groupBy(*by, "_n", "_t", "_h").agg(F.max(F.when(F.col("_k") == k, F.col("_x"))).alias("_a"),
                                                    F.max(F.when(F.col("_k") == F.ceil("_h"), F.col("_x"))).alias("_b")).select(
        *by, "_n", "_t", "_h", (F.col("_a") + (F.col("_h") - k) * (F.col("_b") - F.col("_a"))).alias("_x"))


def linear_rank(p: float) -> Callable[[Column], Column]:
    """Rank of the linearly interpolated p-quantile."""
    return lambda n: (n - 1) * F.lit(float(p))


def quantiles(df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (),
              accuracy: int = SKETCH_ACCURACY, max_groups: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles, one column per name in `probs`."""
    targets = [(name, p, linear_rank(p)) for name, p in probs.items()]
    return order_statistics(df, value, targets, by, accuracy, max_groups)


def column_quantiles(df: DataFrame, columns: Sequence[str], p: float = 0.5) -> DataFrame:
    """One row with the exact p-quantile of each column, from one pair of passes."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("double").alias("_x")) for c in columns])
    long = df.select(F.inline(pairs))
    per = quantiles(long, "_x", {"_m": p}, by=["_name"], max_groups=len(columns))
    return per.agg(*[F.max(F.when(F.col("_name") == c, F.col("_m"))).alias(c) for c in columns])
