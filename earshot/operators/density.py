"""Gaussian kernel density of a numeric column, as violin plots draw it.

Every step works on (value, count) pairs, and their shuffle is shared by all steps.
Quartiles are refined in two passes, each of which joins the pairs with the at most four
groups that the one before it left, so the plan grows by one use of the pairs a pass. The
one row of range and bandwidth enters as a scalar subquery, the only one. A value meets
the grid points at which its kernel is not zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID_POINTS = 512
# A double's sign, exponent and first bits of its fraction make its bin: relative width
# 1/256, zero alone, and at most 2 x 2048 x 256 bins whatever the values are.
_BINS_PER_DOUBLING = 256
# Slices of a bin that holds a wanted rank; about 2^-24 of the value's size each.
_SLICES = 65536
# Beyond this many bandwidths a double's kernel is zero.
_REACH = 40


def value_counts(values: DataFrame, column: str) -> DataFrame:
    """Distinct finite values `v` and how often each occurs, `n`."""
    present = values.select(F.col(column).cast("double").alias("v"))
    return present.filter("abs(v) < double('infinity')").groupBy("v").agg(
        F.count(F.lit(1)).alias("n")
    )


def _binned(pairs: DataFrame) -> DataFrame:
    """Pairs with a bin that rises with the value, and their distance from its edge.

    Bins are relative to the value's size, so values that crowd near zero fall into as
    many bins as others. The bin follows from the value alone, so no pass for the range
    comes first. It is declared present, or the join on it would filter one use of the
    pairs and compute them anew.
    """
    rate = _BINS_PER_DOUBLING
    # Doublings are counted from the smallest double, so all non-zero bins have a sign.
    bin_of = f"CAST(signum(v) * (1 + floor((log2(abs(v)) + 1075) * {rate})) AS BIGINT)"
    edge = f"signum(bin) * pow(2D, (abs(bin) - 1) / {rate}D - 1075)"
    return pairs.selectExpr("v", "n", f"IF(v = 0, 0L, coalesce({bin_of}, 0L)) AS bin").selectExpr(
        "*", f"IF(bin = 0, 0D, {edge}) AS edge"
    )


# Each quartile lies between two neighbouring ranks; past the last rank the neighbour
# has no weight, so the last one stands in.
_LOW, _HIGH = "(total - 1) * 0.25D", "(total - 1) * 0.75D"
_RANKS = [
    f"least(floor({rank}) + {step}, total - 1)" for rank in (_LOW, _HIGH) for step in (0, 1)
]
_HIT = " OR ".join(f"(before <= {r} AND {r} < before + inside)" for r in _RANKS)


# What a group hands on to the next pass beside its place.
_FACTS = ["total", "least", "most", "squares"]
_SLICE = (
    "IF(bin_hi > bin_lo, CAST(least(floor("
    f"(v / 2 - bin_lo / 2) / (bin_hi / 2 - bin_lo / 2) * {_SLICES}), {_SLICES - 1}) AS INT), 0)"
)


def _hit_bins(binned: DataFrame) -> DataFrame:
    """The at most four bins that hold a wanted rank, each with the facts of all pairs.

    Windows over everything see bins only, whose number is bounded. Squared deviations
    are summed around each bin's edge and then moved to the mean.
    """
    return (
        binned.groupBy("bin", "edge")
        .agg(
            F.expr("sum(n)").alias("inside"),
            F.expr("sum(n * (v - edge))").alias("s1"),
            F.expr("sum(n * pow(v - edge, 2))").alias("s2"),
            F.expr("min(v)").alias("bin_lo"),
            F.expr("max(v)").alias("bin_hi"),
        )
        .selectExpr(
            "*",
            "sum(inside) OVER (ORDER BY bin) - inside AS before",
            "sum(inside) OVER () AS total",
            "sum(inside * edge + s1) OVER () / sum(inside) OVER () AS mean",
            "min(bin_lo) OVER () AS least",
            "max(bin_hi) OVER () AS most",
        )
        .selectExpr(
            "bin AS hit_bin",
            "inside",
            "before",
            "bin_lo",
            "bin_hi",
            "total",
            "least",
            "most",
            "sum(s2 + 2 * (edge - mean) * s1 + inside * pow(edge - mean, 2)) OVER () AS squares",
        )
        .filter(_HIT)
    )


def _hit_slices(binned: DataFrame, bins: DataFrame) -> DataFrame:
    """The at most four slices of those bins that hold a wanted rank."""
    fine = binned.join(F.broadcast(bins), binned.bin == bins.hit_bin).selectExpr(
        "hit_bin", "n", "before AS bin_before", "bin_lo", "bin_hi", *_FACTS, f"{_SLICE} AS slice"
    )
    # At most four bins of a bounded number of slices are in this window.
    sums = fine.groupBy("hit_bin", "slice").agg(
        F.expr("sum(n)").alias("inside"),
        *[F.min(name).alias(name) for name in ("bin_before", "bin_lo", "bin_hi", *_FACTS)],
    )
    before = "bin_before + sum(inside) OVER (PARTITION BY hit_bin ORDER BY slice) - inside"
    return sums.selectExpr("*", f"{before} AS before").filter(_HIT)


def summary(pairs: DataFrame) -> DataFrame:
    """One row: `lo`, `hi`, `total`, `sd` and the interpolated quartiles `q1`, `q3`.

    Exact without ranking all values in one task: the pairs are counted into bins, those
    of the at most four bins that hold a wanted rank into slices, and only what is in the
    at most four slices that hold one is ranked.
    """
    binned = _binned(pairs)
    hit = _hit_slices(binned, _hit_bins(binned))
    last = binned.join(F.broadcast(hit.drop("inside", "bin_before")), binned.bin == hit.hit_bin)
    ranked = last.filter(f"{_SLICE} = slice").selectExpr(
        "*", "before + sum(n) OVER (PARTITION BY hit_bin, slice ORDER BY v) - n AS start"
    )
    values = [
        f"max(IF(start <= {r} AND {r} < start + n, v, NULL)) AS x{i}"
        for i, r in enumerate(_RANKS)
    ]
    facts = [F.min(name).alias(name) for name in _FACTS]
    return (
        ranked.agg(*map(F.expr, values), *facts)
        .filter("total IS NOT NULL")
        .selectExpr(
            "least AS lo",
            "most AS hi",
            "total",
            "IF(least = most, 0D, sqrt(greatest(squares, 0D) / nullif(total - 1, 0))) AS sd",
            f"x0 + ({_LOW} - floor({_LOW})) * (x1 - x0) AS q1",
            f"x2 + ({_HIGH} - floor({_HIGH})) * (x3 - x2) AS q3",
        )
    )


def bandwidth(pairs: DataFrame) -> DataFrame:
    """One row: `lo`, `hi`, `total` and the rule-of-thumb bandwidth `h`.

    The spread is the smaller of standard deviation and IQR / 1.34. If that is zero
    the deviation is used, then the size of the value itself, then 1. Fewer than two
    values have no bandwidth.
    """
    narrow = "least(sd, (q3 - q1) / 1.34D)"
    spread = f"coalesce(nullif({narrow}, 0), nullif(sd, 0), nullif(abs(lo), 0), 1)"
    h = f"IF(total > 1, 0.9D * {spread} * pow(total, -0.2D), NULL) AS h"
    return summary(pairs).selectExpr("lo", "hi", "total", h)


def density(values: DataFrame, column: str, points: int = GRID_POINTS) -> DataFrame:
    """Density of `column` at `points` equally spaced positions between its extremes.

    Missing and infinite values are left out; fewer than two values give no rows. The result has
    the position's number `point`, its place `x` and the density `density`, in no
    particular order.
    """
    pairs = value_counts(values, column)
    band = bandwidth(pairs).selectExpr("struct(*)").scalar().alias("b")
    # The least value meets every point, so that none is without a row.
    step = f"nullif(b.hi - b.lo, 0) / {float(points - 1)}D"
    first = f"ceil((v - b.lo - {_REACH} * b.h) / ({step}))"
    last = f"floor((v - b.lo + {_REACH} * b.h) / ({step}))"
    near = [
        f"CAST(IF(v = b.lo, 0, greatest(0, coalesce({first}, 0))) AS INT) AS first",
        f"CAST(IF(v = b.lo, {points - 1}, least({points - 1}, coalesce({last}, {points}))) AS INT) AS last",
    ]
    # Each task sums its own values per position, so `points` rows per task are shuffled.
    return (
        pairs.select("v", "n", band)
        .selectExpr("v", "n", "b", *near)
        .selectExpr("v", "n", "b", "explode(sequence(first, greatest(first, last))) AS point")
        .selectExpr(
            "v",
            "n",
            "point",
            f"b.lo + point * (b.hi - b.lo) / {float(points - 1)}D AS x",
            "b.h AS h",
            "sqrt(2 * pi()) * b.total * b.h AS area",
        )
        .groupBy("point")
        .agg(
            F.min("x").alias("x"),
            F.expr("sum(n * exp(-0.5D * pow((x - v) / h, 2))) / min(area)").alias("density"),
        )
        .filter("density IS NOT NULL")
    )
