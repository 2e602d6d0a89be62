"""Exact, linearly interpolated quantiles in two passes over the input.

The first pass sketches all columns at once and gives two brackets per
quantile, a little below and a little above its rank; a write can take them
along (``bracket_measures`` in ``observe``), and then there is no first pass.
The second pass, also one for all quantiles, only counts the values outside
the brackets and keeps the few inside by value; ranks follow from the counts,
so the brackets decide the work and never the result. Should a rank fall
outside its brackets, ten times further off than the sketch allows, the query
fails instead of guessing. A task sees the values inside one quantile's
brackets at most, 2 * MARGIN of all."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks of the sketch are off by n / ACCURACY at most; brackets are ten times as far.
ACCURACY = 10_000
MARGIN = 10 / ACCURACY

#: name -> (column, share)
Shares = Mapping[str, tuple[str | Column, float]]


def _value(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def bracket_measures(shares: Shares, where: Column | None = None) -> dict[str, Column]:
    """An aggregate per quantile: the array of its two brackets (NULL without values)."""
    def one(column, share: float) -> Column:
        v = _value(column) if where is None else F.when(where, _value(column))
        return F.percentile_approx(v, [max(share - MARGIN, 0.0), min(share + MARGIN, 1.0)], ACCURACY)

    return {name: one(*wanted) for name, wanted in shares.items()}


def column_quantiles(df: DataFrame, shares: Shares, brackets: Mapping[str, list | None] | None = None) -> Column:
    """One struct (a scalar subquery) with a field per name: the value of the
    column at rank ``1 + (n - 1) * share``, interpolated between its two
    neighbours. NULLs are left out; without values a field is NULL.
    ``brackets`` are those that a write of ``df`` observed."""
    names = list(shares)
    if brackets is None:
        sketch = df.agg(F.struct(*[m.alias(n) for n, m in bracket_measures(shares).items()])).scalar()
        ends = {n: (sketch[n][0], sketch[n][1]) for n in names}
    else:
        ends = {n: tuple(F.lit(e).cast("double") for e in (brackets.get(n) or (None, None))) for n in names}

    def row(k: int, name: str) -> Column:
        column, share = shares[name]
        v, (low, high) = _value(column), ends[name]
        # the extremes themselves bracket ranks at the ends
        part = F.when(v < low, 0 if share > MARGIN else 1).when(v > high, 2 if share < 1 - MARGIN else 1).otherwise(1)
        return F.struct(F.lit(k).alias("k"), F.when(v.isNotNull(), part).alias("part"), F.when(part == 1, v).alias("v"), v.alias("any"))

    # without brackets (no values when they were taken) every value lies inside
    held = df.select(F.inline(F.array(*[row(k, n) for k, n in enumerate(names)]))).where("part IS NOT NULL")
    # outside, the value next to the bracket is kept: the neighbour of a rank at the bracket itself
    counts = held.groupBy("k", "part", "v").agg(F.count(F.lit(1)).alias("n"), F.min("any").alias("least"), F.max("any").alias("most"))
    upward = Window.partitionBy("k").orderBy("part", "v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({"upto": F.sum("n").over(upward), "everything": F.sum("n").over(Window.partitionBy("k"))})

    def result(k: int, share: float) -> Column:
        rank = (F.col("everything") - 1) * F.lit(float(share))
        own = F.col("k") == k

        def at(place: Column) -> Column:
            hit = own & (F.col("upto") - F.col("n") <= place) & (place < F.col("upto"))
            value = (F.when(F.col("part") == 1, F.col("v")).when((F.col("part") == 0) & (place == F.col("upto") - 1), F.col("most"))
                     .when((F.col("part") == 2) & (place == F.col("upto") - F.col("n")), F.col("least"))
                     .otherwise(F.raise_error(F.lit("a rank lies outside its brackets")).cast("double")))
            return F.max(F.when(hit, value))

        low, high = at(F.floor(rank)), at(F.ceil(rank))
        return low + (high - low) * F.max(F.when(own, rank - F.floor(rank)))

    return ranked.agg(F.struct(*[result(k, shares[n][1]).alias(n) for k, n in enumerate(names)])).scalar()


def quantiles(df: DataFrame, value: str | Column, **shares: float) -> Column:
    """``column_quantiles`` of one column: a field per share."""
    return column_quantiles(df, {name: (value, share) for name, share in shares.items()})


def median(df: DataFrame, value: str | Column) -> Column:
    return quantiles(df, value, median=0.5)["median"]
