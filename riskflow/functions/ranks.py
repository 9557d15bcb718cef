"""Ranks and quantiles over distinct values, without a window or a buffer that holds all of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values are cut into at most so many bands; a window runs inside one band.
BANDS = 128


def running(df: DataFrame, value: str, counts: dict[str, Column]) -> DataFrame:
    """The distinct values with their counts and, as `<name>_upto`, the sums of the counts up to each value; NULL is left out.

    Bands are cut at approximate quantiles: BANDS - 1 numbers reach the driver. What lies in lower bands comes from one row
    for each band.
    """
    rows = df.filter(F.col(value).isNotNull())
    cuts = sorted(set(rows.select(F.col(value).cast("double").alias("v")).approxQuantile("v", [i / BANDS for i in range(1, BANDS)], 0.25 / BANDS)))
    by = rows.groupBy(value).agg(*[c.cast("long").alias(n) for n, c in counts.items()])
    band = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(value).cast("double"))) if cuts else F.lit(0)
    by = by.withColumn("_band", band)
    below = Window.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each band
    base = by.groupBy("_band").agg(*[F.sum(n).alias(f"_{n}") for n in counts]).select("_band", *[F.coalesce(F.sum(f"_{n}").over(below), F.lit(0)).alias(f"_{n}") for n in counts])
    inside = Window.partitionBy("_band").orderBy(value)
    out = by.join(F.broadcast(base), "_band").withColumns({f"{n}_upto": F.sum(n).over(inside) + F.col(f"_{n}") for n in counts})
    return out.drop("_band", *[f"_{n}" for n in counts])


def at_ranks(df: DataFrame, value: str, ranks: dict[str, Column]) -> DataFrame:
    """One row: the value at each rank (from 0, a column of `n`, the number of values), and their maximum."""
    upto = running(df, value, {"c": F.count(F.lit(1))})
    total = upto.agg(F.max("c_upto").alias("n"))
    picks = [F.min(F.when(F.col("c_upto") > rank, F.col(value))).alias(name) for name, rank in ranks.items()]
    return upto.join(F.broadcast(total)).agg(*picks, F.max(value).alias("max"))


def quantiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """(e): the quantiles of the shares, interpolated between neighbouring values; NULLs if there is no value."""
    n = F.col("n")
    at = [F.lit(s) * (n - 1) for s in shares]
    ends = {f"lo{i}": F.floor(x) for i, x in enumerate(at)} | {f"hi{i}": F.ceil(x) for i, x in enumerate(at)}
    rows = df.select(F.col(value).cast("double").alias("_v"))
    found = at_ranks(rows, "_v", ends).crossJoin(rows.agg(F.count("_v").alias("n")))
    part = [x - F.floor(x) for x in at]
    return found.select(F.array(*[F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * p for i, p in enumerate(part)]).alias("e"))


def nearest(share: float) -> Column:
    """The nearest rank of a share, halves to the even one."""
    assert 0 <= share <= 1 and not math.isnan(share)
    return F.bround(F.lit(share) * (F.col("n") - 1))
