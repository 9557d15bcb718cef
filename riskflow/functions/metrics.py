"""Model and drift metrics as plans over (label, score) or single columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranks


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return a / F.nullif(b, F.lit(0))


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Counts, precision and recall at a threshold; a NULL score predicts 0."""
    predicted, actual = F.coalesce(F.col(score) >= threshold, F.lit(False)), F.col(label) == 1
    n = {"true_positive": predicted & actual, "false_positive": predicted & ~actual, "false_negative": ~predicted & actual, "true_negative": ~predicted & ~actual}
    out = df.agg(*[F.count_if(v).alias(k) for k, v in n.items()], F.count(F.lit(1)).alias("rows_evaluated"))
    tp = F.col("true_positive")
    return out.withColumns({"precision": F.round(ratio(tp, tp + F.col("false_positive")), 4), "recall": F.round(ratio(tp, tp + F.col("false_negative")), 4)})


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """(auc): the rank statistic with average ranks for ties, from counts of distinct scores."""
    by = ranks.running(df.filter(F.col(label).isNotNull()), score, {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)})
    wins = by.withColumn("wins", F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    return wins.agg(F.round(ratio(F.sum("wins"), (F.sum("pos") * F.sum("neg")).cast("double")), 4).alias("auc"))


def psi(df: DataFrame, value: str, in_reference: Column, bins: int = 10) -> DataFrame:
    """(psi) of rows outside the reference against rows inside it: quantile bins of the reference, deduplicated edges, the last
    bin closed, values outside the edges dropped before shares are taken, shares of at least 1e-6; 0 without bins. The edges
    are `bins` + 1 numbers, joined as one row."""
    tagged = df.select(F.col(value).cast("double").alias("v"), in_reference.alias("r")).filter("v is not null")
    edges = ranks.quantiles(tagged.filter("r"), "v", [i / bins for i in range(bins + 1)])
    edges = edges.select(F.array_sort(F.array_distinct(F.transform(F.filter("e", lambda x: x.isNotNull()), lambda x: F.round(x, 6)))).alias("e"))
    b = F.size(F.filter("e", lambda x: x <= F.col("v")))
    binned = tagged.join(F.broadcast(edges)).filter((F.size("e") > 1) & (F.col("v") >= F.get("e", F.lit(0))) & (F.col("v") <= F.get("e", F.size("e") - 1)))
    binned = binned.withColumn("bin", F.least(b, F.size("e") - 1)).groupBy("bin").agg(F.count_if("r").alias("n_r"), F.count_if(~F.col("r")).alias("n_c"))
    totals = binned.agg(F.greatest(F.coalesce(F.sum("n_r"), F.lit(0)), F.lit(1)).alias("t_r"), F.greatest(F.coalesce(F.sum("n_c"), F.lit(0)), F.lit(1)).alias("t_c"))
    grid = edges.select(F.explode_outer(F.when(F.size("e") > 1, F.sequence(F.lit(1), F.size("e") - 1))).alias("bin"))
    rows = grid.join(binned, "bin", "left").join(F.broadcast(totals))
    r, c = (F.greatest(F.coalesce(F.col(f"n_{k}"), F.lit(0)) / F.col(f"t_{k}"), F.lit(1e-6)) for k in "rc")
    term = F.when(F.col("bin").isNotNull(), (c - r) * F.log(c / r))
    return rows.agg(F.round(F.coalesce(F.sum(term), F.lit(0.0)), 4).alias("psi"))


def nearest_rank(df: DataFrame, value: str, shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Nearest-rank percentiles, halves rounded to the even rank, and the maximum."""
    return ranks.at_ranks(df, value, {f"p{round(s * 100)}": ranks.nearest(s) for s in shares})
