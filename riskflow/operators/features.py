"""Time-range features, peer benchmarks, point-in-time joins, and the marts built from them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR, MONTH = 3600, 30 * 24 * 3600
FLOOR = "1900-01-01 00:00:00"


def _range(keys: list[str], seconds: int):
    return Window.partitionBy(*keys).orderBy("_sec").rangeBetween(-seconds, 0)


def _safe_z(value: Column, mean: Column, std: Column) -> Column:
    return F.when(std > 0, (value - mean) / std).otherwise(F.lit(0.0))


def rolling(df: DataFrame, key: str = "customer_id", at: str = "txn_ts", value: str = "amount", span: int = 6 * MONTH) -> DataFrame:
    """Count of the last hour, mean and deviation of the last 30 days, z-score, velocity. One shuffle and one sort serve all.

    A window sees one key's rows of one span of time and, as a halo, of the 30 days before it, so no task holds a key's whole
    history; halo rows are dropped again.
    """
    v = F.col(value).cast("double")
    df = df.withColumn("_sec", F.unix_timestamp(F.col(at).cast("timestamp")))
    own, late = F.floor(F.col("_sec") / span), F.floor((F.col("_sec") + MONTH) / span)
    df = df.withColumns({"_own": own, "_span": F.explode(F.when(late > own, F.array(own, late)).otherwise(F.array(own)))})
    month = _range([key, "_span"], MONTH)
    df = df.withColumns({"txn_count_1h": F.count(F.lit(1)).over(_range([key, "_span"], HOUR)), "amount_mean_30d": F.avg(v).over(month), "amount_std_30d": F.stddev_samp(v).over(month)})
    df = df.filter(F.col("_own").eqNullSafe(F.col("_span")))
    return df.withColumns({"amount_zscore_30d": _safe_z(v, F.col("amount_mean_30d"), F.col("amount_std_30d")), "velocity_score": F.col("txn_count_1h").cast("double")}).drop("_sec", "_own", "_span")


def peer_z(df: DataFrame, group: str = "risk_segment", hint: bool = True) -> DataFrame:
    """Deviation from the group's mean in standard deviations; 0 for a group of NULL. One row for each group is broadcast."""
    v = F.col("amount").cast("double")
    peer = df.groupBy(F.col(group).alias("_g")).agg(F.avg(v).alias("_m"), F.stddev_samp(v).alias("_s"))
    joined = df.join(F.broadcast(peer) if hint else peer, F.col(group) == F.col("_g"), "left")
    return joined.withColumn("peer_deviation", _safe_z(v, F.col("_m"), F.col("_s"))).drop("_g", "_m", "_s")


def peer_raw(df: DataFrame, group: str = "risk_segment", hint: bool = True) -> DataFrame:
    """Difference from the group's mean; NULL is a group. Aggregated and joined: a window over a few large groups wouldn't spread."""
    v = F.col("amount").cast("double")
    peer = df.groupBy(F.col(group).alias("_g")).agg(F.avg(v).alias("_m"))
    return df.join(F.broadcast(peer) if hint else peer, F.col(group).eqNullSafe(F.col("_g")), "left").withColumn("peer_deviation_raw", v - F.col("_m")).drop("_g", "_m")


def with_current(txns: DataFrame, dimension: DataFrame, hint: bool = False) -> DataFrame:
    live = dimension.filter("is_current").select("customer_id", "risk_segment", "home_country")
    return txns.join(F.broadcast(live) if hint else live, "customer_id", "left")


def gold(txns: DataFrame, dimension: DataFrame, tuned: bool = True) -> DataFrame:
    """The gold features; untuned, the small side of the peer benchmark isn't broadcast by a hint."""
    return peer_z(rolling(with_current(txns, dimension)), hint=tuned)


def staging(silver: DataFrame) -> DataFrame:
    """Rows that passed validation, typed, channel in lower case."""
    return silver.filter("_dq_passed").withColumns({"amount": F.col("amount").cast("decimal(12,2)"), "channel": F.lower("channel")})


def trends(txns: DataFrame, dimension: DataFrame) -> DataFrame:
    """Staged transactions with the live customer version and flags."""
    j = with_current(txns, dimension)
    flags = {"txn_hour": F.hour("txn_ts"), "is_high_value": F.col("amount") >= 10000, "is_cross_border": F.col("home_country").isNotNull() & (F.col("geo_country") != F.col("home_country"))}
    return j.withColumns(flags)


def point_in_time(facts: DataFrame, dimension: DataFrame, at: str = "txn_ts") -> DataFrame:
    """Each fact with the version valid at its time; a customer's first version reaches back to the floor.

    Versions and facts of a customer are sorted by time together and each fact takes the last version before it, so the work
    is linear in both, however many versions a customer has.
    """
    first = F.min("effective_start").over(Window.partitionBy("customer_id"))
    begins = F.when(F.col("effective_start") == first, F.lit(FLOOR).cast("timestamp_ntz")).otherwise(F.col("effective_start"))
    version = F.struct("risk_segment", F.col("effective_start").alias("version_start"), "effective_end")
    versions = dimension.select("customer_id", begins.alias("_at"), version.alias("_v"), F.lit(0).alias("_kind"))
    keep = [F.col(c) for c in facts.columns]
    own = facts.select("customer_id", F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*keep).alias("_f"))
    both = own.unionByName(versions, allowMissingColumns=True)
    seen = F.last("_v", ignorenulls=True).over(Window.partitionBy("customer_id").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_seen", seen).filter("_kind = 1")
    valid = F.col("customer_id").isNotNull() & F.col("_at").isNotNull() & (F.col("_seen.effective_end").isNull() | (F.col("_at") < F.col("_seen.effective_end")))
    return found.select("_f.*", F.when(valid, F.col("_seen.risk_segment")).alias("risk_segment"), F.when(valid, F.col("_seen.version_start")).alias("version_start"))


def risk_score() -> Column:
    """Half the z-score's size in thirds, half the high-value flag, within 0 and 1."""
    high = F.when(F.col("is_high_value"), 1.0).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.5 * F.abs("amount_zscore_30d") / 3.0 + 0.5 * high)), 4)


def mart(trended: DataFrame, dimension: DataFrame) -> DataFrame:
    """The health mart: point-in-time segment, rolling features, raw peer deviation, heuristic score."""
    m = peer_raw(rolling(point_in_time(trended.drop("risk_segment"), dimension)))
    key = F.md5(F.concat("transaction_id", F.lit("|"), F.col("change_ts").cast("string")))
    return m.withColumns({"transaction_health_sk": key, "risk_score": risk_score(), "model_distress_score": F.lit(None).cast("double")})


def incremental(existing: DataFrame, source: DataFrame, build, at: str = "txn_ts") -> DataFrame:
    """existing plus the rows that `build` makes for source rows past the high-water mark. `build` sees 30 days before the first
    new row, so its windows are whole; rows already there are never rewritten. Both marks are read first, so that filters by
    them reach the scan of the source."""
    mark = existing.agg(F.max(at)).first()[0]
    new = source if mark is None else source.filter(F.col(at) > F.lit(mark))
    since = new.agg(F.min(at)).first()[0]
    if since is None:
        return existing
    built = build(source.filter(F.col(at) >= F.lit(since - dt.timedelta(seconds=MONTH))))
    return existing.unionByName((built if mark is None else built.filter(F.col(at) > F.lit(mark))).select(*existing.columns))


def one_hot(df: DataFrame, vocabulary: dict[str, list[str]]) -> DataFrame:
    """A 0/1 column for each listed value; unseen values get 0 everywhere."""
    return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, values in vocabulary.items() for v in values})


def bands(score: Column, n: int = 10) -> Column:
    """Labels of n equal bands of 0 to 1; what fits none - NULL too - falls in the last."""
    labels = [f"{i / n:.1f}-{(i + 1) / n:.1f}" for i in range(n)]
    return reduce(lambda rest, i: F.when(score < (i + 1) / n, labels[i]).otherwise(rest), reversed(range(n - 1)), F.lit(labels[-1]))
