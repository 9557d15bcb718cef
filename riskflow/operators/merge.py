"""Merges as plans: (target, source) -> new target. A source with several rows for one key is an
error when the plan runs, unless the caller says that it has one row for each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(source: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by `order`; a top-1 window that Spark prunes before the shuffle."""
    from pyspark.sql import Window

    return source.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def checked(source: DataFrame, keys: list[str]) -> DataFrame:
    """source; the job fails if a key has several rows. Part of the plan, and grouped by the keys that a merge joins by."""
    rest = [c for c in source.columns if c not in keys]
    message = F.lit(f"several source rows for one key {keys}")
    row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("_one"))
    one = source.groupBy(*keys).agg(F.first(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
    sure = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.lit(True))
    return one.filter(sure).select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in source.columns])


def insert_only(target: DataFrame, source: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """target and the source rows whose key it doesn't have. `unique` says that the source has one row for each key already."""
    source = source if unique else checked(source, keys)
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], keep: list[str] = (), unique: bool = False) -> DataFrame:
    """Source rows, and target rows without one. Columns in `keep` stay as the target has them, NULL for new rows."""
    source = source if unique else checked(source, keys)
    if keep:
        old = target.select(*keys, *keep)
        source = source.drop(*keep).join(old, keys, "left").select(*target.columns)
    return source.unionByName(target.join(source.select(*keys), keys, "left_anti"))


def update_only(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], unique: bool = False) -> DataFrame:
    """Matched rows take the source's columns, NULL included."""
    source = source if unique else checked(source.select(*keys, *columns), keys)
    side = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(side, keys, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def snapshot(live: DataFrame, source: DataFrame, key: str, check: list[str], at: str, hard_deletes: bool = True) -> DataFrame:
    """Check-strategy snapshot: `live` has valid_from and valid_to; changed or vanished rows close, changed and new ones open."""
    now = F.lit(at).cast("timestamp_ntz")
    new = source.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_s_{c}") for c in check])
    both = live.filter("valid_to is null").join(new, F.col(key) == F.col("_k"), "full_outer")
    same = F.lit(True)
    for c in check:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    gone = F.col("_k").isNull()
    closes = F.col(key).isNotNull() & ((gone & F.lit(hard_deletes)) | (~gone & ~same))
    old = both.filter(F.col(key).isNotNull()).select(key, *check, "valid_from", F.when(closes, now).alias("valid_to"))
    opened = both.filter(~gone & (F.col(key).isNull() | ~same)).select(F.col("_k").alias(key), *[F.col(f"_s_{c}").alias(c) for c in check], now.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    out = live.filter("valid_to is not null").select(*old.columns).unionByName(old).unionByName(opened)
    return out.withColumn("scd_id", F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), F.col("valid_from").cast("string"))))
