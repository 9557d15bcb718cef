"""The domain relations over the driver's tables: transactions, raw events with defects, a customer change feed, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIDDLE = "2024-01-16 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    return e.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("value") * 100).cast("decimal(12,2)").alias("amount"),
        F.when(F.col("event_type").isin("click", "view"), "ach").when(F.col("event_type").isin("purchase", "signup"), "fednow").otherwise("wire").alias("channel"),
        F.col("ts").alias("txn_ts"),
        F.expr("timestampadd(SECOND, -(k % 91), ts)").alias("change_ts"),
        F.when(k % 20 < 16, "insert").when(k % 20 < 19, "update").otherwise("delete").alias("op_type"),
        (k % 5 == 0).alias("is_new_payee"),
        (k < 3).alias("is_fraud"),
        (k % 25).cast("string").alias("geo_country"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value (JSON text), partition, offset: transactions with one defect by event_id, every 50th row twice."""
    t = transactions(spark, sf_dir).withColumn("id", F.col("transaction_id").cast("bigint")).withColumn("d", F.col("id") % 23)
    d = F.col("d")
    payload = F.to_json(
        F.struct(
            F.when(d != 9, F.col("transaction_id")).alias("transaction_id"),
            F.when(d == 5, F.lit("  ")).otherwise(F.col("customer_id").cast("string")).alias("customer_id"),
            F.when(d == 2, None).when(d == 3, F.lit("-5.00")).when(d == 4, F.lit("20000000.00")).otherwise(F.col("amount").cast("string")).alias("amount"),
            F.when(d != 1, F.col("channel")).alias("channel"),
            F.date_format("txn_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("txn_ts"),
            F.when(d == 7, None).when(d == 8, F.lit("upsert")).otherwise(F.col("op_type")).alias("op_type"),
            F.when(d != 6, F.date_format("change_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("change_ts"),
            "is_fraud",
        )
    )
    rows = t.select(F.when(d == 0, F.lit("not json")).otherwise(payload).alias("value"), (F.col("customer_id") % 4).cast("int").alias("partition"), F.col("id").alias("offset"))
    again = rows.filter(F.col("offset") % 50 == 0).withColumn("offset", F.col("offset") + 1_000_000_000)
    return rows.unionByName(again)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    n = F.col("o_orderkey") % 20
    level = F.substring("o_orderpriority", 1, 1)
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.when(level.isin("1", "2"), "high").when(level == "3", "medium").otherwise("low").alias("risk_segment"),
        F.col("c_nationkey").cast("string").alias("home_country"),
        F.when(n < 16, "update").when(n < 19, "insert").otherwise("delete").alias("op_type"),
        F.expr("timestampadd(SECOND, datediff(o_orderdate, date'1995-01-01') * 1080 + cast(o_orderkey % 1080 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("change_ts"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """transaction_id, score: a stand-in for model output, NULL for some."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("transaction_id"), F.when(k % 37 != 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), k / 100.0))).alias("score"))


def generated(spark: SparkSession, events: int = 500, customers: int = 50) -> DataFrame:
    """Synthetic events of a pool of customers, each value drawn by a hash of the event's number and the column's name: the same
    events at every run and on every partition."""

    def draw(name: str):
        return F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{name}"))), 1, 8), 16, 10).cast("bigint")

    def below(name: str, share: float):
        return draw(name) < F.lit(int(share * 2**32))

    return spark.range(events).select(
        F.md5(F.col("id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("CU"), F.lpad((draw("customer") % customers).cast("string"), 5, "0")).alias("customer_id"),
        ((100 + draw("amount") % 499_901) / 100).cast("decimal(12,2)").alias("amount"),
        F.when(below("channel", 0.5), "fednow").otherwise("ach").alias("channel"),
        F.expr("timestampadd(SECOND, id, timestamp_ntz'2024-01-01 00:00:00')").alias("txn_ts"),
        F.when(below("op", 0.80), "insert").when(below("op", 0.95), "update").otherwise("delete").alias("op_type"),
        (draw("lag") % 91).alias("lag"),
        below("payee", 0.20).alias("is_new_payee"),
        below("fraud", 0.03).alias("is_fraud"),
    ).withColumn("change_ts", F.expr("timestampadd(SECOND, -lag, txn_ts)")).drop("lag")
