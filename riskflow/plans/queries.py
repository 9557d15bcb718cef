"""The registered queries over the fixture relations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import metrics
from ..operators import features as ft
from ..operators import governance, merge, model, quality, scd2
from ..session import shared_folder
from ..sources.store import Store
from ..streaming import bronze
from . import flow

c = F.col
r4 = lambda name: F.round(name, 4).alias(name)
CURRENT = ["risk_segment", "home_country"]


def _folder(spark: SparkSession) -> str:
    """A new folder where all executors can write: in the session's shared folder, or on this machine if all of Spark runs here."""
    return f"{shared_folder(spark)}/riskflow-{uuid.uuid4().hex[:12]}"


def _decoded(s: SparkSession, d: str) -> DataFrame:
    return bronze.decode(fx.raw_events(s, d))


def _dimension(s: SparkSession, d: str) -> DataFrame:
    return scd2.full_history(fx.changes(s, d))


def _passed(s: SparkSession, d: str) -> DataFrame:
    return quality.split(_decoded(s, d))[0]


def _silver(s: SparkSession, d: str) -> DataFrame:
    source = merge.one_per_key(_passed(s, d), ["transaction_id", "change_ts"], ["_partition", "_offset"])
    return source.select("transaction_id", "customer_id", "amount", "channel", "txn_ts", "op_type", "change_ts", "is_fraud")


def _stored_silver(s: SparkSession, d: str) -> DataFrame:
    """Silver rows, written once and read, so that a merge doesn't decode the events for each of its sides."""
    store = Store(s, _folder(s))
    store.write("silver", _silver(s, d))
    return store.read("silver")


def bronze_decode(s, d):
    return _decoded(s, d).drop("_raw_payload")


def dq_classify(s, d):
    return quality.classify(_decoded(s, d)).select("_partition", "_offset", c("_error_type").alias("error_type"), c("_error_detail").alias("error_detail"))


def dq_detail_summary(s, d):
    return dq_classify(s, d).groupBy("error_type", "error_detail").agg(F.count(F.lit(1)).alias("n"))


def dq_split_counts(s, d):
    return dq_classify(s, d).agg(F.count_if(c("error_type").isNull()).alias("passed"), F.count_if(c("error_type").isNotNull()).alias("failed"))


def dq_deadletter(s, d):
    _, failed = quality.split(_decoded(s, d))
    return failed.select("transaction_id", c("_error_type").alias("error_type"), c("_error_detail").alias("error_detail"), "_partition", "_offset")


def reconcile_counts(s, d):
    """Distinct source rows: raw = passed + failed; distinct keys of passed rows = silver."""
    tagged = quality.classify(_decoded(s, d))
    totals = tagged.agg(F.count(F.lit(1)).alias("bronze"), F.count_if(c("_error_type").isNotNull()).alias("rejected"), F.count_if(c("_error_type").isNull()).alias("passed"))
    return totals.join(F.broadcast(_silver(s, d).agg(F.count(F.lit(1)).alias("silver"))))


def silver_merge_insert_only(s, d):
    source = _stored_silver(s, d)
    old = source.filter(c("transaction_id").cast("bigint") % 2 == 0)
    return merge.insert_only(old, source, ["transaction_id", "change_ts"], unique=True)


def silver_merge_replay_noop(s, d):
    source = _stored_silver(s, d)
    once = merge.insert_only(source.filter(c("transaction_id").cast("bigint") % 2 == 0), source, ["transaction_id", "change_ts"])
    return merge.insert_only(once, source, ["transaction_id", "change_ts"])


def latest_per_customer(s, d):
    return scd2.latest(fx.changes(s, d))


def _first(s, d):
    return scd2.apply(None, fx.changes(s, d).filter(c("change_ts") < F.lit(fx.MIDDLE).cast("timestamp_ntz")))


def scd2_apply_first(s, d):
    return _first(s, d)


def scd2_apply_second(s, d):
    return scd2.apply(_first(s, d), fx.changes(s, d).filter(c("change_ts") >= F.lit(fx.MIDDLE).cast("timestamp_ntz")))


def scd2_full_history(s, d):
    return _dimension(s, d)


def scd2_surrogate_keys(s, d):
    return scd2.numbered(_dimension(s, d).select("customer_id", "effective_start"), ["customer_id", "effective_start"], "customer_sk")


def scd2_invariants(s, d):
    return scd2.invariants(scd2_apply_second(s, d))


def _snapshots(s, d, vanish: bool):
    cust = fx.read(s, d, "customer").select(c("c_custkey").alias("customer_id"), c("c_mktsegment").alias("risk_segment"), c("c_nationkey").cast("string").alias("home_country"))
    live = cust.filter("customer_id % 10 <> 9").withColumns({"valid_from": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz")})
    new = cust.withColumn("risk_segment", F.when(c("customer_id") % 7 == 0, "CHANGED").when(c("customer_id") % 11 == 0, F.lit(None)).otherwise(c("risk_segment")))
    if vanish:
        new = new.filter("customer_id % 5 <> 0")
    return merge.snapshot(live, new, "customer_id", CURRENT, "2024-02-01 00:00:00")


def snapshot_check(s, d):
    return _snapshots(s, d, False)


def snapshot_hard_delete(s, d):
    return _snapshots(s, d, True)


def gold_current_dim_join(s, d):
    return ft.with_current(fx.transactions(s, d), _dimension(s, d)).select("transaction_id", "customer_id", *CURRENT)


def rolling_features(s, d):
    return ft.rolling(fx.transactions(s, d)).select("transaction_id", "txn_count_1h", r4("amount_mean_30d"), r4("amount_std_30d"), r4("amount_zscore_30d"), "velocity_score")


def rolling_features_ties(s, d):
    li = fx.read(s, d, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    out = ft.rolling(li, "l_suppkey", "l_shipdate", "l_quantity")
    return out.groupBy("l_suppkey").agg(F.sum("txn_count_1h").alias("sum_count"), F.round(F.sum("amount_mean_30d"), 2).alias("sum_mean"), F.count("amount_std_30d").alias("n_std"))


def _gold(s, d):
    return ft.gold(fx.transactions(s, d), _dimension(s, d))


def peer_benchmark_z(s, d):
    return ft.peer_z(ft.with_current(fx.transactions(s, d), _dimension(s, d))).select("transaction_id", "risk_segment", r4("peer_deviation"))


def peer_deviation_raw(s, d):
    return ft.peer_raw(ft.with_current(fx.transactions(s, d), _dimension(s, d))).select("transaction_id", "risk_segment", r4("peer_deviation_raw"))


def _gold_columns(g: DataFrame) -> DataFrame:
    return g.select("transaction_id", "customer_id", "risk_segment", "channel", c("amount").cast("double").alias("amount"), "txn_ts", "is_fraud", "txn_count_1h", r4("amount_mean_30d"), r4("amount_std_30d"), r4("amount_zscore_30d"), "velocity_score", r4("peer_deviation"))


def gold_enriched(s, d):
    return _gold_columns(_gold(s, d))


def stg_transactions(s, d):
    checked = quality.classify(_decoded(s, d)).withColumn("_dq_passed", c("_error_type").isNull())
    return ft.staging(checked).select("transaction_id", "customer_id", c("amount").cast("double").alias("amount"), "channel", "txn_ts", "op_type", "change_ts", "_offset")


def _trends(s, d):
    return ft.trends(fx.transactions(s, d), _dimension(s, d))


def int_trends(s, d):
    return _trends(s, d).select("transaction_id", "customer_id", "risk_segment", "geo_country", "is_new_payee", c("txn_hour").cast("long").alias("txn_hour"), "is_high_value", "is_cross_border", "is_fraud")


def pit_join(s, d):
    return ft.point_in_time(fx.transactions(s, d), _dimension(s, d)).select("transaction_id", "risk_segment", "version_start")


def pit_join_summary(s, d):
    return pit_join(s, d).groupBy("risk_segment").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("version_start").isNull()).alias("without_version"))


def _mart(s, d):
    return ft.mart(_trends(s, d), _dimension(s, d))


def mart_health(s, d):
    return _mart(s, d).select("transaction_health_sk", "transaction_id", "change_ts", "customer_id", "risk_segment", c("amount").cast("double").alias("amount"), "txn_ts", "channel", "geo_country", "is_cross_border", c("txn_hour").cast("long").alias("txn_hour"), "is_high_value", "txn_count_1h", r4("amount_zscore_30d"), "velocity_score", r4("peer_deviation_raw"), "model_distress_score")


def mart_risk_score(s, d):
    return _mart(s, d).select("transaction_id", r4("risk_score"))


def int_incremental_upsert(s, d):
    t = _trends(s, d).select("transaction_id", "change_ts", "txn_ts", "is_high_value")
    old = t.filter(c("txn_ts") < F.lit(fx.MIDDLE).cast("timestamp_ntz")).withColumn("is_high_value", F.lit(None).cast("boolean"))
    return merge.upsert(old, t.filter(c("transaction_id").cast("bigint") % 3 > 0), ["transaction_id", "change_ts"])


def mart_incremental_equals_rebuild(s, d):
    t = fx.transactions(s, d)
    build = lambda x: ft.rolling(x).select("transaction_id", "txn_ts", "txn_count_1h", r4("amount_mean_30d"), r4("amount_std_30d"))
    return ft.incremental(build(t.filter(c("txn_ts") < F.lit(fx.MIDDLE).cast("timestamp_ntz"))), t, build)


def _labels(s, d):
    t = fx.transactions(s, d)
    scored = fx.scores(s, d).filter(c("transaction_id").cast("bigint") % 2 == 0)
    return t.join(scored.select("transaction_id"), "transaction_id", "left_semi").groupBy("transaction_id").agg(F.max(c("is_fraud").cast("int")).alias("actual_fraud"))


def labels_promoted(s, d):
    return _labels(s, d)


def _scored(s, d):
    """The mart with scores written back."""
    m = _mart(s, d)
    return merge.update_only(m, fx.scores(s, d).withColumnRenamed("score", "model_distress_score"), ["transaction_id"], ["model_distress_score"])


def alert_queue_top20(s, d):
    top = _scored(s, d).orderBy(F.desc_nulls_last("model_distress_score"), c("transaction_id").cast("bigint")).limit(20)
    return top.select("transaction_id", "customer_id", c("amount").cast("double").alias("amount"), "channel", "geo_country", "risk_segment", "is_cross_border", F.round("model_distress_score", 4).alias("fraud_score"))


def sar_candidates(s, d):
    rows = _scored(s, d).filter("model_distress_score >= 0.5").orderBy(F.desc("model_distress_score"), F.desc("amount"))
    return rows.select("transaction_id", "customer_id", c("amount").cast("double").alias("amount"), "channel", "geo_country", "is_cross_border", "txn_count_1h", r4("velocity_score"), r4("amount_zscore_30d"), F.round("model_distress_score", 4).alias("fraud_score"))


def confusion_matrix(s, d):
    return metrics.confusion(fx.scores(s, d).join(_labels(s, d), "transaction_id"), "actual_fraud", "score")


def score_bands(s, d):
    return fx.scores(s, d).groupBy(ft.bands(c("score")).alias("score_band")).agg(F.count(F.lit(1)).alias("txn_count")).orderBy("score_band")


def _mean(score):
    """Mean to 4 digits from an exact sum of millionths, so that it doesn't depend on the order of rows."""
    return F.round(F.sum(F.round(score * 1_000_000).cast("long")) / F.count(score).cast("double") / 1_000_000.0, 4)


def geo_cross_border(s, d):
    g = _scored(s, d).groupBy("geo_country", "is_cross_border")
    return g.agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount").cast("double").alias("total_amount"), _mean(c("model_distress_score")).alias("avg_fraud_score"), F.count_if(c("model_distress_score") >= 0.5).alias("flagged_count"))


def _policy(s, d, who):
    return governance.row_policy(pit_join(s, d), who, frozenset({"auditor"}))


def row_policy_restricted(s, d):
    return _policy(s, d, "analyst")


def row_policy_privileged(s, d):
    return _policy(s, d, "auditor")


def class_balance(s, d):
    return model.class_balance(fx.transactions(s, d), "is_fraud")


def stratified_folds(s, d):
    return model.folds(fx.transactions(s, d), "is_fraud", "transaction_id").select("transaction_id", "is_fraud", "fold")


def stratified_split(s, d):
    return stratified_folds(s, d).select("transaction_id", (c("fold") == 0).alias("held_out"))


def feature_matrix_onehot(s, d):
    f = _gold(s, d).withColumn("risk_segment", F.coalesce("risk_segment", F.lit("unknown")))
    hot = ft.one_hot(f, {"channel": ["ach", "fednow"], "risk_segment": ["high", "low", "medium", "unknown"]})
    return hot.select("transaction_id", "txn_count_1h", *[x for x in hot.columns if x.startswith(("channel_", "risk_segment_"))])


def _online(s, d):
    return model.online_features(_gold(s, d), "customer_id", "txn_ts", ["amount_zscore_30d", "txn_count_1h", "velocity_score", "risk_segment"], "transaction_id")


def online_features_latest(s, d):
    return _online(s, d).select("customer_id", r4("amount_zscore_30d"), "txn_count_1h", "velocity_score", "risk_segment")


def online_score_lookup(s, d):
    """Requests for all customers; those without transactions have no features."""
    asked = fx.read(s, d, "customer").select(c("c_custkey").alias("customer_id"))
    j = asked.join(_online(s, d).withColumn("_hit", F.lit(True)), "customer_id", "left")
    score = F.when(c("_hit"), F.round(F.least(F.lit(1.0), F.abs("amount_zscore_30d") / 3.0), 4))
    return model.decide(j.select("customer_id", score.alias("score")))


def score_writeback_update_only(s, d):
    return _scored(s, d).select("transaction_id", r4("model_distress_score"))


def _z(s, d):
    return ft.rolling(fx.transactions(s, d)).select(c("is_fraud").cast("int").alias("y"), F.round(F.coalesce(F.abs("amount_zscore_30d"), F.lit(0.0)), 9).alias("p"), "txn_ts", "velocity_score", c("amount").cast("double").alias("amount"))


def auc_heuristic(s, d):
    """The rule that a model has to beat: |z|, NULL as 0; to 9 digits, so that ties don't depend on the order of sums."""
    return metrics.roc_auc(_z(s, d), "y", "p")


def psi_amount(s, d):
    return metrics.psi(_z(s, d), "amount", c("txn_ts") < F.lit(fx.MIDDLE).cast("timestamp_ntz"))


def psi_velocity(s, d):
    return metrics.psi(_z(s, d), "velocity_score", c("txn_ts") < F.lit(fx.MIDDLE).cast("timestamp_ntz"))


def latency_percentiles(s, d):
    return metrics.nearest_rank(fx.read(s, d, "events"), "value")


def promotion_gate(s, d):
    auc = auc_heuristic(s, d).withColumnRenamed("auc", "cv_auc").withColumn("heuristic_auc", F.lit(0.5))
    return model.gate(auc)


def dq_tests(s, d):
    return quality.violations(_mart(s, d), ["transaction_health_sk", "is_high_value", "risk_score"], ["transaction_health_sk"], {"channel": ["ach", "fednow"]})


def _stream(s, d, times: int):
    """The raw events land as files and are drained as a stream, `times` times, each with a checkpoint of its own."""
    root = _folder(s)
    fx.raw_events(s, d).write.parquet(f"{root}/landing")
    store = Store(s, f"{root}/store")
    for k in range(times):
        stream = s.readStream.schema("value string, partition int, offset long").parquet(f"{root}/landing")
        bronze.ingest(stream, store, "bronze", "ingest", f"{root}/checkpoint-{k}")
    return store.read("bronze")


def stream_bronze_counts(s, d):
    return _stream(s, d, 1).groupBy("_partition").agg(F.count(F.lit(1)).alias("n"), F.count("transaction_id").alias("with_id"))


def stream_replay_noop(s, d):
    """The checkpoint is lost and the stream starts again: the commit log keeps each batch single."""
    return _stream(s, d, 2).groupBy("_partition").agg(F.count(F.lit(1)).alias("n"))


def _frame(s, d):
    g = _gold(s, d).withColumns({"risk_segment": F.coalesce("risk_segment", F.lit("unknown")), "label": c("is_fraud").cast("int"), "amount": c("amount").cast("double"), "hour": F.hour("txn_ts").cast("double")})
    hot = ft.one_hot(g, {"channel": ["ach", "fednow"], "risk_segment": ["high", "low", "medium", "unknown"]})
    return hot, ["amount", "amount_zscore_30d", "txn_count_1h", "velocity_score", "peer_deviation", "hour", *[x for x in hot.columns if x.startswith(("channel_", "risk_segment_"))]]


def model_train_score(s, d):
    frame, names = _frame(s, d)
    fitted = model.train(frame, names, "label")
    return model.score(fitted, frame).select("transaction_id", "label", "score")


def registry_fallback(s, d):
    frame, names = _frame(s, d)
    registry = model.Registry(Store(s, _folder(s)))
    registry.register(model.train(frame, names, "label", rounds=2), {"cv_auc": 0.4})
    fitted, version, stage = registry.load("champion")
    return model.score(fitted, frame).agg(F.lit(version).alias("version"), F.lit(stage).alias("stage"), F.count("score").alias("n"))


def clustering_layout(s, d):
    return governance.layout(_silver(s, d).select("transaction_id", "customer_id", "op_type"), "customer_id", 8)


def column_tags(s, d):
    """Tags of the governed columns, as the schemas of the tagged tables hold them."""
    customers = fx.read(s, d, "customer").select(c("c_custkey").alias("customer_id"), c("c_nationkey").alias("home_country"), F.lit(None).cast("date").alias("account_open_date"))
    frames = {"fct_transaction_health": _mart(s, d), "dim_customers_snapshot": customers}
    found = [(t, f.name, k, str(v)) for t, df in frames.items() for f in governance.tagged(df, governance.TAGS[t]).schema for k, v in f.metadata.items()]
    return s.createDataFrame(found, "table_name string, column_name string, tag string, value string")


def row_policy_session(s, d):
    """The filter as a SQL function of the session's user, who isn't privileged."""
    pit_join(s, d).createOrReplaceTempView("policy_facts")
    return s.sql(f"SELECT * FROM policy_facts WHERE {governance.session_policy(s, ('auditor',))}(risk_segment)")


def gold_untuned(s, d):
    return _gold_columns(ft.gold(fx.transactions(s, d), _dimension(s, d), tuned=False))


def generated_events(s, d):
    return fx.generated(s).withColumn("amount", c("amount").cast("double"))


def _store(s: SparkSession) -> Store:
    return Store(s, _folder(s))


def _after_flow(s, d) -> tuple[Store, dict]:
    store = _store(s)
    store.write("bronze", _decoded(s, d))
    stages = {
        "silver": lambda: flow.to_silver(store),
        "history": lambda: flow.to_history(store, fx.changes(s, d)),
        "gold": lambda: flow.to_gold(store, fx.transactions(s, d)),
        "mart": lambda: flow.to_mart(store, fx.transactions(s, d)),
        "maintain": lambda: flow.maintain(store),
    }
    return store, flow.run_stages(stages)


def flow_counts(s, d):
    """All stages over a store, and what they counted."""
    rows = [(stage, k, int(v)) for stage, counts in _after_flow(s, d)[1].items() for k, v in counts.items()]
    return s.createDataFrame(rows, "stage string, metric string, n long")


def _twice_silver(s, d) -> Store:
    store = _store(s)
    store.write("bronze", _decoded(s, d))
    for _ in range(2):
        flow.to_silver(store)
    return store


def deadletter_sink(s, d):
    """The stored dead letters after a run that was repeated."""
    return _twice_silver(s, d).read("deadletter").select("transaction_id", c("_error_type").alias("error_type"), c("_error_detail").alias("error_detail"), "_partition", "_offset")


def silver_sink(s, d):
    """Stored silver after a run that was repeated."""
    return _twice_silver(s, d).read("silver").select("transaction_id", "customer_id", "amount", "channel", "txn_ts", "op_type", "change_ts", "is_fraud")


def clustered_table(s, d):
    store = _store(s)
    store.write("silver", _silver(s, d).select("transaction_id", "customer_id", "op_type"))
    return store.cluster("silver", "customer_id", 4)


def labels_table(s, d):
    """A table created from a query over views of stored tables."""
    store = _store(s)
    store.write("txns", fx.transactions(s, d).select("transaction_id", "is_fraud"))
    sql = "SELECT transaction_id, max(cast(is_fraud AS int)) AS actual_fraud FROM txns WHERE cast(transaction_id AS bigint) % 2 = 0 GROUP BY transaction_id"
    return store.create_as("transaction_labels", sql, ("txns",))


def kv_features(s, d):
    """Features of all customers from the key-value table; a third of them were stored without one field."""
    store = _store(s)
    newest = model.online_features(_gold(s, d), "customer_id", "txn_ts", [*model.NUMERIC, *model.CATEGORICAL], "transaction_id")
    model.populate(store, newest.withColumn("peer_deviation", F.when(c("customer_id") % 3 != 0, c("peer_deviation"))))
    found = model.lookup(store, fx.read(s, d, "customer").select(c("c_custkey").alias("customer_id")))
    return found.select("customer_id", *[r4(n) for n in model.NUMERIC], *model.CATEGORICAL)


def writeback_stats(s, d):
    store, m = _store(s), _mart(s, d)
    store.write("mart", m)
    scores = fx.scores(s, d).join(store.read("mart").select("transaction_id", "transaction_health_sk"), "transaction_id").select("transaction_health_sk", "score")
    return s.createDataFrame([tuple(model.write_scores(store, scores).values())], "rows_scored long, non_null_after long, score_checksum double")


def model_holdout(s, d):
    frame, names = _frame(s, d)
    run = model.holdout(frame, names, "label", "transaction_id", rounds=20)[1]
    return s.createDataFrame([(k, float(v)) for k, v in run["metrics"].items()], "metric string, value double")


def model_evaluated(s, d):
    """Out-of-fold figures of 20 rounds (each fold is a fit), the gate's decision, and the registered version."""
    frame, names = _frame(s, d)
    registry = model.Registry(_store(s))
    found = model.evaluate(registry, frame, names, "label", "transaction_id", "amount_zscore_30d", rounds=20)
    _, version, stage = registry.load("champion")
    rows = [*found.items(), ("served_version", version), ("served_as_champion", stage == "champion")]
    return s.createDataFrame([(k, float(v)) for k, v in rows if v is not None], "metric string, value double")


def served_requests(s, d):
    """Requests of all customers through the online features and a model."""
    store, vocabulary = _store(s), {"channel": ["ach", "fednow"], "risk_segment": ["high", "low", "medium", "unknown"]}
    frame, names = _frame(s, d)
    names = [n for n in names if n != "hour"] + ["hour"]
    model.populate(store, model.online_features(frame, "customer_id", "txn_ts", [*model.NUMERIC, *model.CATEGORICAL], "transaction_id"))
    asked = fx.read(s, d, "customer").select(c("c_custkey").cast("string").alias("transaction_id"), c("c_custkey").alias("customer_id"), F.lit("120.50").alias("amount"), F.lit("ach").alias("channel"), F.lit("2024-02-01T13:45:00").alias("txn_ts"))
    return model.respond(model.train(frame, names, "label", rounds=5), asked, store, vocabulary, "unpromoted")


QUERIES = {n: f for n, f in list(globals().items()) if callable(f) and not n.startswith("_") and getattr(f, "__module__", "") == __name__ and n != "r4"}
