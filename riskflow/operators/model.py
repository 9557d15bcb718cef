"""Deterministic splits, boosted trees, the promotion gate, batch and online scoring."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import confusion, roc_auc
from .features import one_hot
from .merge import update_only

GATE, THRESHOLD = 0.60, 0.5


def class_balance(df: DataFrame, label: str) -> DataFrame:
    out = df.agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    return out.withColumn("scale_pos_weight", F.round(F.coalesce(F.col("neg") / F.nullif(F.col("pos"), F.lit(0)), F.lit(1.0)), 4))


def folds(df: DataFrame, label: str, key: str, n: int = 5) -> DataFrame:
    """A fold for each row, the same for the same key, balanced within each label: ranks by hash inside hash buckets."""
    h = F.md5(F.col(key).cast("string"))
    w = Window.partitionBy(label, F.substring(h, 1, 2)).orderBy(h)
    return df.withColumn("fold", ((F.row_number().over(w) - 1) % n).cast("int"))


def train(df: DataFrame, features: list[str], label: str, rounds: int = 100, seed: int = 42) -> PipelineModel:
    """Boosted trees of depth 3, weighted by class balance."""
    balance = class_balance(df.withColumn("_l", F.col(label) == 1), "_l").first()
    weighted = df.withColumn("_w", F.when(F.col(label) == 1, float(balance["scale_pos_weight"])).otherwise(1.0)).withColumn(label, F.col(label).cast("double"))
    trees = GBTClassifier(labelCol=label, featuresCol="_x", weightCol="_w", maxIter=rounds, maxDepth=3, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep"), trees]).fit(weighted)


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    return model.transform(df).withColumn(name, F.round(vector_to_array("probability")[1], 6)).drop("_x", "rawPrediction", "probability", "prediction")


def cross_validated(df: DataFrame, features: list[str], label: str, key: str, n: int = 5, rounds: int = 100) -> DataFrame:
    """Out-of-fold scores."""
    parts = folds(df, label, key, n)
    held = [score(train(parts.filter(F.col("fold") != k), features, label, rounds), parts.filter(F.col("fold") == k)) for k in range(n)]
    return reduce(DataFrame.unionByName, held)


def gate(metrics: DataFrame, auc: str = "cv_auc", heuristic: str = "heuristic_auc") -> DataFrame:
    return metrics.withColumn("promoted", F.coalesce((F.col(auc) >= GATE) & (F.col(auc) > F.col(heuristic)), F.lit(False)))


def decide(df: DataFrame, score: str = "score") -> DataFrame:
    """status and decision of online requests; a request without features has no score."""
    return df.withColumns({"status": F.when(F.col(score).isNull(), "no_features").otherwise("ok"), "decision": F.when(F.col(score) >= THRESHOLD, "review").when(F.col(score).isNotNull(), "pass")})


def online_features(df: DataFrame, key: str, at: str, columns: list[str], tie: str) -> DataFrame:
    """The newest features of each key, and as a map of strings for a key-value store."""
    need = [c for c in [key, at, *columns] if c not in df.columns]
    if need:
        raise ValueError(f"online feature source missing columns: {need}")
    best = df.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(at, tie)).alias("f")).select(key, "f.*")
    return best.withColumn("risk_segment", F.coalesce("risk_segment", F.lit("unknown"))) if "risk_segment" in columns else best


NUMERIC, CATEGORICAL = ("amount_zscore_30d", "txn_count_1h", "velocity_score", "peer_deviation"), ("risk_segment",)
META = "feat:_meta"


def populate(store, features: DataFrame, key: str = "customer_id", table: str = "online") -> int:
    """Writes features as a keyed table of string maps, and one row about them (count, built time); returns the count."""
    need = [x for x in (key, *NUMERIC, *CATEGORICAL) if x not in features.columns]
    if need:
        raise ValueError(f"online feature source missing columns: {need}")
    pairs = [x for n in (*NUMERIC, *CATEGORICAL) for x in (F.lit(n), F.col(n).cast("string"))]
    rows = features.select(F.concat(F.lit("feat:"), F.col(key).cast("string")).alias("key"), F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()).alias("fields"))
    meta = rows.agg(F.lit(META).alias("key"), F.create_map(F.lit("count"), F.count(F.lit(1)).cast("string"), F.lit("built_ts"), F.unix_timestamp().cast("string")).alias("fields"))
    store.write(table, rows.unionByName(meta))
    return int(store.read(table).filter(F.col("key") == META).first().fields["count"])


def lookup(store, asked: DataFrame, key: str = "customer_id", table: str = "online") -> DataFrame:
    """asked with its features: NULLs for an unknown key; a known key's missing field is 0.0, or "unknown" for a category."""
    held = store.read(table).select(F.col("key").alias("_key"), "fields")
    joined = asked.join(held, F.concat(F.lit("feat:"), F.col(key).cast("string")) == F.col("_key"), "left")
    hit = F.col("_key").isNotNull()
    found = {n: F.when(hit, F.coalesce(F.try_element_at("fields", F.lit(n)).cast("double"), F.lit(0.0))) for n in NUMERIC}
    found |= {n: F.when(hit, F.coalesce(F.try_element_at("fields", F.lit(n)), F.lit("unknown"))) for n in CATEGORICAL}
    return joined.withColumns(found | {"_hit": hit}).drop("_key", "fields")


def encoded(df: DataFrame, vocabulary: dict[str, list[str]], at: str = "txn_ts") -> DataFrame:
    """Request fields as model inputs: the hour of an ISO-8601 time, and 0/1 columns of the vocabulary."""
    return one_hot(df.withColumn("hour", F.hour(F.to_timestamp(at)).cast("double")), vocabulary)


def respond(fitted: PipelineModel, requests: DataFrame, store, vocabulary: dict[str, list[str]], ref: str) -> DataFrame:
    """transaction_id, fraud_score (6 digits), status, decision and model of each request (transaction_id, customer_id, amount,
    channel, txn_ts as text); a customer without online features has the status no_features and no score."""
    known = lookup(store, requests)
    scored = score(fitted, encoded(known.filter("_hit"), vocabulary).withColumn("amount", F.col("amount").cast("double")), "fraud_score").select("transaction_id", "fraud_score")
    missed = known.filter("not _hit").select("transaction_id", F.lit(None).cast("double").alias("fraud_score"))
    return decide(scored.unionByName(missed), "fraud_score").withColumn("model_ref", F.lit(ref))


def write_scores(store, scores: DataFrame, table: str = "mart", key: str = "transaction_health_sk", column: str = "model_distress_score") -> dict:
    """Updates a stored table's score column from scores (key, score); returns what was scored, what isn't NULL then, and a checksum."""
    new = scores.select(key, F.col("score").alias(column))
    store.write(table, update_only(store.read(table), new, [key], [column]))
    sent = scores.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score"), 6).alias("sum")).first()
    after = store.read(table).filter(F.col(column).isNotNull()).count()
    return {"rows_scored": sent["n"], "non_null_after": after, "score_checksum": sent["sum"]}


def holdout(df: DataFrame, features: list[str], label: str, key: str, rounds: int = 100) -> tuple[PipelineModel, dict]:
    """A model of four of five folds and its figures on the fifth, as a run's record."""
    parts = folds(df, label, key)
    rest, held = parts.filter("fold <> 0"), parts.filter("fold = 0")
    fitted = train(rest, features, label, rounds)
    scored = score(fitted, held)
    shape = parts.agg(F.count_if(F.col("fold") != 0).alias("n_train"), F.count_if(F.col("fold") == 0).alias("n_test"), F.count_if((F.col("fold") != 0) & (F.col(label) == 1)).alias("fraud_train"), F.count_if((F.col("fold") == 0) & (F.col(label) == 1)).alias("fraud_test")).first()
    at = confusion(scored, label, "score").first()
    figures = {"test_precision": at["precision"] or 0.0, "test_recall": at["recall"] or 0.0, "test_roc_auc": roc_auc(scored, label, "score").first().auc}
    return fitted, {"params": {"features": ", ".join(features), "decision_threshold": THRESHOLD, **shape.asDict()}, "metrics": figures}


def evaluate(registry: Registry, df: DataFrame, features: list[str], label: str, key: str, proxy: str, rounds: int = 100) -> dict:
    """Out-of-fold figures against those of the rule by |proxy|; a model of all rows is registered, and becomes champion if the
    gate lets it."""
    held = cross_validated(df, features, label, key, rounds=rounds)
    at = confusion(held, label, "score").first()
    cv, rule = roc_auc(held, label, "score").first().auc, roc_auc(df.withColumn("_p", F.coalesce(F.abs(proxy), F.lit(0.0))), label, "_p").first().auc
    figures = {"cv_roc_auc": cv, "cv_precision": at["precision"] or 0.0, "cv_recall": at["recall"] or 0.0, "heuristic_roc_auc": rule}
    figures |= {f"confusion_{k}": at[n] for k, n in (("tn", "true_negative"), ("fp", "false_positive"), ("fn", "false_negative"), ("tp", "true_positive"))}
    promoted = cv is not None and cv >= GATE and cv > (rule or 0.0)
    version = registry.register(train(df, features, label, rounds), figures, "champion" if promoted else None)
    return {**figures, "promoted": promoted, "version": version}


class Registry:
    """Saved models with versions and aliases in one JSON file, written through the store's file system."""

    def __init__(self, store):
        self.store = store

    def _state(self) -> dict:
        text = self.store.read_text("registry.json")
        return json.loads(text) if text else {"versions": [], "aliases": {}}

    def register(self, model: PipelineModel, metrics: dict, alias: str | None = None) -> int:
        state = self._state()
        version = len(state["versions"]) + 1
        model.write().overwrite().save(f"{self.store.root}/model-{version}")
        state["versions"].append({"version": version, "metrics": metrics})
        if alias:
            state["aliases"][alias] = version
        self.store.write_text("registry.json", json.dumps(state))
        return version

    def load(self, alias: str = "champion") -> tuple[PipelineModel, int, str]:
        """The aliased version, else the newest; with its number and stage."""
        state = self._state()
        if not state["versions"]:
            raise LookupError("no model is registered")
        version = state["aliases"].get(alias, state["versions"][-1]["version"])
        return PipelineModel.load(f"{self.store.root}/model-{version}"), version, alias if alias in state["aliases"] else "latest"
