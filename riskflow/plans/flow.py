"""The stages from raw events to the mart over a store, with counts, records of failures, and retries."""

from __future__ import annotations

import json
import logging
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, merge, quality, scd2
from ..sources.store import Store

KEYS = ["transaction_id", "change_ts"]


@dataclass(frozen=True)
class Settings:
    """Taken from environment variables RISKFLOW_<NAME>, else from the defaults."""

    retries: int = 2
    backoff_seconds: float = 30.0
    most_seconds: float = 600.0
    files: int = 8

    @classmethod
    @lru_cache(maxsize=1)
    def load(cls) -> Settings:
        found = {f.name: os.environ.get(f"RISKFLOW_{f.name.upper()}") for f in fields(cls)}
        return cls(**{n: type(getattr(cls, n))(v) for n, v in found.items() if v is not None})


def log(stage: str, **metrics) -> str:
    """One JSON line about a stage, to the log `riskflow`."""
    line = json.dumps({"ts": round(time.time(), 3), "stage": stage, **metrics}, default=str)
    logging.getLogger("riskflow").info(line)
    return line


def run_stages(stages: dict[str, Callable[[], dict]], settings: Settings | None = None, on_failure: Callable[[str], None] = lambda line: None, sleep: Callable[[float], None] = time.sleep) -> dict[str, dict]:
    """The stages in order, each again after a wait that doubles up to a bound; a stage that fails for good stops the run.

    Each failure is given to `on_failure` as a JSON line. Returns the metrics of each stage.
    """
    own, done = settings or Settings.load(), {}
    for name, stage in stages.items():
        for attempt in range(own.retries + 1):
            began = time.time()
            try:
                done[name] = stage()
                log(name, **done[name], duration_ms=int(1000 * (time.time() - began)))
                break
            except Exception as error:
                on_failure(log(name, failed=True, attempt=attempt + 1, error=str(error)[:500]))
                if attempt == own.retries:
                    raise
                sleep(min(own.most_seconds, own.backoff_seconds * 2**attempt))
    return done


def to_silver(store: Store, batch: int = 0, app: str = "silver") -> dict:
    """Validates bronze, appends rejected rows to the dead letters (nothing if there are none) and new keys to silver. Both
    tables take a batch once, so a repeated run adds nothing."""
    tagged = quality.classify(store.read("bronze"))
    counts = tagged.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("_error_type").isNull()).alias("rows_passed"), F.count_if(F.col("_error_type").isNotNull()).alias("rows_deadlettered")).first().asDict()
    if counts["rows_deadlettered"]:
        store.write("deadletter", tagged.filter("_error_type is not null").withColumn("_failed_ts", F.current_timestamp()), append=True, app=app, batch=batch)
    passed = tagged.filter("_error_type is null").drop("_error_type", "_error_detail")
    new = merge.one_per_key(passed, KEYS, ["_partition", "_offset"])
    if store.exists("silver"):
        new = new.join(store.read("silver").select(*KEYS), KEYS, "left_anti")
    store.write("silver", new, append=True, app=app, batch=batch)
    return counts


def to_history(store: Store, changes: DataFrame, batch: int = 0, app: str = "history") -> dict:
    """Applies a batch of customer changes to the stored history."""
    old = store.read("customers") if store.exists("customers") else None
    if store.exists("customers") and store.written("customers", app, batch):
        return {"changes_in": changes.count(), "versions": old.count(), "versions_before": old.count()}
    before = old.count() if old is not None else 0
    store.write("customers", scd2.apply(old, changes), app=app, batch=batch)
    return {"changes_in": changes.count(), "versions": store.read("customers").count(), "versions_before": before}


def to_gold(store: Store, txns: DataFrame) -> dict:
    store.write("gold", features.gold(txns, store.read("customers")))
    return {"rows_out": store.read("gold").count()}


def to_mart(store: Store, txns: DataFrame) -> dict:
    customers = store.read("customers")
    store.write("mart", features.mart(features.trends(txns, customers), customers))
    return {"rows_out": store.read("mart").count()}


def maintain(store: Store, tables: tuple[str, ...] = ("silver", "gold"), key: str = "customer_id", settings: Settings | None = None) -> dict:
    """Compacts and clusters stored tables."""
    return {t: store.cluster(t, key, (settings or Settings.load()).files).count() for t in tables}


#: Each table and what it is made from.
LINEAGE = {"bronze": ("events",), "deadletter": ("bronze",), "silver": ("bronze",), "customers": ("changes",), "gold": ("silver", "customers"), "mart": ("silver", "customers"), "online": ("gold",)}
