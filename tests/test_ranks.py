"""Ranks, quantiles and drift against the plain rules on small samples where near misses differ."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.functions import metrics, ranks


def psi(reference, current, bins=10):
    edges = np.unique(np.quantile(reference, np.linspace(0, 1, bins + 1)))
    r, c = np.histogram(reference, edges)[0], np.histogram(current, edges)[0]
    r, c = np.clip(r / max(r.sum(), 1), 1e-6, None), np.clip(c / max(c.sum(), 1), 1e-6, None)
    return ((c - r) * np.log(c / r)).sum()


@pytest.mark.parametrize("shift", [0, 50, 200])
def test_psi_drops_values_outside_the_edges_before_it_takes_shares(spark, shift):
    a, b = list(range(100)), [x + shift for x in range(100)]
    df = spark.createDataFrame([(float(x), k == 0) for k, rows in enumerate((a, b)) for x in rows], "v double, r boolean")
    assert metrics.psi(df, "v", F.col("r")).first().psi == pytest.approx(psi(a, b), abs=1e-4)


@pytest.mark.parametrize("n", [1, 2, 3, 6, 101, 1000])
def test_nearest_rank_rounds_halves_to_the_even_rank(spark, n):
    values = sorted(random.Random(n).random() for _ in range(n))
    got = metrics.nearest_rank(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    assert [got.p50, got.p95, got.p99, got["max"]] == [values[round(p * (n - 1))] for p in (0.5, 0.95, 0.99)] + [values[-1]]


def test_running_counts_and_quantiles(spark):
    r = random.Random(1)
    values = [r.choice([0.0, -3.5, r.random() * 100]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    upto = {x.v: x.n_upto for x in ranks.running(df, "v", {"n": F.count(F.lit(1))}).collect()}
    assert upto == {v: sum(w <= v for w in values) for v in set(values)}
    shares = [i / 10 for i in range(11)]
    assert ranks.quantiles(df, "v", shares).first().e == pytest.approx(np.quantile(values, shares).tolist())
    assert ranks.running(df.limit(0), "v", {"n": F.count(F.lit(1))}).count() == 0


def test_auc_with_ties(spark):
    r = random.Random(2)
    rows = [(r.randint(0, 1), round(r.random(), 1)) for _ in range(300)]
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert metrics.roc_auc(spark.createDataFrame(rows, "y int, p double"), "y", "p").first().auc == pytest.approx(want, abs=1e-4)
