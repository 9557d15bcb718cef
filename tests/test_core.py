"""Properties of merges, history, storage and streaming that single queries don't show."""

import datetime as dt
import random

import duckdb
import oracle
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from riskflow.operators import features, governance, merge, quality, scd2
from riskflow.plans.oracle import ORACLE_SQL
from riskflow.plans.queries import QUERIES
from riskflow.sources.store import Store
from riskflow.streaming import bronze

T0 = dt.datetime(2024, 1, 1)
CHANGE = "customer_id long, risk_segment string, home_country string, op_type string, change_ts timestamp_ntz"


def change(key, segment, op, minute, home="1"):
    return (key, segment, home, op, T0 + dt.timedelta(minutes=minute))


def history(spark, *batches):
    out = None
    for b in batches:
        out = scd2.apply(out, spark.createDataFrame(list(b), CHANGE))
    return sorted(((r.customer_id, r.risk_segment, r.effective_start, r.is_current) for r in out.collect()), key=lambda r: (r[0], r[2]))


def test_first_batch_takes_inserts_only(spark):
    assert [r[0] for r in history(spark, [change(1, "a", "insert", 0), change(2, "a", "update", 0), change(3, "a", "delete", 0)])] == [1]


def test_insert_for_a_live_customer_closes_the_old_version(spark):
    got = history(spark, [change(1, "a", "insert", 0)], [change(1, "b", "insert", 5)])
    assert [(r[1], r[3]) for r in got] == [("a", False), ("b", True)]


def test_change_to_null_is_a_change(spark):
    assert len(history(spark, [change(1, "a", "insert", 0)], [change(1, None, "update", 5)])) == 2


def test_full_history_has_changes_of_country_and_to_null(spark):
    rows = [change(1, "a", "insert", 0), change(1, "a", "update", 1), change(1, "a", "update", 2, "2"), change(1, None, "update", 3, "2"), change(1, None, "update", 4, "2"), change(1, "a", "update", 5, None)]
    got = sorted(scd2.full_history(spark.createDataFrame(rows, CHANGE)).collect(), key=lambda r: r.effective_start)
    assert [(r.risk_segment, r.home_country, r.is_current) for r in got] == [("a", "1", False), ("a", "2", False), (None, "2", False), ("a", None, True)]


def test_full_history_of_changes_at_one_time_is_the_same_in_any_order(spark):
    rows = [change(1, "a", "insert", 0), change(1, "b", "update", 5), change(1, "a", "update", 5), change(1, "c", "update", 5), change(2, "a", "update", 0), change(2, "a", "delete", 0), change(2, "b", "update", 0)]
    for n in range(8):
        got = scd2.full_history(spark.createDataFrame(random.Random(n).sample(rows, len(rows)), CHANGE)).collect()
        assert sorted((r.customer_id, r.risk_segment) for r in got) == [(1, "a"), (1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b")]
        assert [(r.customer_id, r.risk_segment) for r in got if r.is_current] == [(1, "a")]
        assert {(r.customer_id, r.risk_segment, r.op_type) for r in scd2.latest(spark.createDataFrame(rows, CHANGE)).collect()} == {(1, "a", "update"), (2, "a", "delete")}


def undated(tmp_path):
    """A folder of small tables where every seventh order, at most one for a customer, has no date."""
    con = duckdb.connect()
    con.execute(f"create view o as select *, row_number() over (partition by o_custkey order by o_orderkey % 7, o_orderkey) = 1 and o_orderkey % 7 = 0 u from '{SMALL}/orders.parquet'")
    con.execute(f"copy (select * exclude (u) replace (case when not u then o_orderdate end as o_orderdate) from o) to '{tmp_path}/orders.parquet' (format parquet)")
    for name in set(oracle.TABLES) - {"orders"}:
        (tmp_path / f"{name}.parquet").symlink_to(f"{SMALL}/{name}.parquet")
    return str(tmp_path)


def test_latest_of_changes_at_one_time_has_the_order_of_its_sql(spark):
    rows = [change(1, "a", None, 5), change(1, "b", "update", 5), change(1, "c", "insert", 0), change(2, "b", "update", 5), change(2, "a", "update", 5), (3, "a", "1", "update", None), change(3, "b", "update", 0)]
    for r in (rows, rows[::-1]):
        changes = spark.createDataFrame(r, CHANGE)
        got = sorted((g.customer_id, g.risk_segment) for g in scd2.latest(changes).collect())
        assert got == [(1, "b"), (2, "a"), (3, "b")]
        now = {(g.customer_id, g.risk_segment) for g in scd2.full_history(changes.filter("change_ts is not null")).collect() if g.is_current}
        assert now == set(got)
    con = duckdb.connect()
    con.execute("create table C (customer_id bigint, risk_segment varchar, home_country varchar, op_type varchar, change_ts timestamp)")
    con.executemany("insert into C values (?, ?, ?, ?, ?)", rows)
    last = ORACLE_SQL["latest_per_customer"][ORACLE_SQL["latest_per_customer"].rindex("select") :]
    assert {(1, "b"), (3, "b")} < {r[:2] for r in con.execute(last).fetchall()}


def test_surrogate_keys_of_changes_at_one_time_are_the_same_in_any_order(spark):
    rows = [change(1, "a", "insert", 0), change(1, "b", "update", 5), change(1, "a", "update", 5), change(2, "a", "update", 0)]
    want = [(1, 0, 1), (1, 5, 2), (1, 5, 3), (2, 0, 4)]
    for r in (rows, rows[::-1]):
        dim = scd2.full_history(spark.createDataFrame(r, CHANGE)).select("customer_id", "effective_start")
        got = scd2.numbered(dim, ["customer_id", "effective_start"], "sk").collect()
        assert sorted((g.customer_id, (g.effective_start - T0).seconds // 60, g.sk) for g in got) == want


@pytest.mark.parametrize("name", ["scd2_full_history", "scd2_surrogate_keys"])
def test_undated_changes_against_sql(spark, tmp_path, name):
    assert oracle.compare(spark, name, QUERIES[name], ORACLE_SQL[name], undated(tmp_path)) > 0


def test_stale_update_after_delete_is_dropped(spark):
    got = history(spark, [change(1, "a", "insert", 0)], [change(1, "a", "delete", 10)], [change(1, "b", "update", 5)])
    assert [(r[1], r[3]) for r in got] == [("a", False)]


def test_replay_of_a_batch_changes_nothing(spark):
    first, second = [change(1, "a", "insert", 0)], [change(1, "b", "update", 5), change(2, "c", "update", 5)]
    assert history(spark, first, second) == history(spark, first, second, second)


@pytest.mark.parametrize("run", [lambda t, s: merge.insert_only(t, s, ["k"]), lambda t, s: merge.upsert(t, s, ["k"]), lambda t, s: merge.update_only(t, s, ["k"], ["v"])])
def test_several_source_rows_for_a_key_are_an_error(spark, run):
    target, source = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), spark.createDataFrame([(1, 3.0), (3, 4.0)], "k int, v double")
    assert run(target, source).count() >= 2
    with pytest.raises(Exception, match="several source rows"):
        run(target, source.union(source)).collect()


def test_update_only_takes_nulls(spark):
    target, source = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), spark.createDataFrame([(1, None)], "k int, v double")
    assert sorted(map(tuple, merge.update_only(target, source, ["k"], ["v"]).collect())) == [(1, None), (2, 2.0)]


@pytest.mark.parametrize(
    ("row", "kind", "detail"),
    [
        ((None, None, None, None, None, None, None), "parse_error", "raw payload present but all typed fields null"),
        (("t", "c", 1, None, T0, "insert", T0), "schema_violation", "channel missing"),
        (("t", "c", None, None, T0, "insert", T0), "schema_violation", "amount null"),
        (("t", " ", 1, "wire", T0, "insert", T0), "enum_violation", "customer_id empty"),
        (("t", "c", 1, "ACH", T0, "insert", T0), "enum_violation", "channel not allowed: ACH"),
        (("t", "c", 1, "ach", T0, "delete", None), "schema_violation", "change_ts missing for op_type delete"),
        (("t", " ", 1, "ach", T0, "insert", T0), "null_check", "customer_id empty"),
        (("t", "c", 1, "ach", T0, "insert", T0), None, None),
    ],
)
def test_classifier(spark, row, kind, detail):
    df = spark.createDataFrame([(*row, "raw")], "transaction_id string, customer_id string, amount int, channel string, txn_ts timestamp_ntz, op_type string, change_ts timestamp_ntz, _raw_payload string")
    got = quality.classify(df).first()
    assert (got._error_type, got._error_detail) == (kind, detail)


def test_rolling_across_spans_and_point_in_time_against_plain_loops(spark):
    r = random.Random(4)
    rows = [(i, r.randint(1, 3), T0 + dt.timedelta(hours=r.randint(0, 24 * 400)), float(r.randint(1, 50))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, customer_id long, txn_ts timestamp_ntz, amount double")
    for x in features.rolling(df, span=2 * features.MONTH).collect():
        month = [a for _, k, t, a in rows if k == x.customer_id and dt.timedelta() <= x.txn_ts - t <= dt.timedelta(days=30)]
        hour = [1 for _, k, t, _ in rows if k == x.customer_id and dt.timedelta() <= x.txn_ts - t <= dt.timedelta(hours=1)]
        assert (x.txn_count_1h, x.amount_mean_30d) == (len(hour), pytest.approx(sum(month) / len(month)))
    versions = [(1, "a", 10, 20), (1, "b", 30, 100), (1, "c", 100, None), (2, "d", 50, 60)]
    day = lambda n: None if n is None else T0 + dt.timedelta(days=n)
    dim = spark.createDataFrame([(k, s, day(a), day(b)) for k, s, a, b in versions], "customer_id long, risk_segment string, effective_start timestamp_ntz, effective_end timestamp_ntz")
    first = {k: min(a for q, _, a, _ in versions if q == k) for k in (1, 2)}
    got = features.point_in_time(df, dim).collect()
    assert len(got) == len(rows)
    for x in got:
        valid = [(s, day(a)) for k, s, a, b in versions if k == x.customer_id and (a == first[k] or x.txn_ts >= day(a)) and (b is None or x.txn_ts < day(b))]
        assert [(x.risk_segment, x.version_start)] == (valid or [(None, None)])


def test_store_versions_and_batches(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    assert not store.exists("t")
    assert store.write("t", spark.range(3), append=True, app="a", batch=0)
    assert not store.write("t", spark.range(3), append=True, app="a", batch=0)
    assert store.write("t", spark.range(2), append=True, app="a", batch=1)
    assert (store.read("t").count(), store.read("t", version=1).count()) == (5, 3)
    store.write("t", spark.range(1))
    assert store.read("t").count() == 1


def test_retry_sleeps_and_raises():
    slept, calls = [], []

    def land(df, batch):
        calls.append(batch)
        raise OSError

    with pytest.raises(OSError):
        bronze.retrying(land, retries=3, sleep=slept.append)(None, 7)
    assert (slept, len(calls)) == ([2, 4, 8], 4)


def test_tags_survive_parquet(spark, tmp_path):
    df = governance.tagged(spark.range(1).withColumn("x", F.lit(1)), {"x": {"class": "pii"}})
    df.write.parquet(f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").schema["x"].metadata["class"] == "pii"
