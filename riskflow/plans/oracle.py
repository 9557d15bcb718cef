"""The same queries in SQL, written independently of the operators."""

from __future__ import annotations

MID = "TIMESTAMP '2024-01-16 00:00:00'"

CTES = {
    "T": """select cast(event_id as varchar) transaction_id, user_id customer_id, cast(value*100 as decimal(12,2)) amount,
 case when event_type in ('click','view') then 'ach' when event_type in ('purchase','signup') then 'fednow' else 'wire' end channel,
 ts txn_ts, ts - to_seconds(k % 91) change_ts, case when k%20<16 then 'insert' when k%20<19 then 'update' else 'delete' end op_type,
 k%5=0 is_new_payee, k<3 is_fraud, cast(k%25 as varchar) geo_country, event_id id
 from (select *, cast(json_extract_string(props,'$.k') as int) k from events)""",
    "S": "select cast(event_id as varchar) transaction_id, case when k%37<>0 then least(1.0, greatest(0.0, k/100.0))::double end score from (select *, cast(json_extract_string(props,'$.k') as int) k from events)",
    "B0": """select case when d in (0,9) then null else transaction_id end transaction_id,
 case when d=0 then null when d=5 then '  ' else cast(customer_id as varchar) end customer_id,
 case when d in (0,2) then null when d=3 then -5.00 when d=4 then 20000000.00 else amount end::decimal(12,2) amount,
 case when d in (0,1) then null else channel end channel, case when d=0 then null else txn_ts end txn_ts,
 case when d in (0,7) then null when d=8 then 'upsert' else op_type end op_type, case when d in (0,6) then null else change_ts end change_ts,
 case when d=0 then null else is_fraud end is_fraud, cast(customer_id%4 as int) _partition, id _offset from (select *, id % 23 d from T)""",
    "B": "select * from B0 union all select * replace (_offset + 1000000000 as _offset) from B0 where _offset % 50 = 0",
    "Q": """select *, case when transaction_id is null and customer_id is null and amount is null and txn_ts is null then 'parse_error'
 when op_type is null or change_ts is null or channel is null or amount>10000000 or amount<=0 then 'schema_violation'
 when transaction_id is null or customer_id is null or amount is null or txn_ts is null then 'null_check'
 when channel not in ('fednow','ach') or op_type not in ('insert','update','delete') then 'enum_violation'
 when trim(customer_id)='' then 'null_check' end error_type,
 case when transaction_id is null and customer_id is null and amount is null and txn_ts is null then 'raw payload present but all typed fields null'
 when op_type is null then 'op_type missing' when change_ts is null and op_type in ('update','delete') then 'change_ts missing for op_type ' || op_type
 when change_ts is null then 'change_ts missing' when amount>10000000 then 'amount exceeds ceiling: ' || cast(amount as varchar)
 when amount<=0 then 'amount not positive: ' || cast(amount as varchar) when transaction_id is null then 'transaction_id null'
 when customer_id is null then 'customer_id null' when trim(customer_id)='' then 'customer_id empty' when amount is null then 'amount null'
 when txn_ts is null then 'txn_ts null' when channel not in ('fednow','ach') then 'channel not allowed: ' || channel
 when op_type not in ('insert','update','delete') then 'op_type not allowed: ' || op_type when channel is null then 'channel missing' end error_detail from B""",
    "V": "select transaction_id, customer_id, amount, channel, txn_ts, op_type, change_ts, is_fraud from Q where error_type is null qualify row_number() over (partition by transaction_id, change_ts order by _partition, _offset)=1",
    "C": """select o_custkey customer_id, case when o_orderpriority[1] in ('1','2') then 'high' when o_orderpriority[1]='3' then 'medium' else 'low' end risk_segment,
 cast(c_nationkey as varchar) home_country, case when o_orderkey%20<16 then 'update' when o_orderkey%20<19 then 'insert' else 'delete' end op_type,
 TIMESTAMP '2024-01-01 00:00:00' + to_seconds(date_diff('day', DATE '1995-01-01', cast(o_orderdate as date))*1080 + o_orderkey%1080) change_ts
 from orders join customer on o_custkey=c_custkey""",
    "D": """select customer_id, risk_segment, home_country, change_ts effective_start, effective_end, effective_end is null is_current from (
 select *, lead(change_ts) over (partition by customer_id order by change_ts) effective_end from (
 select *, lag(risk_segment) over w seg, lag(op_type) over w op from C window w as (partition by customer_id order by change_ts))
 where seg is null or seg<>risk_segment or op_type='delete' or op='delete') where op_type<>'delete'""",
    "L1": f"select * from C where change_ts < {MID} qualify row_number() over (partition by customer_id order by change_ts desc, op_type)=1",
    "F1": "select customer_id, risk_segment, home_country, change_ts effective_start, cast(null as timestamp) effective_end, true is_current from L1 where op_type='insert'",
    "L2": f"select * from C where change_ts >= {MID} qualify row_number() over (partition by customer_id order by change_ts desc, op_type)=1",
    "E2": """select L2.* from L2 left join F1 using (customer_id) where (F1.customer_id is null and L2.op_type<>'delete')
 or (F1.customer_id is not null and L2.change_ts>F1.effective_start and (L2.op_type='delete' or L2.risk_segment is distinct from F1.risk_segment or L2.home_country is distinct from F1.home_country))""",
    "F2": """select F1.customer_id, F1.risk_segment, F1.home_country, F1.effective_start, E2.change_ts effective_end, E2.customer_id is null is_current from F1 left join E2 using (customer_id)
 union all select customer_id, risk_segment, home_country, change_ts, null, true from E2 where op_type<>'delete'""",
    "J": "select T.*, d.risk_segment, d.home_country from T left join (select * from D where is_current) d using (customer_id)",
    "W": """select *, epoch(date_trunc('second', txn_ts))::bigint sec from T""",
    "R": """select *, case when amount_std_30d>0 then (amount::double-amount_mean_30d)/amount_std_30d else 0.0 end amount_zscore_30d, txn_count_1h::double velocity_score from (
 select *, count(*) over (partition by customer_id order by sec range between 3600 preceding and current row) txn_count_1h,
 avg(amount::double) over (partition by customer_id order by sec range between 2592000 preceding and current row) amount_mean_30d,
 stddev_samp(amount::double) over (partition by customer_id order by sec range between 2592000 preceding and current row) amount_std_30d from W)""",
    "P": """select T.transaction_id, d.risk_segment, d.effective_start version_start from T left join (select *, case when effective_start=min(effective_start) over (partition by customer_id) then TIMESTAMP '1900-01-01' else effective_start end f from D) d
 on T.customer_id=d.customer_id and T.txn_ts>=d.f and (T.txn_ts<d.effective_end or d.effective_end is null)""",
    "I": "select J.*, hour(txn_ts)::bigint txn_hour, amount>=10000 is_high_value, home_country is not null and geo_country<>home_country is_cross_border from J",
    "M": """select md5(R.transaction_id || '|' || cast(R.change_ts as varchar)) transaction_health_sk, R.transaction_id, R.change_ts, R.customer_id, P.risk_segment, R.amount, R.txn_ts, R.channel, R.geo_country, I.is_cross_border,
 I.txn_hour, I.is_high_value, R.txn_count_1h, R.amount_zscore_30d, R.velocity_score, R.amount::double - avg(R.amount::double) over (partition by P.risk_segment) peer_deviation_raw,
 round(least(1.0, greatest(0.0, 0.5*abs(R.amount_zscore_30d)/3.0 + 0.5*case when I.is_high_value then 1.0 else 0.0 end)),4)::double risk_score, S.score model_distress_score
 from R join P using (transaction_id) join I using (transaction_id) join S using (transaction_id)""",
    "A": "select T.transaction_id, max(T.is_fraud::int) actual_fraud from T where T.id % 2 = 0 group by 1",
    "K": "select transaction_id, is_fraud, cast((row_number() over (partition by is_fraud, md5(transaction_id)[1:2] order by md5(transaction_id)) - 1) % 5 as int) fold from T",
    "O": "select R.*, J.risk_segment from R join J using (transaction_id) qualify row_number() over (partition by R.customer_id order by R.txn_ts desc, R.transaction_id desc)=1",
    "Z": "select is_fraud::int y, round(coalesce(abs(amount_zscore_30d), 0.0), 9) p, txn_ts, velocity_score, amount::double amount from R",
    "SN": """select c_custkey customer_id, c_mktsegment risk_segment, cast(c_nationkey as varchar) home_country from customer""",
}
ORDER = list(CTES)
NEEDS = {"S": "", "B0": "T", "B": "B0", "Q": "B", "V": "Q", "D": "C", "L1": "C", "F1": "L1", "L2": "C", "E2": "L2 F1", "F2": "F1 E2", "J": "T D", "W": "T", "R": "W", "P": "T D", "I": "J", "M": "R P I S", "A": "T", "K": "T", "O": "R J", "Z": "R"}


def _with(names: str, sql: str) -> str:
    need, todo = set(), names.split()
    while todo:
        n = todo.pop()
        if n not in need:
            need.add(n)
            todo += NEEDS.get(n, "").split()
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in ORDER if n in need) + " " + sql


def _psi(column: str) -> str:
    steps = ",".join(str(i / 10) for i in range(11))
    return _with(
        "Z",
        f""", vv as (select {column}::double v, txn_ts < {MID} r from Z), ee as (select list_sort(list_distinct(list_transform(quantile_cont(v, [{steps}]), lambda x: round(x,6)))) e from vv where r),
 bb as (select least(len(list_filter(e, lambda x: x <= v)), len(e)-1) bin, r from vv, ee where v>=e[1] and v<=e[len(e)] and len(e)>1),
 n as (select bin, count(*) filter (r) nr, count(*) filter (not r) nc from bb group by 1), tt as (select greatest(sum(nr), 1) tr, greatest(sum(nc), 1) tc from n),
 g as (select unnest(range(1, greatest(1, len(e)))) bin from ee),
 x as (select greatest(coalesce(nr,0)/tr::double, 1e-6) a, greatest(coalesce(nc,0)/tc::double, 1e-6) c from g left join n using (bin), tt)
 select round(coalesce(sum((c-a)*ln(c/a)),0.0),4) psi from x""",
    )


def _snapshot(where: str) -> str:
    new = f"select customer_id, case when customer_id%7=0 then 'CHANGED' when customer_id%11=0 then null else risk_segment end risk_segment, home_country from SN {where}"
    return _with(
        "SN",
        f""", live as (select * from SN where customer_id%10<>9), new as ({new}),
 x as (select live.customer_id lk, live.risk_segment lr, live.home_country lh, new.customer_id nk, new.risk_segment nr, new.home_country nh from live full join new on live.customer_id=new.customer_id),
 o as (select lk customer_id, lr risk_segment, lh home_country, TIMESTAMP '2024-01-01' valid_from, case when nk is null or lr is distinct from nr or lh is distinct from nh then TIMESTAMP '2024-02-01' end valid_to from x where lk is not null
 union all select nk, nr, nh, TIMESTAMP '2024-02-01', null from x where nk is not null and (lk is null or lr is distinct from nr or lh is distinct from nh))
 select *, md5(cast(customer_id as varchar) || '|' || cast(valid_from as varchar)) scd_id from o""",
    )


ORACLE_SQL = {
    "bronze_decode": _with("B", "select * from B"),
    "dq_classify": _with("Q", "select _partition, _offset, error_type, error_detail from Q"),
    "dq_detail_summary": _with("Q", "select error_type, error_detail, count(*) n from Q group by 1,2"),
    "dq_split_counts": _with("Q", "select count(*) filter (error_type is null) passed, count(*) filter (error_type is not null) failed from Q"),
    "dq_deadletter": _with("Q", "select transaction_id, error_type, error_detail, _partition, _offset from Q where error_type is not null"),
    "reconcile_counts": _with("Q V", "select count(*) bronze, count(*) filter (error_type is not null) rejected, count(*) filter (error_type is null) passed, (select count(*) from V) silver from Q"),
    "silver_merge_insert_only": _with("V", "select * from V where transaction_id::bigint%2=0 union all select * from V a where not exists (select 1 from V b where b.transaction_id=a.transaction_id and b.change_ts=a.change_ts and b.transaction_id::bigint%2=0)"),
    "silver_merge_replay_noop": _with("V", "select * from V"),
    "latest_per_customer": _with("C", "select * from C qualify row_number() over (partition by customer_id order by change_ts desc, op_type)=1"),
    "scd2_apply_first": _with("F1", "select * from F1"),
    "scd2_apply_second": _with("F2", "select * from F2"),
    "scd2_full_history": _with("D", "select * from D"),
    "scd2_surrogate_keys": _with("D", "select customer_id, effective_start, row_number() over (order by customer_id, effective_start) customer_sk from D"),
    "scd2_invariants": _with("F2", """select 'several_current' "check", count(*) failures from (select customer_id from F2 where is_current group by 1 having count(*)>1)
 union all select 'overlap', count(*) from F2 a join F2 b on a.customer_id=b.customer_id and a.effective_start<b.effective_start and b.effective_start<coalesce(a.effective_end, TIMESTAMP '9999-01-01')
 union all select 'empty_interval', count(*) from F2 where effective_end<=effective_start"""),
    "snapshot_check": _snapshot(""),
    "snapshot_hard_delete": _snapshot("where customer_id%5<>0"),
    "gold_current_dim_join": _with("J", "select transaction_id, customer_id, risk_segment, home_country from J"),
    "rolling_features": _with("R", "select transaction_id, txn_count_1h, round(amount_mean_30d,4) amount_mean_30d, round(amount_std_30d,4) amount_std_30d, round(amount_zscore_30d,4) amount_zscore_30d, velocity_score from R"),
    "rolling_features_ties": """with w as (select *, epoch(date_trunc('second', l_shipdate))::bigint sec from lineitem), x as (select l_suppkey,
 count(*) over (partition by l_suppkey order by sec range between 3600 preceding and current row) n, avg(l_quantity) over (partition by l_suppkey order by sec range between 2592000 preceding and current row) m,
 stddev_samp(l_quantity) over (partition by l_suppkey order by sec range between 2592000 preceding and current row) s from w)
 select l_suppkey, sum(n)::bigint sum_count, round(sum(m),2) sum_mean, count(s) n_std from x group by 1""",
    "peer_benchmark_z": _with("J", """, g as (select risk_segment, avg(amount::double) m, stddev_samp(amount::double) s from J group by 1)
 select transaction_id, J.risk_segment, round(case when s>0 then (amount::double-m)/s else 0.0 end,4) peer_deviation from J left join g on J.risk_segment=g.risk_segment"""),
    "peer_deviation_raw": _with("J", "select transaction_id, risk_segment, round(amount::double - avg(amount::double) over (partition by risk_segment),4) peer_deviation_raw from J"),
    "gold_enriched": _with("J R", """, g as (select risk_segment, avg(amount::double) m, stddev_samp(amount::double) s from J group by 1)
 select R.transaction_id, R.customer_id, J.risk_segment, R.channel, R.amount::double amount, R.txn_ts, R.is_fraud, txn_count_1h, round(amount_mean_30d,4) amount_mean_30d, round(amount_std_30d,4) amount_std_30d, round(amount_zscore_30d,4) amount_zscore_30d, velocity_score,
 round(case when s>0 then (R.amount::double-m)/s else 0.0 end,4) peer_deviation from R join J using (transaction_id) left join g on J.risk_segment=g.risk_segment"""),
    "stg_transactions": _with("Q", "select transaction_id, customer_id, amount::double amount, lower(channel) channel, txn_ts, op_type, change_ts, _offset from Q where error_type is null"),
    "int_trends": _with("I", "select transaction_id, customer_id, risk_segment, geo_country, is_new_payee, txn_hour, is_high_value, is_cross_border, is_fraud from I"),
    "pit_join": _with("P", "select * from P"),
    "pit_join_summary": _with("P", "select risk_segment, count(*) n, count(*) filter (version_start is null) without_version from P group by 1"),
    "mart_health": _with("M", "select transaction_health_sk, transaction_id, change_ts, customer_id, risk_segment, amount::double amount, txn_ts, channel, geo_country, is_cross_border, txn_hour, is_high_value, txn_count_1h, round(amount_zscore_30d,4) amount_zscore_30d, velocity_score, round(peer_deviation_raw,4) peer_deviation_raw, null::double model_distress_score from M"),
    "mart_risk_score": _with("M", "select transaction_id, risk_score from M"),
    "int_incremental_upsert": _with("I", f"select transaction_id, change_ts, txn_ts, case when id%3>0 then is_high_value end is_high_value from I where id%3>0 or txn_ts<{MID}"),
    "mart_incremental_equals_rebuild": _with("R", "select transaction_id, txn_ts, txn_count_1h, round(amount_mean_30d,4) amount_mean_30d, round(amount_std_30d,4) amount_std_30d from R"),
    "labels_promoted": _with("A", "select * from A"),
    "alert_queue_top20": _with("M", "select transaction_id, customer_id, amount::double amount, channel, geo_country, risk_segment, is_cross_border, round(model_distress_score,4) fraud_score from M order by model_distress_score desc nulls last, transaction_id::bigint limit 20"),
    "sar_candidates": _with("M", "select transaction_id, customer_id, amount::double amount, channel, geo_country, is_cross_border, txn_count_1h, round(velocity_score,4) velocity_score, round(amount_zscore_30d,4) amount_zscore_30d, round(model_distress_score,4) fraud_score from M where model_distress_score>=0.5"),
    "confusion_matrix": _with("A S", """, x as (select case when score>=0.5 then 1 else 0 end p, actual_fraud a from S join A using (transaction_id))
 select count(*) filter (p=1 and a=1) true_positive, count(*) filter (p=1 and a=0) false_positive, count(*) filter (p=0 and a=1) false_negative, count(*) filter (p=0 and a=0) true_negative, count(*) rows_evaluated,
 round(count(*) filter (p=1 and a=1)/nullif(sum(p),0)::double,4) "precision", round(count(*) filter (p=1 and a=1)/nullif(sum(a),0)::double,4) recall from x"""),
    "score_bands": _with("S", "select case " + " ".join(f"when score<{(i + 1) / 10} then '{i / 10}-{(i + 1) / 10}'" for i in range(9)) + " else '0.9-1.0' end score_band, count(*) txn_count from S group by 1"),
    "geo_cross_border": _with("M", "select geo_country, is_cross_border, count(*) txn_count, sum(amount)::double total_amount, round(sum(round(model_distress_score*1000000)::bigint)::bigint/count(model_distress_score)::double/1000000.0,4) avg_fraud_score, count(*) filter (model_distress_score>=0.5) flagged_count from M group by 1,2"),
    "row_policy_restricted": _with("P", "select * from P where risk_segment<>'high'"),
    "row_policy_privileged": _with("P", "select * from P"),
    "class_balance": _with("T", "select count(*) filter (is_fraud) pos, count(*) filter (not is_fraud) neg, round(coalesce(count(*) filter (not is_fraud)/nullif(count(*) filter (is_fraud),0)::double,1.0),4) scale_pos_weight from T"),
    "stratified_folds": _with("K", "select * from K"),
    "stratified_split": _with("K", "select transaction_id, fold=0 held_out from K"),
    "feature_matrix_onehot": _with("R J", "select R.transaction_id, txn_count_1h, " + ", ".join([f"(R.channel='{v}')::int channel_{v}" for v in ("ach", "fednow")] + [f"(coalesce(J.risk_segment,'unknown')='{v}')::int risk_segment_{v}" for v in ("high", "low", "medium", "unknown")]) + " from R join J using (transaction_id)"),
    "online_features_latest": _with("O", "select customer_id, round(amount_zscore_30d,4) amount_zscore_30d, txn_count_1h, velocity_score, coalesce(risk_segment,'unknown') risk_segment from O"),
    "online_score_lookup": _with("O", ", x as (select c_custkey customer_id, round(least(1.0, case when O.customer_id is not null then abs(amount_zscore_30d)/3.0 end),4)::double s, O.customer_id k from customer left join O on c_custkey=O.customer_id) select customer_id, case when k is not null then s end score, case when k is null then 'no_features' else 'ok' end status, case when k is null then null when s>=0.5 then 'review' else 'pass' end decision from x"),
    "score_writeback_update_only": _with("S", "select transaction_id, round(score,4) model_distress_score from S"),
    "auc_heuristic": _with("Z", ", rk as (select y, rank() over (order by p) + (count(*) over (partition by p) - 1)/2.0 k from Z) select round((sum(k) filter (y=1) - count(*) filter (y=1)*(count(*) filter (y=1)+1)/2.0)/nullif((count(*) filter (y=1))*(count(*) filter (y=0)),0)::double,4)::double auc from rk"),
    "psi_amount": _psi("amount"),
    "psi_velocity": _psi("velocity_score"),
    "latency_percentiles": "with x as (select value, row_number() over (order by value) - 1 i, count(*) over () n from events) select " + ", ".join(f"min(value) filter (i = round_even({p}*(n-1), 0)) p{round(p * 100)}" for p in (0.5, 0.95, 0.99)) + ", max(value) \"max\" from x",
    "dq_tests": _with("M", """select 'not_null:transaction_health_sk' test, count(*) filter (transaction_health_sk is null) failures from M union all select 'not_null:is_high_value', count(*) filter (is_high_value is null) from M
 union all select 'not_null:risk_score', count(*) filter (risk_score is null) from M union all select 'accepted:channel', count(*) filter (channel not in ('ach','fednow')) from M
 union all select 'unique:transaction_health_sk', count(*) from (select 1 from M group by transaction_health_sk having count(*)>1)"""),
    "stream_bronze_counts": _with("B", "select _partition, count(*) n, count(transaction_id) with_id from B group by 1"),
    "stream_replay_noop": _with("B", "select _partition, count(*) n from B group by 1"),
    "clustering_layout": _with("V", "select transaction_id, customer_id, op_type from V"),
    "column_tags": """select * from (values ('fct_transaction_health','customer_id','pii','true'),
 ('fct_transaction_health','customer_id','classification','identifier'),
 ('fct_transaction_health','model_distress_score','data_class','model-output'),
 ('fct_transaction_health','model_distress_score','model','fraud_classifier'),
 ('fct_transaction_health','risk_score','data_class','derived-heuristic'),
 ('fct_transaction_health','risk_segment','data_class','sensitive'),
 ('dim_customers_snapshot','customer_id','pii','true'),
 ('dim_customers_snapshot','customer_id','classification','identifier'),
 ('dim_customers_snapshot','home_country','pii','true'),
 ('dim_customers_snapshot','home_country','classification','location'),
 ('dim_customers_snapshot','account_open_date','pii','true'),
 ('dim_customers_snapshot','account_open_date','classification','account-metadata')) t(table_name, column_name, tag, value)""",
    "flow_counts": _with("Q V C T", """select 'silver' stage, 'rows_in' metric, count(*) n from Q union all select 'silver', 'rows_passed', count(*) from Q where error_type is null union all select 'silver', 'rows_deadlettered', count(*) from Q where error_type is not null
 union all select 'history', 'changes_in', count(*) from C union all select 'history', 'versions', count(*) from (select * from C qualify row_number() over (partition by customer_id order by change_ts desc, op_type)=1) where op_type='insert' union all select 'history', 'versions_before', 0
 union all select 'gold', 'rows_out', count(*) from T union all select 'mart', 'rows_out', count(*) from T union all select 'maintain', 'silver', count(*) from V union all select 'maintain', 'gold', count(*) from T"""),
    "kv_features": _with("O J", """, g as (select risk_segment, avg(amount::double) m, stddev_samp(amount::double) s from J group by 1),
 kv as (select O.customer_id k, amount_zscore_30d z, txn_count_1h::double n, velocity_score v, case when O.customer_id%3=0 then 0.0 when s>0 then (amount::double-m)/s else 0.0 end p, coalesce(O.risk_segment,'unknown') r from O left join g on O.risk_segment=g.risk_segment)
 select c_custkey customer_id, round(z,4) amount_zscore_30d, n txn_count_1h, v velocity_score, round(p,4)::double peer_deviation, r risk_segment from customer left join kv on c_custkey=k"""),
    "writeback_stats": _with("S T", "select count(*) rows_scored, count(score) non_null_after, round(sum(score),6)::double score_checksum from S join T using (transaction_id)"),
    "generated_events": """with x as (select range id from range(500)), u as (select id, list_transform(['customer','amount','channel','op','lag','payee','fraud'], lambda f: ('0x' || md5(id::varchar || ':' || f)[1:8])::bigint) u from x)
 select md5(id::varchar) transaction_id, 'CU' || lpad((u[1]%50)::varchar,5,'0') customer_id, ((100+u[2]%499901)/100.0)::decimal(12,2)::double amount, case when u[3]<2147483648 then 'fednow' else 'ach' end channel,
 timestamp '2024-01-01' + to_seconds(id) txn_ts, case when u[4]<3435973836 then 'insert' when u[4]<4080218931 then 'update' else 'delete' end op_type, u[6]<858993459 is_new_payee, u[7]<128849018 is_fraud, timestamp '2024-01-01' + to_seconds(id - u[5]%91) change_ts from u""",
}
ORACLE_SQL["promotion_gate"] = f"select auc cv_auc, 0.5::double heuristic_auc, coalesce(auc>=0.6 and auc>0.5, false) promoted from ({ORACLE_SQL['auc_heuristic']})"
ORACLE_SQL |= {"deadletter_sink": ORACLE_SQL["dq_deadletter"], "silver_sink": ORACLE_SQL["silver_merge_replay_noop"], "clustered_table": ORACLE_SQL["clustering_layout"], "labels_table": ORACLE_SQL["labels_promoted"], "gold_untuned": ORACLE_SQL["gold_enriched"], "row_policy_session": ORACLE_SQL["row_policy_restricted"]}
