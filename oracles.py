"""The same queries as ANSI SQL, written independently of the Spark plans."""

from __future__ import annotations

from tidewatch.schemas import PORTAL_FEATURES, QUICK_PORTAL, QUICK_TRADE, STORE_FEATURES, TRADE_FEATURES


def r(x: str, n: int) -> str:
    return f"cast(round_even(cast({x} as decimal(38,10)), {n}) as double)"


PORTAL = """
portal as (
  select cast(event_id as varchar) as event_id, user_id, ts,
    case when event_type in ('view','error') then 'login' when event_type = 'purchase' then 'deposit'
         when event_type = 'click' and value >= 1 then 'withdrawal' when event_type = 'click' then 'support_ticket'
         when event_type = 'signup' then 'kyc_change' end as kind,
    cast(json_extract_string(props, '$.k') as int) as k,
    case when event_type = 'purchase' or (event_type = 'click' and value >= 1) then value end as amount,
    case when event_type = 'error' then 'failed' else 'success' end as status,
    (event_type = 'error' and value > 260) as flag
  from events)"""

TRADE = """
trade as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice*100) as bigint)) as trade_id,
    o_custkey as user_id, p_type as instrument, l_quantity as lot, l_shipdate as open_ts,
    case when l_returnflag = 'R' then 'sell' else 'buy' end as direction,
    10 * l_tax * l_linenumber as dur, l_extendedprice * (l_discount - 0.05) as pnl,
    l_extendedprice * l_tax as margin, (l_quantity > 49 and l_discount > 0.09) as flag
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)"""


def burst(hours: int = 24) -> str:
    return f"""
burst as (
  select a.user_id, a.ts, count(distinct b.k) as n
  from portal a join portal b on a.user_id = b.user_id and b.kind = 'login'
    and b.ts between a.ts and a.ts + interval {hours} hour
  where a.kind = 'login' group by a.user_id, a.ts)"""


def kyc(hours: int = 24) -> str:
    return f"""
kyc as (
  select w.user_id, w.ts, w.event_id, w.amount, count(b.ts) as n
  from portal w left join portal b on w.user_id = b.user_id and b.kind = 'kyc_change'
    and b.ts between w.ts - interval {hours} hour and w.ts
  where w.kind = 'withdrawal' group by all)"""


GAPS = """
gaps as (
  select user_id, avg(epoch_us(ts) - epoch_us(prev)) / 60000000.0 as gap_min
  from (select user_id, ts, lag(ts) over (partition by user_id order by ts) as prev from portal where kind = 'login')
  group by user_id)"""

ENTROPY = """
ent as (
  select user_id, count(*) as distinct_k, case when count(*) > 1 then -sum(p * ln(p)) else 0.0 end as entropy
  from (select user_id, k, count(*) * 1.0 / sum(count(*)) over (partition by user_id) as p
        from portal where kind = 'login' and k is not null group by user_id, k) group by user_id)"""

_P_DIGITS = {
    "failed_login_ratio": 4, "ip_entropy": 4, "login_hour_mean": 2, "login_hour_std": 2,
    "pct_night_logins": 4, "inter_login_min": 2, "total_deposits": 2, "total_withdrawals": 2,
    "mean_deposit_amt": 2, "mean_withdrawal_amt": 2, "max_deposit_amt": 2, "max_withdrawal_amt": 2,
    "deposit_withdraw_ratio": 4}
_T_DIGITS = {c: 4 for c in TRADE_FEATURES if c not in (
    "total_trades", "consecutive_wins_max", "unique_instruments", "rolling_7d_trades")}
_T_DIGITS.update({c: 2 for c in (
    "total_lot_size", "max_lot_size", "total_pnl", "max_single_win", "max_single_loss",
    "mean_margin_used", "max_margin_used", "rolling_7d_pnl", "rolling_7d_lot_size")})


def _finish(names: list[str], digits: dict[str, int]) -> str:
    return ", ".join(f"{r(c, digits[c])} as {c}" if c in digits else f"cast({c} as bigint) as {c}"
                     for c in names)


PORTAL_RAW = """
portal_raw as (
  select user_id,
    count(*) filter (kind = 'login') as total_logins,
    count(*) filter (kind = 'login' and status = 'failed') / greatest(count(*) filter (kind = 'login'), 1) as failed_login_ratio,
    count(distinct k) filter (kind = 'login') as unique_ips,
    count(distinct k % 20) filter (kind = 'login') as unique_devices,
    count(distinct k % 10) filter (kind = 'login') as unique_countries,
    coalesce(avg(hour(ts)) filter (kind = 'login'), 0) as login_hour_mean,
    coalesce(stddev_samp(hour(ts)) filter (kind = 'login'), 0) as login_hour_std,
    coalesce(avg(case when hour(ts) <= 5 then 1.0 else 0.0 end) filter (kind = 'login'), 0) as pct_night_logins,
    coalesce(sum(amount) filter (kind = 'deposit'), 0) as total_deposits,
    coalesce(sum(amount) filter (kind = 'withdrawal'), 0) as total_withdrawals,
    count(amount) filter (kind = 'deposit') as deposit_count,
    count(amount) filter (kind = 'withdrawal') as withdrawal_count,
    coalesce(avg(amount) filter (kind = 'deposit'), 0) as mean_deposit_amt,
    coalesce(avg(amount) filter (kind = 'withdrawal'), 0) as mean_withdrawal_amt,
    coalesce(max(amount) filter (kind = 'deposit'), 0) as max_deposit_amt,
    coalesce(max(amount) filter (kind = 'withdrawal'), 0) as max_withdrawal_amt,
    coalesce(sum(amount) filter (kind = 'withdrawal'), 0)
      / greatest(coalesce(sum(amount) filter (kind = 'deposit'), 0), 1) as deposit_withdraw_ratio,
    count(*) filter (kind = 'deposit' and amount < 500) as structuring_score,
    count(*) filter (kind = 'kyc_change') as kyc_change_count,
    count(*) filter (kind = 'login' and ts >= last_ts - interval 7 day) as rolling_7d_logins,
    count(*) filter (kind = 'deposit' and ts >= last_ts - interval 7 day) as rolling_7d_deposits,
    count(*) filter (kind = 'withdrawal' and ts >= last_ts - interval 7 day) as rolling_7d_withdrawals,
    count(*) filter (kind = 'support_ticket') as support_ticket_count,
    bool_or(flag) as is_anomalous
  from (select *, max(ts) over (partition by user_id) as last_ts from portal) group by user_id)"""

PORTAL_FEAT = f"""
portal_feat as (
  select user_id, {_finish(PORTAL_FEATURES, _P_DIGITS)}, is_anomalous
  from (select p.*, coalesce(e.entropy, 0) as ip_entropy, coalesce(g.gap_min, 0) as inter_login_min,
          coalesce(b.m, 0) as max_ips_in_1h, coalesce(k.m, 0) as kyc_before_withdrawal
        from portal_raw p left join ent e using (user_id) left join gaps g using (user_id)
        left join (select user_id, greatest(max(n), 1) as m from burst group by user_id) b using (user_id)
        left join (select user_id, max(case when n >= 3 then 1 else 0 end) as m from kyc group by user_id) k using (user_id)))"""

STREAK = """
streak as (
  select user_id, max(wins) as consecutive_wins_max
  from (select user_id, isle, count(*) filter (pnl > 0) as wins
        from (select user_id, pnl, sum(case when pnl > 0 then 0 else 1 end) over (
                partition by user_id order by open_ts, trade_id rows unbounded preceding) as isle from trade)
        group by user_id, isle) group by user_id)"""

MIX = """
mix as (
  select user_id, count(*) as unique_instruments, max(p) as top_instrument_concentration,
    case when count(*) > 1 then -sum(p * ln(p)) else 0.0 end as instrument_entropy,
    max_by(instrument, (c, instrument)) as top_instrument
  from (select user_id, instrument, count(*) as c, count(*) * 1.0 / sum(count(*)) over (partition by user_id) as p
        from trade group by user_id, instrument) group by user_id)"""

TRADE_RAW = """
trade_raw as (
  select user_id, count(*) as total_trades, sum(lot) as total_lot_size, avg(lot) as mean_lot_size,
    coalesce(stddev_samp(lot), 0) as std_lot_size, max(lot) as max_lot_size,
    case when coalesce(stddev_samp(lot), 0) > 0 then (max(lot) - avg(lot)) / stddev_samp(lot) else 0 end as lot_zscore_max,
    count(*) / greatest((epoch_us(max(open_ts)) - epoch_us(min(open_ts))) // 86400000000, 1) as trades_per_day,
    sum(pnl) as total_pnl, avg(pnl) as mean_pnl, coalesce(stddev_samp(pnl), 0) as std_pnl,
    coalesce(stddev_samp(pnl), 0) / (abs(avg(pnl)) + 1) as pnl_volatility,
    avg(case when pnl > 0 then 1.0 else 0.0 end) as win_rate,
    max(pnl) as max_single_win, min(pnl) as max_single_loss, avg(dur) as mean_duration_min,
    coalesce(stddev_samp(dur), 0) as std_duration_min,
    avg(case when dur < 1.0 then 1.0 else 0.0 end) as pct_sub_minute_trades,
    avg(case when dur < 0.5 then 1.0 else 0.0 end) as pct_sub_30s_trades,
    avg(margin) as mean_margin_used, max(margin) as max_margin_used,
    count(*) filter (open_ts >= last_ts - interval 7 day) as rolling_7d_trades,
    sum(pnl) filter (open_ts >= last_ts - interval 7 day) as rolling_7d_pnl,
    sum(lot) filter (open_ts >= last_ts - interval 7 day) as rolling_7d_lot_size,
    coalesce(stddev_samp(hour(open_ts)), 0) as trade_hour_std,
    avg(case when dayofweek(open_ts) in (0, 6) then 1.0 else 0.0 end) as weekend_trade_ratio,
    bool_or(flag) as is_anomalous
  from (select *, max(open_ts) over (partition by user_id) as last_ts from trade) group by user_id)"""

TRADE_FEAT = f"""
trade_feat as (
  select user_id, {_finish(TRADE_FEATURES, _T_DIGITS)}, is_anomalous
  from trade_raw join mix using (user_id) join streak using (user_id))"""

STORE = f"""
store as (
  select coalesce(p.user_id, t.user_id) as user_id,
    {", ".join(f"cast(p.{c} as double) as p_{c}" for c in PORTAL_FEATURES)},
    {", ".join(f"coalesce(cast(t.{c} as double), 0) as t_{c}" for c in TRADE_FEATURES)},
    coalesce(p.is_anomalous, false) or coalesce(t.is_anomalous, false) as is_anomalous
  from portal_feat p full join trade_feat t on p.user_id = t.user_id)"""

PORTAL_ALL = [PORTAL, burst(), kyc(), GAPS, ENTROPY, PORTAL_RAW, PORTAL_FEAT]
TRADE_ALL = [TRADE, STREAK, MIX, TRADE_RAW, TRADE_FEAT]
STORE_ALL = [*PORTAL_ALL, *TRADE_ALL, STORE]

# Stand-in scores computed from the store, so that blending, risk levels and alerts have an oracle.
SCORED = f"""
scored as (
  select user_id, is_anomalous, t_win_rate as if_score, t_pct_sub_minute_trades as lof_score,
    {r("0.6 * t_win_rate + 0.4 * t_pct_sub_minute_trades", 4)} as ensemble_score,
    coalesce(p_pct_night_logins, 0) as lstm_score
  from store)"""


def sql(ctes: list[str], body: str) -> str:
    return "with " + ",".join(ctes) + "\n" + body


PORTAL_RULES = """
prule as (
  select s.user_id, s.n as portal_event_count, s.logins, s.failed, s.night, s.small, s.small_total, s.deps, s.wds,
    s.deposited, s.withdrawn, b.n as burst_ips, k.n as kyc_changes, k.amount as kyc_amount
  from (select user_id, count(*) as n, count(*) filter (kind = 'login') as logins,
          count(*) filter (kind = 'login' and status = 'failed') as failed,
          count(*) filter (kind = 'login' and hour(ts) between 1 and 4) as night,
          count(*) filter (kind = 'deposit' and amount < 500) as small,
          coalesce(sum(amount) filter (kind = 'deposit' and amount < 500), 0) as small_total,
          count(*) filter (kind = 'deposit') as deps, count(*) filter (kind = 'withdrawal') as wds,
          coalesce(sum(amount) filter (kind = 'deposit'), 0) as deposited,
          coalesce(sum(amount) filter (kind = 'withdrawal'), 0) as withdrawn
        from portal group by user_id) s
  left join (select user_id, n from burst where n >= 4
             qualify row_number() over (partition by user_id order by ts) = 1) b using (user_id)
  left join (select user_id, n, amount from kyc where n >= 3
             qualify row_number() over (partition by user_id order by ts, event_id) = 1) k using (user_id)),
pfind as (
  select user_id, portal_event_count,
    case when logins >= 3 and burst_ips >= 4 then 'Multi-IP login burst: ' || burst_ips || ' distinct IPs within 1440 minutes' end as ip_burst,
    case when failed >= 5 then 'Brute force pattern: ' || failed || ' failed login attempts detected' end as brute_force,
    case when night >= 3 then 'Unusual login hours: ' || night || ' logins between 1–4 AM' end as unusual_hours,
    case when small >= 10 then 'Structuring pattern: ' || small || ' deposits under $500 (total ' || format('${:,.0f}', small_total) || ')' end as structuring,
    case when deps > 0 and wds > 0 and withdrawn / greatest(deposited, 1) > 0.75 and deposited > 1000
      then 'Deposit-withdrawal cycle: withdrew ' || format('{:.0f}', withdrawn / greatest(deposited, 1) * 100) || '% of deposits ('
        || format('${:,.0f}', withdrawn) || ' of ' || format('${:,.0f}', deposited) || ')' end as deposit_cycle,
    case when kyc_changes >= 3 then 'KYC manipulation: ' || kyc_changes || ' profile changes in 24h before '
        || format('${:,.0f}', kyc_amount) || ' withdrawal' end as kyc_manipulation
  from prule)"""

DAILY = """
daily as (
  select user_id, avg(c) as mean_daily, max(c) as max_daily
  from (select user_id, cast(open_ts as date) as d, count(*) as c from trade group by all) group by user_id)"""

TRADING_RULES = """
trule as (
  select user_id, count(*) as n, avg(lot) as lot_mean, coalesce(stddev_samp(lot), 0) as lot_sd, max(lot) as lot_max,
    avg(pnl) as pnl_mean, coalesce(stddev_samp(pnl), 0) as pnl_sd, min(pnl) as pnl_min, max(pnl) as pnl_max,
    count(*) filter (dur < 0.5) as fast,
    coalesce(avg(case when pnl > 0 then 1.0 else 0.0 end) filter (dur < 0.5), 0) as fast_wins
  from trade group by user_id),
tfind as (
  select user_id, n as trading_event_count,
    case when n > 5 and max_daily > mean_daily * 5 and max_daily > 20
      then 'Volume spike: ' || max_daily || ' trades in one day (avg ' || format('{:.1f}', mean_daily) || '/day) — '
        || format('{:.1f}', max_daily / greatest(mean_daily, 1)) || 'x baseline' end as volume_spike,
    case when n > 5 and lot_sd > 0 and (lot_max - lot_mean) / lot_sd > 3
      then 'Lot size anomaly: max lot ' || format('{:.1f}', lot_max) || ' (' || format('{:.1f}', (lot_max - lot_mean) / lot_sd)
        || 'σ above user mean of ' || format('{:.2f}', lot_mean) || ')' end as lot_anomaly,
    case when top_instrument_concentration > 0.80 and n > 10
      then 'Instrument concentration: ' || format('{:.0f}', top_instrument_concentration * 100) || '% of trades on ' || top_instrument end as instrument_concentration,
    case when fast > 10 then 'Latency arbitrage signal: ' || fast || ' sub-30s trades, ' || format('{:.0f}', fast_wins * 100) || '% profitable' end as latency_arbitrage,
    case when n > 5 and pnl_sd / (abs(pnl_mean) + 1) > 10
      then 'PnL volatility: std=' || format('{:,.0f}', pnl_sd) || ', range=[' || format('${:,.0f}', pnl_min) || ', ' || format('${:,.0f}', pnl_max) || ']' end as pnl_volatility,
    case when n > 5 and fast > 5 and fast_wins > 0.80
      then 'Suspicious win rate on fast trades: ' || format('{:.0f}', fast_wins * 100) || '% of sub-30s trades profitable' end as fast_win_rate
  from trule join daily using (user_id) join mix using (user_id))"""

ALERTS = """
found as (
  select s.user_id, ensemble_score as final_score, if_score,
    coalesce(portal_event_count, 0) as portal_event_count, coalesce(trading_event_count, 0) as trading_event_count,
    list_filter([ip_burst, brute_force, unusual_hours, structuring, deposit_cycle, kyc_manipulation, volume_spike,
      lot_anomaly, instrument_concentration, latency_arbitrage, pnl_volatility, fast_win_rate], lambda x: x is not null) as f,
    case when ensemble_score >= 0.85 then 'CRITICAL' when ensemble_score >= 0.70 then 'HIGH'
         when ensemble_score >= 0.55 then 'MEDIUM' else 'LOW' end as risk_level
  from scored s left join pfind using (user_id) left join tfind using (user_id)
  where ensemble_score >= 0.30),
alerts as (
  select 'ALT-' || user_id || '-20240701000000' as alert_id, user_id, '2024-07-01T00:00:00' as generated_at, risk_level,
    final_score, if_score, cast(0.0 as double) as ae_score,
    case when len(f) = 0 then 'Statistical anomaly detected (score=' || format('{:.3f}', final_score) || '). Behavior deviates significantly from peer group.'
         when len(f) = 1 then f[1] else f[1] || '; +' || (len(f) - 1) || ' additional signal(s)' end as summary,
    array_to_string(f, ' | ') as findings,
    case
      when risk_level = 'CRITICAL' and (lower(array_to_string(f, ' ')) like '%brute force%' or lower(array_to_string(f, ' ')) like '%multi-ip%')
        then 'IMMEDIATE: Freeze account, initiate security review, notify user via secondary channel'
      when risk_level = 'CRITICAL' and (lower(array_to_string(f, ' ')) like '%kyc manipulation%' or lower(array_to_string(f, ' ')) like '%withdrawal%')
        then 'IMMEDIATE: Block pending withdrawals, escalate to AML team for SAR filing'
      when risk_level = 'CRITICAL' then 'IMMEDIATE: Suspend trading, freeze withdrawals, escalate to senior compliance officer'
      when risk_level = 'HIGH' and lower(array_to_string(f, ' ')) like '%structuring%' then 'URGENT: Flag for AML review within 24h, monitor all transactions'
      when risk_level = 'HIGH' and (lower(array_to_string(f, ' ')) like '%latency arbitrage%' or lower(array_to_string(f, ' ')) like '%volume spike%')
        then 'URGENT: Review trading activity, consider trade reversal if platform abuse confirmed'
      when risk_level = 'HIGH' then 'URGENT: Enhanced monitoring, request additional KYC documentation within 48h'
      when risk_level = 'MEDIUM' then 'Monitor: Add to watchlist, review manually within 72h'
      else 'Log: Flag for routine periodic review' end as recommended_action,
    portal_event_count, trading_event_count
  from found)"""

ALERT_ALL = [*STORE_ALL, SCORED, PORTAL_RULES, DAILY, TRADING_RULES, ALERTS]

LABELLED = """
labelled as (
  select d.doc_id, d.n_chars, l.toxic as label, l.quality from labels l join documents d on d.doc_id = l.doc_id),
series as (
  select 'long' as model, cast(n_chars as double) as score, label, case when n_chars >= 500 then 1 else 0 end as predicted from labelled
  union all
  select 'short', -cast(n_chars as double), label, case when n_chars < 100 then 1 else 0 end from labelled)"""


METRICS = f"""
steps as (
  select model, score, sum(label) as tp, sum(1 - label) as fp from series group by model, score),
cum as (
  select *, sum(tp) over w as ctp, sum(fp) over w as cfp from steps
  window w as (partition by model order by score desc rows unbounded preceding)),
auc as (
  select model, {r("sum(fp * (2 * ctp - tp)) / 2.0 / sum(tp) / sum(fp)", 6)} as auc,
    {r("sum(tp * ctp / (ctp + cfp)) / sum(tp)", 6)} as ap from cum group by model),
hits as (
  select model, count(*) filter (predicted = 1 and label = 1) as h, count(*) filter (predicted = 1) as f,
    count(*) filter (label = 1) as p from series group by model)
select model, auc, ap, {r("case when f > 0 then h / f else 0 end", 6)} as precision,
  {r("case when p > 0 then h / p else 0 end", 6)} as recall,
  {r("case when f + p > 0 then 2 * h / (f + p) else 0 end", 6)} as f1
from auc join hits using (model)"""


ROC = f"""
steps as (select model, score, sum(label) as tp, sum(1 - label) as fp from series group by model, score),
cum as (
  select *, sum(tp) over w as ctp, sum(fp) over w as cfp, lead(tp) over w2 as ntp, lead(fp) over w2 as nfp,
    sum(tp) over (partition by model) as p, sum(fp) over (partition by model) as n from steps
  window w as (partition by model order by score desc rows unbounded preceding), w2 as (partition by model order by score desc))
select model, {r("cfp / n", 6)} as fpr, {r("ctp / p", 6)} as tpr from cum
where ntp is null or ntp <> tp or nfp <> fp
union all select distinct model, 0.0::double, 0.0::double from cum"""

SCORE_SERIES = """
series as (
  select 'Isolation Forest' as model, if_score as score, is_anomalous::int as label, case when if_score >= 0.5 then 1 else 0 end as predicted from scored
  union all select 'LOF', lof_score, is_anomalous::int, case when lof_score >= 0.5 then 1 else 0 end from scored
  union all select 'IF+LOF Ensemble', ensemble_score, is_anomalous::int, case when ensemble_score >= 0.5 then 1 else 0 end from scored
  union all select 'MLP Autoencoder', lstm_score, is_anomalous::int, case when lstm_score >= 0.5 then 1 else 0 end from scored)"""

# The features whose histograms are reported.
HIST_FEATURES = ["p_unique_ips", "p_pct_night_logins", "p_deposit_withdraw_ratio",
                 "t_pnl_volatility", "t_pct_sub_30s_trades", "t_top_instrument_concentration"]


def lof(where: str, width: int = 64, k: int = 20) -> list[str]:
    return [f"""
ref as materialized (select vec_id as id, cast(embedding as double[{width}]) as x from embeddings where {where})""", f"""
nn as materialized (
  select a.id as q, b.id as r, array_distance(a.x, b.x) as dist from ref a join ref b on a.id <> b.id
  qualify row_number() over (partition by a.id order by array_distance(a.x, b.x), b.id) <= {k})""", """
kd as (select q, max(dist) as kdist from nn group by q)""", f"""
lrd as (select n.q, 1.0 / (sum(greatest(kdist, dist)) / {k} + 1e-10) as lrd from nn n join kd on kd.q = n.r group by n.q)""", f"""
lof as (select n.q as id, sum(r.lrd) / {k} / any_value(o.lrd) as lof
  from nn n join lrd r on r.q = n.r join lrd o on o.q = n.q group by n.q)"""]


def oracle_sql() -> dict[str, str]:
    out = {}
    out["portal_features"] = sql(PORTAL_ALL, "select * from portal_feat")
    out["trading_features"] = sql(TRADE_ALL, "select * from trade_feat")
    out["feature_store"] = sql(STORE_ALL, "select * from store")
    out["imputed_matrix"] = sql(STORE_ALL, "select user_id, is_anomalous, " + ", ".join(
        r(f"coalesce({c}, median({c}) over ())", 6) + f" as {c}" for c in STORE_FEATURES) + " from store")
    scaled, raw = [], []
    for c in STORE_FEATURES:
        x = f"coalesce({c}, 0)"
        iqr = f"(select quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) from store)"
        med = f"(select median({x}) from store)"
        raw.append(f"({x} - {med}) / case when {iqr} = 0 then 1 else {iqr} end as {c}")
        scaled.append(r(raw[-1].rsplit(" as ", 1)[0], 6) + f" as {c}")
    out["robust_scaled"] = sql(
        [*STORE_ALL[:-1], STORE.replace("store as (", "store as materialized (", 1)],
        "select user_id, " + ", ".join(scaled) + " from store")
    out["ip_burst"] = sql([PORTAL, burst()],
                          "select user_id, epoch_us(ts) as at_us, n from burst")
    out["kyc_window"] = sql([PORTAL, kyc()],
                            "select user_id, epoch_us(ts) as at_us, n, min(amount) as amount from kyc group by all")
    out["login_gaps"] = sql([PORTAL, GAPS], f"select user_id, {r('coalesce(gap_min, 0)', 2)} as inter_login_min from gaps")
    out["rolling_7d"] = sql(
        [PORTAL, PORTAL_RAW],
        "select user_id, rolling_7d_logins, rolling_7d_deposits, rolling_7d_withdrawals from portal_raw")
    out["win_streak"] = sql([TRADE, STREAK], "select user_id, consecutive_wins_max from streak")
    out["login_diversity"] = sql(
        [PORTAL, ENTROPY],
        f"""select user_id, distinct_k as unique_ips,
          (select count(distinct k % 20) from portal p where p.user_id = ent.user_id and kind = 'login') as unique_devices,
          (select count(distinct k % 10) from portal p where p.user_id = ent.user_id and kind = 'login') as unique_countries,
          {r('entropy', 4)} as ip_entropy from ent""")
    out["instrument_mix"] = sql(
        [TRADE, MIX],
        f"""select user_id, unique_instruments, {r('top_instrument_concentration', 4)} as top_instrument_concentration,
          top_instrument, {r('instrument_entropy', 4)} as instrument_entropy from mix""")
    out["daily_trades"] = sql([TRADE, DAILY],
                              f"select user_id, {r('mean_daily', 6)} as mean_daily, max_daily from daily")
    out["portal_rules"] = sql([PORTAL, burst(), kyc(), PORTAL_RULES], "select * from pfind")
    out["trading_rules"] = sql([TRADE, MIX, DAILY, TRADING_RULES], "select * from tfind")
    out["alert_rules"] = sql(ALERT_ALL, "select * from alerts")
    out["alerts_top"] = sql(
        ALERT_ALL, "select user_id, risk_level, final_score, summary from alerts where risk_level = 'MEDIUM' order by final_score desc, user_id limit 50")
    out["alerts_by_user"] = sql(ALERT_ALL, "select user_id, alert_id, risk_level, findings from alerts where user_id = 42")
    out["blend_scores"] = sql(
        [*STORE_ALL, SCORED],
        f"""select user_id, ensemble_score, {r('0.6 * ensemble_score + 0.4 * lstm_score', 4)} as final_score,
          ({r('0.6 * ensemble_score + 0.4 * lstm_score', 4)}) >= 0.5 as is_anomalous from scored""")
    out["risk_levels"] = sql(
        [*STORE_ALL, SCORED],
        """select case when ensemble_score >= 0.85 then 'CRITICAL' when ensemble_score >= 0.70 then 'HIGH'
             when ensemble_score >= 0.55 then 'MEDIUM' else 'LOW' end as alert_level,
           case when ensemble_score >= 0.85 then 'CRITICAL' when ensemble_score >= 0.70 then 'HIGH'
             when ensemble_score >= 0.55 then 'MEDIUM' when ensemble_score >= 0.30 then 'LOW' else 'NORMAL' end as response_level,
           count(*) as n from scored group by all""")
    out["batch_lookup_hits"] = sql(
        STORE_ALL, "select user_id, t_total_trades, is_anomalous from store where user_id in (select c_custkey from customer)")
    out["batch_lookup_misses"] = sql(
        [PORTAL, burst(), kyc(), GAPS, ENTROPY, PORTAL_RAW, PORTAL_FEAT],
        """select c_custkey as user_id, 'User ''' || c_custkey || ''' not found in feature store' as error
           from customer where c_custkey not in (select user_id from portal_feat)""")
    out["event_envelope"] = sql(
        [PORTAL, TRADE],
        """select 'forex.portal.events' as topic, cast(user_id as varchar) as key, 'portal' as source, event_id as id, epoch_us(ts) as at_us from portal
           union all select 'forex.trading.events', cast(user_id as varchar), 'trading', trade_id, epoch_us(open_ts) from trade""")
    out["stream_users"] = sql(
        [PORTAL, TRADE], "select user_id from portal union select user_id from trade")
    out["value_counts"] = sql([PORTAL], "select kind as event_type, count(*) as n from portal group by kind")
    out["anomaly_type_counts"] = sql(
        [PORTAL, TRADE], """select 'error_spike' as anomaly_type, count(*) as n from portal where flag having count(*) > 0
           union all select 'lot_spike', count(*) from trade where flag having count(*) > 0""")
    out["event_summary"] = sql(
        [PORTAL], f"select count(*) as n_rows, count(distinct user_id) as n_users, {r('avg(flag::int)', 6)} as anomaly_rate from portal")
    hist = " union all ".join(f"select '{c}' as feature, is_anomalous as label, {c} as v from store where {c} is not null"
                              for c in HIST_FEATURES)
    out["histogram_bins"] = sql(
        [*STORE_ALL, f"hv as materialized ({hist})",
         "hr as (select feature, label, min(v) as lo, max(v) as hi from hv group by all)"],
        """select feature, label, cast(least(floor(case when lo = hi then 15 else (v - lo) / (hi - lo) * 30 end), 29) as int) as bin,
             count(*) as n from hv join hr using (feature, label) group by all""")
    out["binary_metrics"] = sql([LABELLED, METRICS], "")
    out["roc_points"] = sql([LABELLED, ROC], "")
    out["model_comparison"] = sql([*STORE_ALL, SCORED, SCORE_SERIES, METRICS], "")
    out["lof_scores"] = sql(lof("true"), f"select id as vec_id, {r('lof', 6)} as lof, lof > 1.5 as is_outlier from lof")
    out["nn_lof"] = sql(
        [*lof("true"), """
moved as materialized (select id, cast(list_transform(cast(x as double[]), lambda v: v * 0.75 + 0.125) as double[64]) as x from ref)"""],
        f"""select q.id as vec_id, {r('lof.lof', 6)} as lof from (
              select m.id, ref.id as nearest from moved m join ref on true
              qualify row_number() over (partition by m.id order by array_distance(m.x, ref.x), ref.id) = 1) q
            join lof on lof.id = q.nearest""")
    parts = " union all ".join(
        f"select user_id, '{c}' as f, {i} as i, abs((coalesce({c}, 0) - avg(coalesce({c}, 0)) over ()) / (stddev_pop(coalesce({c}, 0)) over () + 1e-9)) as z from store"
        for i, c in enumerate(STORE_FEATURES))
    out["explain_top5"] = sql(
        [*TRADE_ALL, *PORTAL_ALL, STORE.replace("store as (", "store as materialized (", 1), f"zs as ({parts})"],
        """select user_id, string_agg(f, '|' order by z desc, i) as top_features from (
             select * from zs qualify row_number() over (partition by user_id order by z desc, i) <= 5) group by user_id""")
    sizes = [len(STORE_FEATURES), 32, 14, 32, len(STORE_FEATURES)]
    layers = []
    for n, (a, b) in enumerate(zip(sizes, sizes[1:])):
        value = (f"list_sum(list_transform(range({a}), lambda i: v{n}[i + 1] * ((i * 7 + j * 13 + {n * 5}) % 17 - 8) / 40.0)) + (j % 5 - 2) * 0.01")
        layers.append(f"l{n + 1} as materialized (select user_id, is_anomalous, v0, list_transform(range({b}), lambda j: "
                      + (f"greatest({value}, 0.0)" if n < 3 else value) + f") as v{n + 1} from l{n})")
    vector = ", ".join(c.rsplit(" as ", 1)[0] for c in raw)
    out["ae_forward"] = sql(
        [*STORE_ALL[:-1], STORE.replace("store as (", "store as materialized (", 1),
         f"l0 as materialized (select user_id, is_anomalous, [{vector}]::double[] as v0 from store)", *layers,
         f"errs as materialized (select user_id, is_anomalous, list_transform(range({sizes[0]}), lambda i: (v0[i + 1] - v4[i + 1]) ** 2) as e from l4)",
         f"sums as materialized (select *, list_sum(e) / {sizes[0]} as err from errs)",
         "thr as (select quantile_cont(err, 0.5) as t from sums where not is_anomalous)",
         f"""tops as (select user_id, string_agg(f, '|' order by v desc, i) as lstm_top_features from (
             select * from (select user_id, unnest(e) as v, unnest(range({sizes[0]})) as i, unnest({list(STORE_FEATURES)!r}) as f from sums)
             qualify row_number() over (partition by user_id order by v desc, i) <= 5) group by user_id)"""],
        f"""select user_id, {r('err', 6)} as lstm_recon_error, {r('least(1.0, greatest(0.0, err / (2 * t + 1e-9)))', 4)} as lstm_score,
             (err > t)::int as lstm_anomaly, lstm_top_features from sums join tops using (user_id), thr""")
    out["stream_features"] = sql(
        [PORTAL, TRADE, """
bp as (select * from portal qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 200)""", """
bt as (select * from trade qualify row_number() over (partition by user_id order by open_ts desc, trade_id desc) <= 200)""", """
fp as (
  select user_id, count(*) filter (kind = 'login') as total_logins,
    count(*) filter (kind = 'login' and status = 'failed') / greatest(count(*) filter (kind = 'login'), 1) as failed_login_ratio,
    count(distinct k) filter (kind = 'login') as unique_ips, count(distinct k % 10) filter (kind = 'login') as unique_countries,
    coalesce(avg(case when hour(ts) <= 5 then 1.0 else 0.0 end) filter (kind = 'login'), 0) as pct_night_logins,
    count(amount) filter (kind = 'deposit') as deposit_count, count(amount) filter (kind = 'withdrawal') as withdrawal_count,
    coalesce(sum(amount) filter (kind = 'withdrawal'), 0) / greatest(coalesce(sum(amount) filter (kind = 'deposit'), 0), 1) as deposit_withdraw_ratio,
    count(*) filter (kind = 'deposit' and amount < 500) as structuring_score,
    count(*) filter (kind = 'kyc_change') as kyc_change_count from bp group by user_id)""", """
ft as (
  select user_id, count(*) as total_trades, avg(lot) as mean_lot_size, max(lot) as max_lot_size,
    coalesce(stddev_samp(pnl), 0) / (abs(avg(pnl)) + 1) as pnl_volatility,
    avg(case when pnl > 0 then 1.0 else 0.0 end) as win_rate, avg(case when dur < 0.5 then 1.0 else 0.0 end) as pct_sub_30s_trades
  from bt group by user_id)""", """
fm as (select user_id, max(c) * 1.0 / sum(c) as top_instrument_concentration
  from (select user_id, instrument, count(*) as c from bt group by all) group by user_id)"""],
        "select cast(coalesce(fp.user_id, ft.user_id) as varchar) as user_id, "
        + ", ".join(r(f"coalesce(fp.{c}, 0)", 6) + f" as p_{c}" for c in QUICK_PORTAL) + ", "
        + ", ".join(r(f"coalesce({'fm' if c.startswith('top') else 'ft'}.{c}, 0)", 6) + f" as t_{c}" for c in QUICK_TRADE)
        + " from fp full join ft using (user_id) left join fm on fm.user_id = coalesce(fp.user_id, ft.user_id)")
    return out
