"""One SQL text per registered query."""

from __future__ import annotations

from oracle.base import AS_OF, age_years, compose, newest

_BODIES: dict[str, str] = {}

# --- ingest -----------------------------------------------------------------------------------
_BODIES["incremental_window"] = """
    SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'"""
_BODIES["audit_watermark"] = """
    SELECT table_name, max(current_run_time) AS last_run_time
    FROM audit WHERE status = 'SUCCESS' GROUP BY table_name"""
_BODIES["bronze_metadata"] = """
    SELECT *, TIMESTAMP '2000-01-01' AS _ingested_at, 'oracle' AS _source_system, 'batch1' AS _batch_id
    FROM src_bank_accounts"""
_BODIES["align_schema"] = """
    SELECT account_id, customer_id, CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS VARCHAR) AS branch_id,
           CAST(NULL AS VARCHAR) AS account_type, CAST(NULL AS VARCHAR) AS account_no,
           CASE WHEN status = 'CLOSED' THEN NULL ELSE balance END AS balance,
           CAST(NULL AS VARCHAR) AS currency, status, opened_date, CAST(NULL AS DATE) AS closed_date,
           CAST(NULL AS DOUBLE) AS interest_rate, CAST(NULL AS TIMESTAMP) AS updated_at,
           TIMESTAMP '2000-01-01' AS _ingested_at, 'oracle' AS _source_system, 'batch1' AS _batch_id
    FROM src_bank_accounts"""
_BODIES["bronze_upsert"] = """
    SELECT *, TIMESTAMP '2000-02-01' AS _ingested_at, 'postgres' AS _source_system, 'b2' AS _batch_id
    FROM changed_customers
    UNION ALL BY NAME
    SELECT *, TIMESTAMP '2000-01-01' AS _ingested_at, 'postgres' AS _source_system, 'b1' AS _batch_id
    FROM src_customers
    WHERE customer_id NOT IN (SELECT customer_id FROM changed_customers)"""
_BODIES["stream_once"] = "SELECT * FROM src_customers UNION SELECT * FROM changed_customers"
# The columns of the export, in order.
_EXPORTED = (
    "customer_id,full_name,age,gender,customer_segment,kyc_status,city,province,total_product_count,"
    "has_savings,has_current,has_credit_card,has_loan,total_deposit_balance,total_loan_outstanding,"
    "credit_utilization_rate,net_asset_value,txn_count_12m,txn_amount_12m,avg_monthly_spend,"
    "top_spend_category,digital_txn_ratio,last_txn_date,active_months_12m,recency_days,frequency_12m,"
    "monetary_12m,r_score,f_score,m_score,rfm_score,rfm_segment,has_npl_loan,days_past_due,"
    "cross_sell_loan_flag,cross_sell_card_flag,cross_sell_invest_flag,tenure_days,snapshot_date"
)
_BODIES["export_meta"] = f"""
    SELECT (SELECT max(snapshot_date) FROM mart) AS snapshot_date,
           (SELECT string_agg(DISTINCT strftime(snapshot_date, '%Y-%m-%d'), ',' ORDER BY strftime(snapshot_date, '%Y-%m-%d')) FROM mart) AS snapshots,
           (SELECT count(*) FROM mart_now) AS row_count,
           '{_EXPORTED}' AS columns,
           (SELECT string_agg(DISTINCT strftime(day, '%Y-%m'), ',' ORDER BY strftime(day, '%Y-%m')) FROM days) AS months,
           (SELECT min(day) FROM days) AS first_day, (SELECT max(day) FROM days) AS last_day"""

# --- cleansing --------------------------------------------------------------------------------
_BODIES["clean_strings"] = """
    SELECT nullif(trim(txn_id), '') AS txn_id, nullif(trim(account_id), '') AS account_id, txn_date, amount,
           nullif(trim(channel), '') AS channel, nullif(trim(status), '') AS status, _ingested_at
    FROM src_bank_transactions"""
_BODIES["upper_codes"] = """
    SELECT * REPLACE (upper(channel) AS channel, upper(status) AS status) FROM src_bank_transactions"""
_BODIES["dedup_latest"] = f"""
    SELECT * FROM src_card_transactions
    QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY
        {newest('_ingested_at', 'account_id', 'txn_date', 'amount', 'merchant_category', 'channel', 'status', 'src_seq')}) = 1"""
_BODIES["drop_null_keys"] = "SELECT * FROM src_bank_transactions WHERE txn_id IS NOT NULL"
_BODIES["conformed_bank_transactions"] = "SELECT * FROM fct_bank"

# --- dimensions and facts ---------------------------------------------------------------------
_BODIES["scd1_upsert"] = """
    SELECT * FROM dim_customer_2
    UNION ALL BY NAME
    SELECT o.* FROM dim_customer o
    WHERE NOT EXISTS (SELECT 1 FROM dim_customer_2 n WHERE n.customer_id = o.customer_id)"""
_BODIES["scd2_row_hash"] = """
    SELECT customer_id, md5(concat_ws('|', customer_segment, city, province, kyc_status)) AS row_hash
    FROM dim_customer"""
_BODIES["scd2_changes"] = """
    SELECT customer_id, n.customer_segment, CASE WHEN is_new THEN 'NEW' ELSE 'CHANGED' END AS change,
           CASE WHEN NOT is_new THEN 1 END AS old_version
    FROM moved JOIN dim_customer_2 n USING (customer_id)"""
_BODIES["scd2_apply"] = "SELECT * FROM history"
_BODIES["scd2_refresh_attributes"] = """
    SELECT h.* REPLACE (
        CASE WHEN h.is_current AND n.customer_id IS NOT NULL THEN n.email ELSE h.email END AS email)
    FROM history h LEFT JOIN dim_customer_2 n ON n.customer_id = h.customer_id"""
_BODIES["scd2_history"] = """
    SELECT customer_id, customer_segment, city, version, is_current, effective_from, effective_to
    FROM history WHERE customer_id = 'CIF000000007' ORDER BY version"""
_BODIES["scd2_as_of"] = """
    SELECT customer_id, customer_segment, version FROM history
    WHERE TIMESTAMP '2000-01-15' >= effective_from AND TIMESTAMP '2000-01-15' < coalesce(effective_to, TIMESTAMP '9999-01-01')"""
_BODIES["scd2_fact_segment"] = """
    SELECT f.txn_id, f.customer_id, f.txn_date, f.amount, h.customer_segment, h.version
    FROM (SELECT txn_id, customer_id, txn_date, amount FROM fct_bank JOIN dim_account USING (account_id)) f
    LEFT JOIN history h ON h.customer_id = f.customer_id
         AND f.txn_date BETWEEN h.effective_from AND coalesce(h.effective_to, TIMESTAMP '9999-01-01') - INTERVAL 1 SECOND"""
_BODIES["fact_insert_new"] = """
    SELECT * FROM fct_bank
    WHERE txn_id NOT IN (SELECT txn_id FROM fct_bank WHERE txn_date < DATE '2000-01-01')"""

# --- gold -------------------------------------------------------------------------------------
_BODIES["agg_holdings"] = "SELECT * FROM holdings_now"
_BODIES["agg_txn_12m"] = "SELECT * FROM activity_now"
_BODIES["agg_txn_dates"] = """
    SELECT DATE '2000-05-31' AS as_of, * FROM activity_old UNION ALL SELECT DATE '2000-06-30', * FROM activity_now"""
_BODIES["agg_txn_auto"] = "SELECT * FROM activity_auto"
_BODIES["mart_base"] = "SELECT * EXCLUDE (full_name, phone, email) FROM base_now"
_BODIES["mart_customer_360"] = "SELECT * FROM mart_now"
_BODIES["customer_age"] = f"""
    SELECT customer_id, date_of_birth, {age_years(AS_OF)} AS age FROM src_customers"""
_BODIES["tenure"] = """
    SELECT customer_id, first_open_date, CAST(DATE '2000-06-30' - first_open_date AS INT) AS tenure_days
    FROM holdings_now"""
_BODIES["rfm_scores"] = "SELECT customer_id, r_score, f_score, m_score, rfm_score FROM mart_now"
_BODIES["rfm_segment"] = "SELECT DISTINCT rfm_score, rfm_segment AS segment FROM mart_now"
_BODIES["cross_sell_flags"] = """
    SELECT customer_id, cross_sell_loan_flag, cross_sell_card_flag, cross_sell_invest_flag FROM mart_now"""

# --- the jobs ---------------------------------------------------------------------------------
_BODIES["job_bronze_batches"] = """
    SELECT 'pg_customers' AS table_name, 'run1' AS batch_id, count(*) AS n FROM src_customers
    UNION ALL SELECT 'pg_customers', 'run2', count(*) FROM changed_customers
    UNION ALL SELECT 'oracle_bank_transactions', 'run1', count(*) FROM fct_bank WHERE txn_date < DATE '2000-01-01'
    UNION ALL SELECT 'oracle_bank_transactions', 'run1b', count(*) FROM fct_bank"""
_BODIES["job_audit"] = """
    SELECT table_name, batch_id, run_mode, 'SUCCESS' AS status, rows_ingested FROM (
        SELECT 'pg_customers' AS table_name, 'run1' AS batch_id, 'incremental' AS run_mode, count(*) AS rows_ingested FROM src_customers
        UNION ALL SELECT 'oracle_bank_accounts', 'run1', 'incremental', count(*) FROM src_bank_accounts
        UNION ALL SELECT 'pg_card_accounts', 'run1', 'incremental', count(*) FROM src_card_accounts
        UNION ALL SELECT 'oracle_loans', 'run1', 'incremental', count(*) FROM src_loans
        UNION ALL SELECT 'oracle_bank_transactions', 'run1', 'incremental', count(*) FROM fct_bank WHERE txn_date < DATE '2000-01-01'
        UNION ALL SELECT 'pg_card_transactions', 'run1', 'incremental', count(*) FROM fct_card
        UNION ALL SELECT 'oracle_bank_transactions', 'run1b', 'incremental', count(*) FROM fct_bank
        UNION ALL SELECT 'pg_customers', 'run2', 'incremental', count(*) FROM changed_customers) runs"""
_BODIES["job_dim_account"] = """
    SELECT account_id, customer_id, status, balance, 'run1' AS _silver_batch_id FROM dim_account"""
_BODIES["silver_scd2_rerun"] = "SELECT * FROM history"
_BODIES["silver_fact_rerun"] = """
    SELECT txn_id, account_id, txn_date, amount, channel, status,
           CASE WHEN txn_date < DATE '2000-01-01' THEN 'run1' ELSE 'run1b' END AS _silver_batch_id FROM fct_bank"""
_BODIES["job_mart"] = "SELECT * FROM mart_now"

# --- masking and governance -------------------------------------------------------------------
_BODIES["mask_name"] = """
    SELECT customer_id, split_part(full_name, ' ', 1) || ' ****' AS masked FROM src_customers"""
_BODIES["mask_phone"] = """
    SELECT customer_id, CASE WHEN length(phone) < 6 THEN phone
           ELSE phone[1:3] || '****' || phone[-3:] END AS masked FROM src_customers"""
_BODIES["mask_email"] = """
    SELECT customer_id, CASE WHEN contains(email, '@')
           THEN email[1] || '***' || email[strpos(email, '@'):] ELSE email END AS masked FROM src_customers"""
_BODIES["hash_token"] = "SELECT customer_id, sha256(id_number) AS token FROM src_customers"
_BODIES["remask_partitions"] = """
    SELECT customer_id, snapshot_date, regexp_extract(full_name, '^[^ ]*') || ' ****' AS full_name FROM leaky"""
_BODIES["pii_leak_counts"] = """
    SELECT count(*) FILTER (WHERE NOT ends_with(full_name, ' ****')) AS raw_name_leak,
           count(*) FILTER (WHERE email_masked NOT LIKE '%***@%') AS raw_email_leak,
           CAST(0 AS BIGINT) AS forbidden_columns FROM leaky"""
_BODIES["pii_sample"] = """
    SELECT customer_id, full_name, phone_masked, email_masked, snapshot_date FROM mart
    ORDER BY customer_id, snapshot_date LIMIT 10"""
_BODIES["pii_masked_by_snapshot"] = """
    SELECT snapshot_date, count(*) AS n, count(*) FILTER (WHERE ends_with(full_name, ' ****')) AS masked
    FROM leaky GROUP BY snapshot_date"""
_BODIES["snapshot_history"] = """
    SELECT CAST(row_number() OVER (ORDER BY snapshot_date) AS INT) AS version, 'overwrite' AS operation,
           count(*) AS rows FROM mart GROUP BY snapshot_date"""
_BODIES["snapshot_at_version"] = "SELECT * FROM mart_old"
_BODIES["snapshot_diff"] = """
    SELECT customer_id, o.rfm_segment AS old_rfm_segment, o.txn_count_12m AS old_txn_count_12m,
           o.top_spend_category AS old_top_spend_category, n.rfm_segment AS new_rfm_segment,
           n.txn_count_12m AS new_txn_count_12m, n.top_spend_category AS new_top_spend_category
    FROM mart_old o JOIN mart_now n USING (customer_id)
    WHERE o.rfm_segment IS DISTINCT FROM n.rfm_segment OR o.txn_count_12m IS DISTINCT FROM n.txn_count_12m
       OR o.top_spend_category IS DISTINCT FROM n.top_spend_category"""
_BODIES["snapshot_key_changes"] = """
    SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
           CASE WHEN o.customer_id IS NULL THEN 'ADDED' WHEN n.customer_id IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change
    FROM dim_customer o FULL JOIN dim_customer_2 n ON o.customer_id = n.customer_id
    WHERE o.customer_id IS NULL OR n.customer_id IS NULL
       OR o.customer_segment IS DISTINCT FROM n.customer_segment OR o.email IS DISTINCT FROM n.email"""
_BODIES["load_changes"] = """
    SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
           CASE WHEN o.customer_id IS NULL THEN 'ADDED' WHEN n.customer_id IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change,
           o.customer_segment AS old_customer_segment, o.email AS old_email,
           n.customer_segment AS new_customer_segment, n.email AS new_email
    FROM dim_customer o FULL JOIN loaded n ON o.customer_id = n.customer_id
    WHERE (o.customer_id, o.customer_segment, o.email) IS DISTINCT FROM (n.customer_id, n.customer_segment, n.email)"""

# --- verification -----------------------------------------------------------------------------
_COUNTED = {
    "dim_customer": "dim_customer",
    "dim_account": "dim_account",
    "dim_card_account": "dim_card_account",
    "dim_loan": "dim_loan",
    "fct_bank_transactions": "fct_bank",
    "fct_card_transactions": "fct_card",
}
_BODIES["table_counts"] = " UNION ALL ".join(
    f"SELECT '{label}' AS table_name, count(*) AS n, CAST(NULL AS VARCHAR) AS error FROM {name}"
    for label, name in _COUNTED.items()
)
_BODIES["audit_recent"] = """
    SELECT batch_id, table_name, run_mode, status, rows_ingested, current_run_time FROM audit
    ORDER BY current_run_time DESC, table_name, batch_id LIMIT 20"""
_BODIES["customer_lookup"] = """
    SELECT customer_id, snapshot_date, full_name, rfm_segment, total_deposit_balance
    FROM mart WHERE customer_id = 'CIF000000007'"""
_BODIES["mart_completeness"] = """
    SELECT snapshot_date, mart_rows, mart_customers, current_customers,
           mart_rows = current_customers AND mart_customers = current_customers AS complete
    FROM (
        SELECT snapshot_date, count(*) AS mart_rows, count(DISTINCT customer_id) AS mart_customers,
               CASE WHEN snapshot_date = DATE '2000-05-31' THEN TIMESTAMP '2000-01-15'
                    ELSE TIMESTAMP '2000-02-15' END AS loaded
        FROM mart GROUP BY snapshot_date) s
    JOIN LATERAL (
        SELECT count(*) AS current_customers FROM history h
        WHERE h.effective_from <= s.loaded AND (h.effective_to IS NULL OR s.loaded < h.effective_to)) k ON TRUE"""
_BODIES["rfm_distribution"] = """
    SELECT rfm_segment, count(*) AS n, round(avg(monetary_12m), 0) AS avg_monetary,
           round(avg(recency_days), 0) AS avg_recency
    FROM mart_now GROUP BY rfm_segment"""
_BODIES["cross_sell_counts"] = """
    SELECT count_if(cross_sell_loan_flag)::BIGINT AS loan_candidates,
           count_if(cross_sell_card_flag)::BIGINT AS card_candidates,
           count_if(cross_sell_invest_flag)::BIGINT AS invest_candidates,
           count_if(has_npl_loan)::BIGINT AS npl_customers FROM mart_now"""
_BODIES["segment_net_asset"] = """
    SELECT customer_segment, count(*) AS n, round(avg(net_asset_value), 0) AS avg_net_asset,
           round(avg(total_product_count), 2) AS avg_products
    FROM mart_now GROUP BY customer_segment"""

# --- lists and trends -------------------------------------------------------------------------
_BODIES["marketing_rfm"] = """
    SELECT customer_id, full_name, customer_segment, rfm_segment, rfm_score, recency_days, frequency_12m,
           monetary_12m, last_txn_date
    FROM mart_now WHERE rfm_segment NOT IN ('Potential_Loyal', 'New', 'Need_Attention')"""
_BODIES["sales_crosssell"] = """
    SELECT customer_id, full_name, customer_segment, net_asset_value, total_deposit_balance,
           cross_sell_loan_flag, cross_sell_card_flag, cross_sell_invest_flag
    FROM mart_now WHERE greatest(cross_sell_loan_flag, cross_sell_card_flag, cross_sell_invest_flag)"""
_BODIES["latest_snapshot"] = "SELECT customer_id, snapshot_date FROM mart_now"
_BODIES["mart_slice_filtered"] = """
    SELECT customer_id, customer_segment, total_product_count, snapshot_date
    FROM mart_old WHERE customer_segment = 'PREMIER' AND total_product_count > 1"""
_BODIES["trend_slice_filtered"] = """
    SELECT * FROM trend WHERE strftime(day, '%Y-%m') BETWEEN '1999-01' AND '1999-06' AND customer_segment = 'MASS'"""
_BODIES["daily_trend"] = "SELECT * FROM trend"
_BODIES["monthly_active"] = """
    SELECT CAST(date_trunc('month', day) AS DATE) AS month, customer_segment,
           count(DISTINCT customer_id) AS active_customers FROM days GROUP BY ALL"""
_BODIES["active_span"] = """
    SELECT count(DISTINCT customer_id) AS active_customers FROM days WHERE strftime(day, '%Y-%m') IN ('1999-01', '1999-02', '1999-03')"""
_BODIES["trend_refreshed"] = _BODIES["daily_trend"]
_BODIES["active_refreshed"] = _BODIES["monthly_active"]
_BODIES["daily_active"] = """
    SELECT day, customer_segment, count(DISTINCT customer_id) AS active_customers FROM days GROUP BY ALL"""

# --- dashboard --------------------------------------------------------------------------------
_DEC = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"
_DEPOSITS, _LOANS = _DEC.format("total_deposit_balance"), _DEC.format("total_loan_outstanding")
_NET, _SPENT = _DEC.format("net_asset_value"), _DEC.format("txn_amount_12m")


def _mean(flag: str) -> str:
    return f"avg(CASE WHEN {flag} THEN 1 ELSE 0 END)"


def _hits(flag: str) -> str:
    return f"count(*) FILTER (WHERE {flag})"


_NPL = f"{_hits('has_npl_loan')} / nullif({_hits('has_loan')}, 0)"
_BODIES["dash_kpis"] = f"""
    SELECT count(*) AS total, {_DEPOSITS} / 1e9 AS aum_billion, {_LOANS} / 1e9 AS loan_billion,
           {_NET} / 1e9 AS net_asset_billion, avg(total_product_count) AS avg_products,
           {_mean('recency_days <= 90')} AS active_share, {_NPL} AS npl_share,
           {_mean('digital_txn_ratio >= 0.5')} AS digital_share FROM mart_now"""
_BODIES["dash_segment_mix"] = "SELECT customer_segment, count(*) AS n FROM mart_now GROUP BY ALL"
_BODIES["dash_penetration"] = f"""
    SELECT {_mean('has_savings')} AS savings, {_mean('has_current')} AS current, {_mean('has_credit_card')} AS card,
           {_mean('has_loan')} AS loan FROM mart_now"""
_BODIES["dash_rfm_counts"] = "SELECT rfm_segment, count(*) AS n FROM mart_now GROUP BY ALL"
_BODIES["dash_province"] = "SELECT province, count(*) AS n FROM mart_now GROUP BY ALL"
_BODIES["dash_rfm_grid"] = "SELECT f_score, r_score, count(*) AS n FROM mart_now GROUP BY ALL"
_BODIES["dash_aum_by_rfm"] = f"SELECT rfm_segment, {_DEPOSITS} / 1e9 AS aum_billion FROM mart_now GROUP BY ALL"
_BODIES["dash_recency_monetary"] = """
    SELECT customer_id, recency_days, monetary_12m / 1e6 AS monetary_million, frequency_12m AS frequency, customer_segment
    FROM mart_now WHERE recency_days IS NOT NULL"""
_BODIES["dash_product_count"] = "SELECT total_product_count, count(*) AS n FROM mart_now GROUP BY ALL"
# Labels of the bands and where each begins; the last of those reached is the band.
_BANDS = {
    "deposits": ((None, "0. Không gửi"), (0, "1. <50tr"), (5e7, "2. 50-200tr"), (2e8, "3. 200-500tr"), (5e8, "4. 500tr-1 tỷ"), (1e9, "5. 1 tỷ+")),
    "utilisation": ((None, "0%"), (0, "1. <30%"), (0.3, "2. 30-60%"), (0.6, "3. 60-90%"), (0.9, "4. ≥90%")),
}


def _band(name: str, value: str) -> str:
    """The label looked up among rows of (order, bound, label). The first band is for 0 alone, the
    second for anything else below the third's bound."""
    rows = ", ".join(f"({i}, {'NULL' if at is None else at}, '{label}')" for i, (at, label) in enumerate(_BANDS[name]))
    met = f"CASE i WHEN 0 THEN TRUE WHEN 1 THEN {value} <> 0 ELSE {value} >= low AND {value} <> 0 END"
    return f"(SELECT max_by(label, i) FROM (VALUES {rows}) AS b(i, low, label) WHERE {met})"


_AUM_BAND = _band("deposits", "total_deposit_balance")
_BODIES["dash_aum_band"] = f"SELECT {_AUM_BAND} AS band, count(*) AS n FROM mart_now GROUP BY ALL"
_BODIES["dash_penetration_by_segment"] = f"""
    SELECT customer_segment, {_mean('has_savings')} AS savings, {_mean('has_credit_card')} AS card, {_mean('has_loan')} AS loan
    FROM mart_now GROUP BY ALL"""
_BODIES["dash_top_category"] = """
    SELECT top_spend_category, count(*) AS n FROM mart_now WHERE top_spend_category IS NOT NULL GROUP BY ALL"""
_BODIES["dash_npl_by_segment"] = f"SELECT customer_segment, {_NPL} AS rate FROM mart_now GROUP BY ALL"
_LEADS = ", ".join(f"{_hits(f'cross_sell_{k}_flag')} AS {k}" for k in ("loan", "card", "invest"))
_BODIES["dash_leads"] = f"SELECT {_LEADS} FROM mart_now"
_BODIES["dash_leads_by_segment"] = f"SELECT customer_segment, {_LEADS} FROM mart_now GROUP BY ALL"
_BODIES["dash_utilisation_band"] = f"""
    SELECT {_band('utilisation', 'credit_utilization_rate')} AS band, count(*) AS n
    FROM mart_now WHERE has_credit_card GROUP BY ALL"""
for _name, _format in (("dash_txn_trend", "%Y-%m"), ("dash_txn_trend_daily", "%Y-%m-%d")):
    _BODIES[_name] = f"""
    SELECT strftime(day, '{_format}') AS x, {_DEC.format('amount')} / 1e9 AS amt, count(*) AS cnt
    FROM days GROUP BY ALL"""
    _BODIES[_name.replace("txn", "active")] = f"""
    SELECT x, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT strftime(day, '{_format}') AS x, customer_segment, count(DISTINCT customer_id) AS n
        FROM days GROUP BY ALL) per_segment GROUP BY x"""
_BODIES["dash_channel_trend"] = f"""
    SELECT strftime(day, '%Y-%m') AS x, {', '.join(f"{_hits(f"channel = '{c}'")} AS {c}" for c in ('ONLINE', 'ATM', 'POS', 'BRANCH'))}
    FROM days GROUP BY 1"""
_BODIES["dash_snapshot_trend"] = f"""
    SELECT snapshot_date, count(*) AS n, {_DEPOSITS} / 1e9 AS aum_billion FROM mart GROUP BY ALL"""
_BODIES["dash_filter_values"] = """
    SELECT DISTINCT 'snapshot' AS filter, strftime(snapshot_date, '%Y-%m-%d') AS value FROM mart
    UNION ALL SELECT DISTINCT 'month', strftime(day, '%Y-%m') FROM days"""

# --- report measures --------------------------------------------------------------------------
# Labels of the bands with the bound of each, in their order, and the label of all others.
_STEPS = {
    "age": ("<", ((25, "1. <25"), (35, "2. 25-34"), (45, "3. 35-44"), (55, "4. 45-54"), (65, "5. 55-64")), "6. 65+"),
    "tenure_days": ("<", ((365, "1. <1 năm"), (1095, "2. 1-3 năm"), (1825, "3. 3-5 năm")), "4. 5+ năm"),
    "recency_days": ("<=", ((30, "1. Rất tích cực (≤30d)"), (90, "2. Tích cực (31-90d)"), (180, "3. Nguội (91-180d)")), "4. Ngủ đông (>180d)"),
    "digital_txn_ratio": (">=", ((0.8, "Digital-native"), (0.5, "Digital-first"), (5e-324, "Hybrid")), "Truyền thống"),
}


def _step(column: str) -> str:
    """The label of the first bound that a value meets, looked up among rows of (order, bound, label)."""
    meets, steps, others = _STEPS[column]
    rows = ", ".join(f"({i}, {bound!r}::DOUBLE, '{label}')" for i, (bound, label) in enumerate(steps))
    return f"coalesce((SELECT min_by(label, i) FROM (VALUES {rows}) AS s(i, bound, label) WHERE {column} {meets} bound), '{others}')"


_AGE_BAND, _TENURE_BAND, _PERSONA = (_step(c) for c in ("age", "tenure_days", "digital_txn_ratio"))
_ENGAGEMENT = f"if(recency_days IS NULL, 'Chưa GD', {_step('recency_days')})"
_BODIES["bi_bands"] = f"""
    SELECT customer_id, {_AGE_BAND} AS age_band, tenure_days / 365.25::DOUBLE AS tenure_years, {_TENURE_BAND} AS tenure_band,
           {_AUM_BAND} AS aum_band, {_ENGAGEMENT} AS engagement_status, {_PERSONA} AS digital_persona,
           CAST(list_position(['Champions', 'Loyal', 'Potential_Loyal', 'New', 'Need_Attention', 'At_Risk', 'Hibernating'],
                              rfm_segment) AS INT) AS rfm_sort
    FROM mart_now"""
_BODIES["bi_kpi"] = f"""
    SELECT count(DISTINCT customer_id) AS total_customers, {_DEPOSITS} AS total_aum, {_DEPOSITS} / 1e9 AS total_aum_billion,
           {_LOANS} AS total_loan_outstanding, {_LOANS} / 1e9 AS total_loan_billion, {_NET} AS total_nav,
           {_NET} / 1e9 AS total_nav_billion, avg(total_product_count) AS avg_products_per_customer,
           {_SPENT} / 1e9 AS total_txn_amount_12m_billion, CAST(sum(txn_count_12m) AS BIGINT) AS total_txn_count_12m,
           {_DEPOSITS} / count(DISTINCT customer_id) / 1e6 AS avg_aum_per_customer_million FROM mart_now"""
_FLAGS = {"savings": "has_savings", "current": "has_current", "card": "has_credit_card", "loan": "has_loan"}
_BODIES["bi_products"] = f"""
    SELECT {', '.join(f'{_hits(v)} AS {k}_holders, {_mean(v)} AS {k}_penetration' for k, v in _FLAGS.items())},
           {_hits('total_product_count = 1')} AS single_product_customers,
           {_hits('total_product_count >= 3')} AS multi_product_customers,
           {_mean('total_product_count >= 3')} AS multi_product_rate FROM mart_now"""
_BODIES["bi_rfm"] = f"""
    SELECT {_hits("rfm_segment = 'Champions'")} AS champions, {_hits("rfm_segment = 'At_Risk'")} AS at_risk,
           {_hits("rfm_segment = 'Hibernating'")} AS hibernating, {_mean("rfm_segment = 'Champions'")} AS champions_rate,
           {_mean("rfm_segment = 'At_Risk'")} AS at_risk_rate, avg(r_score) AS avg_r, avg(f_score) AS avg_f,
           avg(m_score) AS avg_m FROM mart_now"""
_BODIES["bi_aum_by_rfm"] = f"""
    SELECT rfm_segment, {_DEPOSITS} / 1e9 AS total_aum_billion, {_SPENT} / 1e9 AS total_txn_amount_12m_billion
    FROM mart_now GROUP BY ALL"""
_BODIES["bi_digital"] = f"""
    SELECT round(avg(digital_txn_ratio), 6) AS avg_digital_ratio,
           {_hits('digital_txn_ratio >= 0.5')} AS digital_first_customers, {_mean('digital_txn_ratio >= 0.5')} AS digital_first_rate,
           {_hits('recency_days <= 90')} AS active_customers_90d, {_mean('recency_days <= 90')} AS activity_rate,
           {_hits('coalesce(recency_days, 181) > 180')} AS dormant_customers,
           round(avg(avg_monthly_spend) / 1e6, 6) AS avg_monthly_spend_million,
           avg(active_months_12m) AS avg_active_months_12m FROM mart_now"""
_LEAD_MEASURES = ", ".join(
    f"{_hits(f'cross_sell_{k}_flag')} AS {k}_leads" for k in ("loan", "card", "invest")
)
_ANY_LEAD = f"{_hits('cross_sell_loan_flag OR cross_sell_card_flag OR cross_sell_invest_flag')} AS any_lead"
_NPL_MEASURES = f"""{_hits('has_npl_loan')} AS npl_customers, {_mean('has_npl_loan')} AS npl_rate_of_customers,
    {_NPL} AS npl_rate_of_borrowers"""
_BODIES["bi_risk"] = f"""
    SELECT {_NPL_MEASURES}, avg(days_past_due) FILTER (WHERE days_past_due > 0) AS avg_days_past_due,
           round(avg(credit_utilization_rate) FILTER (WHERE has_credit_card), 6) AS avg_credit_utilization,
           {_LEAD_MEASURES}, {', '.join(f"{_mean(f'cross_sell_{k}_flag')} AS {k}_lead_rate" for k in ('loan', 'card', 'invest'))},
           {_ANY_LEAD} FROM mart_now"""
_BODIES["bi_averages"] = """
    SELECT avg(age) AS avg_age, round(avg(tenure_days / 365.25::DOUBLE), 6) AS avg_tenure_years FROM mart_now"""
_GROUPS = {
    "bi_age_gender": f"{_AGE_BAND} AS age_band, gender",
    "bi_tenure": f"{_TENURE_BAND} AS tenure_band",
    "bi_kyc": "kyc_status",
    "bi_engagement": f"{_ENGAGEMENT} AS engagement_status",
    "bi_persona": f"{_PERSONA} AS digital_persona",
    "bi_active_months": "active_months_12m",
}
for _name, _columns in _GROUPS.items():
    _BODIES[_name] = f"SELECT {_columns}, count(*) AS customers FROM mart_now GROUP BY ALL"
_BODIES["bi_top_provinces"] = """
    SELECT province, count(*) AS customers FROM mart_now GROUP BY ALL ORDER BY customers DESC, province LIMIT 10"""
_BODIES["bi_segment_matrix"] = f"""
    SELECT customer_segment, {', '.join(f'{_mean(_FLAGS[k])} AS {k}_penetration' for k in ('savings', 'card', 'loan'))},
           avg(total_product_count) AS avg_products_per_customer FROM mart_now GROUP BY ALL"""
_BODIES["bi_rfm_matrix"] = f"""
    SELECT r_score, {', '.join(f"{_hits(f'f_score = {i}')} AS f{i}" for i in range(1, 6))} FROM mart_now GROUP BY r_score"""
_BODIES["bi_recency_histogram"] = """
    SELECT CAST(recency_days // 30 * 30 AS INT) AS recency_from, count(*) AS customers FROM mart_now GROUP BY ALL"""
_BODIES["bi_champions"] = """
    SELECT customer_id, customer_segment, total_deposit_balance, total_product_count
    FROM mart_now WHERE rfm_segment = 'Champions'"""
_BODIES["bi_invest"] = """
    SELECT customer_id, customer_segment, net_asset_value, total_deposit_balance
    FROM mart_now WHERE cross_sell_invest_flag"""
_BODIES["bi_customer_points"] = """
    SELECT customer_id, customer_segment, rfm_segment, total_deposit_balance, total_product_count, recency_days,
           monetary_12m, frequency_12m, total_loan_outstanding, days_past_due, has_npl_loan FROM mart_now"""
_BODIES["bi_npl_by_segment"] = f"SELECT customer_segment, {_NPL_MEASURES} FROM mart_now GROUP BY ALL"
_BODIES["bi_leads_by_segment"] = f"""
    SELECT customer_segment, {_LEAD_MEASURES}, {_ANY_LEAD} FROM mart_now GROUP BY ALL"""

ORACLE: dict[str, str] = {name: compose(body) for name, body in _BODIES.items()}
