"""The bank fixture and the whole pipeline as DuckDB common table expressions.

Written from the data definitions and not from the Spark code, so that the two
sides can disagree.  `with_prelude(select)` puts the chain before a query.
"""

from __future__ import annotations

CHAIN = r"""
movement AS (
  SELECT o_orderkey AS n, o_custkey AS k, 'TXN' AS prefix,
         strftime(o_orderdate + to_seconds(o_orderkey * 7919 % 86400), '%Y-%m-%d %H:%M:%S') AS ts_text,
         CASE o_orderpriority[1] WHEN '1' THEN 'TRANSFER' WHEN '2' THEN 'PAYMENT' WHEN '3' THEN 'DEPOSIT'
                                 WHEN '4' THEN 'WITHDRAWAL' WHEN '5' THEN 'DEBIT' END AS kind,
         o_totalprice::DECIMAL(18,2) AS money,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN 'FAILED'
              WHEN o_orderstatus = 'P' AND o_orderkey % 50 = 1 THEN 'REVERSED' ELSE 'POSTED' END AS status,
         'raw/transactions/source=batch/part-000.csv' AS source_file
  FROM orders
  UNION ALL
  SELECT event_id, user_id, 'EVT', strftime(ts, '%Y-%m-%d %H:%M:%S'),
         CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'signup' THEN 'DEPOSIT' WHEN 'view' THEN 'TRANSFER'
                         WHEN 'click' THEN 'DEBIT' WHEN 'error' THEN 'WITHDRAWAL' END,
         greatest(value::DECIMAL(18,2), 0.01::DECIMAL(18,2)),
         CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 'FAILED' ELSE 'POSTED' END,
         'raw/transactions/source=stream/ingest_date=2024-02-01/part-000.csv'
  FROM events
),
routed AS (
  SELECT *, (n * 37 % 100000)::DECIMAL(18,2) AS before_,
         CASE kind
           WHEN 'DEPOSIT' THEN ['BRANCH', 'ATM', 'MOBILE', 'ONLINE'][n % 4 + 1]
           WHEN 'WITHDRAWAL' THEN if(n % 4 = 0, 'BRANCH', 'ATM')
           WHEN 'DEBIT' THEN if(n % 10 < 7, 'POS', 'ONLINE')
           ELSE if(n % 10 = 0, 'BRANCH', if(n % 2 = 0, 'MOBILE', 'ONLINE')) END AS channel
  FROM movement
),
clean AS (
  SELECT n, prefix || lpad(n::VARCHAR, 10, '0') AS transaction_id, ts_text AS transaction_timestamp,
         'ACC' || lpad((k + 1)::VARCHAR, 7, '0') AS source_account_id,
         if(kind IN ('PAYMENT', 'DEBIT'), 'M', 'C') || lpad((n * 31 % 100000)::VARCHAR, 6, '0') AS counterparty_id,
         kind AS transaction_type, money::VARCHAR AS amount, channel,
         if(kind IN ('PAYMENT', 'DEBIT'),
            ['GROCERY', 'UTILITIES', 'DINING', 'RETAIL', 'TRAVEL', 'HEALTHCARE', 'FUEL', 'ENTERTAINMENT'][n % 8 + 1],
            '') AS merchant_category,
         if(channel IN ('BRANCH', 'ATM'), 'BR' || lpad((n % 25 + 1)::VARCHAR, 3, '0'), '') AS branch_id,
         status AS transaction_status, before_::VARCHAR AS balance_before,
         (if(kind = 'DEPOSIT', before_ + money, greatest(before_ - money, 0::DECIMAL(19,2))))::VARCHAR AS balance_after,
         if(n % 769 = 0, '1', '0') AS is_fraud_flag, source_file
  FROM routed
),
noisy AS (
  SELECT * REPLACE (
    CASE WHEN n % 2000 >= 32 AND n % 40 = 7 THEN ' ' || lower(channel) || ' '
         WHEN n % 2000 >= 32 AND n % 40 = 27 THEN channel[1] || lower(channel[2:]) ELSE channel END AS channel,
    CASE WHEN n % 2000 >= 32 AND n % 40 = 11 THEN lower(transaction_type) ELSE transaction_type END
      AS transaction_type)
  FROM clean
),
broken AS (
  SELECT * REPLACE (
    if(n % 2000 = 0, '', transaction_id) AS transaction_id,
    CASE WHEN n % 2000 BETWEEN 1 AND 4 THEN ''
         WHEN n % 2000 BETWEEN 5 AND 8 THEN 'ACC9' || lpad((n % 1000000)::VARCHAR, 6, '0')
         ELSE source_account_id END AS source_account_id,
    CASE WHEN n % 2000 = 9 THEN '0' WHEN n % 2000 BETWEEN 10 AND 12 THEN '-' || amount ELSE amount END AS amount,
    if(n % 2000 BETWEEN 13 AND 15, ['UNKNOWN', 'XFER', 'CHARGEBACK'][n % 2000 - 12], transaction_type)
      AS transaction_type,
    CASE WHEN n % 2000 BETWEEN 16 AND 18 THEN '2028' || transaction_timestamp[5:]
         WHEN n % 2000 = 19 THEN ['not-a-date', '31/13/2025 25:61', '2025-02-30 10:00:00'][n % 3 + 1]
         ELSE transaction_timestamp END AS transaction_timestamp,
    if(n % 2000 BETWEEN 20 AND 24, '', channel) AS channel)
  FROM noisy
),
copies AS (
  SELECT * REPLACE (
    if(n % 2000 <= 27, strftime(transaction_timestamp::TIMESTAMP + INTERVAL 60 SECOND, '%Y-%m-%d %H:%M:%S'),
       transaction_timestamp) AS transaction_timestamp)
  FROM broken WHERE n % 2000 BETWEEN 25 AND 31
),
raw AS MATERIALIZED (SELECT * FROM broken UNION ALL SELECT * FROM copies),
std AS MATERIALIZED (
  SELECT n, nullif(upper(trim(transaction_id)), '') AS transaction_id,
         try_strptime(trim(transaction_timestamp), '%Y-%m-%d %H:%M:%S') AS transaction_ts,
         nullif(upper(trim(source_account_id)), '') AS source_account_id,
         nullif(upper(trim(counterparty_id)), '') AS counterparty_id,
         nullif(upper(trim(transaction_type)), '') AS transaction_type,
         try_cast(trim(amount) AS DECIMAL(18,2)) AS amount,
         nullif(upper(trim(channel)), '') AS channel,
         nullif(upper(trim(merchant_category)), '') AS merchant_category,
         nullif(upper(trim(branch_id)), '') AS branch_id,
         nullif(upper(trim(transaction_status)), '') AS transaction_status,
         try_cast(trim(balance_before) AS DECIMAL(18,2)) AS balance_before,
         try_cast(trim(balance_after) AS DECIMAL(18,2)) AS balance_after,
         try_cast(trim(is_fraud_flag) AS INTEGER) AS is_fraud_flag,
         if(contains(source_file, 'source=stream'), 'STREAM', 'BATCH') AS ingest_source, source_file,
         transaction_timestamp AS raw_transaction_timestamp, amount AS raw_amount
  FROM raw
),
raw_branch AS (
  SELECT 'BR' || lpad((n_nationkey + 1)::VARCHAR, 3, '0') AS branch_id, n_name || ' Main Branch' AS branch_name,
         n_name AS city, ['MD', 'VA', 'DC', 'PA', 'NY', 'NJ', 'DE', 'NC', 'GA', 'FL',
           'TX', 'CA', 'IL', 'OH', 'MA', 'WA', 'AZ', 'CO', 'MN', 'TN'][n_nationkey % 20 + 1] AS state,
         replace(upper(r_name), ' ', '_') AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
raw_customer AS (
  SELECT c_custkey AS ck, 'CUST' || lpad(c_custkey::VARCHAR, 6, '0') AS customer_id,
         (DATE '2005-01-01' + (c_custkey * 37 % 5000)::INTEGER)::VARCHAR AS customer_since,
         ['MD', 'VA', 'DC', 'PA', 'NY', 'NJ', 'DE', 'NC', 'GA', 'FL',
          'TX', 'CA', 'IL', 'OH', 'MA', 'WA', 'AZ', 'CO', 'MN', 'TN'][c_nationkey % 20 + 1] AS state,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'MASS' WHEN 'MACHINERY' THEN 'MASS'
              WHEN 'AUTOMOBILE' THEN 'MASS_AFFLUENT' WHEN 'FURNITURE' THEN 'AFFLUENT'
              WHEN 'BUILDING' THEN 'SMALL_BUSINESS' END AS customer_segment,
         CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN c_acctbal < 2000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
         if(c_custkey % 10 < 7, 'Y', 'N') AS digital_enrolled_flag,
         'BR' || lpad((c_nationkey + 1)::VARCHAR, 3, '0') AS home_branch_id
  FROM customer
),
raw_account AS (
  SELECT c_custkey AS ck, 'ACC' || lpad((c_custkey + 1)::VARCHAR, 7, '0') AS account_id,
         'CUST' || lpad(c_custkey::VARCHAR, 6, '0') AS customer_id,
         CASE WHEN c_custkey % 20 < 11 THEN 'CHECKING' WHEN c_custkey % 20 < 17 THEN 'SAVINGS'
              WHEN c_custkey % 20 < 19 THEN 'MONEY_MARKET' ELSE 'CD' END AS account_type,
         (DATE '2005-01-01' + (c_custkey * 37 % 5000 + c_custkey * 13 % 2000)::INTEGER)::VARCHAR AS open_date,
         CASE c_custkey % 1000 WHEN 0 THEN 'ACTV' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN ''
              ELSE CASE WHEN c_custkey % 200 < 180 THEN 'ACTIVE' WHEN c_custkey % 200 < 192 THEN 'DORMANT'
                        WHEN c_custkey % 200 < 199 THEN 'CLOSED' ELSE 'FROZEN' END END AS account_status,
         c_acctbal::DECIMAL(18,2)::VARCHAR AS current_balance
  FROM customer
),
dim_customer AS (
  SELECT customer_id, customer_since::DATE AS customer_since, state, customer_segment, risk_tier,
         digital_enrolled_flag = 'Y' AS digital_enrolled_flag, home_branch_id,
         round(round((2024 - year(customer_since::DATE)) * 12 + 2 - month(customer_since::DATE)
               + if(day(customer_since::DATE) = 1, 0, (1 - day(customer_since::DATE)) / 31.0::DOUBLE), 8) / 12, 1)
           AS tenure_years
  FROM raw_customer
),
all_account AS (
  SELECT account_id, customer_id, account_type, open_date::DATE AS open_date,
         nullif(upper(trim(account_status)), '') AS account_status, current_balance::DECIMAL(18,2) AS current_balance
  FROM raw_account
),
dim_account AS (SELECT * FROM all_account WHERE account_status IN ('ACTIVE', 'DORMANT', 'CLOSED', 'FROZEN')),
dim_branch AS (SELECT branch_id, branch_name, city, state, region FROM raw_branch),
checked AS (
  SELECT std.*, a.customer_id, a.account_type, list_filter([
    if(transaction_id IS NULL, 'NULL_TXN_ID', NULL),
    if(source_account_id IS NULL, 'NULL_ACCOUNT', NULL),
    if(source_account_id IS NOT NULL AND a.account_id IS NULL, 'ORPHAN_ACCOUNT', NULL),
    if(amount IS NULL, 'INVALID_AMOUNT', NULL),
    if(amount <= 0, 'NON_POSITIVE_AMOUNT', NULL),
    if(transaction_ts IS NULL, 'INVALID_TIMESTAMP', NULL),
    if(transaction_ts > TIMESTAMP '2024-02-01', 'FUTURE_TIMESTAMP', NULL),
    if(coalesce(transaction_type, '') NOT IN ('DEPOSIT', 'WITHDRAWAL', 'PAYMENT', 'TRANSFER', 'DEBIT'),
       'INVALID_TYPE', NULL),
    if(channel IS NULL, 'NULL_CHANNEL', NULL),
    if(channel NOT IN ('MOBILE', 'ONLINE', 'ATM', 'BRANCH', 'POS'), 'INVALID_CHANNEL', NULL),
    if(coalesce(transaction_status, '') NOT IN ('POSTED', 'FAILED', 'REVERSED'), 'INVALID_STATUS', NULL)],
    lambda x: x IS NOT NULL) AS found
  FROM std LEFT JOIN all_account a ON std.source_account_id = a.account_id
),
flagged AS MATERIALIZED (
  SELECT * EXCLUDE (found),
         if(len(found) = 0 AND row_number() OVER (PARTITION BY transaction_id, len(found) = 0
              ORDER BY transaction_ts DESC NULLS LAST, source_file, n) > 1, ['DUPLICATE_TXN_ID'], found) AS reasons
  FROM checked
),
quarantine AS (
  SELECT transaction_id, transaction_ts, source_account_id, counterparty_id, transaction_type, amount, channel,
         merchant_category, branch_id, transaction_status, balance_before, balance_after, is_fraud_flag,
         ingest_source, source_file, raw_transaction_timestamp, raw_amount,
         array_to_string(reasons, ',') AS dq_fail_reasons, '20240201T000000Z' AS run_id,
         TIMESTAMP '2024-02-01' AS quarantined_at
  FROM flagged WHERE len(reasons) > 0
),
fact AS MATERIALIZED (
  SELECT transaction_id, transaction_ts, transaction_ts::DATE AS transaction_date,
         hour(transaction_ts)::INTEGER AS transaction_hour, source_account_id, customer_id, account_type,
         counterparty_id, transaction_type, if(transaction_type = 'DEPOSIT', 'INFLOW', 'OUTFLOW') AS flow_direction,
         amount, (if(transaction_type = 'DEPOSIT', amount, -amount))::DECIMAL(18,2) AS signed_amount, channel,
         channel IN ('MOBILE', 'ONLINE') AS digital_channel_flag, merchant_category, branch_id, transaction_status,
         transaction_status = 'FAILED' AS is_failed, balance_before, balance_after, is_fraud_flag, ingest_source,
         source_file, '20240201T000000Z' AS run_id, year(transaction_ts)::INTEGER AS "year",
         month(transaction_ts)::INTEGER AS "month", date_trunc('month', transaction_ts)::DATE AS month_start
  FROM flagged WHERE len(reasons) = 0
),
runs(run_id, run_ts, batch_only, max_rate) AS (
  VALUES ('20240130T000000Z', TIMESTAMP '2024-01-30', true, 0.05::DOUBLE),
         ('20240131T000000Z', TIMESTAMP '2024-01-31', true, 0.01::DOUBLE),
         ('20240201T000000Z', TIMESTAMP '2024-02-01', false, 0.05::DOUBLE)
),
run_rows AS (
  SELECT r.run_id, r.run_ts, f.* FROM runs r JOIN flagged f ON NOT r.batch_only OR f.ingest_source = 'BATCH'
),
run_totals AS (
  SELECT run_id, run_ts, max_rate, raw_rows, raw_rows - bad_rows AS curated_rows, bad_rows,
         round(bad_rows / raw_rows::DOUBLE, 6) AS rate
  FROM (SELECT run_id, run_ts, count(*) AS raw_rows, count(*) FILTER (len(reasons) > 0) AS bad_rows
        FROM run_rows GROUP BY ALL) JOIN runs USING (run_id, run_ts)
),
reason_history AS (
  SELECT reason, ingest_source, count(*) AS row_count, run_id, run_ts
  FROM (SELECT run_id, run_ts, ingest_source, unnest(reasons) AS reason FROM run_rows) GROUP BY ALL
),
judged AS (
  SELECT run_id, run_ts, 'raw_transactions' AS dataset, transaction_id, source_account_id, transaction_ts, channel,
         amount, transaction_type, transaction_status FROM run_rows
  UNION ALL
  SELECT run_id, run_ts, 'curated_transactions', transaction_id, source_account_id, transaction_ts, channel,
         amount, transaction_type, transaction_status
  FROM run_rows JOIN run_totals USING (run_id, run_ts) WHERE len(reasons) = 0 AND rate <= max_rate
),
repeats AS (
  SELECT run_id, dataset, count(*) AS repeated
  FROM (SELECT run_id, dataset, transaction_id FROM judged WHERE transaction_id IS NOT NULL
        GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL
),
measured AS (
  SELECT j.run_id, j.run_ts, j.dataset, count(*) AS n_rows,
         count(*) FILTER (transaction_id IS NULL) AS no_id,
         coalesce(any_value(r.repeated), 0) AS repeated,
         count(*) FILTER (source_account_id IS NULL) AS no_account,
         count(*) FILTER (transaction_ts IS NULL) AS no_ts,
         count(*) FILTER (channel IS NULL) AS no_channel,
         count(*) FILTER (amount <= 0) AS not_positive,
         count(*) FILTER (transaction_type NOT IN ('DEPOSIT', 'WITHDRAWAL', 'PAYMENT', 'TRANSFER', 'DEBIT')) AS bad_type,
         count(*) FILTER (channel NOT IN ('MOBILE', 'ONLINE', 'ATM', 'BRANCH', 'POS')) AS bad_channel,
         count(*) FILTER (transaction_status NOT IN ('POSTED', 'FAILED', 'REVERSED')) AS bad_status,
         count(*) FILTER (transaction_ts > j.run_ts) AS late
  FROM judged j LEFT JOIN repeats r ON j.run_id = r.run_id AND j.dataset = r.dataset
  GROUP BY j.run_id, j.run_ts, j.dataset
),
lines AS (
  SELECT run_id, run_ts, dataset, n_rows, unnest([
    {'rule': 'RowCount > 1000', 'ok': n_rows > 1000, 'txt': n_rows || ' rows', 'j': '{"rows":' || n_rows || '}'},
    {'rule': 'IsComplete "transaction_id"', 'ok': no_id = 0, 'txt': no_id || ' rows without transaction_id',
     'j': '{"nulls":' || no_id || '}'},
    {'rule': 'IsUnique "transaction_id"', 'ok': repeated = 0, 'txt': repeated || ' repeated values of transaction_id',
     'j': '{"repeated":' || repeated || '}'},
    {'rule': 'IsComplete "source_account_id"', 'ok': no_account = 0,
     'txt': no_account || ' rows without source_account_id', 'j': '{"nulls":' || no_account || '}'},
    {'rule': 'IsComplete "transaction_ts"', 'ok': no_ts = 0, 'txt': no_ts || ' rows without transaction_ts',
     'j': '{"nulls":' || no_ts || '}'},
    {'rule': 'IsComplete "channel"', 'ok': no_channel = 0, 'txt': no_channel || ' rows without channel',
     'j': '{"nulls":' || no_channel || '}'},
    {'rule': 'ColumnValues "amount" > 0', 'ok': not_positive = 0,
     'txt': not_positive || ' rows break the rule on amount', 'j': '{"violations":' || not_positive || '}'},
    {'rule': 'ColumnValues "transaction_type" in ["DEPOSIT", "WITHDRAWAL", "PAYMENT", "TRANSFER", "DEBIT"]',
     'ok': bad_type = 0, 'txt': bad_type || ' rows break the rule on transaction_type',
     'j': '{"violations":' || bad_type || '}'},
    {'rule': 'ColumnValues "channel" in ["MOBILE", "ONLINE", "ATM", "BRANCH", "POS"]', 'ok': bad_channel = 0,
     'txt': bad_channel || ' rows break the rule on channel', 'j': '{"violations":' || bad_channel || '}'},
    {'rule': 'ColumnValues "transaction_status" in ["POSTED", "FAILED", "REVERSED"]', 'ok': bad_status = 0,
     'txt': bad_status || ' rows break the rule on transaction_status', 'j': '{"violations":' || bad_status || '}'},
    {'rule': 'Completeness "channel" > 0.98', 'ok': round(1 - no_channel / n_rows::DOUBLE, 6) > 0.98,
     'txt': 'completeness of channel is ' || round(1 - no_channel / n_rows::DOUBLE, 6)::DECIMAL(9,6),
     'j': '{"completeness":' || round(1 - no_channel / n_rows::DOUBLE, 6)::DECIMAL(9,6) || '}'},
    {'rule': 'CustomSql "select count(*) from primary where transaction_ts > :as_of" = 0', 'ok': late = 0,
     'txt': 'query returned ' || late, 'j': '{"result":' || late || '}'}]) AS line
  FROM measured
),
outcome_history AS (
  SELECT run_id, run_ts, dataset, line.rule AS rule, if(line.ok, 'Passed', 'Failed') AS outcome,
         if(line.ok, NULL, line.txt) AS failure_reason, line.j AS evaluated_metrics
  FROM lines
),
summary AS (
  SELECT run_id, run_ts, raw_rows, curated_rows, bad_rows AS quarantined_rows, rate AS quarantine_rate,
         max_rate AS max_quarantine_rate,
         (SELECT round(avg(if(outcome = 'Passed', 1.0::DOUBLE, 0.0::DOUBLE)), 4) FROM outcome_history o
          WHERE o.run_id = t.run_id AND dataset = 'raw_transactions') AS raw_dq_score,
         (SELECT round(avg(if(outcome = 'Passed', 1.0::DOUBLE, 0.0::DOUBLE)), 4) FROM outcome_history o
          WHERE o.run_id = t.run_id AND dataset = 'curated_transactions') AS curated_dq_score,
         (SELECT count(*) FROM all_account
          WHERE coalesce(account_status, '') NOT IN ('ACTIVE', 'DORMANT', 'CLOSED', 'FROZEN')) AS accounts_quarantined,
         if(rate <= max_rate, 'PUBLISHED', 'BLOCKED_BY_QUALITY_GATE') AS pipeline_status
  FROM run_totals t
),
newest_rules AS (
  SELECT run_id, run_ts, dataset, rule, outcome, failure_reason, if(outcome = 'Passed', 1, 0)::INTEGER AS passed_flag
  FROM outcome_history QUALIFY run_ts = max(run_ts) OVER (PARTITION BY dataset)
),
reason_names(reason, dq_dimension, business_rule) AS (
  VALUES ('NULL_TXN_ID', 'Completeness', 'Every transaction has an ID'),
         ('NULL_ACCOUNT', 'Completeness', 'Every transaction has a source account'),
         ('NULL_CHANNEL', 'Completeness', 'Every transaction has a channel'),
         ('ORPHAN_ACCOUNT', 'Referential integrity', 'Source account exists in account master'),
         ('NON_POSITIVE_AMOUNT', 'Validity', 'Amount is greater than zero'),
         ('INVALID_AMOUNT', 'Validity', 'Amount is numeric'),
         ('INVALID_TYPE', 'Validity', 'Type is an approved transaction type'),
         ('INVALID_CHANNEL', 'Validity', 'Channel is an approved channel'),
         ('INVALID_STATUS', 'Validity', 'Status is POSTED, FAILED or REVERSED'),
         ('INVALID_TIMESTAMP', 'Validity', 'Timestamp is parseable'),
         ('FUTURE_TIMESTAMP', 'Timeliness', 'Timestamp is not in the future'),
         ('DUPLICATE_TXN_ID', 'Uniqueness', 'One record per transaction ID')
),
scorecard AS (
  SELECT dq_dimension, d.reason AS rule_code, business_rule, coalesce(r.failing, 0)::BIGINT AS failing_rows,
         s.raw_rows AS evaluated_rows,
         round(100 * (s.raw_rows - coalesce(r.failing, 0))::DOUBLE / s.raw_rows, 4) AS pass_rate_pct, s.run_id
  FROM reason_names d
  CROSS JOIN (SELECT * FROM summary ORDER BY run_ts DESC LIMIT 1) s
  LEFT JOIN (SELECT run_id, reason, sum(row_count) AS failing FROM reason_history GROUP BY ALL) r
         ON r.run_id = s.run_id AND r.reason = d.reason
),
daily AS (
  SELECT transaction_date, transaction_type, flow_direction, channel, digital_channel_flag, ingest_source,
         count(*) AS txn_count, sum(amount)::DECIMAL(28,2) AS txn_value,
         count(*) FILTER (is_failed) AS failed_txn_count, count(*) FILTER (is_fraud_flag = 1) AS fraud_labelled_count
  FROM fact GROUP BY ALL
),
kpis AS (
  SELECT month_start, count(*) AS txn_count, sum(amount)::DECIMAL(28,2) AS txn_value,
         round(sum(amount)::DECIMAL(28,2)::DOUBLE / count(*), 6) AS avg_txn_value,
         coalesce(sum(amount) FILTER (flow_direction = 'INFLOW'), 0)::DECIMAL(28,2) AS deposit_value,
         coalesce(sum(amount) FILTER (flow_direction = 'OUTFLOW'), 0)::DECIMAL(28,2) AS outflow_value,
         sum(signed_amount)::DECIMAL(28,2) AS net_flow, count(DISTINCT customer_id) AS active_customers,
         count(DISTINCT source_account_id) AS active_accounts,
         round(count(*)::DOUBLE / nullif(count(DISTINCT customer_id), 0), 6) AS txns_per_customer,
         round(count(*) FILTER (is_failed) / count(*)::DOUBLE, 6) AS failed_rate,
         round(count(*) FILTER (digital_channel_flag) / count(*)::DOUBLE, 6) AS digital_share
  FROM fact GROUP BY ALL
),
segment AS (
  SELECT month_start, customer_segment, state, risk_tier, digital_enrolled_flag, count(*) AS txn_count,
         sum(amount)::DECIMAL(28,2) AS txn_value, count(DISTINCT t.customer_id) AS active_customers,
         round(count(*) FILTER (digital_channel_flag) / count(*)::DOUBLE, 6) AS digital_share
  FROM fact t LEFT JOIN dim_customer c ON t.customer_id = c.customer_id GROUP BY ALL
),
customer_value AS (
  SELECT t.customer_id, customer_segment, state, risk_tier, tenure_years, digital_enrolled_flag,
         count(*) AS txn_count, sum(amount)::DECIMAL(28,2) AS txn_value,
         coalesce(sum(amount) FILTER (flow_direction = 'INFLOW'), 0)::DECIMAL(28,2) AS inflow_value,
         coalesce(sum(amount) FILTER (flow_direction = 'OUTFLOW'), 0)::DECIMAL(28,2) AS outflow_value,
         sum(signed_amount)::DECIMAL(28,2) AS net_flow,
         round(count(*) FILTER (digital_channel_flag) / count(*)::DOUBLE, 6) AS digital_share,
         max(transaction_date) AS last_txn_date,
         if(sum(signed_amount) < 0, 'NET_OUTFLOW', 'NET_INFLOW') AS flow_band
  FROM fact t LEFT JOIN dim_customer c ON t.customer_id = c.customer_id WHERE NOT is_failed
  GROUP BY t.customer_id, customer_segment, state, risk_tier, tenure_years, digital_enrolled_flag
),
merchant AS (
  SELECT month_start, merchant_category, channel, count(*) AS txn_count, sum(amount)::DECIMAL(28,2) AS txn_value
  FROM fact WHERE merchant_category IS NOT NULL GROUP BY ALL
),
stream_events AS (
  SELECT n, nullif(transaction_id, '') AS transaction_id, nullif(transaction_timestamp, '') AS transaction_timestamp,
         if(n % 200 = 3, NULL, nullif(source_account_id, '')) AS source_account_id, counterparty_id,
         if(n % 200 = 103, 'UNKNOWN', nullif(transaction_type, '')) AS transaction_type,
         if(n % 200 = 53, '-' || amount, amount) AS amount,
         if(n % 200 = 153, NULL, nullif(channel, '')) AS channel,
         nullif(merchant_category, '') AS merchant_category, nullif(branch_id, '') AS branch_id,
         transaction_status, balance_before, balance_after, is_fraud_flag,
         n % 500 IN (7, 8) AS undecodable
  FROM raw WHERE contains(source_file, 'source=stream')
)
"""


def with_prelude(select: str) -> str:
    select = select.strip()
    if select.startswith("WITH "):  # the query adds links of its own
        return f"WITH {CHAIN.strip()},\n{select.removeprefix('WITH ')}"
    return f"WITH {CHAIN.strip()}\n{select}"
