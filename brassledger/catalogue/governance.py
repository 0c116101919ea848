"""Masking, row access, tags, and the same mart as three roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from brassledger.catalogue.core import query
from brassledger.operators import governance as G

MASK = "'H_' || sha256({c})[:16]"


def _masked(columns: str) -> str:
    return ", ".join(f"{MASK.format(c=c)} AS {c}" for c in columns.split())


@query(
    "mask_identifier",
    f"SELECT customer_id AS raw_id, {_masked('customer_id')}, customer_id AS steward_sees FROM dim_customer",
)
def mask_identifier(ws):
    return ws.current.dim_customer.select(
        F.col("customer_id").alias("raw_id"),
        G.mask_identifier("customer_id", G.ANALYST).alias("customer_id"),
        G.mask_identifier("customer_id", G.STEWARD).alias("steward_sees"),
    )


@query(
    "mask_balance",
    """SELECT account_id, round(current_balance, -3)::DECIMAL(18,2) AS current_balance,
              current_balance AS engineer_sees FROM dim_account""",
)
def mask_balance(ws):
    return ws.current.dim_account.select(
        "account_id",
        G.mask_balance("current_balance", G.ANALYST).alias("current_balance"),
        G.mask_balance("current_balance", G.ENGINEER).alias("engineer_sees"),
    )


@query(
    "apply_masking",
    f"""SELECT 'dim_account' AS table_name, {MASK.format(c='account_id')} AS key_1,
               {MASK.format(c='customer_id')} AS key_2, NULL AS key_3,
               round(current_balance, -3)::DECIMAL(18,2) AS money_1, NULL::DECIMAL(18,2) AS money_2 FROM dim_account
        UNION ALL SELECT 'dim_customer', {MASK.format(c='customer_id')}, NULL, NULL, NULL, NULL FROM dim_customer
        UNION ALL SELECT 'fact_transactions', {MASK.format(c='customer_id')}, {MASK.format(c='source_account_id')},
               {MASK.format(c='counterparty_id')}, round(balance_before, -3)::DECIMAL(18,2),
               round(balance_after, -3)::DECIMAL(18,2) FROM fact""",
)
def apply_masking(ws):
    """All nine bindings: three tables as the analyst sees them, one below the other."""
    frames = {"dim_account": ws.current.dim_account, "dim_customer": ws.current.dim_customer, "fact_transactions": ws.current.fact}
    parts = []
    for name, df in frames.items():
        kinds = {"identifier": [], "balance": []}
        for column, kind in G.MASKED[name].items():
            kinds[kind].append(F.col(column))
        keys = kinds["identifier"] + [F.lit(None).cast("string")] * 3
        money = kinds["balance"] + [F.lit(None).cast("decimal(18,2)")] * 2
        shown = [c.alias(f"key_{i}") for i, c in enumerate(keys[:3], 1)]
        shown += [c.alias(f"money_{i}") for i, c in enumerate(money[:2], 1)]
        parts.append(G.apply_masking(df, name, G.ANALYST).select(F.lit(name).alias("table_name"), *shown))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(
    "row_access_state",
    """SELECT customer_id, state FROM dim_customer WHERE state IN ('MD', 'VA', 'DC', 'DE', 'PA')""",
)
def row_access_state(ws):
    return G.visible_rows(ws.current.dim_customer, G.REGIONAL).select("customer_id", "state")


@query(
    "state_entitlements",
    """SELECT 'BANK_ANALYST_MID_ATLANTIC' AS role_name, e.state, count(customer_id) AS customers
       FROM (VALUES ('MD'), ('VA'), ('DC'), ('DE'), ('PA')) e(state) LEFT JOIN dim_customer c ON c.state = e.state
       GROUP BY ALL""",
)
def state_entitlements(ws):
    per_state = ws.current.dim_customer.groupBy("state").agg(F.count("customer_id").alias("n"))
    joined = G.entitlements(ws.spark).join(per_state, "state", "left")
    return joined.select("role_name", "state", F.coalesce("n", F.lit(0)).cast("bigint").alias("customers"))


TAGGED = {
    "customer_id": "DIRECT_IDENTIFIER",
    "source_account_id": "DIRECT_IDENTIFIER",
    "counterparty_id": "DIRECT_IDENTIFIER",
    "balance_before": "SENSITIVE_FINANCIAL",
    "balance_after": "SENSITIVE_FINANCIAL",
}


@query(
    "tag_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{tag}' AS classification, count({c}) AS filled_values FROM fact"
        for c, tag in TAGGED.items()
    ),
)
def tag_columns(ws):
    """Tags survive a projection; each tagged column with the values it covers, from one pass."""
    tagged = G.tag_columns(ws.current.fact, "fact_transactions").select(*TAGGED)
    return G.tag_report(tagged, "fact_transactions").select("column_name", "classification", "filled_values")


@query(
    "tag_report",
    """SELECT 'dim_account' AS table_name, 'account_id' AS column_name, 'DIRECT_IDENTIFIER' AS classification,
              'identifier' AS mask, count(account_id) AS filled_values FROM dim_account
       UNION ALL SELECT 'dim_account', 'customer_id', NULL, 'identifier', count(customer_id) FROM dim_account
       UNION ALL SELECT 'dim_account', 'account_type', NULL, NULL, count(account_type) FROM dim_account
       UNION ALL SELECT 'dim_account', 'open_date', NULL, NULL, count(open_date) FROM dim_account
       UNION ALL SELECT 'dim_account', 'account_status', NULL, NULL, count(account_status) FROM dim_account
       UNION ALL SELECT 'dim_account', 'current_balance', 'SENSITIVE_FINANCIAL', 'balance', count(current_balance)
                 FROM dim_account""",
)
def tag_report(ws):
    """Shows on purpose that account.customer_id is masked although it carries no tag."""
    return G.tag_report(G.tag_columns(ws.current.dim_account, "dim_account"), "dim_account")


@query(
    "access_matrix",
    """SELECT * FROM (
         SELECT 'BANK_DATA_ENGINEER' AS role_name, 'everything' AS sees, 'raw' AS identifiers,
                count(*) AS customers_visible, count(DISTINCT state) AS states_visible FROM dim_customer
         UNION ALL SELECT 'BANK_DQ_STEWARD', 'analytics + dq/quarantine', 'raw', count(*), count(DISTINCT state)
                   FROM dim_customer
         UNION ALL SELECT 'BANK_ANALYST', 'analytics marts', 'hashed', count(*), count(DISTINCT state)
                   FROM dim_customer
         UNION ALL SELECT 'BANK_ANALYST_MID_ATLANTIC', 'analytics marts', 'hashed', count(*), count(DISTINCT state)
                   FROM dim_customer WHERE state IN ('MD', 'VA', 'DC', 'DE', 'PA'))""",
)
def access_matrix(ws):
    return G.access_matrix(ws.masters.dim_customer)


@query(
    "masked_join_still_works",
    """SELECT count(*) AS joined_rows, count(DISTINCT customer_id) AS distinct_customers, true AS same_as_raw
       FROM fact JOIN dim_customer USING (customer_id)""",
)
def masked_join_still_works(ws):
    """Rows and distinct keys of fact x customer, once on raw and once on hashed keys."""

    def joined(role):
        per_customer = ws.current.fact.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
        per_customer = G.apply_masking(per_customer, "fact_transactions", role)  # one hash per customer
        customers = G.apply_masking(ws.current.dim_customer, "dim_customer", role).select("customer_id")
        matched = per_customer.join(customers, "customer_id")
        return matched.agg(F.sum("n").alias("joined_rows"), F.count(F.lit(1)).alias("distinct_customers"))

    raw = joined(G.ENGINEER).select(F.struct("joined_rows", "distinct_customers")).scalar()
    same = (F.col("joined_rows") == raw["joined_rows"]) & (F.col("distinct_customers") == raw["distinct_customers"])
    return joined(G.ANALYST).withColumn("same_as_raw", same)


@query(
    "governance_demo",
    f"""WITH seen AS (
          SELECT 'BANK_ANALYST' AS role_name, {_masked('customer_id')}, state, net_flow FROM customer_value
          UNION ALL SELECT 'BANK_ANALYST_MID_ATLANTIC', {_masked('customer_id')}, state, net_flow FROM customer_value
                    WHERE state IN ('MD', 'VA', 'DC', 'DE', 'PA')
          UNION ALL SELECT 'BANK_DQ_STEWARD', customer_id, state, net_flow FROM customer_value),
        states AS (SELECT role_name, count(DISTINCT state) AS states_visible,
                          string_agg(DISTINCT state, ',' ORDER BY state) AS states
                   FROM (SELECT 'BANK_ANALYST' AS role_name, state FROM segment
                         UNION ALL SELECT 'BANK_DQ_STEWARD', state FROM segment
                         UNION ALL SELECT 'BANK_ANALYST_MID_ATLANTIC', state FROM segment
                                   WHERE state IN ('MD', 'VA', 'DC', 'DE', 'PA')) GROUP BY ALL)
        SELECT role_name, customer_id, state, net_flow, states_visible, states FROM seen JOIN states USING (role_name)
        QUALIFY row_number() OVER (PARTITION BY role_name ORDER BY net_flow, customer_id) <= 5""",
)
def governance_demo(ws):
    """Five lowest net flows and the visible states, as analyst, regional analyst, and steward."""
    parts = []
    listed = F.expr("listagg(DISTINCT state, ',') WITHIN GROUP (ORDER BY state)")
    for role in (G.ANALYST, G.REGIONAL, G.STEWARD):
        seen = ws.current_secure(role)
        lowest = seen.customer_value().orderBy("net_flow", "customer_id").limit(5)
        states = seen.monthly_segment().select("state").distinct()
        reach = states.agg(F.struct(F.count("state").alias("n"), listed.alias("names"))).scalar()
        parts.append(
            lowest.select(
                F.lit(role).alias("role_name"),
                "customer_id",
                "state",
                "net_flow",
                reach["n"].alias("states_visible"),
                reach["names"].alias("states"),
            )
        )
    return parts[0].unionAll(parts[1]).unionAll(parts[2])
