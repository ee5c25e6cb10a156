"""The banking source tables, expressed over the bundled order and customer test tables.

The text is plain SQL that Spark and other engines read alike; names in braces stand for
the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_SQL = {
    "src_customers": """
        SELECT concat('CIF', lpad(CAST(c_custkey AS STRING), 9, '0')) AS customer_id,
               replace(c_name, '#', ' ') AS full_name,
               DATE '1955-01-01' + CAST((c_custkey * 37) % 17000 AS INT) AS date_of_birth,
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
               concat('079', lpad(CAST(c_custkey AS STRING), 9, '0')) AS id_number,
               concat('09', lpad(CAST(c_custkey AS STRING), 8, '0')) AS phone,
               concat('user', CAST(c_custkey AS STRING), '@example.com') AS email,
               n_name AS city, r_name AS province,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'PREMIER' WHEN 'AUTOMOBILE' THEN 'AFFLUENT'
                                 WHEN 'MACHINERY' THEN 'AFFLUENT' ELSE 'MASS' END AS customer_segment,
               'VERIFIED' AS kyc_status
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    """,
    "src_bank_accounts": """
        SELECT concat('BACC', CAST(c_custkey AS STRING)) AS account_id,
               concat('CIF', lpad(CAST(c_custkey AS STRING), 9, '0')) AS customer_id,
               CASE WHEN c_custkey % 3 = 0 THEN 'TERM_DEPOSIT' ELSE 'CURRENT' END AS account_type,
               c_acctbal AS balance,
               CASE WHEN c_custkey % 20 = 0 THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
               DATE '1995-01-01' + CAST(c_custkey % 1500 AS INT) AS opened_date
        FROM {customer}
    """,
    "src_card_accounts": """
        SELECT concat('CARD', CAST(c_custkey AS STRING)) AS account_id,
               concat('CIF', lpad(CAST(c_custkey AS STRING), 9, '0')) AS customer_id,
               CASE c_custkey % 3 WHEN 0 THEN 'VISA_CREDIT' WHEN 1 THEN 'MASTERCARD_CREDIT' ELSE 'VISA_DEBIT' END AS card_type,
               CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE CAST(10000 AS DOUBLE) END AS credit_limit,
               CASE WHEN c_acctbal > 0 AND c_custkey % 3 <> 2 THEN c_acctbal ELSE CAST(0 AS DOUBLE) END AS outstanding_balance,
               CASE WHEN c_custkey % 2 = 0 THEN 'ACTIVE' ELSE 'CLOSED' END AS status,
               DATE '1996-01-01' + CAST(c_custkey % 900 AS INT) AS opened_date
        FROM {customer}
    """,
    "src_loans": """
        SELECT concat('LOAN', CAST(o_orderkey AS STRING)) AS loan_id,
               concat('CIF', lpad(CAST(o_custkey AS STRING), 9, '0')) AS customer_id,
               o_totalprice AS outstanding_amount,
               CASE WHEN o_orderkey % 130 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN 'OVERDUE' ELSE 'NORMAL' END AS npl_status,
               CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 50 <> 0 THEN 'ACTIVE' ELSE 'CLOSED' END AS status,
               CAST(o_orderdate AS DATE) + 365 AS maturity_date
        FROM {orders}
    """,
    "src_bank_transactions": """
        SELECT CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE concat('BTXN', CAST(o_orderkey AS STRING)) END AS txn_id,
               concat('BACC', CAST(o_custkey AS STRING)) AS account_id,
               CAST(o_orderdate AS DATE) AS txn_date,
               o_totalprice AS amount,
               CASE WHEN o_orderkey % 53 = 0 THEN '' WHEN o_orderpriority = '1-URGENT' THEN ' online '
                    WHEN o_orderpriority = '2-HIGH' THEN 'ATM' WHEN o_orderpriority = '3-MEDIUM' THEN 'POS'
                    ELSE 'BRANCH' END AS channel,
               CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'completed' END AS status,
               CAST(o_orderdate AS TIMESTAMP) AS _ingested_at
        FROM {orders}
    """,
    "src_card_transactions": """
        SELECT concat('CTXN', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS txn_id,
               concat('CARD', CAST(o_custkey AS STRING)) AS account_id,
               CAST(l_shipdate AS DATE) AS txn_date,
               l_extendedprice AS amount,
               p_type AS merchant_category,
               CASE WHEN l_returnflag = 'N' THEN 'ONLINE' ELSE 'POS' END AS channel,
               CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'PENDING' END AS status,
               CAST(l_shipdate AS TIMESTAMP) AS _ingested_at,
               l_partkey AS src_seq
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
    """,
}

CHANGED_CUSTOMERS_SQL = """
    SELECT CASE WHEN k % 100 = 0 THEN concat('CIFN', substr(customer_id, 4)) ELSE customer_id END AS customer_id,
           full_name, date_of_birth, gender, id_number, phone,
           CASE WHEN k % 7 = 1 THEN concat('new.', email) ELSE email END AS email,
           city, province,
           CASE WHEN k % 7 = 0 THEN 'PREMIER' ELSE customer_segment END AS customer_segment,
           kyc_status
    FROM (SELECT *, CAST(substr(customer_id, 4) AS BIGINT) AS k FROM {src}) t
"""

_INPUTS = ("customer", "nation", "region", "orders", "lineitem", "part")


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the bundled tables."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def source_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One banking source table over the bundled tables in ``folder``."""
    text = SOURCE_SQL[name]
    inputs = {t: load(spark, folder, t) for t in _INPUTS if f"{{{t}}}" in text}
    return spark.sql(text, **inputs)


def changed_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A second delivery of the customers: changed segments, changed e-mails, new ids."""
    return spark.sql(CHANGED_CUSTOMERS_SQL, src=source_table(spark, folder, "src_customers"))
