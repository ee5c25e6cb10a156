"""Declared table schemas, and projection of any frame onto one of them."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

log = logging.getLogger(__name__)

_INGEST_META = "_ingested_at TIMESTAMP, _source_system STRING, _batch_id STRING"
_SILVER_META = "_silver_loaded_at TIMESTAMP, _silver_batch_id STRING"
_GOLD_META = "_gold_loaded_at TIMESTAMP, _gold_batch_id STRING"

# Column names, types and order of every table.
_SOURCE = {
    "oracle_branches": (
        "branch_id STRING, branch_name STRING, region STRING, city STRING, branch_type STRING, "
        "status STRING, updated_at TIMESTAMP"
    ),
    "oracle_products": (
        "product_id STRING, product_name STRING, product_type STRING, interest_rate DOUBLE, "
        "status STRING, updated_at TIMESTAMP"
    ),
    "oracle_bank_accounts": (
        "account_id STRING, customer_id STRING, product_id STRING, branch_id STRING, "
        "account_type STRING, account_no STRING, balance DOUBLE, currency STRING, status STRING, "
        "opened_date DATE, closed_date DATE, interest_rate DOUBLE, updated_at TIMESTAMP"
    ),
    "oracle_loans": (
        "loan_id STRING, customer_id STRING, product_id STRING, branch_id STRING, "
        "loan_type STRING, principal_amount DOUBLE, outstanding_amount DOUBLE, "
        "interest_rate DOUBLE, disbursement_date DATE, maturity_date DATE, npl_status STRING, "
        "status STRING, updated_at TIMESTAMP"
    ),
    "oracle_bank_transactions": (
        "txn_id STRING, account_id STRING, txn_date DATE, txn_datetime TIMESTAMP, "
        "txn_type STRING, amount DOUBLE, balance_after DOUBLE, channel STRING, status STRING, "
        "created_at TIMESTAMP"
    ),
    "pg_customers": (
        "customer_id STRING, full_name STRING, date_of_birth DATE, gender STRING, "
        "id_number STRING, phone STRING, email STRING, city STRING, province STRING, "
        "customer_segment STRING, kyc_status STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "pg_card_accounts": (
        "account_id STRING, customer_id STRING, card_type STRING, card_number STRING, "
        "credit_limit DOUBLE, outstanding_balance DOUBLE, due_date DATE, status STRING, "
        "opened_date DATE, closed_date DATE, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "pg_card_transactions": (
        "txn_id STRING, account_id STRING, txn_date DATE, txn_datetime TIMESTAMP, amount DOUBLE, "
        "currency STRING, txn_type STRING, merchant_name STRING, merchant_category STRING, "
        "channel STRING, status STRING, created_at TIMESTAMP"
    ),
}

_SILVER = {
    "dim_customer": (
        "customer_sk STRING, customer_id STRING, full_name STRING, date_of_birth DATE, "
        "gender STRING, id_number STRING, phone STRING, email STRING, city STRING, "
        "province STRING, customer_segment STRING, kyc_status STRING, row_hash STRING, "
        "effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN, version INT"
    ),
    "dim_account": _SOURCE["oracle_bank_accounts"],
    "dim_card_account": (
        "account_id STRING, customer_id STRING, card_type STRING, card_number STRING, "
        "credit_limit DOUBLE, outstanding_balance DOUBLE, due_date DATE, status STRING, "
        "opened_date DATE, closed_date DATE, updated_at TIMESTAMP"
    ),
    "dim_product": _SOURCE["oracle_products"],
    "dim_branch": _SOURCE["oracle_branches"],
    "dim_loan": _SOURCE["oracle_loans"],
    "fct_bank_transactions": _SOURCE["oracle_bank_transactions"],
    "fct_card_transactions": _SOURCE["pg_card_transactions"],
}

_GOLD = {
    "agg_customer_holdings": (
        "customer_id STRING, total_product_count INT, has_savings BOOLEAN, has_current BOOLEAN, "
        "has_credit_card BOOLEAN, has_loan BOOLEAN, total_deposit_balance DOUBLE, "
        "total_loan_outstanding DOUBLE, total_credit_limit DOUBLE, "
        "total_card_outstanding DOUBLE, credit_utilization_rate DOUBLE, net_asset_value DOUBLE, "
        "has_npl_loan BOOLEAN, days_past_due INT, first_open_date DATE"
    ),
    "agg_customer_txn_12m": (
        "customer_id STRING, txn_count_12m INT, txn_amount_12m DOUBLE, avg_monthly_spend DOUBLE, "
        "active_months_12m INT, top_spend_category STRING, digital_txn_ratio DOUBLE, "
        "last_txn_date DATE, recency_days INT, frequency_12m INT, monetary_12m DOUBLE"
    ),
    "mart_customer_360": (
        "customer_id STRING, full_name STRING, age INT, gender STRING, customer_segment STRING, "
        "kyc_status STRING, city STRING, province STRING, total_product_count INT, "
        "has_savings BOOLEAN, has_current BOOLEAN, has_credit_card BOOLEAN, has_loan BOOLEAN, "
        "total_deposit_balance DOUBLE, total_loan_outstanding DOUBLE, "
        "credit_utilization_rate DOUBLE, net_asset_value DOUBLE, txn_count_12m INT, "
        "txn_amount_12m DOUBLE, avg_monthly_spend DOUBLE, top_spend_category STRING, "
        "digital_txn_ratio DOUBLE, last_txn_date DATE, active_months_12m INT, recency_days INT, "
        "frequency_12m INT, monetary_12m DOUBLE, r_score INT, f_score INT, m_score INT, "
        "rfm_score STRING, rfm_segment STRING, has_npl_loan BOOLEAN, days_past_due INT, "
        "cross_sell_loan_flag BOOLEAN, cross_sell_card_flag BOOLEAN, "
        "cross_sell_invest_flag BOOLEAN, tenure_days INT, phone_masked STRING, "
        "email_masked STRING, snapshot_date DATE"
    ),
}

_TYPES = {
    "STRING": StringType(),
    "DOUBLE": DoubleType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
}


def _struct(columns: str) -> StructType:
    schema = StructType()
    for column in columns.split(","):
        name, type_name = column.split()
        schema = schema.add(name, _TYPES[type_name])
    return schema


AUDIT = _struct(
    "batch_id STRING, table_name STRING, source_system STRING, run_mode STRING, status STRING, "
    "rows_ingested BIGINT, last_run_time TIMESTAMP, current_run_time TIMESTAMP, "
    "error_message STRING, created_at TIMESTAMP"
)


def _with_meta(tables: dict[str, str], meta: str) -> dict[str, StructType]:
    return {name: _struct(f"{ddl}, {meta}") for name, ddl in tables.items()}


BRONZE = _with_meta(_SOURCE, _INGEST_META)
SILVER = _with_meta(_SILVER, _SILVER_META)
GOLD = _with_meta(_GOLD, _GOLD_META)


def dropped_columns(df: DataFrame, schema: StructType) -> list[str]:
    """Columns of the frame that have no place in the schema."""
    wanted = {f.name.lower() for f in schema}
    return [c for c in df.columns if c.lower() not in wanted]


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto the schema: names matched without case, values cast or NULL.

    Missing columns become NULL, columns outside the schema are dropped and logged.
    """
    dropped = dropped_columns(df, schema)
    if dropped:
        log.info("columns outside the target schema: %s", ", ".join(dropped))
    present = {c.lower(): c for c in df.columns}
    projected = []
    for target in schema:
        name = present.get(target.name.lower())
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        if name is None or df.schema[name].dataType != target.dataType:
            value = value.try_cast(target.dataType)
        projected.append(value.alias(target.name))
    return df.select(*projected)
