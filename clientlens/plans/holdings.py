"""What every current customer holds: accounts, cards, loans, balances and risk."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.functions.money import exact


def active_products(df: DataFrame) -> DataFrame:
    """The accounts, cards or loans that count as holdings."""
    return df.filter(F.col("status") == "ACTIVE")


def _product_rows(
    accounts: DataFrame, cards: DataFrame, loans: DataFrame, as_of: date
) -> DataFrame:
    """One narrow row per active product of any kind; measures of other kinds are NULL."""
    not_normal = F.col("npl_status") != "NORMAL"
    bank = active_products(accounts).select(
        "customer_id",
        F.lit("BANK").alias("kind"),
        exact(F.col("balance")).alias("deposit"),
        (F.col("account_type") == "TERM_DEPOSIT").alias("is_savings"),
        (F.col("account_type") == "CURRENT").alias("is_current_account"),
        F.col("opened_date").alias("bank_opened"),
    )
    card = active_products(cards).select(
        "customer_id",
        F.lit("CARD").alias("kind"),
        exact(F.col("credit_limit")).alias("card_limit"),
        exact(F.col("outstanding_balance")).alias("card_owed"),
        F.contains(F.col("card_type"), F.lit("CREDIT")).alias("is_credit"),
        F.col("opened_date").alias("card_opened"),
    )
    loan = active_products(loans).select(
        "customer_id",
        F.lit("LOAN").alias("kind"),
        exact(F.col("outstanding_amount")).alias("loan_owed"),
        not_normal.alias("is_npl"),
        F.when(
            not_normal, F.greatest(F.datediff(F.lit(as_of), "maturity_date"), F.lit(0))
        ).alias("overdue_days"),
    )
    return bank.unionByName(card, allowMissingColumns=True).unionByName(
        loan, allowMissingColumns=True
    )


def customer_holdings(
    customers: DataFrame, accounts: DataFrame, cards: DataFrame, loans: DataFrame, as_of: date
) -> DataFrame:
    """One row per current customer.

    ``customers`` holds the versions of the customer dimension; the other inputs are the
    account, card and loan dimensions. All products go through one aggregation, which
    combines on the map side, and one join with the customers.
    """
    products = (
        _product_rows(accounts, cards, loans, as_of)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.count_if(F.col("kind") == "LOAN").alias("loans"),
            F.bool_or("is_savings").alias("savings"),
            F.bool_or("is_current_account").alias("current"),
            F.bool_or("is_credit").alias("credit"),
            F.bool_or("is_npl").alias("npl"),
            F.sum("deposit").alias("deposit"),
            F.sum("card_limit").alias("card_limit"),
            F.sum("card_owed").alias("card_owed"),
            F.sum("loan_owed").alias("loan_owed"),
            F.max("overdue_days").alias("overdue_days"),
            F.min("bank_opened").alias("bank_opened"),
            F.min("card_opened").alias("card_opened"),
        )
    )
    spine = customers.filter("is_current").select("customer_id").distinct()

    zero = F.lit(0).cast("decimal(18,2)")
    deposit, limit, card_owed, loan_owed = (
        F.coalesce(c, zero) for c in ("deposit", "card_limit", "card_owed", "loan_owed")
    )
    loans_held = F.coalesce("loans", F.lit(0))
    default_open = F.lit(as_of)

    def flag(name: str):
        return F.coalesce(name, F.lit(False))

    return spine.join(products, "customer_id", "left").select(
        "customer_id",
        F.coalesce("products", F.lit(0)).cast("int").alias("total_product_count"),
        flag("savings").alias("has_savings"),
        flag("current").alias("has_current"),
        flag("credit").alias("has_credit_card"),
        (loans_held > 0).alias("has_loan"),
        deposit.cast("double").alias("total_deposit_balance"),
        loan_owed.cast("double").alias("total_loan_outstanding"),
        limit.cast("double").alias("total_credit_limit"),
        card_owed.cast("double").alias("total_card_outstanding"),
        F.when(limit > 0, card_owed.cast("double") / limit.cast("double"))
        .otherwise(0.0)
        .alias("credit_utilization_rate"),
        (deposit - loan_owed - card_owed).cast("double").alias("net_asset_value"),
        flag("npl").alias("has_npl_loan"),
        F.coalesce("overdue_days", F.lit(0)).cast("int").alias("days_past_due"),
        F.least(
            F.coalesce("bank_opened", default_open), F.coalesce("card_opened", default_open)
        ).alias("first_open_date"),
    )
