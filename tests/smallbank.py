"""A few invented source rows that cover the awkward cases."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql.types import StructType

from clientlens.schemas import BRONZE

T0 = datetime(2024, 10, 1)


def source_schema(bronze: str) -> StructType:
    return StructType([f for f in BRONZE[bronze] if not f.name.startswith("_")])


def _row(bronze: str, **values):
    return tuple(values.get(f.name) for f in source_schema(bronze))


def customer(cid, name, segment="MASS", **other):
    values = {
        "date_of_birth": date(1980, 1, 1),
        "gender": "F",
        "phone": "0900000" + cid[-3:],
        "email": f"{cid.lower()}@mail.test",
        "city": "Hue",
        "province": "Hue",
        "kyc_status": "VERIFIED",
        "created_at": T0,
        "updated_at": T0,
        **other,
    }
    return _row("pg_customers", customer_id=cid, full_name=name, customer_segment=segment, **values)


def account(aid, cid, kind="CURRENT", balance=0.0, **other):
    values = {"status": "ACTIVE", "opened_date": date(2020, 1, 1), "updated_at": T0, **other}
    return _row(
        "oracle_bank_accounts",
        account_id=aid,
        customer_id=cid,
        account_type=kind,
        balance=balance,
        **values,
    )


def card(aid, cid, kind="VISA_CREDIT", limit=None, owed=0.0, **other):
    values = {"status": "ACTIVE", "opened_date": date(2021, 1, 1), "updated_at": T0, **other}
    return _row(
        "pg_card_accounts",
        account_id=aid,
        customer_id=cid,
        card_type=kind,
        credit_limit=limit,
        outstanding_balance=owed,
        **values,
    )


def loan(lid, cid, owed, npl="NORMAL", **other):
    values = {"status": "ACTIVE", "maturity_date": date(2026, 1, 1), "updated_at": T0, **other}
    return _row(
        "oracle_loans",
        loan_id=lid,
        customer_id=cid,
        outstanding_amount=owed,
        npl_status=npl,
        **values,
    )


def bank_txn(tid, aid, on, amount, channel="ONLINE", **other):
    values = {"status": "COMPLETED", "created_at": T0, **other}
    return _row(
        "oracle_bank_transactions",
        txn_id=tid,
        account_id=aid,
        txn_date=on,
        amount=amount,
        channel=channel,
        **values,
    )


def card_txn(tid, aid, on, amount, category, channel="POS", **other):
    values = {"status": "COMPLETED", "created_at": T0, **other}
    return _row(
        "pg_card_transactions",
        txn_id=tid,
        account_id=aid,
        txn_date=on,
        amount=amount,
        merchant_category=category,
        channel=channel,
        **values,
    )


def branch(bid):
    return _row("oracle_branches", branch_id=bid, branch_name="Main", status="active", updated_at=T0)


def product(pid):
    return _row("oracle_products", product_id=pid, product_type="savings", updated_at=T0)


def first_delivery() -> dict[str, list[tuple]]:
    return {
        "pg_customers": [
            customer("C001", "  Mai Thu Lan ", "affluent"),
            customer("C002", "Do Van Khoa"),
            customer("C003", "Vo Ngoc", "PREMIER", city=""),
            customer("C004", "Bui Ha"),
        ],
        "pg_card_accounts": [
            card("K1", "C001", limit=1000.0, owed=250.0),
            card("K2", "C002", "VISA_DEBIT"),
        ],
        "oracle_bank_accounts": [
            account("A1", "C001", balance=500.0),
            account("A2", "C001", "TERM_DEPOSIT", 1500.0),
            account("A3", "C002", balance=70.0, status="closed"),
            account("A4", "C003", balance=9000.0),
        ],
        "oracle_loans": [
            loan("L1", "C002", 300.0, "OVERDUE", maturity_date=date(2024, 10, 20)),
            loan("L2", "C003", 100.0, None),
        ],
        "oracle_bank_transactions": [
            bank_txn("B1", "A1", date(2024, 10, 30), 10.0),
            bank_txn("B2", "A3", date(2024, 9, 1), 20.0, " atm "),
            bank_txn("B3", "A4", date(2024, 8, 1), 30.0, status="PENDING"),
            bank_txn("B4", "A4", date(2023, 10, 31), 40.0),
            bank_txn("B5", "A9", date(2024, 10, 1), 50.0),
            bank_txn(None, "A1", date(2024, 10, 1), 60.0),
        ],
        "pg_card_transactions": [
            card_txn("T1", "K1", date(2024, 10, 31), 5.0, "DINING"),
            card_txn("T2", "K1", date(2024, 10, 2), 5.0, "BOOKS", "online"),
            card_txn("T3", "K1", date(2023, 11, 1), 2.5, "FUEL", None),
        ],
        "oracle_branches": [branch("BR1")],
        "oracle_products": [product("P1"), product("P2")],
    }


def reader(spark, delivery: dict[str, list[tuple]]):
    """A source reader over in-memory rows that honours change windows."""
    from clientlens.operators.incremental import change_window

    def read(table, last, now):
        rows = spark.createDataFrame(delivery[table.bronze], source_schema(table.bronze)).coalesce(1)
        if last is None or table.change_column is None:
            return rows
        return change_window(rows, table.change_column, last, now)

    return read
