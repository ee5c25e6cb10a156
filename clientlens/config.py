"""Run settings: defaults in code, overridable from YAML files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

# Business rules every deployment starts from.
DEFAULT_CROSS_SELL = {
    "cross_sell_loan_flag": "NOT has_loan AND total_deposit_balance >= 50000000",
    "cross_sell_card_flag": "NOT has_credit_card AND txn_count_12m >= 12",
    "cross_sell_invest_flag": (
        "net_asset_value >= 200000000 AND customer_segment IN ('AFFLUENT','PREMIER')"
    ),
}


@dataclass(frozen=True)
class GoldSettings:
    """Parameters of the gold layer. ``as_of=None`` means the latest transaction date."""

    as_of: date | None = None
    lookback_months: int = 12
    digital_channels: tuple[str, ...] = ("ONLINE",)
    cross_sell: Mapping[str, str] = field(default_factory=lambda: dict(DEFAULT_CROSS_SELL))

    @classmethod
    def from_mapping(cls, raw: Mapping) -> GoldSettings:
        """Build from the parsed YAML of a gold configuration file."""
        as_of = raw.get("as_of_date", "auto")
        if as_of == "auto" or as_of is None:
            as_of = None
        elif not isinstance(as_of, date):
            as_of = date.fromisoformat(str(as_of))
        rules = {f"cross_sell_{name}": text for name, text in raw.get("crosssell", {}).items()}
        channels = raw.get("thresholds", {}).get("digital_channels", ["ONLINE"])
        return cls(
            as_of=as_of,
            lookback_months=int(raw.get("lookback_months", 12)),
            digital_channels=tuple(channels),
            cross_sell={**DEFAULT_CROSS_SELL, **rules},
        )


@dataclass(frozen=True)
class SourceTable:
    """One table to ingest. ``change_column=None`` means it is always read in full."""

    source: str
    name: str
    bronze: str
    key: str
    change_column: str | None = None
    partition_column: str | None = None


@dataclass(frozen=True)
class SilverTable:
    """How one bronze table becomes one silver table. ``kind`` is scd1, scd2 or fact."""

    name: str
    kind: str
    bronze: str
    key: str
    tracked: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ()
    surrogate: str | None = None
    partition: str | None = None
    #: Whether the days of ``partition`` are folders, or its months.
    grain: str = "month"
    #: Folders that the rows of a type 1 dimension are dealt to by key; a load rewrites those that its
    #: delivery hits. About a gigabyte for each is a good number.
    buckets: int = 16


# The tables of the two source systems and their keys.
SOURCE_TABLES = (
    SourceTable("oracle", "branches", "oracle_branches", "branch_id", None, "updated_at"),
    SourceTable("oracle", "products", "oracle_products", "product_id", None, "updated_at"),
    SourceTable("oracle", "bank_accounts", "oracle_bank_accounts", "account_id", "updated_at", "opened_date"),
    SourceTable("oracle", "loans", "oracle_loans", "loan_id", "updated_at", "disbursement_date"),
    SourceTable("oracle", "bank_transactions", "oracle_bank_transactions", "txn_id", "created_at", "txn_date"),
    SourceTable("postgres", "customers", "pg_customers", "customer_id", "updated_at", "updated_at"),
    SourceTable("postgres", "card_accounts", "pg_card_accounts", "account_id", "updated_at", "updated_at"),
    SourceTable("postgres", "card_transactions", "pg_card_transactions", "txn_id", "created_at", "txn_date"),
)

SILVER_TABLES = (
    SilverTable(
        "dim_customer",
        "scd2",
        "pg_customers",
        "customer_id",
        tracked=("customer_segment", "city", "province", "kyc_status"),
        attributes=("full_name", "date_of_birth", "gender", "id_number", "phone", "email"),
        surrogate="customer_sk",
    ),
    SilverTable("dim_account", "scd1", "oracle_bank_accounts", "account_id"),
    SilverTable("dim_card_account", "scd1", "pg_card_accounts", "account_id"),
    SilverTable("dim_product", "scd1", "oracle_products", "product_id"),
    SilverTable("dim_branch", "scd1", "oracle_branches", "branch_id"),
    SilverTable("dim_loan", "scd1", "oracle_loans", "loan_id"),
    SilverTable("fct_bank_transactions", "fact", "oracle_bank_transactions", "txn_id", partition="txn_date"),
    SilverTable("fct_card_transactions", "fact", "pg_card_transactions", "txn_id", partition="txn_date"),
)

# Code columns normalised to upper case, per kind of silver table.
UPPER_COLUMNS = {
    "scd1": (
        "status",
        "currency",
        "npl_status",
        "account_type",
        "card_type",
        "product_type",
        "branch_type",
        "kyc_status",
    ),
    "scd2": ("customer_segment", "kyc_status"),
    "fact": ("status", "currency", "txn_type", "channel"),
}


def source_tables_from_mapping(raw: Mapping) -> list[SourceTable]:
    """Ingest tables from the parsed YAML of an ingest configuration file: those of SOURCE_TABLES of
    the sources in it, and those that it names itself.

    A table that is not in SOURCE_TABLES must state its ``key``.
    """
    known = {t.bronze: t for t in SOURCE_TABLES}
    tables = []
    for source, body in raw["sources"].items():
        stated = body.get("tables", ())
        own = {entry["bronze_table"].split(".")[-1] for entry in stated}
        tables += [t for t in SOURCE_TABLES if t.source == source and t.bronze not in own]
        for entry in stated:
            bronze = entry["bronze_table"].split(".")[-1]
            key = entry.get("key") or (known[bronze].key if bronze in known else None)
            if key is None:
                raise ValueError(f"no key configured for {bronze}")
            full = entry.get("mode", "incremental") == "full_snapshot"
            tables.append(
                SourceTable(
                    source,
                    entry["name"],
                    bronze,
                    key,
                    None if full else entry.get("incremental_col", "updated_at"),
                    entry.get("partition_col") or (known[bronze].partition_column if bronze in known else None),
                )
            )
    return tables


def silver_tables_from_mapping(raw: Mapping) -> list[SilverTable]:
    """Silver tables from the parsed YAML of a silver configuration file."""
    tables = []
    for name, body in raw["tables"].items():
        surrogate = body.get("surrogate_key")
        if body["type"] == "scd2" and surrogate is None:
            surrogate = name.removeprefix("dim_") + "_sk"
        tables.append(
            SilverTable(
                name,
                body["type"],
                body["source"],
                body["natural_key"],
                tuple(body.get("tracked_columns", ())),
                tuple(body.get("attributes", ())),
                surrogate,
                body.get("partition"),
                body.get("grain", "month"),
                int(body.get("buckets", 16)),
            )
        )
    return tables


def load_yaml(path: str) -> dict:
    """Parse a YAML configuration file."""
    try:
        import yaml
    except ImportError as exc:
        raise RuntimeError("PyYAML is needed to read configuration files") from exc
    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)
