"""Command line of the batch jobs, for use with spark-submit."""

from __future__ import annotations

import argparse
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from clientlens import config
from clientlens.jobs import conform, gold, ingest, maintain
from clientlens.jobs.audit import AuditLog
from clientlens.plans import checks, export, lists, slices, trends
from clientlens.sources.jdbc import Connection, jdbc_source
from clientlens.sources.lake import Dimension, Lake, LakeTable
from clientlens.sources.scratch import materialise, release


def _ingest(lake: Lake, args: argparse.Namespace) -> None:
    raw = config.load_yaml(args.config)
    connections = {name: Connection.from_mapping(body) for name, body in raw["sources"].items()}
    tables = config.source_tables_from_mapping(raw)
    read = jdbc_source(lake.spark, connections)
    print(ingest.run_ingest(lake, read, args.run_ts, args.batch, tables, full=args.full))


def _conform(lake: Lake, args: argparse.Namespace) -> None:
    tables = config.SILVER_TABLES
    if args.config:
        tables = config.silver_tables_from_mapping(config.load_yaml(args.config))
    options = {n: getattr(args, n) for n in ("refresh_attributes", "stable_dates", "update")}
    print(
        conform.run_conform(
            lake, args.run_ts, args.batch, tables, args.only_batch, args.full, **options
        )
    )


def _gold(lake: Lake, args: argparse.Namespace) -> None:
    settings = config.GoldSettings()
    if args.config:
        settings = config.GoldSettings.from_mapping(config.load_yaml(args.config))
    print(gold.run_gold(lake, args.run_ts, args.batch, settings))


def _silver(lake: Lake) -> dict[str, LakeTable | Dimension]:
    return {t.name: conform.silver_table(lake, t) for t in config.SILVER_TABLES}


def _remask(lake: Lake, _: argparse.Namespace) -> None:
    print(maintain.remask_snapshots(gold.gold_table(lake, "mart_customer_360")))


def _upkeep(lake: Lake) -> dict:
    silver = _silver(lake)
    names = ("fct_bank_transactions", "fct_card_transactions", "dim_customer")
    tables = {name: silver[name] for name in names}
    for name in ("oracle_bank_transactions", "pg_card_transactions"):
        tables[name] = ingest.bronze_table(lake, name)
    tables["mart_customer_360"] = gold.gold_table(lake, "mart_customer_360")
    for layer in ("bronze", "silver", "gold"):
        tables[f"{layer}.audit_log"] = AuditLog(lake, layer)
    return tables


def _compact(lake: Lake, _: argparse.Namespace) -> None:
    for name, outcome in maintain.compact_tables(_upkeep(lake)).items():
        print(name, outcome)


def _vacuum(lake: Lake, _: argparse.Namespace) -> None:
    """Delete what was superseded more than a week ago, in all tables."""
    tables = _upkeep(lake) | _silver(lake)
    tables |= {t.bronze: ingest.bronze_table(lake, t.bronze) for t in config.SOURCE_TABLES}
    tables |= {name: gold.gold_table(lake, name) for name in ("agg_customer_holdings", "agg_customer_txn_12m")}
    for name, outcome in maintain.vacuum_tables(tables).items():
        print(name, outcome)


def _verify(lake: Lake, args: argparse.Namespace) -> None:
    silver = _silver(lake)
    mart = gold.gold_table(lake, "mart_customer_360").read()
    tables = {t.bronze: ingest.bronze_table(lake, t.bronze).read for t in config.SOURCE_TABLES}
    tables |= {name: table.read for name, table in silver.items()}
    customers = silver["dim_customer"].read()
    latest = slices.mart_slice(mart)
    counts = materialise(checks.table_counts(lake.spark, tables), "counts")
    complete = materialise(checks.mart_completeness(mart, customers), "completeness")
    leaks = materialise(checks.pii_leaks(mart), "leaks")
    reports: dict[str, DataFrame] = {
        "rows per table": counts,
        "completeness": complete,
        "segments": checks.rfm_distribution(latest),
        "cross-sell": checks.cross_sell_counts(latest),
        "net assets": checks.segment_net_asset(latest),
        "leaks": leaks,
    }
    for layer in ("bronze", "silver", "gold"):
        reports[f"latest runs of {layer}"] = checks.recent_audit(AuditLog(lake, layer).read())
    if args.customer:
        reports["customer"] = lists.customer_lookup(mart, args.customer)
        reports["versions"] = lists.customer_lookup(customers, args.customer).orderBy("version")
    for title, report in reports.items():
        print(f"== {title}")
        report.show(40, truncate=False)
    wrong = {
        "tables that can't be read": counts.filter("error IS NOT NULL"),
        "incomplete snapshots": complete.filter("NOT complete"),
        "leaks": leaks.filter("raw_name_leak + raw_email_leak + forbidden_columns > 0"),
    }
    found = [title for title, rows in wrong.items() if not rows.isEmpty()]
    if found:
        raise SystemExit("verification failed: " + ", ".join(found))


def _export(lake: Lake, args: argparse.Namespace) -> None:
    silver = {name: table.read() for name, table in _silver(lake).items()}
    days = trends.customer_days(
        silver["fct_bank_transactions"],
        silver["fct_card_transactions"],
        silver["dim_account"],
        silver["dim_card_account"],
        silver["dim_customer"],
    )
    mart = gold.gold_table(lake, "mart_customer_360").read()
    export.export_reports(mart, days, args.out).show(truncate=False)


_JOBS = {
    "ingest": _ingest,
    "conform": _conform,
    "gold": _gold,
    "remask": _remask,
    "compact": _compact,
    "vacuum": _vacuum,
    "verify": _verify,
    "export": _export,
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clientlens", description=__doc__)
    parser.add_argument("job", choices=sorted(_JOBS))
    parser.add_argument("--lake", required=True, help="root folder of all layers")
    parser.add_argument("--config", help="YAML file of the job")
    parser.add_argument("--batch", default=None, help="batch id; reuse it to repeat a batch")
    parser.add_argument("--run-ts", default=None, type=datetime.fromisoformat)
    parser.add_argument("--full", action="store_true", help="ingest, conform: read every table in full")
    parser.add_argument("--refresh-attributes", action="store_true", help="conform: untracked attributes at once")
    parser.add_argument("--stable-dates", action="store_true", help="conform: a transaction never changes its date")
    parser.add_argument("--update", action="store_true", help="conform: update stored transactions")
    parser.add_argument("--only-batch", help="conform: use the rows of one bronze batch")
    parser.add_argument("--customer", help="verify: also show one customer")
    parser.add_argument("--out", help="export: target folder")
    args = parser.parse_args(argv)
    if args.job == "ingest" and not args.config:
        parser.error("ingest needs --config")
    if args.job == "export" and not args.out:
        parser.error("export needs --out")
    args.batch = args.batch or uuid.uuid4().hex[:8]
    args.run_ts = args.run_ts or datetime.now(timezone.utc)
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = (
        SparkSession.builder.appName(f"clientlens-{args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    try:
        _JOBS[args.job](Lake(spark, args.lake), args)
    finally:
        release(spark)


if __name__ == "__main__":
    main()
