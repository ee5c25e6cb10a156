import smallbank as sb
from helpers import rows_of

from clientlens.jobs.audit import AuditLog
from clientlens.operators.incremental import current_rows
from clientlens.schemas import BRONZE
from clientlens.streaming.ingest import ingest_files


def _deliver(spark, folder, rows):
    schema = sb.source_schema("pg_customers")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def _run(lake, tmp_path, once_within=None):
    target = lake.table("bronze", "pg_customers", BRONZE["pg_customers"], "_batch_id")
    query = ingest_files(
        target,
        str(tmp_path / "in"),
        sb.source_schema("pg_customers"),
        str(tmp_path / "checkpoint"),
        "postgres",
        AuditLog(lake, "bronze"),
        once_within,
    )
    assert query.awaitTermination(120)
    return target


def test_arriving_files_become_batches(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    _deliver(spark, folder, [sb.customer("C001", "Mai Lan"), sb.customer("C002", "Do Khoa")])
    _run(lake, tmp_path)
    _deliver(spark, folder, [sb.customer("C002", "Do Khoa", "PREMIER"), sb.customer("C003", "Vo")])
    target = _run(lake, tmp_path)
    assert target.read().count() == 4
    current = current_rows(target.read(), "customer_id").select("customer_id", "customer_segment")
    assert rows_of(current) == [("C001", "MASS"), ("C002", "PREMIER"), ("C003", "MASS")]
    batches = [r[0] for r in target.read().select("_batch_id").distinct().collect()]
    assert len(batches) == 2 and all("None" not in b for b in batches)
    log = AuditLog(lake, "bronze").read()
    assert {r[0] for r in log.select("batch_id").collect()} == set(batches)

    _run(lake, tmp_path)  # nothing new arrived
    assert target.read().count() == 4


def test_rows_that_arrived_already_are_dropped(spark, lake, tmp_path):
    folder = str(tmp_path / "in")
    first = [sb.customer("C001", "Mai Lan"), sb.customer("C001", "Mai Lan"), sb.customer("C002", "Do Khoa")]
    _deliver(spark, folder, first)
    target = _run(lake, tmp_path, "30 days")
    assert target.read().count() == 2
    # The stream starts anew from its checkpoint; an old delivery comes again, with one new row.
    _deliver(spark, folder, [*first, sb.customer("C002", "Do Khoa", "PREMIER")])
    _deliver(spark, folder, first)
    target = _run(lake, tmp_path, "30 days")
    assert rows_of(target.read().select("customer_id", "customer_segment")) == [("C001", "MASS"), ("C002", "MASS"), ("C002", "PREMIER")]
    assert target.read().select("_batch_id").distinct().count() == 2
