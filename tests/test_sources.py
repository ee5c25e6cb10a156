import pytest

from clientlens import config
from clientlens.sources import jdbc, scratch


def test_connection_reads_password_from_the_environment(monkeypatch):
    connection = jdbc.Connection.from_mapping(
        {"jdbc_url": "jdbc:x:y", "driver": "d", "user": "u", "password_env": "X_PASSWORD"}
    )
    monkeypatch.delenv("X_PASSWORD", raising=False)
    with pytest.raises(RuntimeError, match="X_PASSWORD"):
        connection.options()
    monkeypatch.setenv("X_PASSWORD", "secret")
    assert connection.options()["password"] == "secret"


def test_range_options():
    assert jdbc.range_options("opened_date", "2020-01-01", "2024-01-01", 16) == {
        "partitionColumn": "opened_date",
        "lowerBound": "2020-01-01",
        "upperBound": "2024-01-01",
        "numPartitions": "16",
    }


class Asked:
    """Stands for Spark's reader: keeps the options it is given and returns stored rows."""

    def __init__(self, rows, log):
        self.rows, self.log, self.own = rows, log, {}

    def option(self, key, value):
        self.own[key] = value
        return self

    def options(self, **more):
        self.own |= more
        return self

    def load(self):
        self.log.append(self.own)
        if self.own["dbtable"].startswith("(SELECT MIN"):
            return self.rows.selectExpr("min(UPDATED_AT)", "max(UPDATED_AT)")
        return self.rows


@pytest.mark.parametrize("table", config.SOURCE_TABLES, ids=lambda t: t.bronze)
def test_every_table_is_read_in_parallel(spark, monkeypatch, table):
    from datetime import datetime, timezone

    rows = [("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 3)), ("c", None)]
    source = spark.createDataFrame(rows, "ACCOUNT_ID string, UPDATED_AT timestamp")
    source = source.withColumn("CREATED_AT", source.UPDATED_AT)
    asked = []
    monkeypatch.setattr(jdbc, "_reader", lambda *_: Asked(source, asked))
    read = jdbc.jdbc_source(spark, {table.source: jdbc.Connection("u", "d", "u", "p", partitions=7)})
    now = datetime(2024, 1, 5, tzinfo=timezone.utc)
    assert read(table, None, now).count() == 3
    whole = asked[-1]
    assert whole["partitionColumn"] == table.partition_column and whole["numPartitions"] == "7"
    assert (whole["lowerBound"], whole["upperBound"]) == ("2024-01-01 00:00:00", "2024-01-03 00:00:00")
    if table.change_column:
        last = datetime(2024, 1, 2, tzinfo=timezone.utc)
        assert [r[0] for r in read(table, last, now).collect()] == ["b"]
        assert asked[-1]["partitionColumn"] == table.change_column
        assert (asked[-1]["lowerBound"], asked[-1]["upperBound"]) == ("2024-01-02 00:00:00", "2024-01-05 00:00:00")


def test_sizes_and_tables_from_yaml():
    raw = config.load_yaml("conf/ingest.yaml")
    assert config.source_tables_from_mapping(raw) == list(config.SOURCE_TABLES)
    oracle = jdbc.Connection.from_mapping(raw["sources"]["oracle"] | {"fetch_size": 5})
    assert (oracle.partitions, oracle.fetch_size) == (16, 5)


def test_intermediate_results_go_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_root(spark) == root.rstrip("/")
    stored = scratch.materialise(spark.range(5), "numbers")
    assert stored.count() == 5
    assert stored.inputFiles()[0].startswith(f"file://{root}")


class Settings(dict):
    """Stands for the settings of a session."""

    conf = property(lambda self: self)


def test_without_a_setting_they_go_below_the_warehouse():
    assert scratch.scratch_root(Settings({"spark.sql.warehouse.dir": "hdfs://x/wh"})) == "hdfs://x/wh/_scratch"


def test_no_personal_data_in_scratch(spark, monkeypatch, tmp_path):
    import __spark_entry__ as entry
    from clientlens import catalogue

    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(tmp_path))
    monkeypatch.setattr(catalogue, "_banks", {})
    entry.queries()["mart_customer_360"](spark, "/root/testdata/sf0.001").count()
    stored = [p for p in tmp_path.rglob("*.parquet")]
    assert stored
    for path in stored:
        rows = spark.read.parquet(str(path))
        assert not {"phone", "email", "id_number", "date_of_birth"} & set(rows.columns)
        if "full_name" in rows.columns:
            assert rows.filter("full_name NOT LIKE '% ****'").count() == 0


def test_gold_settings_from_yaml(tmp_path):
    path = tmp_path / "gold.yaml"
    path.write_text(
        "as_of_date: 2024-05-06\nlookback_months: 6\n"
        "thresholds: {digital_channels: ['ONLINE', 'APP']}\n"
        "crosssell: {loan_flag: 'NOT has_loan'}\n",
        encoding="utf-8",
    )
    settings = config.GoldSettings.from_mapping(config.load_yaml(str(path)))
    assert str(settings.as_of) == "2024-05-06" and settings.lookback_months == 6
    assert settings.digital_channels == ("ONLINE", "APP")
    assert settings.cross_sell["cross_sell_loan_flag"] == "NOT has_loan"
    assert "txn_count_12m >= 12" in settings.cross_sell["cross_sell_card_flag"]
    assert config.GoldSettings.from_mapping({"as_of_date": "auto"}).as_of is None


def test_silver_tables_from_yaml():
    raw = {
        "tables": {
            "dim_shop": {
                "type": "scd2",
                "source": "pg_shops",
                "natural_key": "shop_id",
                "tracked_columns": ["city"],
                "attributes": ["name"],
            }
        }
    }
    (table,) = config.silver_tables_from_mapping(raw)
    assert table.surrogate == "shop_sk" and table.tracked == ("city",)
    assert config.silver_tables_from_mapping(
        {"tables": {t.name: _as_yaml(t) for t in config.SILVER_TABLES}}
    ) == list(config.SILVER_TABLES)


def _as_yaml(table):
    return {
        "type": table.kind,
        "source": table.bronze,
        "natural_key": table.key,
        "tracked_columns": list(table.tracked),
        "attributes": list(table.attributes),
        "partition": table.partition,
    }
