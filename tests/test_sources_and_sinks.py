import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import dicts
from tillstream import session
from tillstream.operators.upsert import replace_keys
from tillstream.schemas import RATE, SALE
from tillstream.settings import Settings
from tillstream.sinks import database, lakehouse, publish
from tillstream.sinks.versions import Versions
from tillstream.sources import tables, topics


@pytest.fixture
def settings(tmp_path):
    path = tmp_path / "job.properties"
    path.write_text("# job\ndb.url=jdbc:x://h/db?a=b\ndb.username=u\n\nkafka_broker = h:1\ndb.batch_size=50\n")
    return Settings.from_file(str(path), **{"db.password": "given"})


def test_settings(settings):
    assert settings.get("db.url") == "jdbc:x://h/db?a=b"
    assert settings.get("kafka_broker") == "h:1"
    assert settings.get("db.password") == "given"
    assert settings.get("db.driver") is None
    assert settings.get("transactions_topic") == "sales_transactions"
    assert settings.trigger == {"processingTime": "200 milliseconds"}
    with pytest.raises(KeyError):
        settings.require("db.driver")


def test_missing_settings_file():
    with pytest.raises(FileNotFoundError):
        Settings.from_file("/tmp/no-such.properties")


def test_broker_options(settings):
    options = topics.broker_options(settings, "currency_topic")
    assert options["subscribe"] == "currencyExchange"
    assert options["startingOffsets"] == "earliest"
    assert options["kafka.bootstrap.servers"] == "h:1"


def test_database_options(settings):
    assert tables.connection_options(settings) == {"url": "jdbc:x://h/db?a=b", "user": "u", "password": "given"}
    assert database.write_options(settings, "t")["batchsize"] == "50"


def test_database_statements():
    assert database.merge_statement("rates", "s", RATE.columns, RATE.key) == (
        "INSERT INTO rates (from_currency, to_currency, exchange_rate, last_updated) "
        "SELECT from_currency, to_currency, exchange_rate, last_updated FROM s "
        "ON CONFLICT (from_currency, to_currency) DO UPDATE SET "
        "exchange_rate = EXCLUDED.exchange_rate, last_updated = EXCLUDED.last_updated"
    )
    assert database.insert_statement("t", "s", ["a", "b"], ["a"]) == (
        "INSERT INTO t (a, b) SELECT a, b FROM s ON CONFLICT (a) DO NOTHING"
    )


def test_messages(sales):
    df = sales({"transaction_date": "2024-01-02T03:04:05.123456", "currency": None, "total_amount": 2.5})
    row = publish.as_messages(df.drop("payment_method"), SALE, "transaction_id").first()
    body = json.loads(row.value)
    assert row.key == "t"
    assert body["transactionDate"] == "2024-01-02T03:04:05.123456"
    assert body["totalAmount"] == 2.5
    assert "currency" not in body and "paymentMethod" not in body


def test_connectors_say_what_is_missing(spark, settings):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.broker_stream(spark, settings, "currency_topic")
    assert tables.table_or_none(lambda: tables.database_table(spark, settings, "t")) is None


def test_versions(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "v"))
    assert table.read() is None and table.numbers() == []
    for number in (1, 2, 10):
        table.write(number, spark.range(number))
    (tmp_path / "v" / "version=11").mkdir()
    assert table.numbers() == [1, 2, 10]
    assert table.read().count() == 10
    assert table.read(before=10).count() == 2
    assert table.read(before=1) is None
    table.write(10, spark.range(4))
    assert table.read().count() == 4
    table.expire(1)
    assert table.numbers() == [10]


def test_replace_keys(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert dicts(replace_keys(old, new, ["k"])) == [{"k": "a", "v": 1}, {"k": "b", "v": 3}, {"k": "c", "v": 4}]
    assert replace_keys(None, new, ["k"]) is new


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get(session.CHECKPOINT_DIR, None)
    folder = session.shared_folder(spark)
    assert configured is None or folder == configured.rstrip("/")
    assert session.new_folder(spark, "x").startswith(folder)


def test_settled_tables_keep_their_rows(spark):
    df = spark.range(5).select((F.col("id") * 2).alias("n"))
    assert dicts(session.settled(df)) == dicts(df)


def test_merge_needs_a_table_format(spark, tmp_path):
    """The statement is well formed: Spark refuses it only for the kind of table."""
    table = f"merged_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"create table {table} (k string, v int) using parquet location '{tmp_path}/t'")
    rows = spark.createDataFrame([("a", 1)], "k string, v int")
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            lakehouse.merge_into(rows, table, ["k"])
    finally:
        spark.sql(f"drop table {table}")
    assert lakehouse.merge_condition(["a", "b"]) == "stored.a = changed.a AND stored.b = changed.b"


class _Bare:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.conf = self.sparkContext = self
        self.master, self.folder = master, None

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_temporary_folders_are_for_local_sessions_only():
    local = _Bare("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local) == local.folder
    with pytest.raises(ValueError):
        session.shared_folder(_Bare("spark://host:7077"))
