"""Tables: created, changed, laid out anew, replaced and dropped."""

import time
from dataclasses import replace

import pytest

from oreflow.plans import (
    Warehouse,
    append_table,
    conform,
    drop_table,
    ensure_published,
    ensure_table,
    publish,
    repartition_table,
)
from oreflow.plans.lifecycle import _versions, change_statements, create_statements, partition_fields
from oreflow.schemas import BRONZE_COLUMNS, GOLD_COLUMNS, SILVER_COLUMNS


def bronze_rows(spark, *tickers):
    return spark.createDataFrame([(f"k{i}", "{}", t) for i, t in enumerate(tickers)], "key string, value string, ticker string")


def gold_rows(spark, *rows):
    return spark.createDataFrame(rows, "portfolio_id string, ticker string, n int").selectExpr(
        "portfolio_id", "ticker", "n AS net_quantity", "n AS total_fees", "n AS total_value"
    )


@pytest.mark.parametrize(
    "layer, columns", [("bronze", BRONZE_COLUMNS), ("silver", SILVER_COLUMNS), ("gold", GOLD_COLUMNS)]
)
def test_tables_are_as_specified_however_often_made(spark, warehouse, layer, columns):
    spec = getattr(warehouse, layer)
    for _ in range(2):
        ensure_table(spark, spec)
    table = spark.table(spec.name)
    assert dict(table.dtypes) == columns
    assert partition_fields(spark, spec.name) == ["ticker"]


def test_a_missing_column_is_added(spark, warehouse):
    old = replace(warehouse.gold, columns={n: k for n, k in GOLD_COLUMNS.items() if n != "total_value"})
    ensure_table(spark, old)
    append_table(spark.sql("SELECT 'p' portfolio_id, 'A' ticker, 1 net_quantity, 1 total_fees"), old)
    ensure_table(spark, warehouse.gold)
    assert dict(spark.table(warehouse.gold.name).dtypes) == GOLD_COLUMNS
    assert [r.total_value for r in spark.table(warehouse.gold.name).collect()] == [None]


def test_properties_are_set(spark, warehouse):
    spec = replace(warehouse.bronze, properties={"write.data.path": "/data"})
    ensure_table(spark, warehouse.bronze)
    ensure_table(spark, spec)
    shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {spec.name}").collect()}
    assert shown["write.data.path"] == "/data"


def test_another_layout_is_refused_then_copied(spark, warehouse):
    plain = replace(warehouse.bronze, partition_by=())
    ensure_table(spark, plain)
    append_table(bronze_rows(spark, "A", "1", None), plain)
    with pytest.raises(ValueError, match="repartition_table"):
        ensure_table(spark, warehouse.bronze)
    copy = replace(warehouse.bronze, name=f"{plain.namespace}.copy", location=f"{plain.location}_copy")
    repartition_table(spark, plain.name, copy)
    assert partition_fields(spark, copy.name) == ["ticker"]
    assert {r.ticker for r in spark.table(copy.name).collect()} == {"A", "1", None}
    assert spark.table(plain.name).count() == 3


def test_a_ticker_filter_reads_its_partition_only(spark, warehouse):
    ensure_table(spark, warehouse.bronze)
    append_table(bronze_rows(spark, "A", "A", "B", None), warehouse.bronze)
    one = spark.table(warehouse.bronze.name).where("ticker = 'A'")
    assert one.count() == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ticker" in plan


def test_conform_orders_casts_and_fills(spark, warehouse):
    rows = conform(spark.sql("SELECT 1 AS total_fees, 'A' AS ticker"), warehouse.gold)
    assert dict(rows.dtypes) == GOLD_COLUMNS
    assert rows.first().portfolio_id is None


def test_replace_shows_the_last_content_only(spark, warehouse):
    ensure_published(spark, warehouse.gold)
    publish(gold_rows(spark, ("p", "A", 1), ("p", "B", 1)), warehouse.gold)
    before = spark.table(warehouse.gold.name)
    publish(gold_rows(spark, ("q", "007", 2)), warehouse.gold)
    after = spark.table(warehouse.gold.name)
    assert dict(after.dtypes) == GOLD_COLUMNS
    assert [tuple(map(str, row)) for row in after.collect()] == [("q", "007", "2.00", "2.00", "2.00")]
    assert before.count() == 2, "a reader that started earlier keeps its rows"


def test_replace_can_read_what_it_replaces(spark, warehouse):
    publish_all = gold_rows(spark, ("p", "A", 1))
    ensure_published(spark, warehouse.gold)
    publish(publish_all, warehouse.gold)
    for _ in range(3):
        current = spark.table(warehouse.gold.name)
        publish(current.unionByName(conform(publish_all, warehouse.gold)), warehouse.gold)
    assert spark.table(warehouse.gold.name).count() == 4


def test_a_batch_that_runs_again_gives_the_same(spark, warehouse):
    ensure_published(spark, warehouse.gold)
    for _ in range(2):
        publish(gold_rows(spark, ("p", "A", 1)), warehouse.gold)
    assert spark.table(warehouse.gold.name).count() == 1


def test_a_failed_replace_leaves_the_old_content(spark, warehouse):
    ensure_published(spark, warehouse.gold)
    publish(gold_rows(spark, ("p", "A", 1)), warehouse.gold)
    broken = gold_rows(spark, ("p", "A", 1)).selectExpr("*", "raise_error('no') AS x").selectExpr(
        "portfolio_id", "concat(ticker, x) AS ticker", "net_quantity", "total_fees", "total_value"
    )
    with pytest.raises(Exception, match="no"):
        publish(broken, warehouse.gold)
    assert [r.ticker for r in spark.table(warehouse.gold.name).collect()] == ["A"]


def test_old_versions_go(spark, warehouse):
    ensure_published(spark, warehouse.gold)
    for i in range(5):
        publish(gold_rows(spark, ("p", "A", i)), warehouse.gold, keep_seconds=0)
    assert len(_versions(spark, warehouse.gold)) == 1
    assert [int(r.net_quantity) for r in spark.table(warehouse.gold.name).collect()] == [4]


def test_a_reader_outlives_any_number_of_replaces_within_the_time(spark, warehouse):
    ensure_published(spark, warehouse.gold)
    publish(gold_rows(spark, ("p", "A", 0)), warehouse.gold)
    reader = spark.table(warehouse.gold.name)
    for i in range(1, 5):
        publish(gold_rows(spark, ("p", "A", i)), warehouse.gold, keep_seconds=600)
    assert [int(r.net_quantity) for r in reader.collect()] == [0]
    time.sleep(1.1)
    publish(gold_rows(spark, ("p", "A", 9)), warehouse.gold, keep_seconds=1)
    # The one replaced just now stays beside the current one; all earlier ones are older.
    assert len(_versions(spark, warehouse.gold)) == 2


def test_versions_of_an_earlier_catalog_are_found_and_go(spark, warehouse):
    for i in range(2):
        ensure_published(spark, warehouse.gold)
        publish(gold_rows(spark, ("p", "007", i)), warehouse.gold)
    again = replace(warehouse, suffix=f"{warehouse.suffix}_again").gold
    ensure_published(spark, again)
    assert [(r.ticker, int(r.net_quantity)) for r in spark.table(again.name).collect()] == [("007", 1)]
    publish(gold_rows(spark, ("p", "A", 7)), again, keep_seconds=0)
    assert len(_versions(spark, again)) == 1
    assert [int(r.net_quantity) for r in spark.table(again.name).collect()] == [7]
    drop_table(spark, again)
    ensure_published(spark, again)
    assert spark.table(again.name).count() == 0, "what was dropped does not come back"


def test_drop(spark, warehouse):
    ensure_published(spark, warehouse.gold)
    ensure_table(spark, warehouse.bronze)
    for spec in (warehouse.gold, warehouse.bronze):
        for _ in range(2):
            drop_table(spark, spec)
        assert not spark.catalog.tableExists(spec.name)
    assert _versions(spark, warehouse.gold) == []


# ---- statements for Iceberg, which is not here to run them ---------------------------

ICEBERG = Warehouse("s3://lake", format="iceberg", catalog="rest", roots={"gold": "s3://gold/"})


def test_iceberg_create():
    namespace, table = create_statements(ICEBERG.bronze)
    assert namespace == "CREATE NAMESPACE IF NOT EXISTS rest.bronze LOCATION 's3://lake/bronze'"
    assert table == (
        "CREATE TABLE IF NOT EXISTS rest.bronze.trades (key string, value string, ingest_timestamp timestamp, "
        "ticker string) USING iceberg PARTITIONED BY (ticker) LOCATION 's3://lake/bronze/trades' "
        "TBLPROPERTIES ('format-version' = '2', 'write.data.path' = 's3://lake/bronze/trades/data')"
    )
    assert ICEBERG.gold.location == "s3://gold/portfolio_positions"


def test_iceberg_changes():
    properties = (
        "ALTER TABLE rest.bronze.trades SET TBLPROPERTIES "
        "('format-version' = '2', 'write.data.path' = 's3://lake/bronze/trades/data')"
    )
    old = [name for name in BRONZE_COLUMNS if name != "ticker"]
    assert change_statements(ICEBERG.bronze, old, ["days(ingest_timestamp)"]) == [
        "ALTER TABLE rest.bronze.trades ADD COLUMNS (ticker string)",
        "ALTER TABLE rest.bronze.trades DROP PARTITION FIELD days(ingest_timestamp)",
        "ALTER TABLE rest.bronze.trades ADD PARTITION FIELD ticker",
        properties,
    ]
    assert change_statements(ICEBERG.bronze, BRONZE_COLUMNS, ["ticker"]) == [properties]


def test_iceberg_keeps_partition_fields_it_does_not_know():
    changes = change_statements(ICEBERG.silver, SILVER_COLUMNS, ["ticker", "bucket(8, trade_id)"])
    assert not any("PARTITION FIELD" in statement for statement in changes)
