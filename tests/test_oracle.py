"""Every registered query gives the rows of its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from oreflow.queries import ORACLE, QUERIES
from tests.conftest import SF_CHECK, SF_SMALL


def in_duckdb(sf_dir, sql):
    with duckdb.connect() as db:
        db.execute("SET TimeZone = 'UTC'")
        db.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{sf_dir}/lineitem.parquet'")
        cursor = db.execute(sql)
        names = [column[0] for column in cursor.description]
        return names, cursor.fetchall()


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    result = entry.queries()[name](spark, SF_CHECK)
    ours = rows_by_name(result.columns, [tuple(row) for row in result.collect()])
    theirs = rows_by_name(*in_duckdb(SF_CHECK, entry.oracle_sql()[name]))
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_sizes_at_check_scale(spark):
    from decimal import Decimal

    from oreflow.operators import dedup_batch, parse, typed, usable
    from oreflow.queries import _bronze, _silver

    queries = entry.queries()
    assert queries["bronze_ingest"](spark, SF_CHECK).count() == 60_000
    assert queries["bronze_ingest"](spark, SF_CHECK).where("ticker IS NULL").count() == 11_920
    assert queries["silver_quality_filter"](spark, SF_CHECK).count() == 23_565
    assert _silver(spark, SF_CHECK).count() == 18_017
    # With the oldest copy of each trade in place of the first to arrive.
    silver = dedup_batch(usable(typed(parse(_bronze(spark, SF_CHECK)))), arrival=["trade_timestamp"])
    assert silver.count() == 18_017
    assert silver.groupBy().sum("trade_value").first()[0] == Decimal("22869719719.6869")
    assert queries["gold_positions"](spark, SF_CHECK).count() == 1_000


def test_small_scale_reads_its_own_tables(spark):
    assert entry.queries()["bronze_ingest"](spark, SF_SMALL).count() == 6_000
