"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from seriesmill.plans.catalog import REGISTRY
from tools.check_queries import table


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["month_start", "price", "n"] and found.count() == 80


@pytest.mark.parametrize("name", sorted(n for n, q in REGISTRY.items() if q.sql))
def test_query_equals_sql(spark, database, name):
    frame = entry.queries()[name](spark, SMALL)
    answer = database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert table(frame.columns, frame.collect()) == table(columns, answer.fetchall())


def test_every_inventory_entry_is_covered():
    covered = {c for q in REGISTRY.values() for c in q.covers}
    wanted = {
        *(f"B{i}" for i in range(1, 12)),
        *(f"C{i}" for i in range(1, 15)),
        *(f"D{i}" for i in range(1, 13)),
        *(f"E{i}" for i in range(1, 15)),
        *(f"F{i}" for i in range(1, 5)),
        *(f"G{i}" for i in range(1, 13)),
        *(f"P{i}" for i in range(1, 12)),
    }
    assert wanted <= covered
