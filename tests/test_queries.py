"""Every registered query against its SQL on the same tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from checks.oracles import all_oracles
from checks.queries import all_queries


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="session")
def tables(sf):
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(name, spark, sf, tables):
    result = all_queries()[name](spark, sf)
    expected = tables.execute(all_oracles()[name])
    wanted_columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(wanted_columns)
    got, wanted = _rows(result.columns, result.collect()), _rows(wanted_columns, expected.fetchall())
    extra, lacking = got - wanted, wanted - got
    assert not extra and not lacking, (
        f"{sum(extra.values())} extra {list(extra)[:3]}, "
        f"{sum(lacking.values())} lacking {list(lacking)[:3]}"
    )
    assert wanted


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
