"""Every registered query against its SQL counterpart on the driver tables."""

import datetime
import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracle import ORACLE
from workload.queries import QUERIES


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, Decimal):
        return format(value, "f")
    return repr(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in rows)


def oracle_rows(sf_dir, sql):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = connection.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns, expected = multiset(*oracle_rows(sf_dir, ORACLE[name]))
    found_columns, found = multiset(result.columns, [tuple(r) for r in result.collect()])
    assert found_columns == columns
    assert found == expected
    assert found


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
