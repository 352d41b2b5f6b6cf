"""Every query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value)


def table(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in found)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, database, name):
    result = queries()[name](spark, SF_DIR)
    found = table(result.columns, result.collect())
    database.execute(oracle_sql()[name])
    columns = [c[0] for c in database.description]
    assert found == table(columns, database.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs_without_sql(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry_has_rows(spark):
    assert entry(spark).columns == ["split", "country_code", "n_rows"]
