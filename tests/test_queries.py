"""Every registered query against its SQL twin, in a second engine."""

import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as driver
from vigil.plans.oracle import ORACLE
from vigil.plans.queries import QUERIES
from vigil.session import DEFAULT_ROWS_PER_BLOCK, ROWS_PER_BLOCK


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, engine, name):
    frame = driver.queries()[name](spark, SMALL)
    relation = engine.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in relation.description]
    assert sorted(frame.columns) == sorted(columns)
    assert ordered(frame.columns, frame.collect()) == ordered(columns, relation.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, engine, name):
    compare(spark, engine, name)


@pytest.mark.parametrize("name", ["stat_verdicts", "transition_counts_global", "session_count_window"])
def test_query_equals_sql_in_blocks(spark, engine, name):
    spark.conf.set(ROWS_PER_BLOCK, "12" if name == "session_count_window" else "60")
    try:
        compare(spark, engine, name)
    finally:
        spark.conf.set(ROWS_PER_BLOCK, str(DEFAULT_ROWS_PER_BLOCK))


def test_entry(spark):
    assert driver.entry(spark).count() == 1000


def test_queries_without_sql():
    assert set(QUERIES) - set(ORACLE) == {"ae_train", "strict_verdicts"}
