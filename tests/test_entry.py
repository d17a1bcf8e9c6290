"""Every registered query against its SQL twin on the smallest tables."""

import math
import numbers
import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    return db


def cell(value):
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, numbers.Number):
        return repr(float(value))
    return str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in r) for r in frame.itertuples(index=False))


def test_every_query_has_a_twin():
    alone = set(driver.queries()) - set(driver.oracle_sql())
    # Corpus operators that SQL cannot express are tested by brute force.
    assert all(re.match(r"op\d+_|pipeline$", name) for name in alone)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    ours = driver.queries()[name](spark, SF).toPandas()
    theirs = duck.execute(driver.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
    assert len(ours) > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
