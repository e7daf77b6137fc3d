"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import check
from __spark_entry__ import entry
from pagesieve.oracles import ORACLES
from pagesieve.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# On the smallest tables 18 rows are held out, too few to tell a classifier from the larger class.
LARGER = {"train_classifier": "/root/testdata/sf0.01"}


def views(folder):
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def db():
    return {folder: views(folder) for folder in (FOLDER, *LARGER.values())}


def test_entry(spark):
    assert entry(spark).columns == ["doc_id", "rank", "word", "tf", "score"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    folder = LARGER.get(name, FOLDER)
    outcome, _ = check.compare(spark, db[folder], name, folder)
    assert outcome.startswith("same"), outcome
