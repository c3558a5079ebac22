import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import verify
from postloom.plans import core_queries, mail_queries

QUERIES = {**mail_queries.QUERIES, **core_queries.QUERIES}
SQL = {**mail_queries.SQL, **core_queries.SQL}
#: Queries whose rules may find nothing in the smallest tables.
MAY_BE_EMPTY = {"spam_review", "spam_by_year", "spam_reason_counts", "unmatchable_subjects", "unmatchable_orphans", "anchored_sessions", "quote_best_match", "p4_found"}


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name):
    ours = verify.frame(QUERIES[name](spark, folder).toPandas())
    assert len(ours) > 1 or name in MAY_BE_EMPTY
    if name in SQL:
        assert ours == verify.frame(con.execute(SQL[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
