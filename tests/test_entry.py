import duckdb
import pytest

import __spark_entry__
from cohortlake.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, data, duck, name):
    found = queries.QUERIES[name](spark, data)
    cursor = duck.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(found.columns)
    order = sorted(names)
    wanted = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in order)) for r in found.collect()) == wanted


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_checks_pass_on_the_tables(spark, data):
    found = queries.corpus_checks(spark, data)
    assert not [r for r in found.collect() if r.violations and r.severity == "error"]
