"""Every query with an oracle matches DuckDB on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.helpers import canon, duck, spark_rows

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    cols, rows = spark_rows(QUERIES[key](spark, SF001))
    res = con.execute(ORACLES[key])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert canon(cols, rows) == canon(ocols, res.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2 and [r.cutoff for r in sorted(rows)] == [0.32, 0.55]
    assert df.columns[:5] == ["cutoff", "tp", "fp", "fn", "tn"] and df.columns[-1] == "auc"
    assert all(r.tp + r.fp + r.fn + r.tn == rows[0].tp + rows[0].fp + rows[0].fn + rows[0].tn for r in rows)
