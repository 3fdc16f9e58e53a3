"""Every catalogue query against its DuckDB oracle (or shape only where the
operator has no SQL equivalent), plus the driver entry point."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import DUCK_TYPE, canon, duck  # noqa: E402
from strata.plans import queries as catalogue  # noqa: E402

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(catalogue.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["prio", "count"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_documented():
    missing = set(catalogue.queries()) - set(catalogue.oracle_sql())
    assert missing == {"column_profile", "layer_sizes"}
    assert set(NAMES) <= set(E.queries())
    assert not set(E.oracle_sql()) - set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    otypes = {d[0]: str(d[1]) for d in res.description}
    stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: DUCK_TYPE.get(t, t.upper()) for c, t in stypes.items()} == otypes
    assert canon(df.columns, rows) == canon(ocols, res.fetchall())
