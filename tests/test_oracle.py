"""Every registered query against its SQL on the smallest tables."""

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="tables not present")


def plain(value):
    if isinstance(value, Decimal):
        value = int(value) if value == int(value) else float(value)
    return round(value, 6) if isinstance(value, float) else value


def table(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = table(df.select(*columns).collect())
    if name not in ORACLES:
        assert got
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    rows = [[row[names.index(c)] for c in columns] for row in found.fetchall()]
    assert got == table(rows)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
