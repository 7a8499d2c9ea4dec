"""Every registered query against its oracle SQL, on the smallest data folder."""

import decimal
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = os.environ.get("AISLEWATCH_TESTDATA", "/root/testdata/sf0.001")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return round(value, 9) if isinstance(value, float) else value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else "") for v in r))


@pytest.mark.parametrize("name", sorted(entry_module.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = _sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    oracle = entry_module.oracle_sql().get(name)
    assert oracle is not None, "a query without an oracle needs a test of its own"
    cursor = duck.execute(oracle)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = _sorted(tuple(_plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert columns == sorted(names)
    assert {c: SPARK_TYPES[t] for c, t in df.dtypes} == types
    assert ours == theirs
    assert ours or name.startswith("L")


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["db_id", "site_id", "sim", "inliers", "status"]
    assert df.count() > 0


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 140 and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


# The operators of the inventory, by family.
FAMILIES = {"S": 10, "H": 10, "J": 13, "U": 16, "T": 15, "P": 15, "K": 10, "V": 17, "I": 19, "M": 17, "E": 3, "L": 2}


def test_every_operator_is_registered():
    have = {name.split("_")[0] for name in entry_module.queries()}
    assert not [f"{f}{n}" for f, last in FAMILIES.items() for n in range(1, last + 1) if f"{f}{n}" not in have]
