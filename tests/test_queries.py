"""Every registered query against its SQL on the smallest generated tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="generated tables not present")


@pytest.fixture(scope="module")
def checker():
    import check

    return check, check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, checker, name):
    check, con = checker
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        result = check.compare(df, con, sql)
        assert result.startswith("ok"), result


def test_entry(spark):
    assert entry.entry(spark).count() > 0
