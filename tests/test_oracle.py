"""Every registered query against its DuckDB oracle on the driver's sf0.01 tables."""

import os
import re

import pytest

from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _names():
    import __spark_entry__ as e

    return sorted(e.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_of_the_library_has_an_oracle():
    """The optional operators (opN_*) and the pipeline may have none; their own tests check those."""
    import __spark_entry__ as e

    missing = set(e.queries()) - set(e.oracle_sql())
    assert not {name for name in missing if not re.fullmatch(r"op\d+_\w+|pipeline", name)}


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as e

    r = compare(spark, name, e.queries()[name], e.oracle_sql()[name], SF, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    # exact value equality (an integral float equals the same integer: pandas
    # turns Spark's nullable integer columns into floats)
    assert r["exact"], r
