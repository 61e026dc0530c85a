"""Every registered query against its SQL counterpart on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
import __spark_entry__ as contract  # noqa: E402

from dictforge.plans import catalog  # noqa: E402
from tests.compare import difference  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    sql = contract.oracle_sql().get(name)
    assert sql, f"{name} has no SQL counterpart"
    assert difference(df, SF_DIR, sql) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
