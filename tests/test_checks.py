"""Every registered query against its SQL. ``FEW_CHECKS=1`` runs a part."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from areapulse.checks.catalog import QUERIES, SQL
from areapulse.checks.compare import difference
from areapulse.sources.staging import gold

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(SQL)[::9] if os.environ.get("FEW_CHECKS") else sorted(SQL)


@pytest.fixture(scope="module")
def differences(spark):
    """What differs, by name. Small queries mostly wait for the driver, so some run at once."""
    gold(spark, FOLDER)

    def compare(name):
        try:
            return difference(QUERIES[name](spark, FOLDER), SQL[name], FOLDER)
        except Exception as error:  # the test of that name reports it
            return f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(4) as pool:
        return dict(zip(NAMES, pool.map(compare, NAMES), strict=True))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(differences, name):
    assert differences[name] is None


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)
