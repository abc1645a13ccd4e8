"""Registered queries against their SQL on the smallest data set.

The sync queries each run a whole sync, so two of them stand for all here;
``tools/check.py`` runs every query.
"""

import pytest

from tools import check
from workload.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
CHOSEN = [n for n in QUERIES if not n.startswith("M")] + ["M1_current_state", "M4_detect_changes", "M16_sync_batch"]


@pytest.fixture(scope="module")
def duck():
    return check.duck(FOLDER)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, name):
    problem, rows, columns = check.compare(spark, duck, QUERIES[name], ORACLE.get(name), FOLDER)
    assert not problem, problem
    assert columns


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    for row in (("S", 17), ("C", 16), ("N", 8), ("T", 20), ("R", 9), ("Q", 23), ("L", 12), ("M", 17), ("P", 3), ("U", 3)):
        for n in range(1, row[1] + 1):
            assert any(name.startswith(f"{row[0]}{n}_") for name in QUERIES), f"{row[0]}{n}"
