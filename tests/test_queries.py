"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference
from tidemark.plans.specs import SPECS

QUERIES = {name: query for name, query in contract.queries().items() if name not in contract.LLM_QUERIES}


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(contract.oracle_sql()) - set(contract.LLM_ORACLE)


def test_each_load_is_registered():
    loads = [n for n in QUERIES if n.startswith(("full_refresh_", "refresh_", "promote_", "upsert_"))]
    reports = {"full_refresh_counts", "upsert_new_rows", "upsert_changed_rows", "upsert_counts", "upsert_duplicate_guard"}
    assert len(set(loads) - reports) == sum(map(len, SPECS.values())) == 39


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["continent", "location", "date"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    assert difference(spark, sf, name) is None
