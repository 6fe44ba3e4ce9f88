"""Every registered query against its DuckDB statement (row count, columns, values)."""

import pytest

from tests.oracle_compare import compare, duck
from tests.conftest import SF_SMALL
from vantage.plans.catalog import load_all

Q, O = load_all()
_CON = {}


def _con():
    if "c" not in _CON:
        _CON["c"] = duck(SF_SMALL)
    return _CON["c"]


@pytest.mark.parametrize("key", sorted(Q))
def test_query_matches_oracle(spark, key):
    r = compare(spark, key, Q[key], O.get(key), SF_SMALL, _con())
    assert r["status"] in ("ok", "rows-only"), r


def test_every_key_has_an_oracle():
    assert set(Q) == set(O)
