"""Every oracle-checked query equals its DuckDB oracle (sf0.001), and the
driver contract holds."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF0001  # noqa: E402

import __spark_entry__ as E  # noqa: E402


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100 and len(o) >= 80


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "model_key", "roc_auc", "f1", "precision", "recall"]
    assert len(rows) == 9


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_oracle(spark, key):
    from oracle_check import check
    res = check(spark, SF0001, [key], verbose=False)[key]
    assert "error" not in res, res
    assert res["values_match"], res
