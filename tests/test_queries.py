"""Every registered query equals its SQL on DuckDB (small tables)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from ticketgrain.plans import all_queries
from tools.check_queries import compare, duck

ROWS_ONLY = {"rouge_stemmed", "rouge_l", "eval_report", "lr_lang", "lr_saved_model"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


OWN = all_queries()[0]  # the training-data queries have tests of their own


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    status, rows, _, note = compare(spark, con, name, SF)
    assert status == ("rows-only" if name in ROWS_ONLY else "ok"), note
    assert rows > 0 or name == "exp_by_name"


def test_contract(spark):
    assert set(OWN) <= set(entry.queries())
    assert set(entry.oracle_sql()) & set(OWN) == set(OWN) - ROWS_ONLY
    assert entry.entry(spark).columns == ["quality", "n", "pct", "mean_chars", "mean_words"]
