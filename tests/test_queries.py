"""Every registered query of the engine against its SQL, and what its plans look like."""

import pytest
from conftest import DATA, same_rows

from tarn.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    same_rows(QUERIES[name](spark, DATA), duck.sql(ORACLES[name]))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_eq"](spark, DATA))
    assert "EqualTo(c_mktsegment,FURNITURE)" in text and "c_acctbal" not in text


def test_decimal_parameters_do_not_stop_pushdown_of_dates(spark):
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES["filter_range"](spark, DATA))


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_k"](spark, DATA))


def test_no_query_of_the_engine_runs_python(spark):
    for name in ("json_contains", "fts_bm25", "json_array_agg", "win_groups_frame", "dt_bad_text"):
        assert "Python" not in plan(QUERIES[name](spark, DATA)) and "Arrow" not in plan(QUERIES[name](spark, DATA))


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_outside_the_optional_package_imports_it():
    import re
    from pathlib import Path

    import tarn

    for p in Path(tarn.__file__).parent.rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"\bllm\b", p.read_text())
