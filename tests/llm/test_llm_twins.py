"""Operators that SQL can express, against DuckDB."""

import pytest
from compare import difference

from tidegate.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None
