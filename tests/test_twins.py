"""Every query against its SQL twin."""

import pytest
from compare import difference

import __spark_entry__ as entry
from tidegate.operators.profiles import rank_cluster_keys
from tidegate.plans.queries import CLUSTER_CANDIDATES

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_approximate_ranking_is_close_to_the_exact_one(spark, sf_dir):
    exact = {r.column_name: r.distinct_values for r in QUERIES["rank_cluster_keys"](spark, sf_dir).collect()}
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    near = {r.column_name: r.distinct_values for r in rank_cluster_keys(lines, CLUSTER_CANDIDATES).collect()}
    assert set(exact) == set(near)
    assert all(abs(near[c] - exact[c]) <= 0.15 * exact[c] for c in exact)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 11 and rows[5].misfits > 0
