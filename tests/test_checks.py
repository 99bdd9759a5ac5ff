"""Every query against its SQL twin, over shared stages of the smallest tables."""

import dataclasses

import pytest

import __spark_entry__
from checks import compare, oracle, registry
from checks.chain import Chain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chain(spark):
    return Chain(spark, SF_DIR)


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("key", list(registry.QUERIES))
def test_query_equals_sql(chain, con, key):
    df = registry.QUERIES[key](chain)
    result = con.execute(oracle.sql(key))
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert compare.rows_of(df.columns, df.collect()) == compare.rows_of(names, result.fetchall())


@pytest.mark.parametrize("key", ["mkt_outlier", "eol_outlier"])
def test_hot_peer_groups_equal_sql(spark, chain, con, key):
    """The same whole tables with every group of two or more treated as hot."""
    hot = Chain(spark, SF_DIR)
    hot.settings = dataclasses.replace(hot.settings, hot_group_rows=1, rank_slices=4)
    hot.measures, hot.elements = chain.measures, chain.elements
    df = registry.QUERIES[key](hot)
    result = con.execute(oracle.sql(key))
    names = [d[0] for d in result.description]
    assert compare.rows_of(df.columns, df.collect()) == compare.rows_of(names, result.fetchall())


def test_entry_contract(spark):
    checked = __spark_entry__.oracle_sql().keys()
    assert registry.QUERIES.keys() <= checked <= __spark_entry__.queries().keys()
    assert __spark_entry__.entry(spark).count() > 0
