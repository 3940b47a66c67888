"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
import compare

from cellferry import registry

registry.load_all()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def db(small):
    return compare.database(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, small, name):
    ours = QUERIES[name](spark, small).toPandas()
    if name in ORACLES:
        assert compare.differences(ours, db.execute(ORACLES[name]).df()) == ""
    else:
        assert len(ours) > 0


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_only_random_queries_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"random_key_load", "key_sample_random"}


def test_random_keys_are_unique_and_whole(spark, small):
    df = QUERIES["random_key_load"](spark, small)
    source = spark.read.parquet(f"{small}/customer.parquet")
    assert df.select("row_key").distinct().count() == source.count()
    ours = {tuple(r) for r in df.select("c_name", "c_mktsegment").collect()}
    assert ours == {tuple(r) for r in source.select("c_name", "c_mktsegment").collect()}
    assert all(len(r[0]) == 36 for r in df.select("row_key").collect())


def test_random_sample_is_part_of_the_keys(spark, small):
    from cellferry.operators.layout import sample_keys

    keys = spark.range(20_000).selectExpr("cast(id % 10000 as string) as row_key")
    sampled = [r[0] for r in sample_keys(keys, 0.05, seed=3).collect()]
    assert len(sampled) == len(set(sampled))
    assert 350 < len(sampled) < 650
    assert all(0 <= int(k) < 10_000 for k in sampled)
