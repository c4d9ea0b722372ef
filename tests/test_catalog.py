import pytest

import oracle
from shotframe import catalog, catalog_kernels, catalog_runs  # noqa: F401  the others add their queries to the first

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    oracle.compare(spark, catalog.QUERIES[name], catalog.ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_results_do_not_depend_on_partitions(spark, parts):
    from pyspark.sql import functions as F

    from shotframe.operators import differences

    s = catalog.shots(spark, SF).repartition(parts)
    out = differences.on_off_means(s, ["scan"], F.col("ipm"), catalog.on(), catalog.off())
    want = differences.on_off_means(catalog.shots(spark, SF), ["scan"], F.col("ipm"), catalog.on(), catalog.off())
    key = lambda df: sorted((r.scan, round(r.on or 0, 9), round(r.off or 0, 9), r.n_on, r.n_off) for r in df.collect())
    assert key(out) == key(want)
