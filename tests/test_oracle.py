"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver entry point."""


from tests.conftest import SF_SMALL


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["criticality", "versions", "exposed_days", "failures", "mtbf_days", "correctives",
                          "mttr_hours"]
    assert set(E.oracle_sql()) <= set(E.queries())
    from vireo.plans import catalog
    assert set(catalog.SPARK) == set(catalog.SQL) <= set(E.queries())


def test_all_queries_match_oracle(spark):
    from tests.oracle_compare import compare
    from vireo.plans import catalog
    res = compare(spark, SF_SMALL, list(catalog.SPARK))
    bad = {n: r for n, r in res.items()
           if "error" in r or r.get("values_match") is False or r.get("types_match") is False}
    assert not bad, bad
