import __spark_entry__ as entry


def test_entry_has_rows(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and "t_stat" in found.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_equal_their_sql(spark, sf_dir):
    """Some of each kind here; the driver holds all of them against their SQL."""
    import duckdb

    from rainloom.plans import proxy

    con = duckdb.connect()
    for t in ("lineitem", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in ("daily_drift", "pooled_variogram_residual", "variogram_best", "zonal_flush_round", "cache_lookup_fallback", "loo_flat"):
        found = proxy.QUERIES[name](spark, sf_dir)
        columns = sorted(found.columns)
        own = sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect())))
        rows = con.execute(proxy.ORACLE[name])
        names = [d[0] for d in rows.description]
        assert sorted(names) == columns
        assert sorted(str(tuple(dict(zip(names, r, strict=True))[c] for c in columns)) for r in rows.fetchall()) == own, name
