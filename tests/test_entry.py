import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "revenue", "n_orders"]
    rows = df.collect()
    assert 0 < len(rows) <= 3
    assert [r.revenue for r in rows] == sorted((r.revenue for r in rows), reverse=True)
