"""S14 without a database: the JDBC write is replaced by Spark's ``noop``
sink, so table order, modes and observed row counts are checked; the JDBC
calls themselves need a database, which is not started here."""

import os

import pytest

from conftest import SF_SMALL
from hirelake.plans import catalog, feeds
from hirelake.sources import jdbc, lake


def test_load_serving_modes_and_counts(spark, tmp_dir, monkeypatch):
    gold_root = os.path.join(tmp_dir, "gold")
    for name, df in zip(lake.GOLD_TABLES, catalog.gold_tables(spark, SF_SMALL)):
        lake.write_gold(df, gold_root, name, feeds.RUN_DATE)
    calls = []

    def fake_write(df, url, table, mode="append", properties=None, **kw):
        calls.append((table, mode))
        df.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr(jdbc, "write_jdbc", fake_write)
    counts = jdbc.load_serving(spark, gold_root, feeds.RUN_DATE, "jdbc:none")
    assert calls == [(t, "append") for t in lake.GOLD_TABLES]
    expected = {t: lake.read_gold(spark, gold_root, t, feeds.RUN_DATE).count()
                for t in lake.GOLD_TABLES}
    assert counts == expected
    calls.clear()
    jdbc.load_serving(spark, gold_root, None, "jdbc:none", mode="refresh")
    assert calls == [(t, "overwrite") for t in lake.GOLD_TABLES]
    with pytest.raises(ValueError):
        jdbc.load_serving(spark, gold_root, None, "jdbc:none", mode="overwrite")
