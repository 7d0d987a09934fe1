import duckdb

import __spark_entry__ as entry_mod
from tabula.plans.catalog import ORACLES, QUERIES
from tabula.plans.views import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert {r.split for r in rows} == {"train", "test"}
    assert df.columns == ["split", "n_rows", "n_price", "avg_price", "avg_month_sin", "avg_month_cos"]


def test_every_oracle_has_a_query(spark):
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    for name in ("preprocess", "exact_split", "class_report", "snapshot_diff", "metric_latest", "gbt_score"):
        assert name in q


def test_queries_run_at_smallest_scale(spark, tmp_dir):
    """Every query of the catalog, written in full: rows, and the columns that its SQL names."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert set(QUERIES) <= set(entry_mod.queries())
    for name, fn in QUERIES.items():
        df = fn(spark, SF)
        df.write.parquet(f"{tmp_dir}/{name}")
        back = spark.read.parquet(f"{tmp_dir}/{name}")
        assert back.columns == df.columns and back.count() > 0, name
        if name in ORACLES:
            want = con.sql(ORACLES[name])
            assert sorted(want.columns) == sorted(df.columns), name
            assert len(want.fetchall()) == back.count(), name
