"""Driver contract: entry smoke run and queries/oracle pairing."""
import re

import duckdb

import __spark_entry__ as se


def test_keys_pair_up():
    q, o = se.queries(), se.oracle_sql()
    own = {k for k in q if k != "pipeline" and not re.match(r"op\d+_", k)}  # the others come and go with their subpackage
    assert own <= set(o)
    assert set(o) <= set(q)


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) == 24
    assert {"component", "name", "query", "status", "trend"} <= set(df.columns)


def test_some_queries_match_oracle(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("events", "orders", "lineitem", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("rate", "histogram_quantile", "query_range_gauge", "payload_rejects", "list_labels", "payload_edge",
                 "query_range_run", "rate_odd_range"):
        sdf = se.queries()[name](spark, sf)
        cols = sorted(sdf.columns)
        a = sorted(tuple(repr(r[c]) for c in cols) for r in sdf.collect())
        rel = con.sql(se.oracle_sql()[name])
        rc = rel.columns
        b = sorted(tuple(repr(r[rc.index(c)]) for c in cols) for r in rel.fetchall())
        assert a == b, name
