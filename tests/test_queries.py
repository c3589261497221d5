"""Registered queries at sf0.001: they run, and equal their DuckDB oracle."""
import os
import sys

import pytest

from paths import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import digest  # noqa: E402


def oracle(key):
    """Columns and rows of the key's DuckDB SQL."""
    import duckdb
    from surgewatch.plans.oracle import oracle_sql
    con = duckdb.connect()
    for t in ("events", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    cur = con.execute(oracle_sql()[key])
    return [d[0] for d in cur.description], cur.fetchall()


def test_entry_is_not_empty(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows, (cols, want) = [tuple(r) for r in df.collect()], oracle("extract_alert_daily")
    assert len(rows) == 56 and sorted(cols) == sorted(df.columns)
    assert digest(df.columns, rows) == digest(cols, want)


def test_every_query_has_an_oracle_or_is_listed(spark):
    import __spark_entry__ as E
    from surgewatch.plans.catalog import NO_ORACLE, QUERIES
    missing = set(QUERIES) - set(E.oracle_sql()) - NO_ORACLE
    assert not missing


@pytest.mark.parametrize("key", ["count_category", "metrics_rows", "metrics_time", "extract_alert",
                                 "alert_message", "exceed_streak", "spikes_pieces", "metrics_rows_pieces", "metric_series_stored", "dedupe_posts",
                                 "stream_final_counts", "map_with_wordbag_join",
                                 "stream_counts", "job_late_batch", "job_same_snapshot", "read_posts_legacy",
                                 "merge_posts_mixed", "counts_upsert_path", "match_keywords_join", "match_keywords", "keyword_hits",
                                 "keyword_misses"])
def test_query_matches_oracle_sf0001(spark, key):
    import __spark_entry__ as E
    dcols, drows = oracle(key)
    df = E.queries()[key](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)
