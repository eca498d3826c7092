"""The driver's contract: every query has a name, and SQL only for queries there are."""

import pytest


def test_names():
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 40
    assert {"p2_found", "p3_found"} <= set(queries)


@pytest.mark.parametrize("name", ["p2_found", "p3_found", "diff_records", "record_summary", "reference_groups", "heading_asof"])
def test_equal_to_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    got = entry.queries()[name](spark, d)
    db = duckdb.connect()
    db.execute("set timezone='UTC'")
    for t in ("questions", "manifest", "media_records", "orders", "published_questions", "events"):
        db.execute(f"create view {t} as select * from read_parquet('{d}/{t}.parquet')")
    found = db.execute(entry.oracle_sql()[name])
    names = [x[0] for x in found.description]
    cols = sorted(got.columns)
    assert cols == sorted(names)
    want = [dict(zip(names, r)) for r in found.fetchall()]
    assert sorted(str([r[c] for c in cols]) for r in got.collect()) == sorted(str([r[c] for c in cols]) for r in want)
