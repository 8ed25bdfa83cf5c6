"""The queries with SQL against DuckDB on the same tables."""

import duckdb
import pytest

from featurelab.llm.queries import QUERIES, SQL
from featurelab.sources.tables import TABLES


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, name, sf):
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    cur = con.execute(SQL[name])
    names = [c[0] for c in cur.description]
    want = sorted(tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in cur.fetchall())
    df = QUERIES[name](spark, d)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in sorted(names)) for r in df.collect()) == want and want
