"""The queries with SQL against DuckDB over whole tables."""

import duckdb
import pytest

from strata.llm import queries
from tests.conftest import SF001

TABLES = ("documents", "embeddings", "labels")


def plain(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.Q[name](spark, SF001)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(plain, got.select(*columns).collect()), key=repr) == sorted(map(plain, want.fetchall()), key=repr)


def test_every_dealt_operator_is_registered():
    assert [n for n in queries.Q if n.startswith("op")] == sorted(
        (n for n in queries.Q if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert len(queries.Q) == 14 and set(queries.SQL) < set(queries.Q)
