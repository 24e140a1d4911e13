import duckdb
import pytest

from pitchline.llm import queries
from tests.test_queries import ordered

from .conftest import DATA


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    made = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in made.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered(names, made.fetchall())
