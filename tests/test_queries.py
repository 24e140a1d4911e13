import decimal
import math

import duckdb
import pytest

from pitchline.plans import registry

DATA = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents pages clicks sales".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float) and math.isnan(x):
        return None
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    made = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in made.description]
    assert sorted(df.columns) == sorted(names)
    got, want = ordered(df.columns, [tuple(r) for r in df.collect()]), ordered(names, made.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_numbers_of_customers_that_look_like_years_are_none(spark, tmp_path):
    spark.range(3).selectExpr("array(2015L, 12034L, 7L)[id] as c_custkey").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    made = con.execute(registry.oracle_sql()["q15_txt_parse"])
    names = [c[0] for c in made.description]
    got = registry.queries()["q15_txt_parse"](spark, str(tmp_path))
    assert ordered(got.columns, [tuple(r) for r in got.collect()]) == ordered(names, made.fetchall())


ODD_DOCUMENTS = [
    (1, "a"), (2, "A "), (3, ""), (4, " \t\n"), (5, None), (6, "ta"), (8, "t"), (9, " a"), (7, ""), (14, None),  # blank texts are one
    (21, "a"), (21, "b"), (28, None), (28, None), (28, None), (10, "c"), (10, "c"),  # ids that stand twice
    (None, "a"), (None, None), (-7, "a"), (-1, "d"),
]


@pytest.mark.parametrize("name", ["q22_dedup_stats", "q23_union_noid"])
def test_documents_without_text_or_with_repeated_ids(spark, tmp_path, name):
    rows = [(i, t, "en", "a", 1) for i, t in ODD_DOCUMENTS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    made = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in made.description]
    got = registry.queries()[name](spark, str(tmp_path))
    assert ordered(got.columns, [tuple(r) for r in got.collect()]) == ordered(names, made.fetchall())
