import pytest
from pyspark.sql import functions as F

from pitchline.operators import merge

SCHEMA = "id string, homeTeam struct<id:string,name:string>, awayTeam struct<id:string,name:string>, scheduledAt string"
CASES = [
    ((" S:A1 ", None, None, None), ("EXPLICIT_MATCH_ID", "s:a1")),
    ((None, ("H9", None), (None, "St. Mary's"), "2026-08-23T15:00:00+02:00"), ("FIXTURE_COMPOSITE", "id:h9|name:st mary s|2026-08-23T13:00:00+00:00")),
    ((" ", (None, "N"), (None, "M"), "2026-08-23T15:00:00"), ("FIXTURE_COMPOSITE", "name:n|name:m|2026-08-23T15:00:00")),
    ((None, (None, "N"), None, "2026-08-23"), ("NO_SAFE_IDENTITY", "")),
    ((None, (" ", "..."), ("1", None), "2026-08-23"), ("NO_SAFE_IDENTITY", "")),
    (("", ("1", None), ("2", None), None), ("NO_SAFE_IDENTITY", "")),
]


@pytest.fixture(scope="module")
def told(spark):
    rows = [(i, *row) for i, (row, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, f"i int, {SCHEMA}").withColumn("identity", merge.identity())


def test_identity_of_each_row(told):
    got = {r.i: (r.identity.type, r.identity.key) for r in told.collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_identity_filters_a_join(spark, told):
    """The filter names columns of both sides, so it has to stay above the join."""
    ids, rest = told.select("i", "id"), told.drop("id", "identity").withColumnRenamed("i", "k")
    joined = ids.join(rest, F.col("i") == F.col("k")).withColumn("identity", merge.identity())
    assert joined.filter(F.col("identity.type") == "NO_SAFE_IDENTITY").count() == 3
