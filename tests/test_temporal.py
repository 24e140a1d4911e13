import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pitchline.operators import temporal
from pitchline.shared import new_folder
from pitchline.streaming.windows import WindowTable

DAY = datetime(2024, 1, 1)


def rows(seed, n, keys="aab"):
    """A hot key, nulls, equal times, gaps of all lengths."""
    rng = random.Random(seed)
    return [(rng.choice([*keys, "a", "a", None]), None if rng.random() < 0.05 else DAY + timedelta(seconds=rng.choice([0, 1, 59, 60, 61]) + 60 * rng.randrange(900)), i) for i in range(n)]


def frame(spark, made):
    return spark.createDataFrame(made, "key string, t timestamp, id long")


@pytest.mark.parametrize("bucket", [60, 3600, 10**7])
@pytest.mark.parametrize("gap", [1, 60, 600])
def test_sessions_equal_runs_found_one_by_one(spark, bucket, gap):
    made = rows(gap, 300)
    want, by = [], {}
    for k, t, i in made:
        if k is not None and t is not None:
            by.setdefault(k, []).append((t, i))
    for k, every in by.items():
        every.sort()
        run = [every[0]]
        for x in [*every[1:], None]:
            if x is None or x[0] - run[-1][0] >= timedelta(seconds=gap):
                want.append((k, run[0][0], run[-1][0], len(run), sum(i for _, i in run)))
                run = []
            run.append(x)
    got = temporal.sessions(frame(spark, made), "key", "t", gap, bucket, ids=F.col("id"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("bucket", [60, 3600, 10**7])
def test_as_of_equals_a_search_one_by_one(spark, bucket):
    left, right = rows(1, 200), rows(2, 60, "abc")
    right += [(k, t, i + 1000) for k, t, i in right[:20]]  # equal times: the largest id counts
    want = []
    for k, t, i in left:
        before = [(u, j) for c, u, j in right if k is not None and t is not None and c == k and u is not None and u <= t]
        want.append((i, max(before)[1] if before else None))
    clash = frame(spark, left).withColumnsRenamed({"id": "side", "t": "bucket"}).withColumn("tie", F.lit(1)).withColumn("inside", F.lit("x"))
    got = temporal.as_of(clash, frame(spark, right), "key", "bucket", "t", "id", bucket).select("left.side", "right.id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("before, after", [(0, 0), (0, 61), (3600, 120)])
def test_within_equals_all_pairs(spark, before, after):
    left, right = rows(3, 80), rows(4, 80, "abc")
    close = lambda t, u: timedelta(seconds=-before) <= u - t <= timedelta(seconds=after)
    want = [(i, j) for k, t, i in left for c, u, j in right if k is not None and k == c and t is not None and u is not None and close(t, u)]
    got = temporal.within(frame(spark, left), frame(spark, right), "key", "t", "t", before, after)
    assert sorted(tuple(r) for r in got.select("left.id", "right.id").collect()) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_tables(spark):
    none, some = frame(spark, rows(1, 1)).limit(0), frame(spark, rows(5, 20))
    assert temporal.sessions(none, "key", "t", 60).count() == 0
    assert temporal.as_of(none, some, "key", "t", "t", "id").count() == 0
    assert temporal.as_of(some, none, "key", "t", "t", "id").filter("right is null").count() == 20
    assert temporal.within(some, none, "key", "t", "t", 5, 5).count() == 0


def test_late_rows_are_dropped_and_others_change_their_windows(spark):
    folder = new_folder(spark, "late")
    at = lambda minute, key="a": (key, DAY + timedelta(minutes=minute), 1)
    portions = [[at(1), at(2), at(11), at(31, "b")], [at(3), at(12), at(25)], [at(75)], [at(41), at(70)]]
    # the watermark is 20 minutes behind the latest row of the portions before: 11 after the first, so the window up to 10 is closed in the second
    for part in portions:
        frame(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/arrived")
        stream = spark.readStream.schema("key string, t timestamp, id long").option("maxFilesPerTrigger", "1").parquet(f"{folder}/arrived")
        table = WindowTable(spark, f"{folder}/windows", "t", "10 minutes", "key", late="20 minutes", ids=F.col("id"))
        table.update(stream)
    got = {(r.key, (r.start - DAY).seconds // 60): r.rows for r in table.rows().collect()}
    assert got == {("a", 0): 2, ("a", 10): 2, ("b", 30): 1, ("a", 20): 1, ("a", 70): 2}
