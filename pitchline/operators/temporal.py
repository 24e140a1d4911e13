"""Windows, sessions and joins over time.

Whatever has to be ordered within a key is cut by buckets of time first, so a key with most of the rows is ordered by many tasks; only one row for each key and bucket is brought together.
Rows without a time or a key belong to no window or session and meet nothing.  Times that are equal are decided by a column that the caller names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def windows(rows: DataFrame, time: str, size: str, *keys: str, slide: str | None = None, **sums: Column) -> DataFrame:
    """(keys, start, end, rows, sums) of windows of a fixed size, batch or stream: each row is in one of them, or with slide in each that starts so often and holds it."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    told = rows.groupBy(*keys, window.alias("window")).agg(F.count("*").alias("rows"), *(F.sum(c).alias(n) for n, c in sums.items()))
    return told.select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "rows", *sums)


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def sessions(rows: DataFrame, key: str, time: str, gap_seconds: int, bucket_seconds: int = 86_400, **sums: Column) -> DataFrame:
    """(key, start, last, rows, sums): runs of a key's rows in which none is gap_seconds or more after the one before.

    Runs are found within buckets of time, then runs of neighbouring buckets are joined: a key brings together its runs, not its rows.
    """
    gap, wide = gap_seconds * 1_000_000, bucket_seconds * 1_000_000
    at = rows.select(F.col(key).alias("key"), _micros(F.col(time)).alias("t"), *(c.alias(n) for n, c in sums.items())).filter("key is not null and t is not null")

    def joined(parts: DataFrame, cut: list[str]) -> DataFrame:
        """Runs of parts (key, start, last, rows, sums) within the groups of cut."""
        order = Window.partitionBy(*cut).orderBy("start", "last")
        fresh = F.col("start") - F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1)) >= gap
        numbered = parts.withColumn("run", F.sum(F.coalesce(fresh, F.lit(True)).cast("int")).over(order))
        return numbered.groupBy(*cut, "run").agg(F.min("start").alias("start"), F.max("last").alias("last"), F.sum("rows").alias("rows"), *(F.sum(n).alias(n) for n in sums)).drop("run")

    each = at.withColumn("bucket", F.floor(F.col("t") / wide)).select("key", "bucket", F.col("t").alias("start"), F.col("t").alias("last"), F.lit(1).cast("long").alias("rows"), *sums)
    whole = joined(joined(each, ["key", "bucket"]).drop("bucket"), ["key"])
    return whole.select(F.col("key").alias(key), F.timestamp_micros("start").alias("start"), F.timestamp_micros("last").alias("last"), "rows", *sums)


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, tie: str, bucket_seconds: int = 3_600) -> DataFrame:
    """(left: the row, right: the last row of the same key at or before the left row's time, of equal times that with the largest tie, or null) of each left row.

    Both sides are ordered together within a key and bucket of time; the last right row before a bucket comes from one row for each key and bucket.
    """
    wide = bucket_seconds * 1_000_000
    cut = lambda df, time, **more: df.select(F.col(f"`{key}`").alias("key"), _micros(F.col(f"`{time}`")).alias("t"), *(c.alias(n) for n, c in more.items())).withColumn("bucket", F.floor(F.col("t") / wide))
    row = lambda df: F.struct(*(F.col(f"`{c}`") for c in df.columns))
    asked = cut(left, left_time, left=row(left))
    known = cut(right, right_time, right=row(right), tie=F.col(f"`{tie}`")).filter("key is not null and t is not null")
    # a left row without a key or a time asks for nothing
    alone = asked.filter("key is null or t is null").select("left", F.lit(None).cast(known.schema["right"].dataType).alias("right"))
    asked = asked.filter("key is not null and t is not null")
    both = asked.withColumns({"right": F.lit(None).cast(known.schema["right"].dataType), "tie": F.lit(None).cast(known.schema["tie"].dataType), "side": F.lit(1)}).unionByName(known.withColumns({"left": F.lit(None).cast(asked.schema["left"].dataType), "side": F.lit(0)}))
    inside = F.last("right", True).over(Window.partitionBy("key", "bucket").orderBy("t", "side", "tie"))
    told = both.withColumn("inside", inside).filter("side = 1")
    last = known.groupBy("key", "bucket").agg(F.max_by("right", F.struct("t", "tie")).alias("last")).withColumnRenamed("bucket", "from")
    # each bucket's last row holds until the next bucket that has one
    until = last.withColumn("until", F.lead("from").over(Window.partitionBy("key").orderBy("from")))
    need = told.filter("inside is null").select("key", "bucket").distinct()
    held = need.withColumn("side", F.lit(1)).unionByName(until.select("key", F.col("from").alias("bucket"), "last", F.lit(0).alias("side")), allowMissingColumns=True)
    # the bucket's own row comes after what asks for the ones before it
    before = Window.partitionBy("key").orderBy("bucket", F.desc("side")).rowsBetween(Window.unboundedPreceding, -1)
    carried = held.withColumn("carried", F.last("last", True).over(before)).filter("side = 1").select(F.col("key").alias("k"), F.col("bucket").alias("b"), "carried")
    out = told.join(carried, (F.col("key") == F.col("k")) & (F.col("bucket") == F.col("b")) & F.col("inside").isNull(), "left")
    return out.select("left", F.coalesce("inside", "carried").alias("right")).unionByName(alone)


def within(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, before_seconds: int, after_seconds: int) -> DataFrame:
    """(left, right) for the rows of a key of which the right one is at most before_seconds before and after_seconds after the left one.

    A right row stands in one bin of time, a left row in the two or three that its interval touches, so the join is by equality and each pair is met once.
    """
    lo, hi = before_seconds * 1_000_000, after_seconds * 1_000_000
    wide = max(1, lo + hi)
    row = lambda df: F.struct(*(F.col(f"`{c}`") for c in df.columns))
    t = _micros(F.col(f"`{left_time}`"))
    bins = F.sequence(F.floor((t - lo) / wide), F.floor((t + hi) / wide))
    a = left.select(F.col(f"`{key}`").alias("key"), t.alias("t"), row(left).alias("left"), F.explode(bins).alias("bin"))
    u = _micros(F.col(f"`{right_time}`"))
    b = right.select(F.col(f"`{key}`").alias("key"), u.alias("u"), row(right).alias("right"), F.floor(u / wide).alias("bin"))
    return a.join(b, ["key", "bin"]).filter((F.col("u") >= F.col("t") - lo) & (F.col("u") <= F.col("t") + hi)).select("left", "right")
