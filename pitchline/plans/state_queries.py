"""Named queries over data that changes or arrives in portions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, rules, sinks, summaries, temporal
from ..shared import Workspace, new_folder
from ..streaming import intake, merging
from ..streaming import windows as temporal_windows
from .queries import _HOLED, _ORDERS, holed, order_matches, query, table
from .stage_queries import SETTINGS, raw_customers

# ------------------------------------------------------------------ changes

# Three states of orders: some are missing, then others, and prices move; the last is the second once more.
_STATE = [("o_orderkey % 11 != 0", "o_totalprice"), *[("o_orderkey % 13 != 0", "CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 1 ELSE o_totalprice END")] * 2]


def _state(spark: SparkSession, d: str, number: int) -> DataFrame:
    keep, price = _STATE[number]
    rows = table(spark, d, "orders").filter(keep).withColumn("o_totalprice", F.expr(price))
    content = F.struct("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return changes.snapshot(rows, F.col("o_orderkey"), content)


@query("q65_changes", """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'added' WHEN o_orderkey % 13 = 0 THEN 'removed' ELSE 'changed' END AS change FROM orders
WHERE (o_orderkey % 11 != 0 OR o_orderkey % 13 != 0) AND (o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0)""")
def q65(spark, d):
    """What changed between two states of all orders, by their stored snapshots."""
    store = changes.Snapshots(spark, new_folder(spark, "q65"))
    store.commit(_state(spark, d, 0))
    return store.commit(_state(spark, d, 1))[1].select(F.col("identity").alias("o_orderkey"), "change")


@query("q66_versions", """WITH n AS (SELECT count(*) FILTER (o_orderkey % 11 != 0) AS first, count(*) FILTER (o_orderkey % 13 != 0) AS second, count(*) FILTER (o_orderkey % 11 = 0 AND o_orderkey % 13 != 0) AS added,
 count(*) FILTER (o_orderkey % 13 = 0 AND o_orderkey % 11 != 0) AS removed, count(*) FILTER (o_orderkey % 17 = 0 AND o_orderkey % 11 != 0 AND o_orderkey % 13 != 0) AS changed FROM orders)
SELECT 0 AS run, 0 AS version, true AS written, first AS added, 0 AS changed, 0 AS removed, first AS rows, 'none' AS drift FROM n UNION ALL SELECT 1, 1, true, added, changed, removed, second, CASE WHEN abs(second - first) > 0.001 * first THEN CASE WHEN second < first THEN 'drop' ELSE 'increase' END ELSE 'none' END FROM n
UNION ALL SELECT 2, 1, false, 0, 0, 0, second, 'none' FROM n UNION ALL SELECT 3, 2, true, 0, 0, second, 0, 'drop' FROM n""")
def q66(spark, d):
    """Four runs: a first state, a changed one, the same again, which writes nothing, and none at all."""
    store = changes.Snapshots(spark, new_folder(spark, "q66"))
    runs = [_state(spark, d, 0), _state(spark, d, 1), _state(spark, d, 2), _state(spark, d, 0).filter("false")]
    told = [store.commit(s, 0.001)[0] for s in runs]
    return spark.createDataFrame([(i, t.version, t.written, t.added, t.changed, t.removed, t.rows, t.drift) for i, t in enumerate(told)], "run int, version int, written boolean, added long, changed long, removed long, rows long, drift string")


# ------------------------------------------------------------------ portions

_CUSTOMER_ROWS = """SELECT 'src_' || (c_nationkey % 3) || ':' || (c_custkey + 1) AS id, c_name AS home, 'Away ' || c_nationkey AS away, c_mktsegment AS competition, strftime(DATE '2026-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') || 'T00:00:00+00:00' AS kickoff, again, CASE WHEN again THEN 'UNKNOWN' ELSE 'FINISHED' END AS status
 FROM customer, (VALUES (false), (true)) t(again) WHERE NOT again OR c_custkey % 10 = 0"""


@query("q67_intake", f"SELECT id, home, away, competition, kickoff, status FROM ({_CUSTOMER_ROWS}) UNION ALL SELECT 'runs', NULL, NULL, NULL, NULL, CASE WHEN early = 0 THEN '0' ELSE CAST(early AS VARCHAR) END || ',' || CAST(files - early AS VARCHAR) || ',0' FROM (SELECT count(DISTINCT c_nationkey) AS files, count(DISTINCT c_nationkey) FILTER (c_nationkey % 3 = 0) AS early FROM customer)")
def q67(spark, d):
    """Raw files of all customers that arrive in two portions, taken by three runs of a stream: each file is parsed once; a row `runs` tells how many each run took."""
    folder = new_folder(spark, "q67")
    raw_customers(spark, d, folder, F.col("c_nationkey") % 3 == 0)
    stream = intake.Intake(spark, f"{folder}/raw", f"{folder}/taken", SETTINGS.as_of_year)
    took = [stream.run()]
    raw_customers(spark, d, folder, F.col("c_nationkey") % 3 != 0)
    took += [stream.run(), stream.run()]
    rows = stream.rows().select("id", F.col("homeTeam.name").alias("home"), F.col("awayTeam.name").alias("away"), F.col("competition.name").alias("competition"), F.col("scheduledAt").alias("kickoff"), "status")
    none = [F.lit(None).cast("string").alias(c) for c in ("home", "away", "competition", "kickoff")]
    return rows.unionByName(spark.range(1).select(F.lit("runs").alias("id"), *none, F.lit(",".join(map(str, took))).alias("status")))


@query("q68_stream_merge", f"WITH {_ORDERS} SELECT home, away, kickoff, cid, cname, status, first_ord, records FROM merged")
def q68(spark, d):
    """The merge of all orders, kept as state over portions of them; equal to the merge at once."""
    folder = new_folder(spark, "q68")
    rows = order_matches(spark, d)
    rows.repartition(4).write.parquet(f"{folder}/arrived")
    merged = merging.MergedTable(spark, f"{folder}/merged")
    merged.update(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/arrived"))
    return merged.rows().select(F.col("homeTeam.name").alias("home"), F.col("awayTeam.name").alias("away"), F.col("scheduledAt").alias("kickoff"), F.col("competition.id").alias("cid"), F.col("competition.name").alias("cname"), "status", F.col("_rec_ord").alias("first_ord"), "records")


# ------------------------------------------------------------------ time

_CENTS = "CAST(floor(100 * value + 0.5) AS BIGINT)"


def _cents() -> Column:
    return F.floor(100 * F.col("value") + 0.5).cast("long")


def _named(df: DataFrame) -> DataFrame:
    """Starts and ends as texts, which both sides write alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start", "end", "last") if c in df.columns})


@query("q69_tumbling", f"SELECT kind, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS \"end\", count(*) AS rows, CAST(sum({_CENTS}) AS BIGINT) AS cents FROM clicks WHERE ts IS NOT NULL GROUP BY ALL")
def q69(spark, d):
    """Clicks by kind and hour as a stream over their files, read in one portion, so that none is late."""
    folder = new_folder(spark, "q69")
    rows = table(spark, d, "clicks").select("kind", F.col("ts").cast("timestamp").alias("ts"), "value")
    rows.write.parquet(f"{folder}/arrived")
    made = temporal_windows.WindowTable(spark, f"{folder}/windows", "ts", "1 hour", "kind", late="1 day", cents=_cents())
    made.update(spark.readStream.schema(rows.schema).parquet(f"{folder}/arrived"))
    return _named(made.rows())


@query("q70_sliding", """SELECT event_type, strftime(s, '%Y-%m-%d %H:%M:%S') AS start, strftime(s + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS "end", count(*) AS rows FROM (SELECT event_type, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '2000-01-01') - INTERVAL 15 MINUTE * unnest(range(4)) AS s FROM events WHERE ts IS NOT NULL) GROUP BY ALL""")
def q70(spark, d):
    """Events by type in hours that start every quarter."""
    return _named(temporal.windows(table(spark, d, "events"), "ts", "1 hour", "event_type", slide="15 minutes"))


@query("q71_sessions", f"""WITH o AS (SELECT client_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY client_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY client_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT client_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, count(*) AS rows, CAST(sum({_CENTS}) AS BIGINT) AS cents FROM r GROUP BY client_id, run""")
def q71(spark, d):
    """Sessions of all clients: runs of clicks with less than half an hour between them."""
    return _named(temporal.sessions(table(spark, d, "clicks"), "client_id", "ts", 1800, cents=_cents()))


@query("q72_as_of", """WITH s AS (SELECT client_id, sold_at, max(sale_id) AS sale_id FROM sales WHERE client_id IS NOT NULL AND sold_at IS NOT NULL AND sale_id IS NOT NULL GROUP BY client_id, sold_at)
SELECT click_id, clicks.client_id, sale_id FROM clicks ASOF LEFT JOIN s ON clicks.client_id = s.client_id AND clicks.ts >= s.sold_at""")
def q72(spark, d):
    """Each click with the last sale of its client before it."""
    clicks = table(spark, d, "clicks").select("click_id", "client_id", "ts")
    sales = table(spark, d, "sales").select("sale_id", "client_id", "sold_at").filter("sale_id is not null")
    return temporal.as_of(clicks, sales, "client_id", "ts", "sold_at", "sale_id").select("left.click_id", "left.client_id", "right.sale_id")


@query("q73_within", "SELECT a.o_orderkey AS first, b.o_orderkey AS second FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate BETWEEN a.o_orderdate AND a.o_orderdate + INTERVAL 30 DAY AND a.o_orderkey != b.o_orderkey")
def q73(spark, d):
    """Pairs of orders of a customer of which the second came within 30 days after the first."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    met = temporal.within(orders, orders, "o_custkey", "o_orderdate", "o_orderdate", 0, 30 * 86_400)
    return met.select(F.col("left.o_orderkey").alias("first"), F.col("right.o_orderkey").alias("second")).filter("first != second")


# ------------------------------------------------------------------ summaries and sinks


@query("q74_findings_cube", f"WITH {_HOLED}, s AS (SELECT f.*, coalesce(i % 3, -1) AS source FROM f) SELECT severity, \"check\", source, CAST(grouping(severity, \"check\", source) AS BIGINT) AS level, count(*) AS findings, count(DISTINCT i) AS records, count(DISTINCT message) AS messages FROM s GROUP BY CUBE (severity, \"check\", source)")
def q74(spark, d):
    """Findings by every combination of severity, check and source, with the records that they touch."""
    rows = rules.findings(holed(spark, d), rules.Rules(), work=Workspace(spark, "q74"))
    told = rows.withColumn("source", F.coalesce(F.col("record_index") % 3, F.lit(-1)))
    return summaries.cube(told, "severity", "check", "source", records=F.col("record_index"), messages=F.col("message")).withColumnRenamed("rows", "findings")


@query("q75_parts", "SELECT o_orderpriority AS source, count(*) FILTER (o_orderpriority != '2-HIGH' OR o_orderkey % 2 = 0) AS rows, o_orderpriority != '2-HIGH' AS untouched FROM orders GROUP BY o_orderpriority HAVING count(*) FILTER (o_orderpriority != '2-HIGH' OR o_orderkey % 2 = 0) > 0")
def q75(spark, d):
    """A table of all orders by priority, of which one is written again with half of its rows; whether each part's files are those of the first run."""
    folder = new_folder(spark, "q75")
    rows = order_matches(spark, d).select("scheduledAt", "status", "_rec_ord", F.col("awayTeam.name").alias("source"))
    sinks.write_parts(rows, folder, "source")
    read = lambda: spark.read.schema(rows.schema).parquet(folder)
    files = lambda c: read().select("source", F.col("_metadata.file_name").alias("f")).groupBy("source").agg(F.min("f").alias(c))
    before = Workspace(spark, "q75").save(files("before"), "before")
    sinks.write_parts(rows.filter("source = '2-HIGH' and _rec_ord % 2 = 0"), folder, "source")
    after = read().select("source", F.col("_metadata.file_name").alias("f")).groupBy("source").agg(F.count("*").alias("rows"), F.min("f").alias("after"))
    return after.join(before, "source").select("source", "rows", (F.col("before") == F.col("after")).alias("untouched"))
