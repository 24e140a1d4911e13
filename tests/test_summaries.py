import json
from itertools import product

from pyspark.sql import functions as F

from pitchline.operators import publish, sinks, summaries
from pitchline.plans import engine
from pitchline.plans.stage_queries import SETTINGS, customer_rows
from pitchline.shared import Workspace, new_folder


def test_cube_equals_counts_by_every_set_of_columns(spark):
    made = [(a, b, c) for a, b, c in product(["x", None, "y"], [1, 2, None], [None, 5, 6, 6])][:30]
    want = set()
    for use in product([True, False], repeat=2):
        groups = {}
        for a, b, c in made:
            groups.setdefault((a if use[0] else None, b if use[1] else None), []).append(c)
        level = 2 * (not use[0]) + (not use[1])
        want |= {(*k, level, len(v), len({c for c in v if c is not None})) for k, v in groups.items()}
    got = summaries.cube(spark.createDataFrame(made, "a string, b int, c int"), "a", "b", values=F.col("c"))
    assert {tuple(r) for r in got.collect()} == want
    assert summaries.cube(spark.createDataFrame([], "a string, b int, c int"), "a", "b", values=F.col("c")).count() <= 1


def test_parts_are_replaced_one_by_one_and_pruned(spark):
    folder = new_folder(spark, "parts")
    rows = spark.range(60).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("s "), F.col("id") % 3)).alias("source"))
    sinks.write_parts(rows, folder, "source")
    sinks.write_parts(rows.filter("source = 's 1' and id < 9"), folder, "source")
    back = spark.read.parquet(folder)
    assert {(r.source, r["count"]) for r in back.groupBy("source").count().collect()} == {(None, 20), ("s 1", 3), ("s 2", 20)}
    plan = back.filter("source = 's 2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_a_report_counts_more_findings_than_it_lists(spark):
    rows = customer_rows(spark, "/root/testdata/sf0.001")
    work = Workspace(spark, "t")
    settings = engine.Settings(SETTINGS.clock, 2026, listed=5)
    found = engine.validate(rows, settings, work)
    whole, head = (engine.report(found, rows.count(), s, "in") for s in (SETTINGS, settings))
    assert head["validation"]["errors"] == whole["validation"]["errors"] == len(whole["errors"]) > 5
    assert len(head["errors"]) + len(head["warnings"]) == 5 == head["validation"]["listed"] and "listed" not in whole["validation"]
    assert head["errors"] == whole["errors"][: len(head["errors"])] and head["validation"]["publicationAllowed"] is False


def test_a_written_report_is_the_report_and_lists_all(spark):
    rows = customer_rows(spark, "/root/testdata/sf0.001")
    work = Workspace(spark, "t")
    found = engine.validate(rows, SETTINGS, work)
    text = lambda: spark.read.text(f"{work.path}/report.json", wholetext=True).first()[0]
    for settings in (SETTINGS, engine.Settings(SETTINGS.clock, 2026, listed=5), engine.Settings(SETTINGS.clock, 2026, listed=0)):
        engine.write_report(found, rows.count(), settings, "in", f"{work.path}/report.json")
        assert text() == publish.json_text(engine.report(found, rows.count(), settings, "in"))
    many = spark.range(100_001).selectExpr("'error' as severity", "1 as stage", "0 as seq", "'c' as check", "'m' as message", "id as record_index")
    engine.write_report(many, 100_001, SETTINGS, "in", f"{work.path}/report.json")
    assert len(json.loads(text())["errors"]) == 100_001
