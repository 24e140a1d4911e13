import json
import random

import pytest
from pyspark.sql import functions as F

from pitchline.operators import changes, merge, sinks
from pitchline.plans import engine
from pitchline.plans.queries import order_matches
from pitchline.plans.stage_queries import SETTINGS
from pitchline.shared import Workspace, new_folder
from pitchline.streaming import intake, merging

DATA = "/root/testdata/sf0.001"


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ changes


def state(spark, rows):
    return changes.snapshot(spark.createDataFrame(rows, "k string, v double, note string"), F.col("k"), F.struct("v", "note"))


def kinds(before, after):
    """Changes by comparing bags of rows."""
    bag = lambda rows, k: sorted(((v, n) for key, v, n in rows if key == k), key=repr)
    out = []
    for k in {r[0] for r in before} | {r[0] for r in after}:
        a, b = bag(before, k), bag(after, k)
        out.append((k, "added" if not a else "removed" if not b else "same" if a == b else "changed"))
    return sorted(out, key=repr)


def test_changes_equal_a_comparison_of_bags(spark):
    rng = random.Random(2)
    make = lambda: [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1.0, 2.0]), rng.choice([None, "", "x"])) for _ in range(25)]
    for _ in range(4):
        before, after = make(), make()
        after += before[:10]
        assert told(changes.changes(state(spark, before), state(spark, after))) == kinds(before, after)


def test_versions_are_written_only_if_something_changed(spark):
    store = changes.Snapshots(spark, new_folder(spark, "versions"))
    assert store.current() is None
    first, found = store.commit(state(spark, [("a", 1.0, None), ("a", 1.0, None), (None, 2.0, "n")]))
    assert (first.version, first.written, first.added, first.rows, first.drift) == (0, True, 2, 3, "none") and found.count() == 2
    same, found = store.commit(state(spark, [(None, 2.0, "n"), ("a", 1.0, None), ("a", 1.0, None)]))
    assert (same.version, same.written, found.count()) == (0, False, 0)
    # a repeated row that goes is a change
    less, found = store.commit(state(spark, [(None, 2.0, "n"), ("a", 1.0, None)]))
    assert (less.version, less.written, told(found)) == (1, True, [("a", "changed")])
    none, _ = store.commit(state(spark, []))
    assert (none.removed, none.rows, none.drift, none.written) == (2, 0, "drop", True)
    assert store.commit(state(spark, []))[0].written is False and store.current().count() == 0


@pytest.mark.parametrize("before, now, most, want", [(None, 5, 0.8, "none"), (0, 5, 0.8, "none"), (10, 2, 0.8, "none"), (10, 1, 0.8, "drop"), (10, 18, 0.8, "none"), (10, 19, 0.8, "increase")])
def test_drift(before, now, most, want):
    assert changes.drift(before, now, most) == want


# ------------------------------------------------------------------ runs


def raw(spark, folder, name, text):
    sinks.write_files(spark.createDataFrame([(f"{folder}/raw/{name}", bytearray(text.encode()))], "path string, content binary")).collect()


def matches(*ids):
    return json.dumps([{"id": i, "home": {"id": f"h{i}", "name": f"Home {i}"}, "away": {"id": "a", "name": "Away"}, "date": "2026-01-02", "status": "ft"} for i in ids])


def metrics(spark, folder, clock=SETTINGS.clock, **settings):
    return {(r.stage, r.metric): r.value for r in engine.run(spark, folder, engine.Settings(clock, 2026, **settings)).collect()}


def test_a_run_without_raw_files_is_blocked(spark):
    folder = new_folder(spark, "run")
    got = metrics(spark, folder)
    assert got["run", "status"] == "BLOCKED" and got["run", "error"] == "raw/ directory does not exist."
    sinks.write_files(spark.createDataFrame([(f"{folder}/raw/readme.md", bytearray(b"x"))], "path string, content binary")).collect()
    assert metrics(spark, folder)["run", "error"] == "No raw files found."


def test_a_run_whose_sources_all_fail_keeps_its_counters(spark):
    folder = new_folder(spark, "run")
    text = json.dumps({"schemaVersion": "1.0", "sources": [{"id": "s", "name": "n", "provider": "p", "type": "t", "priority": 1, "url": "https://github.com/o/r"}]})
    sinks.write_files(spark.createDataFrame([(f"{folder}/source.json", bytearray(text.encode()))], "path string, content binary")).collect()
    rows = engine.run(spark, folder, engine.Settings(SETTINGS.clock, 2026), f"{folder}/source.json", lambda url, accept: (500, b"")).collect()
    got = {(r.stage, r.metric): r.value for r in rows}
    assert got["fetch", "failed"] == "1" and got["run", "status"] == "BLOCKED" and got["run", "error"] == "raw/ directory does not exist."


def test_the_same_data_are_published_once(spark):
    folder = new_folder(spark, "run")
    raw(spark, folder, "s/a.json.raw", matches(1, 2, 3, 4, 5, 6))
    assert metrics(spark, folder)["run", "status"] == "PUBLISHED"
    place = f"{folder.removeprefix('file:')}/data/matches.json".replace("//", "/")
    before = open(place).read()
    later = "2026-09-01T00:00:00+00:00"
    assert metrics(spark, folder, later)["run", "status"] == "UNCHANGED" and open(place).read() == before
    assert metrics(spark, folder, later, only_if_changed=False)["run", "status"] == "PUBLISHED" and open(place).read() != before
    raw(spark, folder, "s/a.json.raw", matches(1))
    got = metrics(spark, folder, "2026-10-01T00:00:00+00:00")
    assert got["run", "status"] == "PUBLISHED" and got["build", "drift"] == "drop"


def test_a_file_that_cannot_be_saved_leaves_the_others(spark):
    work = Workspace(spark, "t")
    for name, ids in (("a", (1, 2)), ("b", (3,))):
        raw(spark, work.path, f"s/{name}.json.raw", matches(*ids))
    raw(spark, work.path, "s/c.json.raw", "[]")
    # a folder stands where the document of the second file belongs
    sinks.write_files(spark.createDataFrame([(f"{work.path}/documents/s__b.json.json/x", bytearray(b""))], "path string, content binary")).collect()
    rows, report = engine.normalize(spark, f"{work.path}/raw", SETTINGS, work, f"{work.path}/documents")
    assert sorted(r.id for r in rows.collect()) == ["s:1", "s:2"]
    assert {r.path: (r.status, r.matches) for r in report.collect()} == {"s/a.json.raw": ("successful", 2), "s/b.json.raw": ("failed", 0), "s/c.json.raw": ("empty", 0)}
    assert engine.files.file_counters(report).first().asDict() == {"raw_files": 3, "successful_files": 1, "empty_files": 1, "failed_files": 1, "normalized_matches": 2}


# ------------------------------------------------------------------ portions


def test_files_in_portions_equal_all_at_once(spark):
    folder = new_folder(spark, "intake")
    made = lambda: intake.Intake(spark, f"{folder}/raw", f"{folder}/taken", 2026, most=2)
    raw(spark, folder, "s/a.json.raw", matches(1, 2))
    assert made().rows().columns  # before the first run there are none
    assert made().run() == 1 and made().run() == 0
    for name, text in (("b", matches(3)), ("c", "{broken"), ("deep/raw/d", matches(4, 4)), ("e", "")):
        raw(spark, folder, f"t/{name}.json.raw", text)
    raw(spark, folder, "t/ignored.md", "x")
    stream = made()
    assert stream.run() == 3 and stream.run() == 0  # Spark's file sources pass over files without a byte
    found = engine.files.raw_files(spark, f"{folder}/raw")
    whole = engine.files.file_matches(found, 2026)
    assert told(stream.rows().select(*whole.columns)) == told(whole)
    assert told(stream.report()) == told(engine.files.file_report(found, whole))


def test_a_batch_that_runs_again_gives_its_rows_once(spark):
    batches = intake.Batches(spark, new_folder(spark, "batches"))
    part = spark.range(5)
    for _ in range(2):
        batches.put("rows", part, 3)
    batches.put("rows", part.limit(2), 4)
    assert sorted(r.id for r in batches.rows("rows", part.schema).collect()) == [0, 0, 1, 1, 2, 3, 4]


@pytest.mark.parametrize("portions", [1, 5])
def test_the_merge_of_portions_equals_the_merge_at_once(spark, portions):
    folder = new_folder(spark, "merge")
    rows = order_matches(spark, DATA).filter("_rec_ord < 400")
    odd = rows.limit(6).withColumn("homeTeam", F.lit(None).cast(rows.schema["homeTeam"].dataType))  # no safe identity
    rows = rows.unionByName(odd.withColumn("_rec_ord", F.col("_rec_ord") + 1000)).unionByName(rows.limit(9).withColumn("_rec_ord", F.col("_rec_ord") + 5000))
    rows = Workspace(spark, "t").save(rows, "rows")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/arrived")
    cut = rows.withColumn("part", F.pmod(F.xxhash64("_rec_ord"), F.lit(portions)))
    for part in range(portions):
        cut.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/arrived")
        if part != 1:  # two portions wait for one run
            merging.MergedTable(spark, f"{folder}/merged", True).update(stream)
    whole = merge.merged(rows, True)
    assert told(merging.MergedTable(spark, f"{folder}/merged", True).rows().select(*whole.columns)) == told(whole)


def test_teams_that_are_no_objects_stay_none(spark):
    rows = order_matches(spark, DATA).limit(1).withColumn("id", F.lit("x"))
    gone = F.lit(None).cast(rows.schema["homeTeam"].dataType)
    none = rows.withColumn("homeTeam", gone)
    assert merge.merged(none).first().homeTeam is None
    both = merge.merged(none.unionByName(rows.withColumn("_rec_ord", F.col("_rec_ord") + 1))).first()
    assert both.homeTeam is not None and both.records == 2




@pytest.mark.parametrize("portions", [1, 4])
def test_the_merge_keeps_no_state_between_portions(spark, portions):
    folder = new_folder(spark, "merge")
    rows = order_matches(spark, DATA).filter("_rec_ord < 400")
    odd = rows.limit(6).withColumn("homeTeam", F.lit(None).cast(rows.schema["homeTeam"].dataType)).withColumn("_rec_ord", F.col("_rec_ord") + 1000)
    rows = Workspace(spark, "t").save(rows.unionByName(odd).unionByName(rows.limit(9).withColumn("_rec_ord", F.col("_rec_ord") + 5000)), "rows")
    for part in range(portions):
        rows.filter(F.pmod(F.xxhash64("_rec_ord"), F.lit(portions)) == part).coalesce(1).write.mode("append").parquet(f"{folder}/arrived")
    table = merging.MergedTable(spark, f"{folder}/merged", True)
    table.update(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/arrived"))
    whole = merge.merged(rows, True)
    for t in (table, merging.MergedTable(spark, f"{folder}/merged", True)):
        assert told(t.rows().select(*whole.columns)) == told(whole)
    kept = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/merged/state/state")
    assert not kept.getFileSystem(spark._jsc.hadoopConfiguration()).exists(kept)


def test_rows_without_a_safe_identity_stay_where_places_are_told_twice(spark):
    folder = new_folder(spark, "merge")
    one = order_matches(spark, DATA).limit(1).withColumn("homeTeam", F.lit(None).cast(order_matches(spark, DATA).schema["homeTeam"].dataType))
    rows = Workspace(spark, "t").save(one.unionByName(one).unionByName(one.withColumn("status", F.lit("other"))), "rows")
    for _ in range(2):  # the same three rows in each of two portions
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/arrived")
    table = merging.MergedTable(spark, f"{folder}/merged")
    table.update(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/arrived"))
    whole = merge.merged(rows.unionByName(rows))
    assert sorted((r._section, r.status == "other", r.records) for r in whole.collect()) == [(1, False, 1)] * 4 + [(1, True, 1)] * 2
    assert told(table.rows().select(*whole.columns)) == told(whole)
