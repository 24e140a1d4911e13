import json

import pytest
from pyspark.sql import functions as F

from pitchline.operators import merge, publish, records, rules, schema, sinks
from pitchline.plans import engine, stage_queries
from pitchline.shared import Workspace
from pitchline.sources import documents, files

DATA = "/root/testdata/sf0.001"
SETTINGS = stage_queries.SETTINGS


def local(path):
    return path.removeprefix("file://")


def test_raw_files_below_a_folder_of_the_same_name(spark):
    work = Workspace(spark, "t")
    rows = [(f"{work.path}/raw/src/raw/x.json.raw", b'{"a":'), (f"{work.path}/raw/a-b/x.raw", " é".encode("latin-1")), (f"{work.path}/raw/a/y.raw", b"\n [1]"), (f"{work.path}/raw/s__0001__n.txt.raw", b"x\xff")]
    stage_queries.write(spark.createDataFrame(rows, "path string, content binary"))
    found = files.raw_files(spark, f"{work.path}/raw").withColumn("key", merge.file_key(F.col("path"))).orderBy("key").collect()
    assert [(r.path, r.source_id, r.format) for r in found] == [("a/y.raw", "a", "json"), ("a-b/x.raw", "a-b", "unknown"), ("s__0001__n.txt.raw", "s", "text"), ("src/raw/x.json.raw", "src", "json")]
    assert found[2].text == "x�" and found[1].text is None


@pytest.mark.parametrize("depth", [0, 1, 3, 4, 12, 200])
def test_records_at_any_depth(spark, depth):
    text = '{"l":' * depth + '{"first":{"matches":[{"a":1},3]},"x":[{"b":2}]}' + "}" * depth
    got = spark.range(1).select(records.discovered(F.lit(text)).alias("r")).first().r
    assert [json.loads(r) for r in got] == [{"a": 1}, {"b": 2}]


def test_a_run_publishes_and_a_blocked_run_leaves_the_old_document(spark):
    work = Workspace(spark, "t")
    stage_queries.raw_customers(spark, DATA, work.path)
    told = {(r.stage, r.metric): r.value for r in engine.run(spark, work.path, SETTINGS).collect()}
    assert told["run", "status"] == "PUBLISHED"
    path = f"{local(work.path)}/data/matches.json"
    with open(path, encoding="utf-8") as f:
        text = f.read()
    made = json.loads(text)
    assert text == json.dumps(made, ensure_ascii=False, indent=2) + "\n" and schema.document_faults(spark, made, schema.Schema(schema.PUBLISHED)) == []
    assert list(made) == schema.PUBLISHED["required"] and made["pipeline"] == {"stage": "BUILD_MATCHES", "validationStatus": "PASS", "publicationAllowed": True}
    assert str(made["matchCount"]) == told["build", "matchCount"] and made["datasetHash"] == told["build", "datasetHash"]
    # a report of another run is stale
    off = engine.Settings("2027-01-01T00:00:00+00:00", 2026, rules.Rules(enabled=False))
    again = {(r.stage, r.metric): r.value for r in engine.run(spark, work.path, off).collect()}
    assert again["run", "status"] == "BLOCKED" and "another run" in again["run", "error"]
    # a stricter rule blocks the next run
    strict = engine.Settings(SETTINGS.clock, 2026, rules.Rules(most=10))
    blocked = {(r.stage, r.metric): r.value for r in engine.run(spark, work.path, strict).collect()}
    assert blocked["run", "status"] == "BLOCKED"
    with open(path, encoding="utf-8") as f:
        assert f.read() == text
    with open(f"{local(work.path)}/deduplicated/matches.json", encoding="utf-8") as f:
        merged = json.load(f)
    assert list(merged) == ["schemaVersion", "deduplicatedAt", "statistics", "matches"] and merged["statistics"]["uniqueRecords"] == made["matchCount"]
    assert "score" not in merged["matches"][0] and set(merged["matches"][0]["provenance"]) == {"sourceId", "format", "sourceIds"}


def test_nothing_to_normalize_blocks(spark):
    work = Workspace(spark, "t")
    stage_queries.write(spark.createDataFrame([(f"{work.path}/raw/s/x.json.raw", b"[]")], "path string, content binary"))
    told = {r.metric: r.value for r in engine.run(spark, work.path, SETTINGS).collect()}
    assert told == {"status": "BLOCKED", "error": "Zero matches were normalized."}


def test_more_rows_than_a_document_may_hold(spark):
    rows = publish.canonical(spark.range(30).select(*[F.struct(F.lit("a").alias("id"), F.lit("b").alias("name")).alias(c) for c in ("awayTeam", "competition", "homeTeam")], F.col("id").cast("string").alias("id"), F.struct(F.array(F.lit("s")).alias("sourceIds")).alias("provenance"), F.lit("2026").alias("scheduledAt"), F.lit("LIVE").alias("status")), ("id",))
    rows = rows.toDF(*[c if i < 7 else "ord" for i, c in enumerate(rows.columns)])
    assert publish.dataset_hash(rows, ("ord",), 30).first().match_count == 30
    with pytest.raises(Exception, match="more than 29 matches"):
        publish.dataset_hash(rows, ("ord",), 29).collect()
    with pytest.raises(ValueError, match="more than 29 matches"):
        publish.payload(rows, ("ord",), "now", {}, 29)


def test_faulty_documents(spark, tmp_path):
    bad = {"none": None, "list": "[]", "nosources": "{}"}
    for name, text in bad.items():
        if text is not None:
            (tmp_path / name).write_text(text)
    with pytest.raises(FileNotFoundError, match="not found"):
        documents.registry(spark, f"file://{tmp_path}/none")
    with pytest.raises(ValueError, match="must contain a JSON object"):
        documents.registry(spark, f"file://{tmp_path}/list")
    with pytest.raises(ValueError, match="'sources' array"):
        documents.registry(spark, f"file://{tmp_path}/nosources")
    with pytest.raises(FileNotFoundError, match="dataset not found"):
        documents.dataset_rows(spark, f"file://{tmp_path}/none")
    with pytest.raises(RuntimeError, match="does not exist"):
        documents.dataset_rows(spark, f"file://{tmp_path}/none", strict=True)
    with pytest.raises(ValueError, match="must be a JSON object"):
        documents.dataset_rows(spark, f"file://{tmp_path}/list")
    with pytest.raises(ValueError, match="valid 'matches' array"):
        documents.dataset_rows(spark, f"file://{tmp_path}/nosources")
    with pytest.raises(ValueError, match="must contain a JSON object"):
        rules.Rules.of([])
    with pytest.raises(ValueError, match="missing the 'validation' object"):
        rules.Rules.of({})
    with pytest.raises(ValueError, match="disabled"):
        rules.findings(spark.range(1), rules.Rules(enabled=False))


def test_payload_schema(spark):
    told = lambda document: sorted({p for p, _ in schema.document_faults(spark, document, schema.Schema(schema.PUBLISHED))})
    good = {"schemaVersion": "1.0", "generatedAt": "t", "pipeline": {"stage": "BUILD_MATCHES", "validationStatus": "PASS", "publicationAllowed": True}, "sourceCount": 1, "sourceIds": ["a"], "matchCount": 0, "datasetHash": "a" * 64, "matches": []}
    assert told(good) == []
    for change, path in (({"schemaVersion": "2"}, "schemaVersion"), ({"sourceCount": 0}, "sourceIds"), ({"sourceIds": ["a", "a"]}, "sourceIds"), ({"matchCount": -1}, "matchCount"), ({"matches": [1], "matchCount": 1}, "matches[0]"), ({"matches": [1]}, "matches,matches[0]"), ({"datasetHash": "x"}, "datasetHash"), ({"more": 1}, "more"), ({"pipeline": {}}, "pipeline.publicationAllowed,pipeline.stage,pipeline.validationStatus")):
        assert told(good | change) == path.split(",")
    assert told(5) == [""] and told({}) == sorted(good)


def test_merge_takes_the_earlier_file_by_the_parts_of_its_path(spark):
    base = "id string, competition struct<id:string,name:string>, homeTeam struct<id:string,name:string>, awayTeam struct<id:string,name:string>, scheduledAt string, status string, provenance struct<sourceId:string,sourceIds:array<string>>, score struct<home:int,away:int>, path string, _rec_ord long"
    team = ("1", "n")
    rows = [("x", None, team, team, "d", "LIVE", (s, None), None, p, 0) for s, p in (("second", "a-b/x"), ("first", "a/x"))]
    df = spark.createDataFrame(rows, base).withColumn("_file", merge.file_key(F.col("path"))).drop("path")
    got = merge.merged(merge.with_source(df, F.col("provenance.sourceId"))).collect()
    assert [(r.provenance.sourceIds, r.records) for r in got] == [(["first"], 2)]
    both = merge.merged(merge.with_source(df, F.col("provenance.sourceId")), merge_provenance=True).first()
    assert both.provenance.sourceIds == ["first", "second"]


def test_written_files_are_whole(spark):
    work = Workspace(spark, "t")
    rows = [(f"{work.path}/deep/er/{i}.bin", bytes([i]) * i) for i in range(20)]
    told = sinks.write_files(spark.createDataFrame(rows, "path string, content binary")).collect()
    assert sorted((r.path, r.size) for r in told) == sorted((p, len(c)) for p, c in rows)
    for p, c in rows:
        with open(local(p), "rb") as f:
            assert f.read() == c
