"""Named queries of the stages: they write files to the shared folder, read them back and run the engine over them."""

from __future__ import annotations

import json
import urllib.parse
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import lines, merge, publish, records, rules, schema, sinks
from ..shared import Workspace, spread
from ..sources import documents, files, ledger, selection
from . import engine
from .queries import _HOLED, expected, holed, query, table

CLOCK = "2026-08-01T00:00:00+00:00"
SETTINGS = engine.Settings(CLOCK, 2026)


def write(rows: DataFrame) -> None:
    sinks.write_files(rows).write.format("noop").mode("overwrite").save()


def one_file(spark: SparkSession, path: str, text: str) -> None:
    write(spark.range(1).select(F.lit(path).alias("path"), F.encode(F.lit(text), "utf-8").alias("content")))


def nations(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"), F.trim("n_name").alias("name"), F.trim("r_name").alias("region"))


def raw_nations(spark: SparkSession, d: str, folder: str) -> str:
    """A raw file for each nation: JSON of three kinds, listings, broken JSON and bytes that are no text.  A folder below is called raw too."""
    n = nations(spark, d)
    k = F.col("k")
    said = lambda form, *c: F.format_string(form, *c)
    record = '{"id":%d,"home":"%s","away":"%s","date":"2026-01-02","status":"ft"}'
    two = said(f"[{record},{record}]", k + 1, "name", "region", k + 101, "name", "region")  # an id of zero does not count as given
    games = said('  {"page":{"games":[{"team1":"%s","team2":"%s","date":"2026-01-03"},5]}}', "name", "region")
    listing = said("= League\nSun Aug 23\n%s v %s\n", "name", "region")
    ending = F.when(k % 4 == 0, ".json.raw").when(k % 4 == 1, ".txt.raw").when(k % 8 == 7, ".json.raw").otherwise(".raw")
    content = F.when(k % 8 == 3, F.unhex(F.lit("FF7B"))).otherwise(F.encode(F.when(k % 4 == 0, two).when(k % 4 == 1, listing).when(k % 4 == 2, games).otherwise("{broken"), "utf-8"))
    write(n.select(F.concat(F.lit(f"{folder}/raw/src_"), "r", F.when(k % 2 == 0, "-x").otherwise("/raw"), F.lit("/n_"), "k", ending).alias("path"), content.alias("content")))
    return f"{folder}/raw"


_RAW = """n AS (SELECT n_nationkey AS k, n_regionkey AS r, trim(n_name) AS name, trim(r_name) AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
raw AS (SELECT *, 'src_' || r || CASE WHEN k % 2 = 0 THEN '-x' ELSE '/raw' END || '/n_' || k || CASE WHEN k % 4 = 0 THEN '.json.raw' WHEN k % 4 = 1 THEN '.txt.raw' WHEN k % 8 = 7 THEN '.json.raw' ELSE '.raw' END AS path,
 'src_' || r || CASE WHEN k % 2 = 0 THEN '-x' ELSE '' END AS source_id, CASE WHEN k % 8 = 3 THEN 'unknown' WHEN k % 4 = 1 THEN 'text' ELSE 'json' END AS format FROM n),
rows AS (SELECT path, source_id, 0 AS rec_ord, CAST(k + 1 AS VARCHAR) AS own, name, region, '2026-01-02' AS day, 'FINISHED' AS status FROM raw WHERE k % 4 = 0
 UNION ALL SELECT path, source_id, 1, CAST(k + 101 AS VARCHAR), name, region, '2026-01-02', 'FINISHED' FROM raw WHERE k % 4 = 0
 UNION ALL SELECT path, source_id, 3, NULL, name, region, '2026-08-23', 'SCHEDULED' FROM raw WHERE k % 4 = 1
 UNION ALL SELECT path, source_id, 0, '2026-01-03:' || name || ':' || region, name, region, '2026-01-03', 'UNKNOWN' FROM raw WHERE k % 4 = 2),
matches AS (SELECT *, CASE WHEN own IS NULL THEN 'n_' || regexp_extract(path, 'n_([0-9]+)', 1) || '.txt:3' ELSE source_id || ':' || own END AS id, day || 'T00:00:00+00:00' AS kickoff FROM rows)"""


@query("q45_raw_scan", f"WITH {_RAW} SELECT path, source_id, format, row_number() OVER (ORDER BY string_split(path, '/')) AS place FROM raw")
def q45(spark, d):
    work = Workspace(spark, "q45")
    found = files.raw_files(spark, raw_nations(spark, d, work.path)).withColumn("_file", merge.file_key(F.col("path")))
    return publish.places(found.drop("text"), [F.col("_file")], F.col("_file")[0], work).select("path", "source_id", "format", "place")


@query("q46_file_report", f"WITH {_RAW} SELECT path, source_id, format, coalesce(n, 0) AS matches, CASE WHEN n > 0 THEN 'successful' ELSE 'empty' END AS status, CASE WHEN format = 'unknown' THEN 'unknown format' WHEN k % 8 = 7 THEN 'no JSON' END AS error FROM raw LEFT JOIN (SELECT path, count(*) AS n FROM rows GROUP BY path) USING (path)")
def q46(spark, d):
    work = Workspace(spark, "q46")
    return engine.normalize(spark, raw_nations(spark, d, work.path), SETTINGS, work)[1]


@query("q47_file_counters", f"WITH {_RAW} SELECT (SELECT count(*) FROM raw) AS raw_files, (SELECT count(DISTINCT path) FROM rows) AS successful_files, (SELECT count(*) FROM raw) - (SELECT count(DISTINCT path) FROM rows) AS empty_files, 0 AS failed_files, (SELECT count(*) FROM rows) AS normalized_matches")
def q47(spark, d):
    return files.file_counters(q46(spark, d))


@query("q48_normalized_rows", f"WITH {_RAW} SELECT path AS file, CAST(rec_ord AS BIGINT) AS rec_ord, id, name AS home, region AS away, kickoff, status FROM matches")
def q48(spark, d):
    work = Workspace(spark, "q48")
    rows, _ = engine.normalize(spark, raw_nations(spark, d, work.path), SETTINGS, work)
    return rows.select(F.array_join("_file", "/").alias("file"), "_rec_ord", "id", F.col("homeTeam.name").alias("home"), F.col("awayTeam.name").alias("away"), F.col("scheduledAt").alias("kickoff"), "status").withColumnRenamed("_rec_ord", "rec_ord")


@query("q49_normalized_documents", f"""WITH {_RAW} SELECT source_id || '__n_' || regexp_extract(path, 'n_([0-9]+.*)[.]raw$', 1) || '.json' AS file, row_number() OVER (PARTITION BY path ORDER BY rec_ord) - 1 AS rec_ord, id, source_id AS sources,
 CASE WHEN own IS NULL THEN 'text' ELSE 'json' END AS format, CASE WHEN own IS NULL THEN path END AS source_file, CASE WHEN own IS NULL THEN 3 END AS source_line FROM matches""")
def q49(spark, d):
    """What the sink of normalised documents wrote, scanned again, with its provenance."""
    work = Workspace(spark, "q49")
    engine.normalize(spark, raw_nations(spark, d, work.path), SETTINGS, work, f"{work.path}/normalized-documents")
    rows = documents.normalized_rows(spark, f"{work.path}/normalized-documents")
    return rows.select(F.col("_file")[0].alias("file"), F.col("_rec_ord").alias("rec_ord"), "id", F.array_join("provenance.sourceIds", ",").alias("sources"), "provenance.format", F.col("provenance.sourceFile").alias("source_file"), F.col("provenance.sourceLine").alias("source_line"))


# ------------------------------------------------------------------ fetch


def remote(spark: SparkSession, d: str) -> dict[str, tuple[int, bytes]]:
    """Answers of an invented host: a repository for each region, a file for each nation.  Region 2 is truncated, 3 has a file that fails, 4 none."""
    answers: dict[str, tuple[int, bytes]] = {}
    said = lambda x: (200, json.dumps(x).encode())
    listed: dict[int, list] = {}
    for n in sorted(nations(spark, d).collect(), key=lambda n: n["k"]):  # the host's answers are a small literal of 25 files
        listed.setdefault(n["r"], []).append(n)
    for r, mine in listed.items():
        base = f"{files.API}/repos/o/r{r}"
        tree = [{"type": "blob", "path": f"2026/league {n['name']}.{'md' if r == 4 else 'json'}", "size": None} for n in mine] + [{"type": "tree", "path": "2026"}]
        answers |= {base: said({"default_branch": "main"}), f"{base}/git/ref/heads/main": said({"object": {"sha": f"s{r}"}}), f"{base}/git/trees/s{r}?recursive=1": said({"tree": tree, "truncated": r == 2})}
        for n, item in zip(mine, tree):
            body = json.dumps([{"id": n["k"], "home": n["name"], "away": n["region"], "date": "2026-01-02"}]).encode()
            bad = r == 3 and n is mine[-1]
            answers[f"https://raw.githubusercontent.com/o/r{r}/main/{urllib.parse.quote(item['path'])}"] = (404, b"") if bad else (200, body)
    return answers


def registry(spark: SparkSession, d: str, folder: str) -> str:
    sources = [{"id": f"src_{r['r_regionkey']}", "name": "n", "provider": "p", "type": "t", "priority": 5 - r["r_regionkey"], "url": "https://example.org/x" if r["r_regionkey"] == 1 else f"https://github.com/o/r{r['r_regionkey']}"} for r in table(spark, d, "region").collect()]
    one_file(spark, f"{folder}/source.json", json.dumps({"schemaVersion": "1.0", "sources": [*sources, {"id": "odd", "url": "u"}]}))
    return f"{folder}/source.json"


def fetched(spark: SparkSession, d: str, work: Workspace) -> DataFrame:
    answers = remote(spark, d)
    return engine.fetch(spark, registry(spark, d, work.path), f"{work.path}/raw", SETTINGS, lambda url, accept: answers.get(url, (404, b"")))


_BODY = """len('[{"id": , "home": "", "away": "", "date": "2026-01-02"}]') + len(CAST(n_nationkey AS VARCHAR)) + len(trim(n_name)) + len(trim(r_name))"""


@query("q50_fetch", f"""WITH n AS (SELECT n_regionkey AS r, count(*) AS files, sum({_BODY}) AS bytes, max(trim(n_name)) FILTER (n_nationkey = last) AS failing FROM (SELECT *, max(n_nationkey) OVER (PARTITION BY n_regionkey) AS last FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY n_regionkey)
SELECT 'src_' || r AS source_id, CASE WHEN r = 0 THEN 'FETCHED' ELSE 'FETCH_FAILED' END AS status, CASE WHEN r = 0 THEN files ELSE 0 END AS discovered, CASE WHEN r = 0 THEN files ELSE 0 END AS downloaded, CAST(CASE WHEN r = 0 THEN bytes ELSE 0 END AS BIGINT) AS bytes,
 CASE r WHEN 1 THEN 'Configured source URL is not a supported repository URL.' WHEN 2 THEN 'The listing of o/r2 is truncated; an incomplete one is refused.' WHEN 3 THEN 'HTTP 404 while downloading 2026/league ' || failing || '.json' WHEN 4 THEN 'No relevant JSON or text files were discovered.' END AS error FROM n
UNION ALL SELECT 'odd', 'CONFIG_FAILED', 0, 0, 0, 'Source definition missing ''name''.'""")
def q50(spark, d):
    """Registry, listings, selection and downloads of five sources, four of which fail in ways of their own."""
    found = fetched(spark, d, Workspace(spark, "q50"))
    return found.select("source_id", "status", F.col("files_discovered").alias("discovered"), F.col("files_downloaded").alias("downloaded"), F.col("bytes_received").alias("bytes"), "error")


@query("q51_fetched_files", """SELECT 'src_' || r_regionkey || '/src_' || r_regionkey || '__' || lpad(CAST(place AS VARCHAR), 4, '0') || '__' || regexp_replace('league ' || name, '[^A-Za-z0-9_.-]', '_', 'g') || '.json.raw' AS path, 'src_' || r_regionkey AS source_id, 'json' AS format
FROM (SELECT *, trim(n_name) AS name, row_number() OVER (PARTITION BY r_regionkey ORDER BY len(trim(n_name)), n_nationkey) AS place, max(n_nationkey) OVER (PARTITION BY r_regionkey) AS last FROM nation JOIN region ON n_regionkey = r_regionkey)
WHERE r_regionkey = 0 OR r_regionkey = 3 AND place < (SELECT p FROM (SELECT n_nationkey, row_number() OVER (ORDER BY len(trim(n_name)), n_nationkey) AS p FROM nation WHERE n_regionkey = 3) ORDER BY n_nationkey DESC LIMIT 1)""")
def q51(spark, d):
    """The raw files that a fetch leaves: of the source that fails those before the failure."""
    work = Workspace(spark, "q51")
    fetched(spark, d, work).count()
    return files.raw_files(spark, f"{work.path}/raw").select("path", "source_id", "format")


@query("q76_resume", """WITH n AS (SELECT r_regionkey AS r, count(*) AS files, count(*) FILTER (n_nationkey % 4 = 1) AS bad FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 0 GROUP BY ALL)
SELECT run, CASE WHEN run = 0 AND bad > 0 THEN 'FETCH_FAILED' ELSE 'FETCHED' END AS status, CASE WHEN run = 0 THEN files WHEN run = 1 THEN bad ELSE 0 END AS tried, CASE WHEN run = 0 THEN files - bad WHEN run = 1 THEN bad ELSE 0 END AS came, CASE WHEN run = 0 THEN files - bad ELSE files END AS raw_files FROM n CROSS JOIN (VALUES (0), (1), (2)) t(run)""")
def q76(spark, d):
    """Three fetches of one source with a ledger: some files fail, then only these are asked for, then nothing is missing."""
    work = Workspace(spark, "q76")
    answers = remote(spark, d)
    broken = {f"{n['name']}.json" for n in nations(spark, d).collect() if n["k"] % 4 == 1}
    failing = {u: (503, b"") if urllib.parse.unquote(u).rsplit("league ", 1)[-1] in broken else a for u, a in answers.items()}
    out = []
    for run, told in enumerate((failing, answers, answers)):
        settings = engine.Settings(f"2026-08-0{run + 1}T00:00:00+00:00", 2026, resume=True, retries=1)
        w = Workspace(spark, f"q76-{run}")
        w.made = []
        got = engine.fetch_source(spark, "s", "https://github.com/o/r0", f"{work.path}/raw", settings, lambda url, accept, t=told: t.get(url, (404, b"")), w)
        book = ledger.Ledger(spark, f"{work.path}/raw-ledger").rows().filter(F.col("at") == settings.clock).agg(F.count("*").alias("tried"), F.count_if(F.col("error").isNull()).alias("came")).first()
        out.append((run, got["status"], book["tried"], book["came"], files.raw_files(spark, f"{work.path}/raw").count()))
    return spark.createDataFrame(out, "run int, status string, tried long, came long, raw_files long")


@query("q52_contents_url", "SELECT url, 'https://api.github.com/repos/o/r/contents/' || replace(url_encode(regexp_replace(url, '^/+|/+$', '', 'g')), '%2F', '/') AS address FROM pages")
def q52(spark, d):
    return table(spark, d, "pages").select("url", files.contents_url(F.lit("o"), F.lit("r"), F.col("url")).alias("address"))


# ------------------------------------------------------------------ the whole run


def raw_customers(spark: SparkSession, d: str, folder: str, some: Column | None = None) -> None:
    """customers as raw JSON, a file for each nation; each tenth customer stands twice, the second time without a status.  some: which nations."""
    c = table(spark, d, "customer").filter(F.lit(True) if some is None else some)
    k = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), (k % 365).cast("int")), "yyyy-MM-dd")
    once = F.to_json(F.struct(
        (k + 1).alias("id"), F.struct((k + 1).alias("id"), F.col("c_name").alias("name")).alias("homeTeam"), F.struct(F.concat(F.lit("a"), "c_nationkey").alias("id"), F.concat(F.lit("Away "), "c_nationkey").alias("name")).alias("awayTeam"),
        day.alias("date"), F.struct(F.col("c_mktsegment").alias("name")).alias("competition"), F.col("status"),
    ))
    both = c.withColumn("status", F.explode(F.when(k % 10 == 0, F.array(F.lit("ft"), F.lit(None).cast("string"))).otherwise(F.array(F.lit("ft")))))
    path = F.concat(F.lit(f"{folder}/raw/src_"), F.col("c_nationkey") % 3, F.lit("/n_"), "c_nationkey", F.lit(".json.raw")).alias("path")
    piece = lambda part, again, key, item, text: F.struct(F.struct(F.lit(part).alias("part"), again.alias("again"), key.cast("long").alias("key")).alias("order"), F.lit(item).alias("item"), F.encode(text, "utf-8").alias("content"))
    each = both.select(path, F.inline(F.array(piece(1, F.col("status").isNull(), k, True, once))))
    ends = c.select("c_nationkey").distinct().select(path, F.inline(F.array(*(piece(p, F.lit(False), F.lit(0), False, F.lit(t)) for p, t in ((0, '{"matches":['), (2, "]}"))))))
    sinks.write_pieces(each.unionByName(ends), b",").write.format("noop").mode("overwrite").save()


_PUBLISHED = """p AS (SELECT *, 'src_' || (c_nationkey % 3) AS source, 'src_' || (c_nationkey % 3) || ':' || (c_custkey + 1) AS id, strftime(DATE '2026-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') || 'T00:00:00+00:00' AS kickoff FROM customer WHERE (SELECT count(*) FROM customer) <= 10000),
h AS (SELECT sha256(to_json(list({'awayTeam': {'id': 'a' || c_nationkey, 'name': 'Away ' || c_nationkey}, 'competition': {'id': NULL::VARCHAR, 'name': c_mktsegment}, 'homeTeam': {'id': CAST(c_custkey + 1 AS VARCHAR), 'name': c_name}, 'id': id, 'provenance': {'sourceIds': [source]}, 'scheduledAt': kickoff, 'status': 'FINISHED'} ORDER BY kickoff, lower(c_mktsegment), lower(id)))) AS hash FROM p)"""


@query("q53_published", f"WITH {_PUBLISHED} SELECT row_number() OVER (ORDER BY kickoff, lower(c_mktsegment), lower(id)) AS place, id, c_name AS home, 'Away ' || c_nationkey AS away, c_mktsegment AS competition, kickoff, 'FINISHED' AS status, source AS sources FROM p")
def q53(spark, d):
    """From raw files to the published document, read back; more customers than a document may hold leave it unpublished."""
    work = Workspace(spark, "q53")
    raw_customers(spark, d, work.path)
    engine.run(spark, work.path, SETTINGS)
    try:
        text = spark.read.text(f"{work.path}/data/matches.json", wholetext=True)
    except documents.AnalysisException:
        text = spark.range(0).select(F.lit("").alias("value"))
    each = text.select(F.posexplode(F.from_json(F.from_json("value", "map<string,string>")["matches"], f"array<struct<{sinks.NESTED}>>")).alias("at", "m"))
    return each.select((F.col("at") + 1).cast("long").alias("place"), "m.id", F.col("m.homeTeam.name").alias("home"), F.col("m.awayTeam.name").alias("away"), F.col("m.competition.name").alias("competition"), F.col("m.scheduledAt").alias("kickoff"), "m.status", F.array_join("m.provenance.sourceIds", ",").alias("sources"))


# stage, metric, value and whether only a published (true) or a blocked run (false) tells it
_METRICS = [
    ("normalize", "raw_files", "files", None), ("normalize", "successful_files", "files", None), ("normalize", "empty_files", "0", None), ("normalize", "failed_files", "0", None), ("normalize", "normalized_matches", "n + twice", None),
    ("deduplicate", "input", "n + twice", None), ("deduplicate", "identified", "n + twice", None), ("deduplicate", "without_identity", "0", None), ("deduplicate", "duplicates", "twice", None), ("deduplicate", "unique_rows", "n", None), ("deduplicate", "collisions", "0", None),
    ("validate", "status", "CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END", None), ("validate", "recordCount", "n", None), ("validate", "errors", "CASE WHEN ok THEN 0 ELSE 1 END", None), ("validate", "warnings", "0", None),
    ("build", "sourceCount", "sources", True), ("build", "matchCount", "n", True), ("build", "datasetHash", "hash", True), ("run", "status", "'PUBLISHED'", True), ("run", "error", "''", True),
    ("run", "status", "'BLOCKED'", False), ("run", "error", "'Validation status is not PASS. Actual status: ''FAIL''. Publication is blocked.'", False),
]


@query("q54_run_metrics", f"WITH {_PUBLISHED}, c AS (SELECT count(*) AS n, count(*) FILTER (c_custkey % 10 = 0) AS twice, count(DISTINCT c_nationkey) AS files, count(DISTINCT c_nationkey % 3) AS sources FROM customer), m AS (SELECT *, n <= 10000 AS ok FROM c, h) " + " UNION ALL ".join(f"SELECT '{stage}' AS stage, '{metric}' AS metric, CAST({value} AS VARCHAR) AS value FROM m" + ("" if when is None else f" WHERE ok = {when}") for stage, metric, value, when in _METRICS))
def q54(spark, d):
    work = Workspace(spark, "q54")
    raw_customers(spark, d, work.path)
    return engine.run(spark, work.path, SETTINGS)


# ------------------------------------------------------------------ scans of merged rows, rules, gates


def odd_dataset(spark: SparkSession, d: str, path: str) -> None:
    """customers as the merged document: each seventh is a number, others lack members or have them of other kinds."""
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    piece = lambda n, bad, good: F.when(k % n == 0, bad).otherwise(good)
    text = F.concat(
        F.lit("{"), piece(5, F.lit('"id":null,'), piece(8, F.lit(""), F.concat(F.lit('"id":"c'), k, F.lit('",')))), piece(3, F.lit(""), F.lit('"homeTeam":{"id":1,"name":"H"},')),
        piece(11, F.lit('"awayTeam":" ",'), piece(4, F.lit('"awayTeam":"X",'), F.lit('"awayTeam":{"id":"2","name":"A"},'))), F.lit('"scheduledAt":"2026-01-02",'), piece(13, F.lit('"status":""'), F.lit('"status":"LIVE"')), F.lit("}"),
    )
    whole = c.select(F.struct(k, F.when(k % 7 == 0, "5").otherwise(text).alias("t")).alias("x")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x.t), ",").alias("t"))
    write(whole.select(F.lit(path).alias("path"), F.encode(F.concat(F.lit('{"matches":['), "t", F.lit("]}")), "utf-8").alias("content")))


_ODD = """c AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) - 1 AS pos FROM customer), o AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM c WHERE k % 7 != 0)"""


@query("q55_merged_scan", f"WITH {_ODD} SELECT i AS record_index, CASE WHEN k % 5 != 0 AND k % 8 != 0 THEN 'c' || k END AS id, NULL AS error FROM o UNION ALL SELECT NULL, NULL, 'Invalid match record at index ' || min(pos) || '.' FROM c WHERE k % 7 = 0")
def q55(spark, d):
    """The two readings of the merged document: one leaves out what is no object, one makes it an error."""
    path = f"{Workspace(spark, 'q55').path}/matches.json"
    odd_dataset(spark, d, path)
    try:
        documents.dataset_rows(spark, path, strict=True)
        error = None
    except RuntimeError as e:
        error = str(e)
    none = F.lit(None).cast("string")
    return documents.dataset_rows(spark, path).select("record_index", "id", none.alias("error")).unionAll(spark.range(1).select(F.lit(None).cast("long"), none, F.lit(error).cast("string")))


@query("q56_missing_members", f"""WITH {_ODD} SELECT i, message FROM (SELECT i, 'Required field is null: id' AS message FROM o WHERE k % 5 = 0 UNION ALL SELECT i, 'Missing required field: id' FROM o WHERE k % 8 = 0 AND k % 5 != 0 UNION ALL SELECT i, 'Missing required field: homeTeam' FROM o WHERE k % 3 = 0
 UNION ALL SELECT i, 'Required field is empty: awayTeam' FROM o WHERE k % 11 = 0 UNION ALL SELECT i, 'Required field is empty: status' FROM o WHERE k % 13 = 0 UNION ALL SELECT i, 'homeTeam must be an object.' FROM o WHERE k % 3 = 0 UNION ALL SELECT i, 'awayTeam must be an object.' FROM o WHERE k % 11 = 0 OR k % 4 = 0)""")
def q56(spark, d):
    """Rules over rows of a document, where a member that is missing, null, blank or no object is told apart."""
    work = Workspace(spark, "q56")
    odd_dataset(spark, d, f"{work.path}/matches.json")
    rows = documents.dataset_rows(spark, f"{work.path}/matches.json")
    found = rules.findings(rows, rules.Rules(), F.col("raw"), work)
    return found.filter(F.col("check").isin("requiredFields", "teamValidation")).select(F.col("record_index").alias("i"), "message")


_CONFIG = {
    "validation": {
        "recordValidation": {"requiredFields": ["id"], "teamValidation": {"requireAwayTeam": False, "requireHomeTeamId": False}, "statusValidation": {"allowedValues": ["ODD"]}},
        "duplicateValidation": {"enabled": False}, "schemaValidation": {"enabled": False}, "datasetValidation": {"maximumMatches": 5, "minimumMatches": 2_000_000_000}, "publicationGate": {"requiredChecks": ["matchIdentity"]},
    }
}


@query("q57_configuration", f"""WITH {_HOLED} SELECT i, severity, "check", message FROM f WHERE "check" IN ('matchIdentity', 'dateTimeValidation', 'dataQuality') OR message IN ('Required field is empty: id', 'Required field is null: id', 'homeTeam must be an object.', 'Home team name is missing.', 'Match status is missing.')
UNION ALL SELECT i, 'error', 'statusValidation', 'Invalid match status: FINISHED' FROM h WHERE st = 'FINISHED' UNION ALL SELECT NULL, 'error', 'datasetValidation', 'Dataset contains ' || count(*) || ' matches; minimum required is 2000000000.' FROM h UNION ALL SELECT NULL, 'error', 'datasetValidation', 'Dataset contains ' || count(*) || ' matches; maximum allowed is 5.' FROM h""")
def q57(spark, d):
    """Findings under a configuration that is read from a document."""
    work = Workspace(spark, "q57")
    one_file(spark, f"{work.path}/validation.json", json.dumps(_CONFIG))
    told = rules.Rules.of(documents.document(spark, f"{work.path}/validation.json", "no configuration"))
    return rules.findings(holed(spark, d), told, work=work).select(F.col("record_index").alias("i"), "severity", "check", "message")


def customer_rows(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    pair = lambda i, n: F.struct(i.cast("string").alias("id"), n.alias("name"))
    return c.select(
        k.alias("record_index"), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("c"), k)).alias("id"), pair(F.lit(None), F.col("c_mktsegment")).alias("competition"), pair(k, F.col("c_name")).alias("homeTeam"), pair(F.lit("a"), F.lit("Away")).alias("awayTeam"),
        F.when(k % 14 != 0, F.lit("2026-01-02")).alias("scheduledAt"), F.lit("LIVE").alias("status"), F.struct(F.when(k % 8 == 0, F.array(F.lit("s"), F.lit("s"))).otherwise(F.array(F.lit("s"))).alias("sourceIds")).alias("provenance"),
    )


@query("q58_schema_finding", "SELECT 'error' AS severity, 'Dataset failed JSON Schema validation: matches[' || c_custkey || '].' || CASE WHEN c_custkey % 9 = 0 THEN 'id' WHEN c_custkey % 14 = 0 THEN 'scheduledAt' ELSE 'provenance.sourceIds' END AS message FROM customer WHERE c_custkey % 9 = 0 OR c_custkey % 14 = 0 OR c_custkey % 8 = 0 ORDER BY c_custkey LIMIT 1")
def q58(spark, d):
    work = Workspace(spark, "q58")
    found = engine.validate(customer_rows(spark, d), engine.Settings(CLOCK, 2026, rules.Rules(schema=True)), work)
    return found.filter("check = 'schemaValidation'").select("severity", "message")


_SHAPE = {
    "type": "object", "additionalProperties": False, "required": ["id", "team", "status"],
    "properties": {
        "id": {"$ref": "#/$defs/text"}, "team": {"$ref": "#/$defs/team"}, "status": {"enum": ["LIVE", 7, None]}, "when": {"type": ["string", "null"]}, "n": {"type": "integer", "minimum": 0},
        "ids": {"type": "array", "uniqueItems": True, "maxItems": 3, "items": {"$ref": "#/$defs/text"}}, "code": {"pattern": "^[A-Z]{2}[0-9]+$", "maxLength": 8}, "odd name": {"const": {"a": [1, True]}},
        "side": {"anyOf": [{"const": "home"}, {"type": "object", "required": ["id"]}]}, "free": {"type": "object", "additionalProperties": {"type": "boolean"}},
    },
    "allOf": [{"if": {"properties": {"n": {"const": 0}}, "required": ["n"]}, "then": {"properties": {"ids": {"maxItems": 0}}}}],
    "$defs": {"text": {"type": "string", "minLength": 1}, "team": {"type": "object", "required": ["name"], "properties": {"name": {"type": ["string", "null"]}}, "additionalProperties": False}},
}
# k % n == r breaks keyword at path; each member of the record reads one remainder.
_BROKEN = [
    ("id", "minLength", 9, 0), ("id", "type", 9, 1), ("id", "required", 9, 2), ("team", "required", 7, 0), ("team.more", "additionalProperties", 7, 1), ("team.name", "type", 7, 2), ("team", "type", 7, 3), ("team.name", "required", 7, 4),
    ("status", "enum", 5, 0), ("when", "type", 8, 0), ("n", "type", 6, 0), ("n", "minimum", 6, 1), ("ids", "uniqueItems", 11, 0), ("ids[1]", "minLength", 11, 1), ("ids", "maxItems", 11, 2), ("code", "pattern", 10, 0), ("code", "maxLength", 10, 1),
    ("odd name", "const", 12, 0), ("side", "anyOf", 13, 0), ("free.x", "type", 14, 0), ("extra", "additionalProperties", 15, 0), ("", "json", 101, 0),
]


def shaped(k: Column) -> Column:
    """A JSON record for each k, with faults by its remainders; numbers of other spellings, nulls and absent members are none."""
    pick = lambda n, other, **odd: reduce(lambda c, r: c.when(k % n == int(r[1:]), odd[r]), odd, F.when(F.lit(False), "")).otherwise(other)
    members = [
        pick(9, '"id":"c",', r0='"id":"",', r1='"id":5,', r2=""),
        pick(7, '"team":{"name":null},', r0="", r1='"team":{"name":"x","more":1},', r2='"team":{"name":[]},', r3='"team":"x",', r4='"team":{},'),
        pick(5, '"status":7.0,', r0='"status":"live",', r1='"status":null,', r2='"status":"LIVE",'), pick(8, '"when":"2026",', r0='"when":1,', r1='"when":null,'),
        pick(6, '"n":3,', r0='"n":2.5,', r1='"n":-1,', r2='"n":0,', r3='"n":4.0,', r4=""), pick(11, '"ids":["a","b"],', r0='"ids":["a","a"],', r1='"ids":["a",""],', r2='"ids":["a","b","c","d"],', r3='"ids":[],'),
        pick(10, '"code":"AB1",', r0='"code":"ab",', r1='"code":"AB1234567",', r2='"code":9,'), pick(12, '"odd name":{"a":[1.0,true]},', r0='"odd name":{"a":[1,1]},', r1=""), pick(13, '"side":{"id":1},', r0='"side":"away",', r1='"side":"home",'),
        pick(15, "", r0='"extra":null,'), pick(14, '"free":{"x":true}', r0='"free":{"x":1}', r1='"free":{}'),
    ]
    return F.when(k % 101 == 0, "{no json").otherwise(F.concat(F.lit("{"), *members, F.lit("}")))


_IDS_AT_ZERO = "SELECT c_custkey AS i, 'ids' AS path, 'maxItems' AS keyword FROM customer WHERE c_custkey % 101 != 0 AND c_custkey % 6 = 2 AND c_custkey % 11 != 3"


@query("q39_schema_rules", " UNION ALL ".join([*(f"SELECT c_custkey AS i, '{path}' AS path, '{keyword}' AS keyword FROM customer WHERE c_custkey % {n} = {r}" + (" AND c_custkey % 101 != 0" if n != 101 else "") for path, keyword, n, r in _BROKEN), _IDS_AT_ZERO]))
def q39(spark, d):
    """Faults of records of all customers under a schema with a fault for each kind of keyword."""
    told = spread(table(spark, d, "customer")).select(F.col("c_custkey").alias("i"), shaped(F.col("c_custkey")).alias("text"))
    return schema.each_fault(schema.check(told, "text", schema.Schema(_SHAPE)), "i")


@query("q59_report", """WITH c AS (SELECT count(*) AS n, count(*) FILTER (c_custkey % 9 = 0) AS noid, count(*) FILTER (c_custkey % 14 = 0) AS noday, count(*) FILTER (c_custkey % 9 = 0 AND c_custkey % 14 = 0) AS nokey FROM customer), e AS (SELECT *, 2 * noid + 2 * noday + CAST(n > 10000 AS BIGINT) AS errors FROM c)
SELECT 'FAIL' AS status, n AS records, errors, nokey + 1 AS warnings, '' AS passed, 'schemaValidation' AS skipped, 'requiredFields,matchIdentity,dateTimeValidation' || CASE WHEN n > 10000 THEN ',datasetValidation' ELSE '' END AS failed, false AS allowed, errors AS listed_errors, nokey + 1 AS listed_warnings FROM e""")
def q59(spark, d):
    """The report, written and read back: a check without its schema is skipped with a warning."""
    work = Workspace(spark, "q59")
    rows = customer_rows(spark, d)
    settings = engine.Settings(CLOCK, 2026, rules.Rules(schema=True))
    found = engine.validate(rows, settings, work, has_schema=False)
    engine.write_report(found, rows.count(), settings, "deduplicated/matches.json", f"{work.path}/validation-report.json", has_schema=False)
    part = "status:string,recordCount:bigint,errors:bigint,warnings:bigint,passedChecks:array<string>,skippedChecks:array<string>,requiredCheckFailures:array<string>,publicationAllowed:boolean"
    told = spark.read.text(f"{work.path}/validation-report.json", wholetext=True).select(F.from_json("value", f"struct<validation:struct<{part}>,errors:array<string>,warnings:array<string>>").alias("r"))
    joined = lambda c: F.array_join(f"r.validation.{c}", ",")
    v = F.col("r.validation")
    return told.select(v["status"].alias("status"), v["recordCount"].alias("records"), v["errors"].alias("errors"), v["warnings"].alias("warnings"), joined("passedChecks").alias("passed"), joined("skippedChecks").alias("skipped"), joined("requiredCheckFailures").alias("failed"), v["publicationAllowed"].alias("allowed"), F.size("r.errors").cast("long").alias("listed_errors"), F.size("r.warnings").cast("long").alias("listed_warnings"))


_STOP = " Publication is blocked."
_REPORTS = [
    (None, "Validation report does not exist." + _STOP), ("5", "Validation report is not a JSON object." + _STOP), ("{}", "Validation report does not contain a valid 'validation' object." + _STOP),
    ('{"validation":{"status":"FAIL"}}', "Validation status is not PASS. Actual status: 'FAIL'." + _STOP), ('{"validation":{"publicationAllowed":true}}', "Validation status is not PASS. Actual status: None." + _STOP),
    ('{"validation":{"status":"PASS","publicationAllowed":1}}', "Validation did not explicitly authorize publication. publicationAllowed=1." + _STOP),
    ('{"validation":{"status":"PASS","publicationAllowed":true,"validatedAt":"before"}}', "Validation report belongs to another run." + _STOP), (f'{{"validation":{{"status":"PASS","publicationAllowed":true,"validatedAt":"{CLOCK}"}}}}', None),
]


@query("q60_report_gate", f"SELECT CAST(n_nationkey AS INTEGER) AS ord, message FROM nation JOIN ({expected('case_no message', list(enumerate(m for _, m in _REPORTS)), {'case_no': 'BIGINT'})}) ON n_nationkey % {len(_REPORTS)} = case_no")
def q60(spark, d):
    """What the gate says of a report for each nation, written and read back."""
    work = Workspace(spark, "q60")
    keys = nations(spark, d).select("k")
    case = F.get(F.array(*(F.lit(t) for t, _ in _REPORTS)), (F.col("k") % len(_REPORTS)).cast("int"))
    write(keys.select(F.concat(F.lit(f"{work.path}/report-"), "k", F.lit(".json")).alias("path"), F.encode(case, "utf-8").alias("content")).filter("content is not null"))
    out = []
    for k in sorted(r["k"] for r in keys.collect()):
        try:
            told = documents.document(spark, f"{work.path}/report-{k}.json", "")
        except FileNotFoundError:
            told = None
        try:
            engine.permission(told, CLOCK)
            out.append((k, None))
        except engine.Blocked as e:
            out.append((k, str(e)))
    return spark.createDataFrame(out, "ord int, message string")


@query("q61_record_dates", """SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 9 = 5 THEN 'T15:30:00+02:00' WHEN o_orderkey % 9 = 6 THEN 'T09:05:00+00:00' WHEN o_orderkey % 9 = 7 THEN 'T23:59:58.250000+00:00' ELSE 'T00:00:00+00:00' END AS kickoff, 'o:' || (o_orderkey + 1) AS id, 'H' || o_custkey AS home, o_orderpriority AS away FROM orders WHERE o_orderkey % 9 != 8""")
def q61(spark, d):
    """All orders as JSON records whose dates are written in nine ways, one of which is no date."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    form = lambda f: F.date_format("o_orderdate", f)
    ways = [form("yyyy-MM-dd"), form("yyyyMMdd"), form("yyyy/M/d"), form("d.M.yyyy"), form("dd/MM/yyyy"), F.concat(form("yyyy-MM-dd"), F.lit("T15:30+02:00")), F.concat(form("yyyy-M-d"), F.lit(" 9:05")), F.concat(form("yyyy-MM-dd"), F.lit(" 23:59:58.25 UTC")), F.concat(F.lit("on "), form("yyyy-MM-dd"))]
    date = ways[8]
    for i, w in enumerate(ways[:8]):
        date = F.when(k % 9 == i, w).otherwise(date)
    text = F.to_json(F.struct((k + 1).alias("match_id"), F.concat(F.lit(" H"), "o_custkey").alias("home"), F.struct(F.col("o_orderpriority").alias("club")).alias("away_team"), date.alias("datetime")))
    rows = o.select(F.lit("o").alias("source_id"), text.alias("json"), F.array(F.lit("f")).alias("_file"), k.alias("_rec_ord"))
    return records.normalized(rows).select(F.col("_rec_ord").alias("k"), F.col("scheduledAt").alias("kickoff"), "id", F.col("homeTeam.name").alias("home"), F.col("awayTeam.name").alias("away"))



@query("q62_listings", """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey % 3 AS f, o_orderkey % 4 AS m FROM orders),
n AS (SELECT *, 1 + sum(CASE WHEN f != 2 THEN 2 ELSE 1 END) OVER w AS line, last_value(CASE WHEN f != 2 THEN d END IGNORE NULLS) OVER w AS day FROM o WINDOW w AS (PARTITION BY c ORDER BY k))
SELECT 'c_' || c || '.txt:' || CAST(line AS BIGINT) AS id, 'Customer ' || c AS competition, 'H' || k AS home, 'A' || k AS away, day || CASE WHEN m = 0 THEN 'T15:30:00+00:00' ELSE 'T00:00:00+00:00' END AS kickoff,
 CASE WHEN m = 1 THEN 'FINISHED' ELSE 'SCHEDULED' END AS status, CASE WHEN m = 1 THEN CAST(k % 7 AS INTEGER) END AS home_score, CASE WHEN m = 1 THEN CAST(k % 5 AS INTEGER) END AS away_score FROM n WHERE m != 3 AND day IS NOT NULL""")
def q62(spark, d):
    """All orders as lines of listings, a file for each customer: dates in two forms or carried from above, matches in three, and lines that are none."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    dated = F.when(k % 3 == 0, F.date_format("o_orderdate", "EEE MMM d yyyy")).when(k % 3 == 1, F.date_format("o_orderdate", "MMMM d yyyy"))
    line = (
        F.when(k % 4 == 0, F.format_string("  15:30 H%d v A%d @ Main Ground", k, k)).when(k % 4 == 1, F.format_string("H%d %d-%d A%d [note]", k, k % 7, k % 5, k))
        .when(k % 4 == 2, F.format_string("• H%d vs. A%d 3-0", k, k)).otherwise("no match here")
    )
    lines_of = F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), F.concat_ws("\n", dated, line).alias("text")))), lambda x: x.text)
    listed = o.groupBy("o_custkey").agg(F.array_join(lines_of, "\n").alias("text"))
    raw = listed.select(F.concat(F.lit("src/c_"), "o_custkey", F.lit(".txt.raw")).alias("path"), F.lit("src").alias("source_id"), F.concat(F.lit("= Customer "), "o_custkey", F.lit(" # note\n"), "text").alias("text"))
    made = lines.text_matches(raw, 2026)
    return made.select("id", F.col("competition.name").alias("competition"), F.col("homeTeam.name").alias("home"), F.col("awayTeam.name").alias("away"), F.col("scheduledAt").alias("kickoff"), "status", F.col("score.home").alias("home_score"), F.col("score.away").alias("away_score"))


@query("q63_season_scores", """SELECT o_orderkey AS k, CAST(CASE o_orderkey % 4 WHEN 0 THEN 1000 - 10 * abs(y - 26) WHEN 1 THEN 1100 - 10 * least(abs(y - 26), abs(y + 1 - 26)) ELSE 0 END AS INTEGER) AS score, o_orderkey % 4 != 3 AS data FROM (SELECT *, o_orderkey % 60 AS y FROM orders)""")
def q63(spark, d):
    """A path for each order: with a season of one year or of two, with a year inside a number, about the data."""
    k = F.col("o_orderkey")
    y = k % 60
    path = F.when(k % 4 == 0, F.format_string("20%02d/league/%d.json", y, k % 9)).when(k % 4 == 1, F.format_string("a/20%02d-20%02d/cup.txt", y, y + 1)).when(k % 4 == 2, F.format_string("qual/id20%02d7.json", y)).otherwise("league/README.txt")
    rows = table(spark, d, "orders").select(k.alias("k"), path.alias("path"))
    return rows.select("k", selection.season_score(F.col("path"), 2026).alias("score"), selection.is_match_data(F.col("path")).alias("data"))


@query("q64_statuses", """SELECT o_orderkey AS k, ['SCHEDULED', 'SCHEDULED', 'SCHEDULED', 'LIVE', 'LIVE', 'LIVE', 'FINISHED', 'FINISHED', 'FINISHED', 'FINISHED', 'POSTPONED', 'CANCELLED', 'CANCELLED', 'SUSPENDED', 'UNKNOWN', 'UNKNOWN'][o_orderkey % 16 + 1] AS status FROM orders""")
def q64(spark, d):
    """Every spelling of a status in cases and spaces of its own, by order."""
    k = F.col("o_orderkey")
    said = F.array(*map(F.lit, "scheduled Upcoming NOT_STARTED live In_Play PLAYING finished ft Full_Time completed postponed cancelled CANCELED suspended over".split()), F.lit(None).cast("string"))
    raw = F.concat(F.lit(" \t"), F.get(said, (k % 16).cast("int")), F.when(k % 2 == 0, "\u00a0").otherwise(""))
    return table(spark, d, "orders").select(k.alias("k"), tx.status(raw).alias("status"))
