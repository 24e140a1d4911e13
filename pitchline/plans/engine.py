"""The stages from a registry of sources to the published document, and the run that joins them.

fetch -> raw files -> normalize -> deduplicate -> validate -> build.  Each stage reads what the one before has left in
the folder of the run and tells its counters; a gate that is not passed raises Blocked, and nothing is published.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, merge, publish, rules, schema, sinks
from ..shared import Workspace, spread
from ..sources import documents, files, ledger, selection

RESULT = "source_id string, source_url string, status string, fetched_at string, files_discovered long, files_selected long, files_downloaded long, bytes_received long, error string"


class Blocked(RuntimeError):
    """A stage may not go on."""


@dataclass
class Settings:
    """clock: the time that every document of the run carries.  override: see selection.select_files()."""

    clock: str
    as_of_year: int
    rules: rules.Rules = field(default_factory=rules.Rules)
    text_form: str = "text"
    override: tuple[str, str] | None = None
    merge_provenance: bool = False
    #: Findings that a report lists at most; without it all.  Its counts and the table of findings hold all.
    listed: int | None = None
    #: How often a download is tried again, and the seconds between.
    retries: int = 0
    retry_delay: float = 0.0
    #: Keep a ledger of downloads, and download only what it lacks.
    resume: bool = False
    #: Leave what is published if its data are the same.
    only_if_changed: bool = True
    #: The share by which the number of published matches may move; more is told as a drop or an increase.
    most_change: float = 0.8
    #: The schema document of what is published; its part MATCH is that of a row.
    schema: dict = field(default_factory=lambda: schema.PUBLISHED)


# ------------------------------------------------------------------ fetch


def fetch_source(spark: SparkSession, source_id: str, url: str, folder: str, settings: Settings, get: files.Transport, work: Workspace) -> dict:
    """What a source's fetch came to.  A file that fails ends it: files before it are written."""
    told = {"source_id": source_id, "source_url": url, "status": "FETCH_FAILED", "fetched_at": settings.clock, "files_discovered": 0, "files_selected": 0, "files_downloaded": 0, "bytes_received": 0, "error": None}
    try:
        where = spark.range(1).select(selection.repository(F.lit(url)).alias("r")).first()["r"]
        if where is None:
            raise RuntimeError("Configured source URL is not a supported repository URL.")
        listing = files.remote_listing(where["owner"], where["repo"], get)
        found = spark.createDataFrame([(source_id, *x) for x in listing], "source_id string, ord int, path string, download_url string, size long, extension string")
        chosen = selection.select_files(found, settings.as_of_year, settings.override).join(found.select("path", "download_url"), "path").orderBy("place").collect()
        if not chosen:
            raise RuntimeError("No relevant JSON or text files were discovered.")
        wanted = [(r["place"], r["path"], r["download_url"]) for r in chosen]
        book = ledger.Ledger(spark, f"{folder.rstrip('/')}-ledger")
        if settings.resume:
            there = {(r["place"], r["path"], r["url"]) for r in book.done(source_id).collect()}
            wanted = [w for w in wanted if w not in there]
        size = 0
        if wanted:
            spark.dataSource.register(files.download_source(get, settings.retries, settings.retry_delay))
            got = spark.read.format("downloads").option("urls", json.dumps([u for *_, u in wanted])).load()
            names = spark.createDataFrame(wanted, "place int, path string, download_url string")
            got = work.save(got.join(names, F.col("url") == F.col("download_url")).select("place", "path", "url", "status", "content", "error", "attempts"), f"fetched-{len(work.made)}")
            work.made.append(source_id)
            bad = got.filter("error is not null").orderBy("place").select("place", "path", "status", "error").first()
            # what is resumed keeps every file that came; otherwise files after the first failure wait for the next run
            good = got.filter("error is null") if settings.resume or bad is None else got.filter(F.col("place") < bad["place"])
            paths = sinks.raw_paths(folder, F.lit(source_id), F.col("place") + 1, F.col("path"))
            size = sinks.write_files(good.select(paths.alias("path"), "content")).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
            if settings.resume:
                book.add(got.select(F.lit(source_id).alias("source_id"), "path", "url", "place", F.lit(settings.clock).alias("at"), "attempts", "status", "error", F.length("content").cast("long").alias("size")))
            if bad is not None:
                raise RuntimeError(f"HTTP {bad['status']} while downloading {bad['path']}" if bad["status"] is not None else f"{bad['error']} while downloading {bad['path']}")
        return told | {"status": "FETCHED", "files_discovered": len(listing), "files_selected": len(chosen), "files_downloaded": len(wanted), "bytes_received": size}
    except Exception as e:  # one source that fails leaves the others
        return told | {"error": str(e)}


def fetch(spark: SparkSession, registry: str, folder: str, settings: Settings, get: files.Transport = files.http_get) -> DataFrame:
    """RESULT of each source of a registry, in the order of priority; raw files go to folder/<source>/."""
    work = Workspace(spark, "fetch")
    work.made = []
    out = []
    for s in documents.registry(spark, registry).orderBy("place").collect():
        if s["error"] is not None:
            out.append({"source_id": s["id"], "source_url": s["url"], "status": "CONFIG_FAILED", "fetched_at": settings.clock, "files_discovered": 0, "files_selected": 0, "files_downloaded": 0, "bytes_received": 0, "error": s["error"]})
        else:
            out.append(fetch_source(spark, s["id"], s["url"], folder, settings, get, work))
    return spark.createDataFrame([tuple(r.values()) for r in out], RESULT)


def fetch_summary(results: DataFrame) -> DataFrame:
    """One row: configured, fetched and failed sources, and bytes."""
    ok = F.col("status") == "FETCHED"
    return results.agg(F.count("*").alias("configured"), F.count_if(ok).alias("fetched"), F.count_if(~ok).alias("failed"), F.sum(F.when(ok, F.col("bytes_received"))).alias("bytes"))


# ------------------------------------------------------------------ normalize, deduplicate


def normalize(spark: SparkSession, folder: str, settings: Settings, work: Workspace, sink: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(match rows, report of the files) of the raw files below a folder; no match at all is Blocked.

    sink: a folder for a document of each raw file with matches.  A file whose document cannot be written failed: its matches go, the others stay.
    """
    try:
        raw = files.raw_files(spark, folder)
    except AnalysisException as e:  # the folder is not there, as after a fetch without a success
        raise Blocked("raw/ directory does not exist.") from e
    if raw.isEmpty():
        raise Blocked("No raw files found.")
    rows = work.save(files.file_matches(raw, settings.as_of_year, settings.text_form), "normalized")
    if rows.isEmpty():
        raise Blocked("Zero matches were normalized.")
    lost = None
    if sink:
        written = work.save(sinks.write_normalized(rows, sink, settings.clock), "written")
        bad = written.filter("error is not null").select("path", F.col("error").alias("lost"))
        if not bad.isEmpty():
            placed = rows.withColumn("path", sinks.normalized_path(sink, F.col("provenance.sourceId"), F.col("_file")))
            lost = work.save(placed.select("_file", "path").distinct().join(bad, "path").drop("path"), "lost")
            rows = work.save(rows.join(lost.select("_file"), "_file", "left_anti").select(*rows.columns), "kept")
            if rows.isEmpty():
                raise Blocked("Zero matches were normalized.")
    return rows, work.save(files.file_report(raw, rows, lost), "files")


def deduplicate(rows: DataFrame, settings: Settings, work: Workspace, sink: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(merged rows with record_index, the row of counters).

    sink: the path of the one document, which is written if it may hold so many rows; the table holds any number.
    """
    told = merge.with_source(rows, F.col("provenance.sourceId"))
    unique = merge.merged(told, settings.merge_provenance)
    # first-seen order: sections, then files and records; the first part of a file's path deals it to its place
    ordered = publish.places(unique, [F.col("_section"), F.col("_file"), F.col("_rec_ord")], F.struct("_section", F.col("_file")), work)
    unique = work.save(ordered.withColumn("record_index", F.col("place") - 1).drop("place"), "unique")
    counted = work.save(merge.statistics(told), "statistics")
    numbers = counted.first()
    if sink and numbers["unique_rows"] <= settings.rules.most:
        sinks.write_files(sinks.styled(sinks.dedup_document(unique, numbers, sink, settings.clock, settings.rules.most))).count()
    return unique, counted


# ------------------------------------------------------------------ validate


def validate(rows: DataFrame, settings: Settings, work: Workspace, raw: str | None = None, has_schema: bool = True) -> DataFrame:
    """All findings of rows with record_index.  raw: the column with the rows' JSON texts, if they come from a document."""
    broken = None
    if settings.rules.schema and has_schema:
        told = spread(rows).withColumn("__json", schema.published_row(F.col("provenance.sourceIds")))
        rows = schema.check(told, "__json", schema.Schema(settings.schema), schema.MATCH).drop("__json")
        broken = F.array_distinct(F.transform("faults", lambda f: f.path))
    return work.save(rules.findings(rows, settings.rules, F.col(raw) if raw else None, work, broken), "findings")


def _first(found: DataFrame, settings: Settings) -> DataFrame:
    order = ["stage", F.coalesce("record_index", F.lit(-1)), "seq"]
    return found if settings.listed is None else found.orderBy(*order).limit(settings.listed)


def _told(found: DataFrame, count: int, settings: Settings, input_file: str, has_schema: bool) -> tuple[dict, list[dict]]:
    """(a report without its lists, the warnings of the run itself)."""
    gate = rules.gate(found, settings.rules).first()
    passed, skipped, own = rules.checks_told(settings.rules, has_schema)
    if passed and not found.filter("check = 'schemaValidation'").isEmpty():
        passed = []
    listed = min(gate["errors"] + gate["warnings"], settings.listed if settings.listed is not None else gate["errors"] + gate["warnings"])
    return {
        "schemaVersion": publish.VERSION,
        "validation": {
            "status": gate["status"], "validatedAt": settings.clock, "inputFile": input_file, "recordCount": count, "errors": gate["errors"], "warnings": gate["warnings"] + len(own),
            "passedChecks": passed, "skippedChecks": skipped, "requiredCheckFailures": gate["required_failures"], "publicationAllowed": gate["publication_allowed"],
            **({"listed": listed} if listed < gate["errors"] + gate["warnings"] else {}),
        },
    }, own


def report(found: DataFrame, count: int, settings: Settings, input_file: str, has_schema: bool = True) -> dict:
    """The report on a run's findings, for few of them: all are counted, the first ones are listed, and `listed` tells how many if these are not all."""
    told, own = _told(found, count, settings, input_file, has_schema)
    rows = _first(found, settings).orderBy("stage", F.coalesce("record_index", F.lit(-1)), "seq").collect()
    say = lambda r: {"check": r["check"], "message": r["message"]} | ({} if r["record_index"] is None else {"recordIndex": r["record_index"]})
    errors, warnings = ([say(r) for r in rows if r["severity"] == s] for s in ("error", "warning"))
    return told | {"errors": errors, "warnings": warnings + own}


def write_report(found: DataFrame, count: int, settings: Settings, input_file: str, path: str, has_schema: bool = True) -> dict:
    """Write report() as a file, as its findings pass: neither the driver nor a task holds them all.  Returns it without its lists."""
    told, own = _told(found, count, settings, input_file, has_schema)
    first = _first(found, settings)
    numbers = {r["severity"]: r["count"] for r in first.groupBy("severity").count().collect()}
    order = lambda part, stage, at, seq: F.struct((part if isinstance(part, Column) else F.lit(part)).cast("int").alias("part"), stage.cast("int").alias("stage"), at.cast("long").alias("at"), seq.cast("int").alias("seq")).alias("order")
    place = F.lit(path).alias("path")
    say = F.to_json(F.struct("check", "message", F.col("record_index").alias("recordIndex"))).alias("text")
    texts = first.select(place, order(F.when(F.col("severity") == "error", 1).otherwise(3), F.col("stage"), F.coalesce("record_index", F.lit(-1)), F.col("seq")), say)
    if own:
        mine = found.sparkSession.createDataFrame([(json.dumps(w, ensure_ascii=False), i) for i, w in enumerate(own)], "text string, i int")
        texts = texts.unionByName(mine.select(place, order(F.lit(3), F.lit(2**31 - 1), F.lit(0), F.col("i")), "text"))
    some = {"errors": numbers.get("error", 0), "warnings": numbers.get("warning", 0) + len(own)}
    begin = lambda name: f'"{name}": [' + ("\n" if some[name] else "")
    end = lambda name: "\n  ]" if some[name] else "]"
    ends = [(0, publish.json_text(told)[:-3] + ",\n  " + begin("errors")), (2, end("errors") + ",\n  " + begin("warnings")), (4, end("warnings") + "\n}\n")]
    fixed = found.sparkSession.createDataFrame(ends, "part int, text string").select(place, order(F.col("part"), F.lit(0), F.lit(0), F.lit(0)), F.lit(False).alias("item"), F.encode("text", "utf-8").alias("content"))
    sinks.write_pieces(sinks.styled_items(texts, False).unionByName(fixed), b",\n").count()
    return told


def permission(told: object, at: str | None = None) -> dict:
    """The validation part of a report that allows publication; anything else is Blocked.

    at: the time of the run; a report of another run is stale.
    """
    stop = " Publication is blocked."
    if told is None:
        raise Blocked("Validation report does not exist." + stop)
    if not isinstance(told, dict):
        raise Blocked("Validation report is not a JSON object." + stop)
    part = told.get("validation")
    if not isinstance(part, dict):
        raise Blocked("Validation report does not contain a valid 'validation' object." + stop)
    if part.get("status") != "PASS":
        raise Blocked(f"Validation status is not PASS. Actual status: {part.get('status')!r}." + stop)
    if part.get("publicationAllowed") is not True:
        raise Blocked(f"Validation did not explicitly authorize publication. publicationAllowed={part.get('publicationAllowed')!r}." + stop)
    if at is not None and part.get("validatedAt") != at:
        raise Blocked("Validation report belongs to another run." + stop)
    return part


# ------------------------------------------------------------------ build


def build(rows: DataFrame, order: tuple[str, ...], validation: dict, settings: Settings) -> dict:
    """The document to publish.  It is checked once more: its own status and permission, and the published schema."""
    made = publish.payload(publish.canonical(rows, order), order, settings.clock, validation, settings.rules.most)
    if made["pipeline"]["validationStatus"] != "PASS":
        raise Blocked("Final validation status is not PASS.")
    if made["pipeline"]["publicationAllowed"] is not True:
        raise Blocked("Publication was not explicitly authorized.")
    if bad := schema.document_faults(rows.sparkSession, made, schema.Schema(settings.schema)):
        raise Blocked(f"The document breaks the published schema at {bad[0][0]}.")
    return made


METRIC = "stage string, metric string, value string"


def run(spark: SparkSession, folder: str, settings: Settings, registry: str | None = None, get: files.Transport = files.http_get) -> DataFrame:
    """All stages over a folder (a URI that driver and executors share); returns the counters of each stage, METRIC.

    registry: where sources are fetched from first; without one, raw files stand in folder/raw.  The last two metrics are
    the status (PUBLISHED, UNCHANGED or BLOCKED) and what stopped the run.  A blocked run leaves what was published before.
    """
    folder = folder.rstrip("/")
    work = Workspace(spark, "run")
    told: list[tuple[str, str, str]] = []
    say = lambda stage, **values: told.extend((stage, k, str(v)) for k, v in values.items())
    status, error = "BLOCKED", ""
    try:
        if registry:
            say("fetch", **fetch_summary(fetch(spark, registry, f"{folder}/raw", settings, get)).first().asDict())
        rows, report_of_files = normalize(spark, f"{folder}/raw", settings, work, f"{folder}/normalized")
        say("normalize", **files.file_counters(report_of_files).first().asDict())
        merged_at = f"{folder}/deduplicated/matches.json"
        unique, counted = deduplicate(rows, settings, work, merged_at)
        say("deduplicate", **counted.first().asDict())
        report_at = f"{folder}/validation/validation-report.json"
        if settings.rules.enabled:
            found = validate(unique, settings, work)
            checked = write_report(found, unique.count(), settings, merged_at, report_at)
            say("validate", **{k: checked["validation"][k] for k in ("status", "recordCount", "errors", "warnings")})
        try:
            stands = documents.document(spark, report_at, "")
        except FileNotFoundError:
            stands = None
        allowed = permission(stands, settings.clock)
        made = build(unique, ("_section", "_file", "_rec_ord"), allowed, settings)
        published_at = f"{folder}/data/matches.json"
        try:
            last = documents.document(spark, published_at, "")
            last = last if isinstance(last, dict) else {}
        except (FileNotFoundError, ValueError):
            last = {}
        say("build", **{k: made[k] for k in ("sourceCount", "matchCount", "datasetHash")})
        if last:
            say("build", drift=changes.drift(last.get("matchCount"), made["matchCount"], settings.most_change))
        if settings.only_if_changed and last.get("datasetHash") == made["datasetHash"]:
            status = "UNCHANGED"
        else:
            publish.write_atomically(spark, made, published_at)
            status = "PUBLISHED"
    except (Blocked, ValueError, FileNotFoundError) as e:
        error = str(e)
    say("run", status=status, error=error)
    return spark.createDataFrame(told, METRIC)
