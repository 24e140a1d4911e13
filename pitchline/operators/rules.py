"""The rule engine: findings of each record and of the whole, and the gate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_or_empty
from ..functions.timeparse import is_iso
from ..shared import Workspace
from .merge import duplicate_key
from .records import Record, with_record

FINDING = "struct<severity:string,stage:int,seq:int,check:string,message:string>"


# What a configuration that says nothing means, and the statuses of the shipped one.
STATUSES = ("SCHEDULED", "LIVE", "FINISHED", "POSTPONED", "CANCELLED", "SUSPENDED", "UNKNOWN")
CHECKS = ("schemaValidation", "requiredFields", "teamValidation", "matchIdentity", "dateTimeValidation", "statusValidation", "duplicateValidation", "datasetValidation")


@dataclass
class Rules:
    """The shipped configuration, with the schema rule left out until it is asked for."""

    required: tuple[str, ...] = ("id", "homeTeam", "awayTeam", "scheduledAt", "status")
    home: bool = True
    away: bool = True
    home_id: bool = True
    away_id: bool = True
    home_name: bool = True
    away_name: bool = True
    statuses: tuple[str, ...] = STATUSES
    duplicates: bool = True
    schema: bool = False
    least: int = 1
    most: int = 10_000
    longest_id: int = 512
    must_pass: tuple[str, ...] = CHECKS
    enabled: bool = True

    @classmethod
    def of(cls, document: object) -> Rules:
        """From a configuration document; members that it leaves out have the values that the documented code gives them."""
        if not isinstance(document, dict):
            raise ValueError("validation.json must contain a JSON object.")
        told = document.get("validation")
        if not isinstance(told, dict):
            raise ValueError("validation.json is missing the 'validation' object.")
        part = lambda *keys: reduce(lambda d, k: d.get(k, {}), keys, told)
        team, record, whole = part("recordValidation", "teamValidation"), part("recordValidation"), part("datasetValidation")
        on = lambda key: bool(team.get(key, True))
        return cls(
            tuple(record.get("requiredFields", ())), on("requireHomeTeam"), on("requireAwayTeam"), on("requireHomeTeamId"), on("requireAwayTeamId"), on("requireHomeTeamName"), on("requireAwayTeamName"),
            tuple(part("recordValidation", "statusValidation").get("allowedValues", ())), bool(part("duplicateValidation").get("enabled", True)), bool(part("schemaValidation").get("enabled", True)),
            whole.get("minimumMatches", 0), whole.get("maximumMatches", 10_000), 512, tuple(part("publicationGate").get("requiredChecks", ())), bool(told.get("enabled", True)),
        )


def _finding(when: Column, stage: int, seq: int, check: str, message: Column | str, severity: str = "error") -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(stage).alias("stage"), F.lit(seq).alias("seq"), F.lit(check).alias("check"), text.alias("message")))


def record_findings(rules: Rules, told: Record | None = None) -> Column:
    """Array of the findings of a row.  told: its JSON, where a member that is missing, null or no object is to be told apart."""
    out: list[Column] = []
    say = lambda when, stage, check, message, severity="error": out.append(_finding(when, stage, len(out), check, message, severity))
    for f in rules.required:
        if told is None:
            missing, null = F.lit(False), F.col(f).isNull()
            blank = F.lit(False) if f in ("homeTeam", "awayTeam") else F.col(f).isNotNull() & (strip_or_empty(F.col(f)) == "")
        else:
            missing = ~F.coalesce(F.map_contains_key(told.texts, F.lit(f)), F.lit(False))
            null = told.kind(f) == "VOID"
            blank = (told.kind(f) == "STRING") & (strip_or_empty(told.texts[f]) == "")
        say(missing, 1, "requiredFields", f"Missing required field: {f}")
        say(~missing & null, 1, "requiredFields", f"Required field is null: {f}")
        say(~missing & blank, 1, "requiredFields", f"Required field is empty: {f}")
    for side, label, on, need_id, need_name in (("homeTeam", "Home", rules.home, rules.home_id, rules.home_name), ("awayTeam", "Away", rules.away, rules.away_id, rules.away_name)):
        if on:
            # a member that is no object is null in the typed row
            say(F.col(side).isNull(), 2, "teamValidation", f"{side} must be an object.")
            for need, part, name in ((need_id, "id", "ID"), (need_name, "name", "name")):
                if need:
                    say(F.col(side).isNotNull() & (strip_or_empty(F.col(f"{side}.{part}")) == ""), 2, "teamValidation", f"{label} team {name} is missing.")
    own = strip_or_empty(F.col("id"))
    say(own == "", 3, "matchIdentity", "Match ID is missing.")
    say(F.char_length(own) > rules.longest_id, 3, "matchIdentity", "Match ID exceeds maximum length.")
    when = strip_or_empty(F.col("scheduledAt"))
    say(when == "", 4, "dateTimeValidation", "scheduledAt is missing.")
    say((when != "") & ~is_iso(F.col("scheduledAt")), 4, "dateTimeValidation", "scheduledAt is not a valid ISO-8601 datetime.")
    status = F.upper(strip_or_empty(F.col("status")))
    say(status == "", 5, "statusValidation", "Match status is missing.")
    say((status != "") & ~status.isin(*rules.statuses), 5, "statusValidation", F.concat(F.lit("Invalid match status: "), status))
    for part, check, message, severity in (("id", lambda c: c, "Home and away teams have the same ID.", "error"), ("name", F.lower, "Home and away team names are identical.", "warning")):
        a, b = (check(strip_or_empty(F.col(f"{s}.{part}"))) for s in ("homeTeam", "awayTeam"))
        say((a != "") & (a == b), 6, "dataQuality", message, severity)
    return F.array_compact(F.array(*out))


_COLUMNS = ["severity", "stage", "seq", "check", "message", "record_index"]


def _whole(checks: list[Column]) -> list[Column]:
    return [F.inline(F.array_compact(F.array(*checks)))]


def findings(rows: DataFrame, rules: Rules, raw: Column | None = None, work: Workspace | None = None, schema: Column | None = None) -> DataFrame:
    """(severity, stage, seq, check, message, record_index): stage, record_index and seq give the order of emission.

    rows carry record_index from 0.  raw: the rows' JSON texts.  With work, what is read of the rows is saved first, so that they are read once.
    schema: array of the paths at which a row breaks the published schema, for the schema rule.
    """
    if not rules.enabled:
        raise ValueError("Validation is disabled.")
    told = None
    if raw is not None:
        rows, told = with_record(rows, raw)
    found = record_findings(rules, told)
    broken = F.array().cast("array<string>") if schema is None else schema
    base = rows.select("record_index", found.alias("found"), duplicate_key().alias("key"), broken.alias("broken"))
    base = work.save(base, "found") if work else base
    each = base.select("record_index", F.inline("found")).select("severity", F.lit(1).alias("stage"), (F.col("stage") * 100 + F.col("seq")).alias("seq"), "check", "message", "record_index")
    # what is counted by key tells the number of rows as well
    groups = base.groupBy("key").agg(F.count("*").alias("n"), F.min("record_index").alias("first"))
    groups = work.save(groups, "groups") if work else groups
    total = lambda word, limit: F.concat(F.lit("Dataset contains "), F.col("n"), F.lit(f" matches; {word} is {limit}."))
    limits = [_finding(F.col("n") < rules.least, 0, 0, "datasetValidation", total("minimum required", rules.least)), _finding(F.col("n") > rules.most, 0, 1, "datasetValidation", total("maximum allowed", rules.most))]
    size = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
    none = F.lit(None).cast("long").alias("record_index")
    parts = [each, size.select(*_whole(limits), none)]
    if rules.duplicates:
        lost = _finding(F.col("key").isNull(), 2, 0, "duplicateValidation", "Record has no deterministic duplicate key.", "warning")
        again = _finding(F.col("record_index") > F.col("first"), 2, 0, "duplicateValidation", F.concat(F.lit("Duplicate match detected. First occurrence: index "), F.col("first")))
        parts.append(base.filter("key is null").select("record_index", *_whole([lost])))
        # only keys that stand twice are joined back; a popular one is split by the join, as no window gathers it
        parts.append(base.select("record_index", "key").join(groups.filter("key is not null and n > 1").select("key", "first"), "key").select("record_index", *_whole([again])))
    if rules.schema and schema is not None:
        # like the documented check, one finding for the whole: the first path of the first row that breaks it
        least = base.filter(F.size("broken") > 0).agg(F.min(F.struct("record_index", F.col("broken")[0].alias("path"))).alias("b")).filter("b is not null")
        said = F.concat(F.lit("Dataset failed JSON Schema validation: matches["), F.col("b.record_index"), F.lit("]."), F.col("b.path"))
        parts.append(least.select(*_whole([_finding(F.lit(True), 3, 0, "schemaValidation", said)]), none))
    return reduce(DataFrame.unionByName, [p.select(*_COLUMNS) for p in parts])


def checks_told(rules: Rules, schema: bool) -> tuple[list[str], list[str], list[dict]]:
    """(passed, skipped, warnings) that the run itself adds: the schema rule passes, or is skipped where there is no schema."""
    if not rules.schema:
        return [], [], []
    if schema:
        return ["schemaValidation"], [], []
    return [], ["schemaValidation"], [{"check": "schemaValidation", "message": "matches.schema.json is not available; schema validation was skipped."}]


def gate(found: DataFrame, rules: Rules) -> DataFrame:
    """One row: status, publication_allowed, errors, warnings, failed required checks in the order of the configuration."""
    error = F.col("severity") == "error"
    sums = found.agg(F.count_if(error).alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.collect_set(F.when(error, F.col("check"))).alias("failed"))
    must = F.filter(F.array(*map(F.lit, rules.must_pass)), lambda c: F.array_contains(F.col("failed"), c))
    ok = F.col("errors") == 0
    return sums.select(F.when(ok, "PASS").otherwise("FAIL").alias("status"), ok.alias("publication_allowed"), "errors", "warnings", must.alias("required_failures"))
