"""Text listings: numbered lines, carried date and competition, match lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE, let, strip, without_score
from ..functions.timeparse import clock_time, date_shaped, heading_date
from ..shared import spread
from .merge import file_key

_BREAK = "\r\n|[\n\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
MATCH = "struct<home:string,away:string,home_score:int,away_score:int>"


def numbered(files: DataFrame) -> DataFrame:
    """A row for each physical line of `text`, numbered from 1, with the other columns."""
    lines = F.split("text", _BREAK)
    whole = F.when(F.element_at(lines, -1) == "", F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    return files.select(*[c for c in files.columns if c != "text"], F.posexplode(whole).alias("pos", "line")).withColumn("line_no", F.col("pos") + 1).drop("pos")


def _cut(c: Column, form: str) -> Column:
    """c before the first place of form."""
    return F.element_at(F.split(c, form, 2), 1)


def match_line(c: Column) -> Column:
    """The two sides of a match line, and the score if it stands between them; null for other lines."""
    versus = f"(?i){SPACE}+(?:v|vs\\.?){SPACE}+"
    result = f"{SPACE}+(\\p{{Nd}}+){SPACE}*[-–]{SPACE}*(\\p{{Nd}}+){SPACE}+"
    none = F.lit(None).cast("int")

    def inside(text: Column) -> Column:
        body = _cut(text, f"{SPACE}+@{SPACE}+")
        body = F.regexp_replace(body, f"^\\p{{Nd}}{{1,2}}:\\p{{Nd}}{{2}}{SPACE}+", "")
        return strip(F.regexp_replace(body, f"^[•*]{SPACE}*", ""))

    def sides(body: Column, form: str, scores: tuple[Column, Column]) -> Column:
        parts = F.split(body, form, 2)
        away = F.regexp_replace(F.get(parts, F.lit(1)), f"{SPACE}+\\[[^\\n]*$", "")
        told = F.struct(without_score(F.get(parts, F.lit(0))).alias("home"), without_score(strip(away)).alias("away"), scores[0].alias("home_score"), scores[1].alias("away_score"))
        return let(told, lambda t: F.when((t["home"] != "") & F.coalesce(t["away"] != "", F.lit(False)), t))

    def told(body: Column) -> Column:
        scores = tuple(F.regexp_extract(body, result, i).try_cast("int") for i in (1, 2))
        return F.coalesce(sides(body, versus, (none, none)), sides(body, result, scores)).cast(MATCH)

    return let(strip(c), lambda text: F.when(~text.rlike("^[#=▪»|]"), let(inside(text), told)))


def classified(lines: DataFrame, year: Column) -> DataFrame:
    """lines with kind, and what each line sets: title (headings), date (date lines), match."""
    # columns of their own, so that each is found once
    told = lines.withColumn("__text", strip(F.col("line")))
    text, date, match = F.col("__text"), F.col("__date"), F.col("__match")
    told = told.withColumn("__shaped", date_shaped(text))
    # only what has the shape of a date is read as one, and only other lines as matches
    shaped = F.col("__shaped")
    told = told.withColumns({"__date": F.when(shaped, heading_date(text, year)), "__match": F.when(~shaped, match_line(text))})
    title = F.nullif(strip(F.regexp_replace(strip(F.substr(text, F.lit(2))), f"{SPACE}+#[^\\n]*$", "")), F.lit(""))
    kind = (
        F.when(text == "", "blank").when(text.startswith("="), "heading").when(text.startswith("#"), "comment").when(date.isNotNull(), "date")
        .when(F.col("__shaped"), "date_shaped").when(match.isNotNull(), "match").otherwise("other")
    )
    of = lambda k, c: F.when(F.col("kind") == k, c)
    return told.withColumn("kind", kind).withColumns({"title": of("heading", title), "date": of("date", date), "match": of("match", match)}).drop("__text", "__date", "__match", "__shaped")


def carried(lines: DataFrame, file: str = "path") -> DataFrame:
    """title and date of the last line that set them, within the file."""
    above = Window.partitionBy(file).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("competition", F.last("title", True).over(above)).withColumn("on", F.last("date", True).over(above))


def season_year(path: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(path, F.lit("20\\d{2}"), 0), F.lit(-1)).cast("int")


def text_matches(files: DataFrame, as_of_year: int, form: str = "text") -> DataFrame:
    """Match rows of text files (path, source_id, text): those without a date above them are dropped.  form is what provenance calls their format."""
    year = F.coalesce(season_year(F.col("path")), F.lit(as_of_year))
    # lines take much longer to read than files to move
    rows = carried(classified(numbered(spread(files)), year)).filter((F.col("kind") == "match") & F.col("on").isNotNull() & (F.col("on.year") >= 1))
    time = clock_time(F.col("line"))
    when = F.format_string("%04d-%02d-%02dT%02d:%02d:00+00:00", "on.year", "on.month", "on.day", F.coalesce(time["hour"], F.lit(0)), F.coalesce(time["minute"], F.lit(0)))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), "\\.raw$", "")
    team = lambda name: F.struct(F.lit(None).cast("string").alias("id"), F.col(name).alias("name"))
    scored = F.col("match.home_score").isNotNull()
    return rows.select(
        F.concat_ws(":", stem, F.col("line_no")).alias("id"),
        F.struct(F.lit(None).cast("string").alias("id"), F.col("competition").alias("name")).alias("competition"),
        team("match.home").alias("homeTeam"), team("match.away").alias("awayTeam"), when.alias("scheduledAt"),
        F.when(scored, "FINISHED").otherwise("SCHEDULED").alias("status"),
        F.struct(F.col("source_id").alias("sourceId"), F.lit(form).alias("format"), F.col("path").alias("sourceFile"), F.col("line_no").alias("sourceLine"), F.lit(None).cast("array<string>").alias("sourceIds")).alias("provenance"),
        F.when(scored, F.struct(F.col("match.home_score").alias("home"), F.col("match.away_score").alias("away"))).alias("score"),
        file_key(F.col("path")).alias("_file"), F.col("line_no").cast("long").alias("_rec_ord"),
    )
