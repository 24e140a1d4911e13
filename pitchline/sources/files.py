"""Raw files as texts, and remote listings and downloads through a Python data source."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import strip
from ..operators import lines, records
from ..operators.merge import file_key, union
from .selection import EXTENSIONS, source_of


def below(spark: SparkSession, folder: str, path: Column) -> Column:
    """A file's path below the folder that was read, wherever else the folder's name stands in it."""
    given = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString().rstrip("/")
    return F.substr(path, F.lit(len(root) + 2))


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path below the folder, source_id, format, text) of each *.raw file; format is json, text or unknown.

    Text is null for JSON that is no UTF-8 and for unknown files.  Files without a byte are not listed.  Files are in the order of operators.merge.file_key(path).
    """
    return described(spark, spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.raw").load(folder), folder)


def described(spark: SparkSession, found: DataFrame, folder: str) -> DataFrame:
    """raw_files() of files (path, content) that were found below a folder."""
    path = below(spark, folder, F.col("path"))
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    exact = F.try_validate_utf8(F.col("content").cast("string"))
    start = F.left(strip(exact), F.lit(1))
    form = F.when(name.endswith(".json.raw"), "json").when(name.endswith(".txt.raw"), "text").when(exact.isNull(), "unknown").when(start.isin("{", "["), "json").otherwise("text")
    text = F.when(form == "json", exact).when(form == "text", F.make_valid_utf8(F.col("content").cast("string")))
    return found.select(path.alias("path"), source_of(path).alias("source_id"), form.alias("format"), text.alias("text"))


def file_matches(files: DataFrame, as_of_year: int, text_form: str = "text") -> DataFrame:
    """Match rows of raw files of both formats; files of unknown format give none."""
    return union(records.json_matches(files.filter("format = 'json'")), lines.text_matches(files.filter("format = 'text'"), as_of_year, text_form))


def file_report(files: DataFrame, rows: DataFrame, lost: DataFrame | None = None) -> DataFrame:
    """(path, source_id, format, matches, status, error) of each file: one that cannot be read is empty and leaves the others.

    lost: (_file, lost) of the files whose matches could not be saved, and why; they failed and count no matches.
    """
    counts = rows.groupBy("_file").agg(F.count("*").alias("matches"))
    read = F.when(F.col("format") == "json", F.try_parse_json("text").isNull())
    error = F.when(F.col("format") == "unknown", "unknown format").when(F.col("text").isNull(), "no UTF-8").when(read, "no JSON")
    told = files.select("path", "source_id", "format", error.alias("error"), file_key(F.col("path")).alias("_file")).join(counts, "_file", "left")
    told = told.withColumn("lost", F.lit(None).cast("string")) if lost is None else told.join(lost, "_file", "left")
    n = F.when(F.col("lost").isNull(), F.coalesce("matches", F.lit(0))).otherwise(0)
    status = F.when(F.col("lost").isNotNull(), "failed").when(n > 0, "successful").otherwise("empty")
    return told.select("path", "source_id", "format", n.alias("matches"), status.alias("status"), F.coalesce("lost", F.when(n == 0, F.col("error"))).alias("error"))


def file_counters(report: DataFrame) -> DataFrame:
    """One row: raw, successful, empty and failed files, and matches."""
    of = lambda s: F.count_if(F.col("status") == s).alias(f"{s}_files")
    return report.agg(F.count("*").alias("raw_files"), of("successful"), of("empty"), of("failed"), F.coalesce(F.sum("matches"), F.lit(0)).alias("normalized_matches"))


def source_counts(rows: DataFrame, source: Column) -> DataFrame:
    """(source, n, place): rows of each source, in the order of the sources.  The places of a registry's sources are found in one task."""
    counted = rows.groupBy(source.alias("source")).agg(F.count("*").alias("n"))
    return counted.withColumn("place", F.row_number().over(Window.orderBy("source")).cast("long"))


Transport = Callable[[str, str], tuple[int, bytes]]


def http_get(url: str, accept: str) -> tuple[int, bytes]:
    request = urllib.request.Request(url, headers={"User-Agent": "pitchline", "Accept": accept})
    with urllib.request.urlopen(request, timeout=60) as answer:
        return answer.status, answer.read()


class _File(InputPartition):
    def __init__(self, url: str):
        self.value = url


class _Downloads(DataSourceReader):
    def __init__(self, urls: list[str], get: Transport, retries: int, delay: float):
        self.urls, self.get, self.retries, self.delay = urls, get, retries, delay

    def partitions(self) -> list[InputPartition]:
        return [_File(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for attempt in range(1, self.retries + 2):
            try:
                status, body = self.get(partition.value, "*/*")
                row = (partition.value, status, bytearray(body), None if status == 200 else f"HTTP {status}", attempt)
                again = status >= 500  # what the other side may mend
            except Exception as e:  # one file that fails leaves the others
                row, again = (partition.value, None, None, str(e), attempt), True
            if not again or attempt > self.retries:
                break
            time.sleep(self.delay)
        yield row


def download_source(get: Transport = http_get, retries: int = 0, delay: float = 0.0) -> type[DataSource]:
    """A data source `downloads` with option urls (a JSON list): (url, status, content, error, attempts), a task for each file.

    What fails on the way or on the other side is tried again up to retries times, after delay seconds each.
    """

    class Downloads(DataSource):
        @classmethod
        def name(cls) -> str:
            return "downloads"

        def schema(self) -> str:
            return "url string, status int, content binary, error string, attempts int"

        def reader(self, schema) -> DataSourceReader:
            return _Downloads(json.loads(self.options["urls"]), get, retries, delay)

    return Downloads


API = "https://api.github.com"


def contents_url(owner: Column, repo: Column, path: Column, api: str = API) -> Column:
    """The address of a file's description; the separators of its path stay as they are."""
    inner = F.regexp_replace(path, "^/+|/+$", "")
    escaped = F.replace(F.replace(F.url_encode(inner), F.lit("%2F"), F.lit("/")), F.lit("+"), F.lit("%20"))
    # url_encode is for forms: these two differ in paths
    escaped = F.replace(F.replace(escaped, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(f"{api}/repos/"), owner, F.lit("/"), repo, F.lit("/contents/"), escaped)


def remote_listing(owner: str, repo: str, get: Transport = http_get, api: str = API) -> list[tuple[int, str, str, int, str]]:
    """(ord, path, download_url, size, extension) of a repository's data files at the head of its default branch."""

    def asked(path: str) -> dict:
        status, body = get(f"{api}/repos/{owner}/{repo}{path}", "application/vnd.github+json")
        if status != 200:
            raise RuntimeError(f"HTTP {status} for {path or '/'}")
        return json.loads(body)

    branch = asked("").get("default_branch")
    if not branch:
        raise RuntimeError(f"Unable to determine default branch for {owner}/{repo}")
    head = asked(f"/git/ref/heads/{urllib.parse.quote(branch, safe='')}").get("object", {}).get("sha")
    if not head:
        raise RuntimeError(f"Unable to resolve branch SHA for {owner}/{repo}")
    tree = asked(f"/git/trees/{head}?recursive=1")
    if tree.get("truncated"):
        raise RuntimeError(f"The listing of {owner}/{repo} is truncated; an incomplete one is refused.")
    out = []
    for item in tree.get("tree", ()):
        name = item["path"].rsplit("/", 1)[-1]
        extension = "." + name.rsplit(".", 1)[1].lower() if "." in name[1:] else ""
        if item["type"] == "blob" and extension in EXTENSIONS:
            url = f"https://raw.githubusercontent.com/{owner}/{repo}/{branch}/{urllib.parse.quote(item['path'])}"
            out.append((len(out), item["path"], url, item.get("size") or 0, extension))
    return out
