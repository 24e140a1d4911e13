"""Files that the executors write, one for each row, and the documents of the stages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..sources.selection import safe_filename
from .publish import VERSION

# Members of a match as the stages write them, in their order.
MATCH = (
    "id string, competition struct<id:string,name:string>, homeTeam struct<id:string,name:string>, awayTeam struct<id:string,name:string>, scheduledAt string, status string, "
    "provenance struct<sourceId:string,format:string,sourceFile:string,sourceLine:int,sourceIds:array<string>>, score struct<home:int,away:int>"
)
#: The same as members of a struct.
NESTED = re.sub(r"(^|, )(\w+) ", r"\1\2:", MATCH)
FIELDS = ("id", "competition", "homeTeam", "awayTeam", "scheduledAt", "status", "provenance", "score")


def write_files(rows: DataFrame, isolate: bool = False) -> DataFrame:
    """rows: path (a URI), content (binary).  Writes each row as a file, beside its place first, and tells (path, size, error) of each.

    Files are written by the tasks, in any file system that pyarrow knows; a task that runs again writes the same files.
    isolate: a file that cannot be written is told with its error and leaves the others; otherwise it ends the job.
    """

    def run(batches):
        import pyarrow
        import pyarrow.fs

        def put(path: str, content: bytes) -> None:
            uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
            system, place = pyarrow.fs.FileSystem.from_uri(uri)
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(place + ".tmp") as out:
                out.write(content)
            system.move(place + ".tmp", place)

        for batch in batches:
            sizes, errors = [], []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                error = None
                try:
                    put(path, content or b"")
                except (OSError, pyarrow.ArrowException) as e:
                    if not isolate:
                        raise
                    error = str(e)
                sizes.append(0 if error else len(content or b""))
                errors.append(error)
            yield pyarrow.RecordBatch.from_arrays([batch.column(0), pyarrow.array(sizes, pyarrow.int64()), pyarrow.array(errors, pyarrow.string())], ["path", "size", "error"])

    return rows.select("path", "content").mapInArrow(run, "path string, size long, error string")


def write_pieces(pieces: DataFrame, between: bytes, isolate: bool = False) -> DataFrame:
    """pieces: path (a URI), order, item (whether it is one of a list), content (binary).  write_files() of files that are long: a task appends a file's pieces as they pass and holds one batch of them.

    between stands between items that follow each other.
    """

    def run(batches):
        import pyarrow
        import pyarrow.fs

        told: list[tuple] = []
        path, out, size, error, listed, system, place = None, None, 0, None, False, None, None

        def end() -> None:
            nonlocal error
            if path is None:
                return
            try:
                if error is None:
                    out.close()
                    system.move(place + ".tmp", place)
            except (OSError, pyarrow.ArrowException) as e:
                if not isolate:
                    raise
                error = str(e)
            told.append((path, 0 if error else size, error))

        for batch in batches:
            for at, item, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                try:
                    if at != path:
                        end()
                        path, size, error, listed = at, 0, None, False
                        system, place = pyarrow.fs.FileSystem.from_uri("file://" + at[5:] if at.startswith("file:/") and not at.startswith("file://") else at)
                        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                        out = system.open_output_stream(place + ".tmp")
                    if error is None:
                        content = between + content if item and listed else content
                        out.write(content)
                        size, listed = size + len(content), item
                except (OSError, pyarrow.ArrowException) as e:
                    if not isolate:
                        raise
                    error = str(e)
        end()
        yield pyarrow.RecordBatch.from_arrays([pyarrow.array([t[k] for t in told], kind) for k, kind in enumerate((pyarrow.string(), pyarrow.int64(), pyarrow.string()))], ["path", "size", "error"])

    dealt = pieces.repartition("path").sortWithinPartitions("path", "order")
    return dealt.select("path", "item", "content").mapInArrow(run, "path string, size long, error string")


def _plain(match: dict) -> dict:
    """A match without the members that its format does not have."""
    told = match.get("provenance") or {}
    gone = {"sourceFile", "sourceLine"} if told.get("format") == "json" else set()
    kept = {k: v for k, v in told.items() if k not in gone and not (k == "sourceIds" and v is None)}
    return {k: kept if k == "provenance" and told else v for k, v in match.items() if not (k == "score" and v is None)}


def styled_items(texts: DataFrame, match: bool) -> DataFrame:
    """(path, order, item, content): JSON texts (path, order, text) as items of a list of a document, in the style of all documents.  match: they are matches."""

    def run(batches):
        import json

        import pyarrow

        for batch in batches:
            each = map(json.loads, batch.column(2).to_pylist())
            out = [("    " + json.dumps(_plain(x) if match else x, ensure_ascii=False, indent=2).replace("\n", "\n    ")).encode() for x in each]
            yield pyarrow.RecordBatch.from_arrays([batch.column(0), batch.column(1), pyarrow.array([True] * len(out), pyarrow.bool_()), pyarrow.array(out, pyarrow.binary())], ["path", "order", "item", "content"])

    rows = texts.select("path", "order", "text")
    return rows.mapInArrow(run, f"path string, order {rows.schema['order'].dataType.simpleString()}, item boolean, content binary")


def styled(texts: DataFrame) -> DataFrame:
    """(path, content): JSON texts (path, text) in the style of all documents; members that a format does not have are left out."""

    def run(batches):
        import json

        import pyarrow

        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                document = json.loads(text)
                document["matches"] = [_plain(m) for m in document["matches"]]
                out.append((json.dumps(document, ensure_ascii=False, indent=2) + "\n").encode())
            yield pyarrow.RecordBatch.from_arrays([batch.column(0), pyarrow.array(out, pyarrow.binary())], ["path", "content"])

    return texts.select("path", "text").mapInArrow(run, "path string, content binary")


def normalized_path(folder: str, source: Column, file: Column) -> Column:
    """Where the document of a raw file goes; file: the parts of its path."""
    name = F.regexp_replace(F.regexp_replace(F.element_at(file, -1), r"\.raw$", ""), "[^A-Za-z0-9_.-]", "_")
    return F.concat(F.lit(folder.rstrip("/") + "/"), F.coalesce(source, F.lit("")), F.lit("__"), name, F.lit(".json"))


def write_normalized(rows: DataFrame, folder: str, at: str) -> DataFrame:
    """Write a document for each raw file with its matches, in the order of the records, and tell (path, size, error); files without matches have none.

    A document is written as its matches pass, so no task holds one.
    """
    source = F.col("provenance.sourceId")
    path = normalized_path(folder, source, F.col("_file")).alias("path")
    each = styled_items(rows.select(path, F.struct(F.lit(1).alias("part"), F.col("_rec_ord").cast("long").alias("at")).alias("order"), F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"}).alias("text")), True)
    text = lambda c: F.get_json_object(F.to_json(F.struct(F.array(c).alias("a")), {"ignoreNullFields": "false"}), "$.a")
    quoted = lambda c: F.regexp_extract(text(c), r"^\[([\s\S]*)\]$", 1)
    made = rows.groupBy("_file", source.alias("source")).agg(F.count("*").alias("n"))
    head = F.concat(F.lit(f'{{\n  "schemaVersion": "{VERSION}",\n  "sourceId": '), quoted(F.col("source")), F.lit(',\n  "sourceFile": '), quoted(F.array_join("_file", "/")), F.lit(',\n  "normalizedAt": '), quoted(F.lit(at)), F.lit(',\n  "matchCount": '), F.col("n"), F.lit(',\n  "matches": [\n'))
    ends = made.select(normalized_path(folder, F.col("source"), F.col("_file")).alias("path"), F.inline(F.array(*(F.struct(F.struct(F.lit(k).alias("part"), F.lit(0).cast("long").alias("at")).alias("order"), F.lit(False).alias("item"), F.encode(t, "utf-8").alias("content")) for k, t in ((0, head), (2, F.lit("\n  ]\n}\n")))))))
    return write_pieces(each.unionByName(ends), b",\n", isolate=True)


# The counters of the dedup document, and what statistics() calls them.
STATISTICS = {"inputRecords": "input", "identifiedRecords": "identified", "recordsWithoutSafeIdentity": "without_identity", "duplicateRecords": "duplicates", "uniqueRecords": "unique_rows", "identityCollisions": "collisions"}


def dedup_document(rows: DataFrame, statistics: Row, path: str, at: str, most: int) -> DataFrame:
    """(path, text) of the one document of merged rows; more rows than the rules allow are an error before they meet.

    statistics: the row of merge.statistics().
    """
    order = F.struct("_section", "_file", "_rec_ord")
    listed = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.struct(*FIELDS).alias("match"))))
    one = rows.limit(most + 1).agg(F.transform(listed, lambda x: x.match).alias("matches"))
    counters = F.struct(*(F.lit(statistics[c]).alias(n) for n, c in STATISTICS.items()))
    whole = F.when(F.size("matches") > most, F.raise_error(F.lit(f"more than {most} matches")).cast("string"))
    document = F.struct(F.lit(VERSION).alias("schemaVersion"), F.lit(at).alias("deduplicatedAt"), counters.alias("statistics"), "matches")
    return one.select(F.lit(path).alias("path"), whole.otherwise(F.to_json(document, {"ignoreNullFields": "false"})).alias("text"))


def raw_paths(folder: str, source: Column, index: Column, path: Column) -> Column:
    """Where the raw sink puts a file of a source."""
    return F.concat(F.lit(folder.rstrip("/") + "/"), source, F.lit("/"), safe_filename(source, index, path))



def write_parts(rows: DataFrame, folder: str, by: str) -> None:
    """Write rows to a table with a folder for each value of a column; only the folders of values among the rows are replaced.

    A rerun of one source leaves the others' files as they are, and a filter by the column reads its folder alone.  A value's rows are written by the tasks that have them, so a popular one is split.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)
