"""Interpolated modified Kneser-Ney language model over hashed n-grams.

Tokens are lower-cased words (A-Z alone) and one end for each text; order - 1 starts stand before it.  An n-gram of the highest order counts as often as it stands in
the training texts, a shorter one by the different words before it (one that begins with a start: as often as it stands).  Each level has its discounts
for counts of 1, 2 and more, from its counts of counts; where these say nothing sensible, the discounts are FALLBACK.

Counting: tasks count the n-grams of CHUNK tokens at a time and Spark deals them by hash ranges, so a frequent n-gram is one row for each chunk and no range is larger than
another.  Within a range rows are sorted by hash, equal ones are merged as they pass, written to the arrays of that range, and counts for the level below go on.
Nothing is left out, so a model grows with its corpus.

Storage: for each level and range, files of sorted 64-bit hashes and of their numbers, in the shared folder.  Workers map them into memory and search them, so pages in use
are shared by the workers of a machine and nothing is sent to them.  In a file system that cannot be mapped, a worker fetches the files of a range when it first asks for it.

Null and empty texts are the end alone.  Repeated rows count as often as they stand.  Texts may have any length.  Without a training text every probability is 1.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, Workspace, byte_texts, partitions, slices

#: Hashes of the end of a text and of what stands before it.
END, START = 1, 2
#: Tokens that a task counts, or looks up, at a time.
CHUNK = 1 << 20
#: Different n-grams that a task holds before it hands them on.
DISTINCT = 3 << 20
#: Passes over the texts that count the highest order.
PASSES = 2
#: Rows of sorted n-grams that are merged and written at a time.
MERGED = 1 << 20
FALLBACK = (0.5, 1.0, 1.5)
#: What each n-gram below the highest order has: its count; as a history, the counts after it and how many of them are 1, 2 and more; for words, how often they stand.
NUMBERS = ("count", "total", "ones", "twos", "more", "raw")


def tokens(text: bytes, words: WordHashes) -> np.ndarray:
    return np.append(words.of(text.lower().split()), np.uint64(END))


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def joint_hash(columns: list[np.ndarray]) -> np.ndarray:
    """What F.xxhash64 gives for columns of longs; a single word's own hash."""
    if len(columns) == 1:
        return columns[0]
    # The primes of XXH64.
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    h = np.full(len(columns[0]), 42, np.uint64)
    with np.errstate(over="ignore"):
        for x in columns:
            h = h + p5 + np.uint64(8)
            h ^= _rotate(x * p2, 31) * p1
            h = _rotate(h, 27) * p1 + p4
            h = (h ^ (h >> np.uint64(33))) * p2
            h = (h ^ (h >> np.uint64(29))) * p3
            h ^= h >> np.uint64(32)
    return h


def _padded(texts: list[bytes], words: WordHashes, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all texts with starts before each, where the real ones stand)."""
    start = np.full(order - 1, START, np.uint64)
    parts, places, at = [], [], 0
    for t in texts:
        own = tokens(t, words)
        parts += [start, own]
        places.append(np.arange(at + order - 1, at + order - 1 + len(own)))
        at += order - 1 + len(own)
    return np.concatenate(parts), np.concatenate(places)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of about CHUNK tokens at a time; a longer text alone."""
    for batch in slices(batches):
        texts = byte_texts(batch.column(column))
        begin = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > 6 * CHUNK:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(t)
        yield batch.slice(begin), texts[begin:]


def _sum_by(hashes: np.ndarray, numbers: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places of the first row of each hash, sums of the numbers over its rows)."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
    return order[head], [np.add.reduceat(n[order], head) if len(head) else n for n in numbers]


def _counted(texts: DataFrame, order: int, bits: int, number: int) -> DataFrame:
    """(w1, ..., count): n-grams of the highest order whose range falls to a pass, counted by chunk."""
    names = [f"w{i}" for i in range(1, order + 1)]

    def summed(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
        columns = [np.concatenate([p[0][k] for p in parts]) for k in range(order)]
        heads, (counts,) = _sum_by(joint_hash(columns), [np.concatenate([p[1] for p in parts])])
        return [c[heads] for c in columns], counts

    def told(words: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        near = np.argsort(words[0], kind="stable")  # rows that share a word are shuffled side by side, which compresses better
        return pa.RecordBatch.from_arrays([*(pa.array(w[near].view(np.int64)) for w in words), pa.array(counts[near])], [*names, "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, fresh = WordHashes(), [], 0
        for _, some in _texts(batches, 0):
            if not some:
                continue
            row, at = _padded(some, words, order)
            gram = [row[at - order + 1 + k] for k in range(order)]
            mine = (joint_hash(gram) >> np.uint64(64 - bits)) % np.uint64(PASSES) == number
            parts.append(([w[mine] for w in gram], np.ones(int(mine.sum()), np.int64)))
            fresh += len(parts[-1][1])
            if fresh >= CHUNK:
                parts, fresh = [summed(parts)], 0
                if len(parts[0][1]) >= DISTINCT:
                    yield told(*parts[0])
                    parts = []
        if parts:
            yield told(*summed(parts))

    return texts.mapInArrow(run, ", ".join(f"{n} long" for n in (*names, "count")))


def _open(uri: str):
    import pyarrow.fs

    return pyarrow.fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class _Files:
    """The arrays of one range, written as rows pass: beside their place first, in the narrowest type that holds them."""

    def __init__(self, folder: str, columns: tuple[str, ...]):
        self.system, self.place = _open(folder)
        self.system.create_dir(self.place, recursive=True)
        self.mark = f"{os.getpid()}-{os.urandom(4).hex()}"
        self.kind = {c: np.dtype("<u8") if c == "hash" else np.dtype("<u1") for c in columns}
        self.out = {c: self._stream(c) for c in columns}
        self.rows = 0

    def _stream(self, column: str, again: str = ""):
        return self.system.open_output_stream(f"{self.place}/{column}.{self.mark}{again}")

    def add(self, **columns: np.ndarray) -> None:
        for c, x in columns.items():
            need = self.kind[c] if c == "hash" or not len(x) else np.min_scalar_type(int(x.max()))
            if need.itemsize > self.kind[c].itemsize:
                self._widen(c, need)
            self.out[c].write(np.ascontiguousarray(x.astype(self.kind[c])))
        self.rows += len(columns["hash"])

    def _widen(self, column: str, kind: np.dtype) -> None:
        self.out[column].close()
        name, old = f"{self.place}/{column}.{self.mark}", self.kind[column]
        out = self._stream(column, "w")
        with self.system.open_input_stream(name) as read:
            while part := read.read(8 * MERGED):
                out.write(np.frombuffer(part, old).astype(kind))
        out.close()
        self.system.move(name + "w", name)
        self.kind[column] = kind
        self.out[column] = self.system.open_append_stream(name)

    def close(self, told: dict) -> None:
        for c, out in self.out.items():
            out.close()
            self.system.move(f"{self.place}/{c}.{self.mark}", f"{self.place}/{c}")
        said = told | {"rows": self.rows, "kinds": {c: k.str for c, k in self.kind.items()}}
        with self.system.open_output_stream(f"{self.place}/told.{self.mark}") as out:
            out.write(json.dumps(said).encode())
        self.system.move(f"{self.place}/told.{self.mark}", f"{self.place}/told.json")


def _range(columns: list[str], bits: int) -> Column:
    h = F.col(columns[0]) if len(columns) == 1 else F.xxhash64(*columns)
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def _level(rows: DataFrame, folder: str, level: int, order: int, bits: int) -> DataFrame:
    """Merge the rows of a level (w1, ..., its numbers), write its arrays, and give the rows of the level below."""
    names = [f"w{i}" for i in range(1, level + 1)]
    numbers = ("count",) if level == order else NUMBERS
    below = names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: _Files | None = None
        stats = dict.fromkeys(("n1", "n2", "n3", "n4", "grams", "count", "raw"), 0)
        number = -1

        def merged(h: np.ndarray, words: list[np.ndarray], sums: list[np.ndarray]) -> pa.RecordBatch | None:
            files.add(hash=h, **dict(zip(numbers, sums)))
            count = sums[0]
            stats["grams"] += int((count > 0).sum())
            stats["count"] += int(count.sum())
            stats["raw"] += int((count if level == order else sums[-1]).sum())
            for k in range(1, 5):
                stats[f"n{k}"] += int((count == k).sum())
            if level == 1:
                return None
            real = count > 0
            count, raw = count[real], (count if level == order else sums[-1])[real]
            w = [x[real] for x in words]
            zero = np.zeros(len(count), np.int64)
            suffix = [np.where(w[1] == START, count, 1), zero, zero, zero, zero, raw]
            history = [zero, count, (count == 1).astype(np.int64), (count == 2).astype(np.int64), (count > 2).astype(np.int64), zero]
            both = [np.concatenate([a, b]) for a, b in zip(w[1:], w[:-1])]
            heads, totals = _sum_by(joint_hash(both), [np.concatenate([a, b]) for a, b in zip(suffix, history)])
            return pa.RecordBatch.from_arrays([*(pa.array(x[heads].view(np.int64)) for x in both), *(pa.array(t) for t in totals)], [*below, *NUMBERS])

        held: list[tuple[list[np.ndarray], list[np.ndarray]]] = []

        def flush(last: bool) -> pa.RecordBatch | None:
            words = [np.concatenate([x[0][k] for x in held]) for k in range(level)]
            sums = [np.concatenate([x[1][k] for x in held]) for k in range(len(numbers))]
            h = joint_hash(words)
            head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            done = len(h) if last else int(head[-1])  # the last n-gram may go on
            held.clear()
            if not last:
                held.append(([w[done:] for w in words], [s[done:] for s in sums]))
                head = head[:-1]
            if not len(head):
                return None
            return merged(h[head], [w[head] for w in words], [np.add.reduceat(s[:done], head) for s in sums])

        for batch in batches:
            if not batch.num_rows:
                continue
            words = [batch.column(k).to_numpy().view(np.uint64) for k in range(level)]
            if files is None:
                number = int(joint_hash([w[:1] for w in words])[0]) >> (64 - bits)
                files = _Files(f"{folder}/level-{level}/{number}", ("hash", *numbers))
            held.append((words, [batch.column(level + k).to_numpy() for k in range(len(numbers))]))
            if sum(len(x[1][0]) for x in held) >= MERGED and (out := flush(False)) is not None:
                yield out
        if held and (out := flush(True)) is not None:
            yield out
        if files is not None:
            files.close(stats)

    dealt = rows.repartitionById(1 << bits, _range(names, bits))
    h = F.col(names[0]) if level == 1 else F.xxhash64(*names)
    schema = ", ".join(f"{n} long" for n in ((*below, *NUMBERS) if level > 1 else ("w1",)))
    return dealt.withColumn("h", h).sortWithinPartitions("h").select(*names, *numbers).mapInArrow(run, schema)


@contextmanager
def _released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the query that made them has ended, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def train(texts: DataFrame, folder: str, order: int = 2) -> dict:
    """Count the texts (column text), write the model below folder, and return what it says of itself.  order: 2 or more.

    The n-grams of the highest order, by far the most, are counted in PASSES, each over all texts for its part of the ranges, so that only a part of them is shuffled at a time.
    """
    spark = texts.sparkSession
    bits = max(1, (partitions(spark) - 1).bit_length())
    texts = texts.select(F.col("text").cast("string").alias("text"))
    rows = None
    with _released(spark):
        for level in range(order, 0, -1):
            below = f"{folder}/rows-{level - 1}"
            for number in range(PASSES if rows is None else 1):
                given = _counted(texts, order, bits, number) if rows is None else rows
                made = _level(given, folder, level, order, bits)
                made.write.mode("append").option("compression", "zstd").parquet(below)
            rows = spark.read.schema(made.schema).parquet(below)
    return _describe(folder, order, bits)


def _describe(folder: str, order: int, bits: int) -> dict:
    """Sums over the ranges of each level: one small file for each is read."""
    system, place = _open(folder)
    system.create_dir(place, recursive=True)
    levels = []
    for level in range(1, order + 1):
        ranges, total = {}, dict.fromkeys(("n1", "n2", "n3", "n4", "grams", "count", "raw"), 0)
        for number in range(1 << bits):
            at = f"{place}/level-{level}/{number}/told.json"
            if system.get_file_info(at).type.name != "File":
                continue
            with system.open_input_stream(at) as f:
                said = json.loads(f.read())
            ranges[str(number)] = {"rows": said["rows"], "kinds": said["kinds"]}
            total = {k: v + said[k] for k, v in total.items()}
        levels.append(total | {"ranges": ranges, "discounts": discounts(*(total[f"n{k}"] for k in range(1, 5)))})
    model = {"folder": folder, "order": order, "bits": bits, "levels": levels, "tokens": levels[0]["raw"], "words": levels[0]["grams"]}
    with system.open_output_stream(f"{place}/model.json") as out:
        out.write(json.dumps(model).encode())
    return model


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What counts of 1, 2 and more lose, by Chen and Goodman's estimate; FALLBACK if a count of counts is zero or a discount is not between 0 and its count."""
    if not (n1 and n2 and n3):
        return list(FALLBACK)
    y = n1 / (n1 + 2 * n2)
    found = [k - (k + 1) * y * b / a for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return found if all(0 <= d <= k for k, d in enumerate(found, 1)) else list(FALLBACK)


class Model:
    """A model's arrays.  Those of a range are mapped while it is searched and let go then, so a worker holds the pages of one range, however large the model."""

    def __init__(self, told: dict):
        self.told, self.order, self.bits = told, told["order"], told["bits"]
        self.system, self.place = _open(told["folder"])
        self.known: dict[str, str] = {}
        self.fetched = ""

    def _arrays(self, level: int, number: int, columns: tuple[str, ...]) -> dict[str, np.ndarray] | None:
        about = self.told["levels"][level - 1]["ranges"].get(str(number))
        if about is None:
            return None
        return {c: np.memmap(self._local(f"level-{level}/{number}/{c}"), dtype=np.dtype(about["kinds"][c]), mode="r", shape=(about["rows"],)) for c in columns}

    def _local(self, name: str) -> str:
        if self.system.type_name == "local":
            return f"{self.place}/{name}"
        if not self.fetched:
            import tempfile

            self.fetched = tempfile.mkdtemp()  # a copy for this worker alone
        if name in self.known:
            return self.known[name]
        at = self.known[name] = f"{self.fetched}/{name.replace('/', '-')}"
        with self.system.open_input_stream(f"{self.place}/{name}") as read, open(at, "wb") as out:
            while part := read.read(8 * MERGED):
                out.write(part)
        return at

    def find(self, level: int, hashes: np.ndarray, numbers: tuple[str, ...]) -> list[np.ndarray]:
        """The numbers of each hash, zero for those that the level lacks."""
        asked, back = np.unique(hashes, return_inverse=True)
        out = [np.zeros(len(asked), np.int64) for _ in numbers]
        number = (asked >> np.uint64(64 - self.bits)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True]) if len(asked) else np.zeros(1, np.int64)
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            arrays = self._arrays(level, int(number[begin]), ("hash", *numbers))
            if arrays is None:
                continue
            at = np.minimum(np.searchsorted(arrays["hash"], asked[begin:end]), len(arrays["hash"]) - 1)
            met = arrays["hash"][at] == asked[begin:end]
            for o, name in zip(out, numbers):
                o[begin:end][met] = arrays[name][at[met]]
            del arrays
        return [o[back] for o in out]

    def _left(self, level: int, count: np.ndarray) -> np.ndarray:
        """Counts less their discounts."""
        d = np.array([0.0, *self.told["levels"][level - 1]["discounts"]])
        return np.maximum(count - d[np.minimum(count, 3)], 0.0)

    def probabilities(self, row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, times in the training texts) of the tokens at given places of a padded row."""
        count, raw = self.find(1, row[at], ("count", "raw"))
        below = self.told["levels"][0]
        total, (d1, d2, d3) = below["count"], below["discounts"]
        even = 1.0 / (self.told["words"] + 1)
        mass = d1 * below["n1"] + d2 * below["n2"] + d3 * (below["grams"] - below["n1"] - below["n2"])
        p = (self._left(1, count) + mass * even) / total if total else np.full(len(at), even)
        for level in range(2, self.order + 1):
            gram = [row[at - level + 1 + k] for k in range(level)]
            (count,) = self.find(level, joint_hash(gram), ("count",))
            total, *follow = self.find(level - 1, joint_hash(gram[:-1]), ("total", "ones", "twos", "more"))
            mass = sum(d * n for d, n in zip(self.told["levels"][level - 1]["discounts"], follow))
            p = np.where(total > 0, (self._left(level, count) + mass * p) / np.maximum(total, 1), p)
        return p, raw


def is_held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each row by a trained model."""
    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    n, v = model["tokens"], model["words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = WordHashes(), Model(model)
        for batch, texts in _texts(batches, 1):
            if not texts:
                continue
            row, at = _padded(texts, words, own.order)
            p, raw = own.probabilities(row, at)
            heads = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            sums = [np.add.reduceat(x, heads) for x in ((raw > 0).astype(np.int64), np.log10((raw + 1) / (n + v + 1)), np.log10(p))]
            lengths = np.diff(np.r_[heads, len(at)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *map(pa.array, sums)], names)

    return kept.mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def scored(docs: DataFrame, training: Column, order: int = 2) -> DataFrame:
    """scores() of all docs by a model of those for which training holds, with its number of tokens as train_tokens."""
    work = Workspace(docs.sparkSession, "ngrams")
    model = train(docs.filter(training), f"{work.path}/model", order)
    return scores(docs, model).withColumn("train_tokens", F.lit(model["tokens"]).cast("long"))
