"""What the corpus operators share: tables in the shared folder and Arrow batches of texts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import Workspace  # noqa: F401  (the operators' tables)

#: Rows of one slice of an Arrow batch that is held as Python objects at a time.
SLICE_ROWS = 500


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file on this machine, of its name or of a path: workers resolve it, each on its own."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, empty for null."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_text(docs: DataFrame, row: Callable[[bytes], tuple], schema: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """columns, then row(UTF-8 of the text) under schema, for each document; no shuffle."""
    kept = docs.select(*columns, F.col("text").cast("string").alias("text"))
    out = ", ".join([*(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in columns), schema])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [row(t) for t in byte_texts(batch.column(len(columns)))]
            fields = [pa.array(c, type=t) for c, t in zip(zip(*made), types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], *fields], names)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(out))
    names, types = arrow.names, arrow.types[len(columns) :]
    return kept.mapInArrow(rows, out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads each bit over all (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> its 64-bit XXH64, for up to LIMIT words."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:  # frequent words come early: the later half goes
            for k in list(islice(self, self.LIMIT // 2, None)):
                del self[k]
        h = self[word] = xxhash.xxh64_intdigest(word, 0)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


#: Odd multiplier of the rolling polynomial over word hashes.
ROLL = 0x9E3779B97F4A7C15


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """One hash for each k consecutive word hashes, by doubling: log2(k) passes over the array."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, width = None, 0, h, 1
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                part = power[done : done + n]
                out = part.copy() if out is None else mix(out * np.uint64(ROLL) + part)
                done += width
            if done == k:
                return out
            power = mix(power[: len(power) - width] * np.uint64(ROLL) + power[width:])
            width *= 2
