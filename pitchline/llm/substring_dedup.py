"""Repeated passages by seed and extend.

Every WINDOW = 50 consecutive words hold 43 runs of SEED = 8 words.  The run with the smallest hash
(the last one, if several tie) is the window's anchor, so windows of equal words have equal anchors
at equal places.  Consecutive windows share an anchor; what they cover together is the anchor's
span, which extends the seed both ways as far as its windows reach.

1. Documents are joined on the hashes of their anchors.
2. Where two spans are equal, all their windows repeat at once: the document with the larger id
   loses the whole span.
3. Where the spans of one anchor differ (at the ends of a repeat, or at an edit), the windows inside
   them are compared one by one, by hashes of their words that are computed again from the texts of
   just these documents.
4. What a document loses is the union of both kinds of intervals: its maximal repeats.

Whole copies of a document with a smaller id are found by a 128-bit digest first; they lose every
word and take no part in the rest.  Anchors are compared by 64-bit hash, spans by two such hashes,
windows by anchor, place and hash (over 128 bits).  Spans and windows that differ are taken for equal with a
probability under n * n / 2**129 for n spans or windows (10**-14 for a trillion); rows that share a doc_id are told apart by 64 bits of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROLL, WordHashes, Workspace, byte_texts, mix, slices, window_hashes

WINDOW = 50
SEED = 8
#: Bits of an ordering key that hold the place; ties go to the last place.
_PLACE = np.uint64((1 << 24) - 1)

_words_seen = WordHashes()


class _Powers:
    """Powers of the rolling multiplier and of its inverse, as many as the longest text needs."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def need(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up))
            for name, factor in (("up", ROLL), ("down", pow(ROLL, -1, 1 << 64))):
                a = np.full(size, factor, np.uint64)
                a[0] = 1
                with np.errstate(over="ignore"):
                    setattr(cls, name, np.multiply.accumulate(a))


def anchors(h: np.ndarray, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window, span hash) of each anchor in a text's word hashes."""
    n = len(h) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 5
    grams = window_hashes(h, seed)
    width = window - seed + 1
    least = (grams & ~_PLACE) | (_PLACE - (np.arange(len(grams), dtype=np.uint64) & _PLACE))
    done = 1
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    least = np.minimum(least[:n], least[width - done : width - done + n])
    starts = np.arange(n, dtype=np.uint64)
    place = (starts + ((_PLACE - (least & _PLACE) - starts) & _PLACE)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate(([0], cuts))
    last = np.concatenate((cuts, [n])) - 1
    at = place[first]
    _Powers.need(len(h) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _Powers.up[: len(h)], dtype=np.uint64)))
        span = (total[last + window] - total[first]) * _Powers.down[first]
        shape = ((last - first).astype(np.uint64) << np.uint64(32)) | (at - first).astype(np.uint64)
        span = mix(span ^ mix(shape + np.uint64(ROLL)))
    return grams[at].view(np.int64), at, first, last, span.view(np.int64)


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("h", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("span", pa.int64())])
    for batch in slices(batches):
        rows, found, offsets = [], [], [0]
        for text in byte_texts(batch.column(1)):
            words = text.split()
            part = anchors(_words_seen.of(words)) if len(words) >= WINDOW else None
            if part:
                found.append(part)
            offsets.append(offsets[-1] + (len(part[0]) if part else 0))
            rows.append((digest(words), len(words)))
        flat = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 5
        arrays = [pa.array(c.astype(t.type.to_pandas_dtype()), t.type) for c, t in zip(flat, kind)]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, fields=list(kind)))
        cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *cols, lists], ["doc_id", "tag", "digest", "n_words", "anchors"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each window of the spans asked for."""
    names = ["doc_id", "tag", "h", "off", "window", "start"]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
    for batch in slices(batches, 100):
        out: list[list] = [[] for _ in range(5)]
        for row, (text, spans) in enumerate(zip(byte_texts(batch.column(1)), batch.column(3))):
            hashes = window_hashes(_words_seen.of(text.split()), WINDOW).view(np.int64)
            h, at, lo, hi = (spans.values.field(i).to_numpy().astype(np.int64) for i in range(4))
            size = hi - lo + 1
            start = np.repeat(lo - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            for k, v in enumerate((np.full(len(start), row, np.int64), np.repeat(h, size), np.repeat(at, size) - start, hashes[start], start)):
                out[k].append(v)
        rows, *rest = (np.concatenate(c) if c else np.empty(0, np.int64) for c in out)
        arrays = [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(rest, types)]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), batch.column(2).take(pa.array(rows)), *arrays], names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_removed", "kept_text"]
    for batch in slices(batches, 100):
        rows = []
        for text, holes in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist()):
            words = text.split()
            if holes:
                kept, at = [], 0
                for lo, hi in sorted((x["from"], x["to"]) for x in holes):
                    kept += words[at:lo]
                    at = max(at, hi)
                kept += words[at:]
            else:
                kept = words
            rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
        cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names)


def dedup_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of each row; kept_text has the words left, one space between them.

    Null and empty texts have no words and an empty kept_text; texts under 50 words lose nothing.
    Rows sharing a doc_id do not remove words from one another.  A row whose doc_id is null neither
    loses words nor removes any; doc_id keeps its type and order.  Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "passages")
    # the tag tells rows apart that share a doc_id; rows of equal texts may share all
    source = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("tag", F.xxhash64("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    scan = source.mapInArrow(_scan, f"doc_id {kind}, tag long, digest binary, n_words int, anchors array<struct<h:long,at:int,lo:int,hi:int,span:long>>")
    scan = work.save(scan.filter(f"doc_id is not null and n_words >= {WINDOW}"), "scan")
    firsts = work.save(scan.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "firsts")
    copies = scan.join(firsts, ["doc_id", "digest"], "left_anti").select("doc_id", "tag", F.lit(0).alias("from"), F.col("n_words").alias("to"))
    marks = scan.join(firsts, ["doc_id", "digest"], "left_semi").select("doc_id", "tag", F.explode("anchors").alias("x")).select("doc_id", "tag", "x.*")
    repeats = marks.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("span").alias("s0"), F.max("span").alias("s1")).filter("low < high")
    # Counts are saved before they are joined: Spark splits a hot key only where both sides of a join come as they were dealt.
    repeats = work.save(repeats.select("h", "low", (F.col("s0") != F.col("s1")).alias("mixed")), "repeats")
    seeded = work.save(marks.join(repeats, "h"), "seeded")
    whole = [F.col("doc_id"), F.col("tag"), F.col("lo").alias("from"), (F.col("hi") + WINDOW).alias("to")]
    plain = seeded.filter("not mixed and doc_id > low").select(whole)
    # Differing spans of one seed: the first row of each span is extended window by window, others follow it.
    mixed = seeded.filter("mixed")
    lows = work.save(mixed.groupBy("h", "span").agg(F.min("doc_id").alias("span_low")), "lows")
    told = mixed.join(lows, ["h", "span"])
    follow = told.filter("doc_id > span_low").select(whole)
    ask = told.filter("doc_id = span_low").groupBy("doc_id", "tag").agg(F.collect_set(F.struct("h", "at", "lo", "hi")).alias("spans"))
    windows = source.join(ask, ["doc_id", "tag"]).select("doc_id", "text", "tag", "spans").mapInArrow(_windows, f"doc_id {kind}, tag long, h long, off int, window long, start int")
    windows = work.save(windows, "windows")
    shared = windows.groupBy("h", "off", "window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").drop("high")
    shared = work.save(shared, "shared")
    single = windows.join(shared, ["h", "off", "window"]).filter("doc_id > low").select("doc_id", "tag", F.col("start").alias("from"), (F.col("start") + WINDOW).alias("to"))
    holes = copies.unionByName(plain).unionByName(follow).unionByName(single).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("from", "to")).alias("holes"))
    told = source.join(holes, ["doc_id", "tag"], "left").select("doc_id", "text", "holes")
    return told.mapInArrow(_cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string")
