"""Near duplicates by SimHash and covering locality-sensitive hashing.

A document's fingerprint has 64 bits.  Two fingerprints are linked if they differ in at most
RADIUS = 3 bits; a component is what links join.

Covering masks: each of the 64 bits gets a non-zero label of RADIUS + 1 = 4 bits, and each
non-zero v of 4 bits gives the mask of the bits whose label has odd overlap with v.  The labels
of any 3 differing bits span at most 3 of 4 dimensions, so some v is orthogonal to all of them
and its mask holds none of the differing bits: every pair within the radius collides under one
of the 15 masks, and each mask still compares about 34 bits.

A bucket (mask, masked bits) is read as a sorted stream.  Up to BUCKET fingerprints are joined in
memory.  A larger bucket streams on to a second covering of the bits that its mask leaves
free: 15 finer masks leave at most 16 bits free, so no bucket of that level can hold more than
2**16 different fingerprints, whatever the data.  Only a spanning forest of a bucket's links is
emitted, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, by_text, partitions

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of a bucket that are compared in memory at the first level (64 KB).
BUCKET = 8192


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    """The SimHash of a text, as a signed 64-bit integer; zero if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    join = b" ".join
    shingles = map(join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else (join(words),)
    count = max(1, len(words) - k + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype=">u8", count=count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 4096):
        part = hashes[at : at + 4096]
        ones += np.unpackbits(part.view(np.uint8)).reshape(len(part), 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > count).view(">i8")[0])


def covering(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit places such that any radius of them miss one mask altogether."""
    n = 1 << (radius + 1)
    labels = {b: i % (n - 1) + 1 for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (labels[b] & v).bit_count() & 1) for v in range(1, n)]


MASKS = covering(list(range(64)))
#: For each mask, the masks of the second level: its own bits and a covering of the rest.
FINER = [[m | c for c in covering([b for b in range(64) if not m >> b & 1])] for m in MASKS]
#: Bits that a second-level mask may leave free.
FREE = 16
assert max(64 - f.bit_count() for fs in FINER for f in fs) <= FREE


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(values: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """(smallest of the component, member) for each linked member of different fingerprints.

    A breadth-first search that compares each reached value with those not reached yet: as a dense
    group is reached at once, its pairs are not enumerated.
    """
    left = np.sort(values)
    while len(left) > 1:
        found, queue, left = [left[0]], [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            # unsigned: of signed values the bits of the absolute value would be counted
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= radius
            if near.any():
                new = left[near]
                left = left[~near]
                found.extend(new)
                queue.extend(new)
        if len(found) > 1:
            low = min(found)
            yield from ((int(low), int(x)) for x in found if x != low)


def _joined(keyed: DataFrame, level: int) -> DataFrame:
    """keyed: bucket, value, mask_no.  Rows kind 0 (low, member): links; kind 1 (value, mask_no): members of a bucket too large here."""
    names = ["kind", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, count, large = None, [], 0, False

        def close() -> list[tuple[int, int, int]]:
            return [(0, a, b) for a, b in forest(np.concatenate(held).view(np.int64))] if count > 1 and not large else []

        def out(rows: list) -> pa.RecordBatch:
            cols = zip(*rows) if rows else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64()))], names)

        rows: list = []
        for batch in batches:
            buckets, values, numbers = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(values):
                continue
            edges = np.flatnonzero((buckets[1:] != buckets[:-1]) | (numbers[1:] != numbers[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(values)]):
                this = (buckets[lo], numbers[lo])
                if this != key:
                    rows += close()
                    key, held, count, large = this, [], 0, False
                held.append(values[lo:hi])
                count += hi - lo
                if level == 1 and count > BUCKET:
                    large = True
                if large:
                    rows += [(1, int(v), int(this[1])) for part in held for v in part]
                    held = []
                if len(rows) > 50_000:
                    yield out(rows)
                    rows = []
        rows += close()
        yield out(rows)

    n = partitions(keyed.sparkSession)
    dealt = keyed.select("bucket", "value", "mask_no").repartition(n, "mask_no", "bucket").sortWithinPartitions("mask_no", "bucket")
    return dealt.mapInArrow(run, "kind int, a long, b long")


def links(values: DataFrame, work: Workspace) -> DataFrame:
    """values: different fingerprints (column value).  A forest (a < b) that joins what links join."""
    spark = values.sparkSession
    masks = F.array(*(F.struct(F.lit(i).alias("mask_no"), F.lit(signed(m)).alias("mask")) for i, m in enumerate(MASKS)))
    keyed = values.select("value", F.explode(masks).alias("m")).select("value", "m.mask_no", F.col("value").bitwiseAND(F.col("m.mask")).alias("bucket"))
    first = work.save(_joined(keyed, 1), "links1")
    edges = first.filter("kind = 0").select("a", "b")
    if not first.filter("kind = 1").isEmpty():
        finer = [(i, i * 16 + j, signed(m)) for i, ms in enumerate(FINER) for j, m in enumerate(ms)]
        rest = F.broadcast(spark.createDataFrame(finer, "old int, mask_no int, mask long"))  # 225 rows
        hot = first.filter("kind = 1").select(F.col("a").alias("value"), F.col("b").alias("old")).join(rest, "old")
        second = work.save(_joined(hot.select("value", "mask_no", F.col("value").bitwiseAND(F.col("mask")).alias("bucket")), 2), "links2")
        edges = edges.unionByName(second.filter("kind = 0").select("a", "b"))
    return edges.filter("a < b").distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(value, root) of every end of an edge, root the smallest value reachable.

    Large and small stars in turn (Kiveris et al., Connected Components in MapReduce and Beyond): a large star links each
    larger neighbour of a value to the smallest one near it, a small star each smaller neighbour.  Both keep what is
    connected, and rounds grow with the logarithm of the values, not with the length of a chain.  Edges are rows (u, v), u > v;
    a table in the shared folder ends each step's lineage, and the driver sees a checksum of it alone.
    """
    state = work.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "star0")
    before, step = _checksum(state), 0
    while True:
        step += 1
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = work.save(both.groupBy("u").agg(F.least("u", F.min("v")).alias("low")), f"low{step}")
        # every value v with a neighbour u: v > u hangs on the lowest near u
        large = state.select(F.col("v").alias("of"), F.col("u").alias("end")).unionByName(state.select(F.col("u").alias("of"), F.col("u").alias("end")))
        large = large.join(lows, F.col("of") == lows["u"]).select(F.col("end").alias("u"), F.col("low").alias("v")).filter("u > v").distinct()
        large = work.save(large, f"large{step}")
        lows = work.save(large.groupBy("u").agg(F.min("v").alias("low")), f"least{step}")
        small = large.join(lows, "u").filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        new = work.save(small.unionByName(lows.select("u", F.col("low").alias("v"))).distinct(), f"star{step}")
        for name in (f"low{step}", f"large{step}", f"least{step}", f"star{step - 1}"):
            work.drop(name)
        after = _checksum(new)
        state = new
        if after == before:
            return state.select(F.col("u").alias("value"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("value"), F.col("v").alias("root")).distinct())
        before = after


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of docs.

    Null texts, empty texts and texts of white space alone have the fingerprint zero and are linked
    with one another.  Rows that share a doc_id are each returned.  A null doc_id is never the
    smallest of a component unless all its doc_ids are null.  Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "simhash")
    prints = work.save(by_text(docs, lambda t: (fingerprint(t),), "value long"), "prints")
    firsts = work.save(prints.groupBy("value").agg(F.min("doc_id").alias("first")), "firsts")
    roots = components(links(firsts.select("value"), work), work)
    joined = firsts.join(roots, "value")  # only linked fingerprints
    lows = joined.groupBy("root").agg(F.min("first").alias("low"))
    linked = joined.join(lows, "root").select("value", "low")
    # saved before the join: Spark splits a hot fingerprint only where both sides come as they were dealt
    labels = work.save(firsts.join(linked, "value", "left").select("value", F.coalesce("low", "first").alias("component_id")), "labels")
    work.only("prints", "labels")
    return prints.join(labels, "value").select("doc_id", F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id")


def text_digest() -> Column:
    """A text's MD5; null counts as empty, as it does in fingerprints."""
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))


def representatives(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of the first row of each component: by doc_id, null last, then by text_digest().

    Rows of one doc_id and different texts are rows of their own.
    """
    work = Workspace(docs.sparkSession, "simhash")
    prints = by_text(docs.withColumn("digest", text_digest()), lambda t: (fingerprint(t),), "value long", ("doc_id", "digest"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    firsts = work.save(prints.groupBy("value").agg(F.min(row).alias("first")), "firsts")
    roots = components(links(firsts.select("value"), work), work)
    chosen = firsts.join(roots, "value", "left").groupBy(F.coalesce("root", "value").alias("root")).agg(F.min("first").alias("first"))
    chosen = work.save(chosen.select("first.doc_id", "first.digest"), "chosen")
    work.only("chosen")
    return chosen
