"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a pseudo-random order, are cut into blocks of BLOCK documents, and these into
quanta of QUANTUM.  Two Pfair tasks of weights a and b, W = a + b, give quantum i of a the window from its release
floor(i W / a) to its deadline ceil((i + 1) W / a), and earliest deadline first has a closed form: the heavier task's quantum
stands at slot floor((i + 1) W / a) - 1, the lighter one's at ceil((i + 1) W / b) - 2; each slot is taken once, and each
quantum within its window.  More sources are scheduled as a tree of such pairs, built from the two lightest up (Huffman):
a node's slots are the quanta of the node above.  A quantum's slot in the mix is the closed form of each node on its path
applied in turn, in whole numbers, so the schedule is a column expression and nothing is simulated.

Deviation: a pair puts a task of share x between x - 1 and x quanta ahead of its share, and a path adds these up, each
times the shares below it.  That telescopes: no source is a whole quantum behind, and none is more ahead than the sum of w / W over
its nodes.  In a tree built from the lightest up the W of a path grow at least like Fibonacci numbers, so the sum is
under 1 + 1/2 + 1/3 + 1/5 + 1/8 + ... = 2.36 quanta, less than the 4 of a block: every source stays within one block of its exact
weight, however long the schedule is.

When a source has no quantum left, the others go on in a new phase with a tree of their own, so all documents are used;
the bound holds within each phase, from its start.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Mapping
from fractions import Fraction
from math import lcm

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

#: Documents of a block and of a quantum.
BLOCK, QUANTUM = 8, 2
#: Whole weights add up to less than 2**WEIGHT_BITS, so that slots of 2**40 quanta are exact in 38 digits.
WEIGHT_BITS = 80
#: Rows of the plan that the driver writes at a time.
PLAN_ROWS = 50_000

Source = str | None
Path = list[tuple[int, int, bool]]  # (weight of the node, of the side that is taken, whether it is the heavier), from the leaf up


def temperature(sizes: Mapping[Source, int], power: float = 0.5) -> dict[Source, float]:
    """Weights in proportion to a power of the sizes: 1 keeps the corpus's own mix, 0 makes all alike."""
    return {s: n**power for s, n in sizes.items()}


def whole_weights(weights: Mapping[Source, float]) -> dict[Source, int]:
    """Whole numbers in the proportion of the weights: exactly, or to 1 part in 2**(WEIGHT_BITS - 1) of all where exact ones have more bits."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = lcm(*(w.denominator for w in exact.values()))
    total = sum(exact.values())
    if total * scale < 1 << WEIGHT_BITS:
        return {s: int(w * scale) for s, w in exact.items()}
    return {s: max(1, round(w / total * (1 << WEIGHT_BITS - 1))) for s, w in exact.items()}


def tree(weights: Mapping[Source, int]) -> tuple:
    """Nested pairs: ("leaf", weight, source), or ("pair", weight, heavier, lighter)."""
    heap: list[tuple] = [(w, i, ("leaf", w, s)) for i, (s, w) in enumerate(sorted(weights.items(), key=lambda x: (x[0] is not None, x[0] or "")))]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        (a, _, light), (b, _, heavy) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a + b, serial, ("pair", a + b, heavy, light)))
        serial += 1
    return heap[0][2]


def paths(weights: Mapping[Source, int]) -> dict[Source, Path]:
    out: dict[Source, Path] = {}
    todo: list[tuple[tuple, Path]] = [(tree(weights), [])]
    while todo:
        node, above = todo.pop()
        if node[0] == "leaf":
            out[node[2]] = above[::-1]
        else:
            todo += [(node[2], [*above, (node[1], node[2][1], True)]), (node[3], [*above, (node[1], node[3][1], False)])]
    return out


def slot_of(i: int, path: Path) -> int:
    for whole, part, heavy in path:
        i = (i + 1) * whole // part - 1 if heavy else -(-(i + 1) * whole // part) - 2
    return i


def taken_by(slots: int, path: Path) -> int:
    """How many quanta of a source stand in the first slots of the mix: slot_of() turned round."""
    for whole, part, heavy in reversed(path):
        if heavy:  # (i + 1) W / a < slots + 1
            slots = ((slots + 1) * part - 1) // whole
        else:  # (i + 1) W / b <= slots + 1
            slots = (slots + 1) * part // whole
    return slots


def planned(quanta: Mapping[Source, int], weights: Mapping[Source, float]) -> Iterator[dict]:
    """A row for each source and phase: quanta first .. first + n - 1 of the source stand at slots start + slot_of(0 ..)."""
    whole = whole_weights(weights)
    left = {s: n for s, n in quanta.items() if n > 0}
    used, start = dict.fromkeys(left, 0), 0
    while left:
        roads = paths({s: whole[s] for s in left})
        length = min(slot_of(n - 1, roads[s]) for s, n in left.items()) + 1
        taken = {s: taken_by(length, road) for s, road in roads.items()}
        for s, n in taken.items():
            if n:
                yield {"source": s, "first": used[s], "n": n, "start": start, "path": roads[s]}
                used[s] += n
        left = {s: left[s] - n for s, n in taken.items() if left[s] > n}
        start += length


_ROW = "source:string,first:long,n:long,start:long,path:array<struct<whole:decimal(38,0),part:decimal(38,0),heavy:boolean>>"


def plan_table(work: Workspace, quanta: Mapping[Source, int], weights: Mapping[Source, float]) -> DataFrame:
    """The plan as a table: a row for each source and phase, whatever the number of documents."""
    spark = work.spark
    rows: list[dict] = []

    def write() -> DataFrame:
        told = json.dumps([{**r, "path": [{"whole": a, "part": b, "heavy": h} for a, b, h in r["path"]]} for r in rows])
        df = spark.sql(f"select inline(from_json(:told, 'array<struct<{_ROW}>>'))", args={"told": told})
        df.write.mode("append").option("compression", "zstd").parquet(f"{work.path}/plan")
        return df

    df = None
    for row in planned(quanta, weights):
        rows.append(row)
        if len(rows) == PLAN_ROWS:
            df, rows = write(), []
    if rows or df is None:
        df = write()
    return work.read("plan", df)


def slot(i: Column, path: Column) -> Column:
    """slot_of() as a Column."""
    up = lambda x: (x + 1).cast("decimal(38,0)")

    def step(x: Column, node: Column) -> Column:
        # `div` of decimals is exact and gives a long
        heavy = F.call_function("div", up(x) * node["whole"], node["part"]) - 1
        light = F.call_function("div", up(x) * node["whole"] + node["part"] - 1, node["part"]) - 2
        return F.when(node["heavy"], heavy).otherwise(light)

    return F.aggregate(path, i.cast("long"), step)


def file_row(docs: DataFrame) -> list[Column]:
    """Part number, file and row of a table that is read from files: they tell equal rows apart and are the same at each reading."""
    name = docs.metadataColumn("_metadata").getField("file_name")
    part = F.coalesce(F.regexp_extract(name, "^part-([0-9]+)", 1).try_cast("long"), F.lit(0))
    return [part.alias("__part"), name.alias("__file"), docs.metadataColumn("_metadata").getField("row_index").alias("__row")]


PLACE = ("__part", "__file", "__row")


def identified(docs: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, source, the row itself as `whole`, and the columns of file_row(); what does not come from files alone is written first."""
    told = lambda d: d.select("doc_id", "source", F.struct(*(F.col(f"`{c}`") for c in d.columns)).alias("whole"), *file_row(d))
    try:
        return told(docs)
    except AnalysisException:  # not read from files
        return told(work.save(docs, "given"))


Weights = Mapping[Source, float] | Callable[[Mapping[Source, int]], Mapping[Source, float]]


def places(docs: DataFrame, weights: Weights, block: int = BLOCK, quantum: int = QUANTUM) -> DataFrame:
    """doc_id and source of each row with __part, __file and __row, and where it stands: block, slot and place in the quantum.

    docs comes from identified().  Texts are not read.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "mixing")
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), *PLACE, F.xxhash64("doc_id").alias("draw"), F.xxhash64("doc_id", *PLACE).alias("salt"))
    sizes = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}  # the weights are by source, so the driver knows the sources
    share = weights(sizes) if callable(weights) else weights
    if missing := [s for s in sizes if not share.get(s, 0) > 0]:
        raise ValueError(f"sources without a positive weight: {missing[:5]}")
    plan = plan_table(work, {s: -(-n // quantum) for s, n in sizes.items()}, {s: share[s] for s in sizes})
    # Rank within a source without bringing it together: by ranges of the draw, then within each range.  The largest source has as
    # many ranges as it has documents in each of them, about, so neither the ranges nor a range grow faster than its root.
    top = lambda c, bits: F.shiftrightunsigned(c, 64 - bits) if bits else F.lit(0).cast("long")
    largest = max(sizes.values(), default=0)
    bits = (largest.bit_length() + 1) // 2
    cell = rows.withColumn("range", top("draw", bits))
    counted = work.save(cell.groupBy("source", "range").agg(F.count("*").alias("n")), "ranges")
    # rows that share a doc_id share a draw: where they fill a range, all ranges are cut again by a hash of the rows themselves
    most = counted.agg(F.max("n")).first()[0] or 0
    again = (most // (4 * max(1, largest >> bits))).bit_length()
    key = ["source", "range", "cut"]
    cell = cell.withColumn("cut", top("salt", again))
    if again:
        counted = work.save(cell.groupBy(key).agg(F.count("*").alias("n")), "cuts")
    else:
        counted = counted.withColumn("cut", F.lit(0).cast("long"))
    before = counted.select(*key, (F.sum("n").over(Window.partitionBy("source").orderBy("range", "cut")) - F.col("n")).alias("before"))
    before = work.save(before, "before")
    within = F.row_number().over(Window.partitionBy(key).orderBy("draw", "doc_id", "salt", *PLACE)) - 1
    told = cell.withColumn("within", within).alias("r").join(before.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.range") == F.col("b.range")) & (F.col("r.cut") == F.col("b.cut")))
    ranked = told.select("doc_id", F.col("r.source").alias("source"), *PLACE, (F.col("within") + F.col("before")).alias("rank"))
    q = F.floor(F.col("rank") / quantum)
    on = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("q") >= F.col("first")) & (F.col("q") < F.col("first") + F.col("n"))
    # a row for each source and phase, so the join is by the source and a range of few rows
    met = ranked.withColumn("q", q).alias("d").join(plan.alias("p"), on)
    at = F.col("start") + slot(F.col("q") - F.col("first"), F.col("path"))
    return met.select("doc_id", F.col("d.source").alias("source"), *PLACE, F.floor(F.col("rank") / block).alias("block"), at.alias("slot"), (F.col("rank") % quantum).alias("place"))


def mix(docs: DataFrame, weights: Weights = temperature, block: int = BLOCK, quantum: int = QUANTUM) -> DataFrame:
    """doc_id, source, block, slot and place of each row: the mix is in the order of slot, then place.

    weights: by source, or a function from the sizes to that; all must be positive.  Null is a source of its
    own.  Each row has a slot and place of its own, also rows that are equal, share a doc_id or have none.  An empty
    table gives no rows.  Other columns are not read.
    """
    return places(identified(docs.select("doc_id", "source"), Workspace(docs.sparkSession, "rows")), weights, block, quantum).drop(*PLACE)


def mixed_documents(docs: DataFrame, weights: Weights = temperature) -> DataFrame:
    """docs' rows and columns in the order of their slots: sorted ranges, so that files written follow the mix.

    Places are found from ids and sources alone and joined to the rows by file and row, so texts are moved twice and not
    more.  Rows that are equal, share a doc_id or have none are each kept, as are columns of any name.
    """
    work = Workspace(docs.sparkSession, "rows")
    known = identified(docs, work)
    where = places(known, weights).select(*(F.col(c).alias(f"of{c}") for c in PLACE), F.col("slot").alias("__slot"), F.col("place").alias("__place"))
    rows = known.select("whole", *PLACE).join(where, [F.col(c) == F.col(f"of{c}") for c in PLACE])
    return rows.repartitionByRange("__slot", "__place").sortWithinPartitions("__slot", "__place").select("whole.*")
