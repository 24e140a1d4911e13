import datetime as dt
import hashlib
import math
import zlib
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pitchline.llm import erasure, queries
from pitchline.llm.common import Workspace

from .conftest import DATA


def first_key(row):
    return tuple((x is not None, x) for x in row)


def crc(x):
    return zlib.crc32(b"" if x is None else str(x).encode())


def brute(tables):
    """Files of the contract from (columns, rows) of each table."""
    at = {t: {c: i for i, c in enumerate(cols)} for t, (cols, _) in tables.items()}
    col = lambda t, row, c: row[at[t][c]]
    owner = {}
    for r in tables["sales"][1]:
        s, c = col("sales", r, "sale_id"), col("sales", r, "client_id")
        if s is not None and c is not None:
            owner[s] = min(owner.get(s, c), c)
    clients = tables["clients"][1]
    clicks = Counter(col("clicks", r, "client_id") for r in tables["clicks"][1])
    owned = {(col("clients", r, "master_id"), col("clients", r, "client_id")) for r in clients if col("clients", r, "master_id") is not None}
    busy = Counter()
    for m, c in owned:
        busy[m] += clicks[c] if c is not None else 0
    masters = {m for m, _ in owned if crc(m) % 200 == 0} | ({min(busy, key=lambda m: (-busy[m], m))} if busy else set())
    gone_clients = {col("clients", r, "client_id") for r in clients if col("clients", r, "master_id") in masters} - {None}
    gone_sales = {col("sales", r, "sale_id") for r in tables["sales"][1] if col("sales", r, "client_id") in gone_clients} - {None}
    victim = {
        "clients": lambda r: col("clients", r, "master_id") in masters,
        "clicks": lambda r: col("clicks", r, "client_id") in gone_clients,
        "sales": lambda r: col("sales", r, "client_id") in gone_clients,
        "sale_lines": lambda r: col("sale_lines", r, "sale_id") in gone_sales,
    }
    out = {}
    for t, (cols, rows) in tables.items():
        place = (lambda r: owner.get(col(t, r, "sale_id"))) if t == "sale_lines" else (lambda r, t=t: col(t, r, "client_id"))
        rows = sorted(rows, key=lambda r: (crc(place(r)), first_key(r)))
        size = 1 + len(rows) // 250
        for n in range(0, -(-len(rows) // size)):
            part = rows[n * size : (n + 1) * size]
            kept = [r for r in part if not victim[t](r)]
            if not kept:
                continue
            money = [col(t, r, erasure.MONEY[t]) for r in kept]
            cents = sum(math.floor(100 * x + 0.5) for x in money if x is not None and math.isfinite(x))
            ids = hashlib.sha256(",".join("" if r[0] is None else str(r[0]) for r in kept).encode()).hexdigest()
            out[t, n] = (len(kept), len(part) - len(kept), cents, len(kept) < len(part), ids, ",".join(cols), kept)
    return out


def check(df, tables):
    got = {(r.table_name, r.file_no): r for r in df.collect()}
    want = brute(tables)
    assert got.keys() == want.keys()
    for k, r in got.items():
        n, gone, cents, rewritten, ids, cols, kept = want[k]
        assert (r.n_rows, r.n_erased, r.cents, r.rewritten, r.ids_sha256, r.columns) == (n, gone, cents, rewritten, ids, cols)
    folders = {Path(urlparse(r.path).path).parents[1] for r in got.values()}
    on_disk = {p for f in folders for p in f.rglob("*.parquet")}
    assert on_disk == {Path(urlparse(r.path).path) for r in got.values()}
    for r in got.values():
        file = pq.ParquetFile(urlparse(r.path).path)
        n, _, _, _, _, cols, kept = want[r.table_name, r.file_no]
        assert ",".join(file.schema_arrow.names) == cols and file.metadata.num_rows == n
        first = [x[0] for x in kept if x[0] is not None]
        stats = file.metadata.row_group(0).column(0).statistics
        if first and file.metadata.num_row_groups == 1:
            assert (stats.min, stats.max) == (min(first), max(first))
    return got


def test_the_shop_equals_brute_force(spark):
    tables = {}
    for t in erasure.MONEY:
        df = spark.read.parquet(f"{DATA}/{t}.parquet")
        tables[t] = (df.columns, [tuple(r) for r in df.collect()])
    got = check(queries.op11_erasure(spark, DATA), tables)
    assert any(r.rewritten for r in got.values()) and not all(r.rewritten for r in got.values())


def shop(spark, clients, clicks, sales, lines):
    day = dt.datetime(2024, 1, 1)
    schemas = {
        "clients": "client_id long, master_id long, name string, balance double, file_no int, n int, at string",
        "clicks": "click_id long, ts timestamp, client_id long, value double, row string, gone boolean, path string",
        "sales": "sale_id long, client_id long, total double, first int, place long, key0 string",
        "sale_lines": "sale_id long, line_no int, amount double, sale long, client long, FILE_NO int",
    }
    rows = {
        "clients": [(*c, None, 1, "x") for c in clients], "clicks": [(i, day, c, v, None, None, "p") for i, c, v in clicks],
        "sales": [(*s, None, 2, "k") for s in sales], "sale_lines": [(*x, None, 3, 4) for x in lines],
    }
    return {t: spark.createDataFrame(rows[t], schemas[t]) for t in erasure.MONEY}


def test_odd_rows_and_clashing_names(spark):
    hot = next(i for i in range(10_000) if zlib.crc32(str(i).encode()) % 200 == 0)
    clients = [(1, 1, "a", 1.005), (2, 1, None, None), (3, 2, "c", -0.125), (3, 2, "c", -0.125), (None, 2, "d", 5.0), (4, None, "e", 1.0), (None, None, None, None), (5, hot, "f", 2.0), (6, 7, "g", float("nan"))]
    clicks = [(i, [1, 2, None, 9, 3][i % 5], i / 7) for i in range(600)] + [(None, 1, None)] * 3 + [(7, 1, float("inf"))]
    sales = [(10, 1, 5.0), (11, 3, None), (11, 5, 2.0), (12, None, 1.0), (None, 1, 3.0), (13, 6, 4.5), (13, 6, 4.5), (14, 5, 0.0)]
    lines = [(s, n, n * 1.115) for s in (10, 11, 12, 13, 14, 99, None) for n in range(40)] + [(10, 1, None)] * 5
    frames = shop(spark, clients, clicks, sales, lines)
    tables = {t: (df.columns, [tuple(r) for r in df.collect()]) for t, df in frames.items()}
    for rows in tables.values():  # NaN compares with nothing: give it the place Spark gives it, after all numbers
        rows[1][:] = [tuple(float("inf") if isinstance(x, float) and math.isnan(x) else x for x in r) for r in rows[1]]
    check(erasure.erased_shop(spark, frames), tables)


def test_empty_tables_and_total_erasure(spark):
    frames = shop(spark, [], [], [], [])
    assert erasure.erased_shop(spark, frames).collect() == []
    frames = shop(spark, [(1, 1, "a", 1.0)], [(1, 1, 1.0)], [(1, 1, 1.0)], [(1, 1, 1.0)])
    assert erasure.erased_shop(spark, frames).collect() == []
    frames = shop(spark, [(1, None, "a", 1.0)], [(1, 1, 1.0)], [(1, 1, 1.0)], [(1, 1, 1.0)])
    assert {(r.table_name, r.n_rows, r.rewritten) for r in erasure.erased_shop(spark, frames).collect()} == {(t, 1, False) for t in erasure.MONEY}


def reachable(rows, edges, seeds):
    """All keys to erase, one row at a time."""
    known = {p: set(k) for p, k in seeds.items()}
    wanted = {(e.parent, e.key) for e in edges}
    grew = True
    while grew:
        grew = False
        for e in edges:
            for row in rows.get(e.child, []):
                if row[e.column] is not None and row[e.column] in known.get((e.parent, e.key), ()):
                    for place in (p for p in wanted if p[0] == e.child):
                        k = row[place[1]]
                        if k is not None and k not in known.setdefault(place, set()):
                            known[place].add(k)
                            grew = True
    return {p: k for p, k in known.items() if k}


@pytest.mark.parametrize("seed", range(3))
def test_cycles_self_references_and_several_parents(spark, seed):
    import random

    rng = random.Random(seed)
    node = lambda: rng.choice([None, *range(40)])
    rows = {"a": [{"id": i, "up": node(), "b": node()} for i in range(40)], "b": [{"id": i, "a": node(), "a2": node()} for i in range(40)]}
    tables = {"a": spark.createDataFrame([tuple(r.values()) for r in rows["a"]], "id long, up long, b long"), "b": spark.createDataFrame([tuple(r.values()) for r in rows["b"]], "id long, a long, a2 long")}
    edges = [erasure.Edge("a", "up", "a", "id"), erasure.Edge("a", "b", "b", "id"), erasure.Edge("b", "a", "a", "id"), erasure.Edge("b", "a2", "a", "id")]
    seeds = {("a", "id"): {3}, ("b", "id"): {5, 6}}
    frames = {p: spark.createDataFrame([(k,) for k in ks], "x long") for p, ks in seeds.items()}
    found = erasure.frontier(Workspace(spark, "test"), tables, edges, frames)
    got = {p: sorted(r.k for r in df.collect()) for p, df in found.items()}
    assert got == {p: sorted(k) for p, k in reachable(rows, edges, seeds).items()}


def test_a_chain_is_followed_to_its_end(spark):
    table = spark.range(30).select(F.col("id"), (F.col("id") - 1).alias("up"))
    found = erasure.frontier(Workspace(spark, "test"), {"t": table}, [erasure.Edge("t", "up", "t", "id")], {("t", "id"): spark.createDataFrame([(20,)], "x long")})
    assert sorted(r.k for r in found["t", "id"].collect()) == list(range(20, 30))
