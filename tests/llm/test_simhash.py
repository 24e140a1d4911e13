import itertools
import random
import re

import numpy as np
import xxhash

from pitchline.llm import simhash_dedup as s
from pitchline.llm.common import Workspace

from .conftest import key, table

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    prints = [fingerprint(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    different = {}
    for i, p in enumerate(prints):
        parent[i] = root(different.setdefault(p, i))
    for a, b in itertools.combinations(different, 2):
        if (a ^ b).bit_count() <= 3:
            parent[root(different[a])] = root(different[b])
    low = {}
    for i, (d, *_) in enumerate(rows):
        r = root(i)
        low[r] = d if low.get(r) is None else min(low[r], low[r] if d is None else d)
    return sorted(((d, f"{p:016x}", low[root(i)]) for i, ((d, *_), p) in enumerate(zip(rows, prints))), key=key)


def test_documents(documents, rows):
    assert table(s.near_duplicates(documents), "doc_id", "fingerprint", "component_id") == brute(rows)


def test_odd_rows(odd, odd_rows, empty):
    assert table(s.near_duplicates(odd), "doc_id", "fingerprint", "component_id") == brute(odd_rows)
    assert s.near_duplicates(empty).count() == 0


def test_every_pair_within_the_radius_collides():
    rng = random.Random(1)
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(flips & m == 0 for m in s.MASKS)
        assert all(any(flips & f == 0 for f in s.FINER[i]) for i, m in enumerate(s.MASKS) if flips & m == 0)


def groups(edges, values):
    near = {v: {v} for v in values}
    for a, b in edges:
        joined = near[a] | near[b]
        for x in joined:
            near[x] = joined
    return {frozenset(x) for x in near.values()}


def test_large_buckets_go_to_the_second_level(spark, monkeypatch):
    rng = random.Random(2)
    centre = rng.getrandbits(63)
    values = sorted({centre ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 6))) for _ in range(500)} | {rng.getrandbits(63) for _ in range(100)})
    df = spark.createDataFrame([(v,) for v in values], "value long")
    want = groups([(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3], values)
    plain = groups([tuple(r) for r in s.links(df, Workspace(spark, "t")).collect()], values)
    monkeypatch.setattr(s, "BUCKET", 4)
    # the limit is read where the task runs, so the function is sent with it
    import pyspark.cloudpickle as pickle

    pickle.register_pickle_by_value(s)
    try:
        finer = groups([tuple(r) for r in s.links(df, Workspace(spark, "t")).collect()], values)
    finally:
        pickle.unregister_pickle_by_value(s)
    assert plain == want and finer == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1001)], "a long, b long")
    got = dict(tuple(r) for r in s.components(edges, Workspace(spark, "t")).collect())
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_rounds_do_not_grow_with_the_chain(spark, monkeypatch):
    rng = random.Random(6)
    labels = rng.sample(range(1 << 40), 6000)
    path = list(zip(labels, labels[1:3000])) + list(zip(labels[3000:], labels[3001:]))
    star = [(labels[0], (1 << 41) + i) for i in range(500)]
    edges = spark.createDataFrame([(min(e), max(e)) for e in path + star], "a long, b long").repartition(8)
    saved = []
    monkeypatch.setattr(Workspace, "save", lambda self, df, name, save=Workspace.save: saved.append(name) or save(self, df, name))
    got = dict(tuple(r) for r in s.components(edges, Workspace(spark, "t")).collect())
    low, other = min(labels[:3000]), min(labels[3000:])
    assert got == dict.fromkeys([*labels[:3000], *(x for _, x in star)], low) | dict.fromkeys(labels[3000:], other)
    assert sum(name.startswith("star") for name in saved) <= 14


def test_forest_joins_what_is_linked():
    rng = np.random.default_rng(3)
    v = np.unique(rng.integers(0, 1 << 12, 300)).astype(np.int64)
    want = groups([(a, b) for a, b in itertools.combinations(v.tolist(), 2) if (a ^ b).bit_count() <= 3], v.tolist())
    assert groups(s.forest(v), v.tolist()) == want


def test_forest_counts_all_64_bits():
    rng = random.Random(4)
    top = 1 << 63
    links = [(x, x ^ top ^ sum(1 << b for b in rng.sample(range(63), n))) for n in (0, 1, 2) for x in (rng.getrandbits(64) for _ in range(100))]
    apart = [(x, x ^ 0xF << 60) for x in (rng.getrandbits(64) for _ in range(100))] + [(x, x ^ top ^ 0b111) for x in (rng.getrandbits(64) for _ in range(100))]
    for pairs, want in ((links, 1), (apart, 0)):
        for a, b in pairs:
            got = list(s.forest(np.array([s.signed(a), s.signed(b)], np.int64)))
            assert len(got) == want and all(g == tuple(sorted((s.signed(a), s.signed(b)))) for g in got)


def test_links_of_64_bit_values(spark):
    rng = random.Random(5)
    values = set()
    for _ in range(300):
        x = rng.getrandbits(64)
        values |= {x, x ^ 1 << 63 ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 3)))}
        if rng.random() < 0.2:
            values.add(x ^ 0xF << 60)
    values = sorted(values)
    df = spark.createDataFrame([(s.signed(v),) for v in values], "value long")
    want = groups([(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3], values)
    unsigned = (1 << 64) - 1
    assert groups([(a & unsigned, b & unsigned) for a, b in map(tuple, s.links(df, Workspace(spark, "t")).collect())], values) == want
