import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchline.llm import ngram_model, queries
from pitchline.llm.common import Workspace

END, START = "</end>", "<start>"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w] + [END]


def brute(rows, held, order):
    """Modified Kneser-Ney by dictionaries of n-grams: (n_tokens, n_known, N, base, score) of each row."""
    train = [words(t) for t, h in zip(rows, held) if not h]
    raw = Counter(w for ws in train for w in ws)
    counts = {order: Counter(tuple(p[i : i + order]) for ws in train for p in [[START] * (order - 1) + ws] for i in range(len(ws)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter()
        for gram, c in counts[k + 1].items():
            counts[k][gram[1:]] += c if gram[1] == START else 1
    after = {k: defaultdict(list) for k in counts}
    lost = {}
    for k, grams in counts.items():
        of = Counter(grams.values())
        lost[k] = [0.0, *ngram_model.discounts(of[1], of[2], of[3], of[4])]
        for gram, c in grams.items():
            after[k][gram[:-1]].append(c)

    totals = {k: {h: (sum(cs), sum(lost[k][min(x, 3)] for x in cs)) for h, cs in by.items()} for k, by in after.items()}

    def probability(gram, k):
        if k == 0:
            return 1 / (len(raw) + 1)
        lower = probability(gram[1:], k - 1)
        if gram[:-1] not in totals[k]:
            return lower
        c, (total, mass) = counts[k].get(gram, 0), totals[k][gram[:-1]]
        return (max(c - lost[k][min(c, 3)], 0) + mass * lower) / total

    n, v = sum(raw.values()), len(raw)
    out = []
    for t in rows:
        ws = words(t)
        p = [START] * (order - 1) + ws
        score = sum(math.log10(probability(tuple(p[i : i + order]), order)) for i in range(len(ws)))
        out.append((len(ws), sum(raw[w] > 0 for w in ws), n, sum(math.log10((raw[w] + 1) / (n + v + 1)) for w in ws), score))
    return out


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9) and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


def columns(df):
    return [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_odd_texts(spark, odd, odd_rows, order):
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i, *_ in odd_rows]
    got = columns(ngram_model.scored(odd, ~ngram_model.is_held_out(), order))
    same(got, [(r[0], *x) for r, x in zip(odd_rows, brute([r[1] for r in odd_rows], held, order))])


def test_whole_documents(spark, documents, rows):
    from .conftest import DATA

    held = [zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    df = queries.op13_lm_scoring(spark, DATA)
    assert df.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert {r.doc_id: r.held_out for r in df.collect()} == dict(zip((r[0] for r in rows), held))
    same(columns(df), [(r[0], *x) for r, x in zip(rows, brute([r[1] for r in rows], held, 2))])


def test_the_model_beats_its_base_on_held_out_texts(spark):
    from .conftest import DATA

    df = queries.op13_lm_scoring(spark, DATA).filter("held_out")
    r = df.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_no_texts(spark, empty, odd):
    assert ngram_model.scored(empty, ~ngram_model.is_held_out()).collect() == []
    got = columns(ngram_model.scored(odd, F.lit(False)))
    assert all(g[2:] == (0, 0, 0.0, 0.0) for g in got)


def test_probabilities_of_all_words_sum_to_one(spark):
    texts = ["a b a c", "a b b a", "c a b", "b", "", "a b a b a c c c"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    told = ngram_model.train(docs, f"{Workspace(spark, 'test').path}/model", 3)
    from pitchline.llm.common import WordHashes

    known, model = WordHashes(), ngram_model.Model(told)
    vocabulary = np.append(known.of([b"a", b"b", b"c", b"never"]), np.uint64(ngram_model.END))
    for history in (("a", "b"), ("c", "c"), ("never", "a"), ("never", "never")):
        before = known.of([w.encode() for w in history])
        row = np.concatenate([np.append(before, w) for w in vocabulary])
        p, _ = model.probabilities(row, np.arange(2, len(row), 3))
        assert p.sum() == pytest.approx(1)


def test_joint_hash_equals_sparks(spark):
    x = np.random.default_rng(1).integers(0, 1 << 64, (50, 3), dtype=np.uint64)
    df = spark.createDataFrame([tuple(map(int, r)) for r in x.view(np.int64)], "a long, b long, c long")
    assert [r.h for r in df.select(F.xxhash64("a", "b", "c").alias("h")).collect()] == ngram_model.joint_hash(list(x.T)).view(np.int64).tolist()


def test_chunks_ranges_and_wide_counts_do_not_change_a_model(spark, odd, monkeypatch):
    want = sorted(columns(ngram_model.scored(odd, ~ngram_model.is_held_out())), key=repr)
    files = ngram_model._Files("file:" + __import__("tempfile").mkdtemp(), ("hash", "count"))
    for part in ([1, 2], [300], [70_000, 3], [1 << 40]):
        files.add(hash=np.array(part, np.uint64), count=np.array(part))
    files.close({})
    assert np.fromfile(f"{files.place}/count", files.kind["count"]).tolist() == [1, 2, 300, 70_000, 3, 1 << 40]
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        same(sorted(columns(ngram_model.scored(odd.repartition(5), ~ngram_model.is_held_out())), key=repr), want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
