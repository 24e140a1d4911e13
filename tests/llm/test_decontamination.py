import random
import re
from collections import Counter

from pitchline.llm import decontaminate as d

from .conftest import DATA, table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def grams(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)])


def brute(rows, items):
    best = {}
    for doc, text, *_ in rows:
        w = words(text)
        if not w:
            continue
        mine = grams(w)
        for item, t in items:
            v = words(t)
            if not v or not (want := grams(v)).keys() & mine.keys():
                continue
            n = min(len(v), len(w))
            for i in range(len(w) - n + 1):
                got = grams(w[i : i + n])
                s = (got & want).total() / (got | want).total()
                if s >= 0.8 and (s, -i) > best.get((doc, item), (0,))[:2]:
                    best[doc, item] = (s, -i, n)
    return sorted((doc, item, round(s, 9), -i, n) for (doc, item), (s, i, n) in best.items())


def got(docs, items):
    return [(*r[:2], round(r[2], 9), *r[3:]) for r in table(d.contaminated(docs, items), "doc_id", "item_id", "similarity", "first_word", "words")]


def test_documents(spark, documents, rows):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    want = brute(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert got(documents, items) == want and want


def test_edited_copies(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["a", "b"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 60)))) for i in range(40)]
    items += [(40, items[0][1]), (41, None), (42, "..."), (43, "b " * 30), (0, items[1][1])]
    rows = []
    for i in range(120):
        w = rng.choice(items[:40])[1].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            w = w[: len(w) - rng.randint(0, 4)]
        own = lambda: [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))]
        rows.append((i, " ".join(own() + w + own()).upper().replace(" W1 ", " W1, "), "en", "s"))
    rows += [(500, "b " * 200, "en", "s"), (501, None, "en", "s"), (502, "", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    table_ = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert len(want) > 20 and got(docs, table_) == want
    monkeypatch.setattr(d, "BLOCK_BYTES", 3000)
    assert got(docs, table_) == want


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert d.contaminated(odd, items).count() == 0
    assert d.contaminated(empty, items).count() == 0
    assert d.contaminated(odd, items.limit(0)).count() == 0


def test_ids_keep_their_types(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([("a", "say " + text), ("b", None), (None, text)], "doc_id string, text string")
    items = spark.createDataFrame([("q1", text), ("q2", text), (None, text)], "item_id string, text string")
    found = d.contaminated(docs, items)
    assert {tuple(r) for r in found.select("doc_id", "item_id", "similarity").collect()} == {(x, q, 1.0) for x in ("a", None) for q in ("q1", "q2", None)}


def test_firm_bits_never_differ_in_a_match():
    import numpy as np

    rng = np.random.default_rng(1)
    firm = 0
    for n in [*range(1, 40), 100, 400] * 4:
        item = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        wide = int(rng.integers(max(1, int(0.8 * n)), n + 1))
        common = d.least_common(n, wide)
        if common > wide:
            continue
        window = np.concatenate([rng.permutation(item)[:common], rng.integers(0, 1 << 63, wide - common, dtype=np.uint64)])
        ones = [d.bit_rows(x).sum(axis=0, dtype=np.int64) for x in (item, window)]
        a, b = (d.prints(o[None, :], len(x))[0] for o, x in zip(ones, (item, window)))
        held = d.firm_bits(2 * ones[0] - n, n + wide - 2 * common)
        assert not ((a ^ b) & held).any()
        firm += int(np.bitwise_count(held).sum())
    assert firm > 1000


def test_every_edit_at_the_least_similarity_is_found():
    """Items of 1 to 40 words and windows that are exactly as similar as a match has to be, or as near above as words allow."""
    rng = random.Random(3)
    item = "w173812435 w361983460 w53722460 w402602562 w958892957 w323166944 w202133033 w505922670 w156841838"
    assert d.Items([item.encode()]).matches(item.rsplit(" ", 1)[0].encode())[0][1] == 0.8
    fresh = lambda: f"w{rng.randrange(10**9)}"
    for _ in range(60):
        texts = [[fresh() for _ in range(n)] for n in range(1, 41)]
        index = d.Items([" ".join(t).encode() for t in texts])
        for i, t in enumerate(texts):
            shown = max(1, len(t) - 4)
            for cut in {0, int(0.2 * shown + 1e-9)}:  # a document that ends early lacks so many shingles
                w = t[: len(t) - cut]
                assert [m[0] for m in index.matches(" ".join(w).encode())] == [i]
            edited = list(t)
            if shown >= 9:  # the last word replaced: one shingle on each side differs
                edited[-1] = fresh()
            if len(t) >= 5:  # shorter items are no shingle of a longer text
                assert i in [m[0] for m in index.matches(" ".join([fresh(), *edited, fresh()]).encode())]


def test_rare_shingles_find_every_match():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 40))).encode() for _ in range(60)]
    index = d.Items(texts)
    found = 0
    for _ in range(600):
        w = rng.choice(texts).decode().split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(words)
        text = " ".join([rng.choice(words) for _ in range(rng.randint(0, 9))] + w)
        want = {i: s for _, i, s, *_ in brute([(0, text)], [(i, t.decode()) for i, t in enumerate(texts)])}
        assert {i: round(s, 9) for i, s, *_ in index.matches(text.encode())} == want
        found += len(want)
    assert found > 200


def test_a_large_benchmark():
    """Memory of an index of 100,000 items, and items found again in it."""
    import tracemalloc

    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(["which of the following is"] + rng.choices(words, k=25)).encode() for _ in range(100_000)]
    tracemalloc.start()
    index = d.Items(texts)
    assert tracemalloc.get_traced_memory()[0] < 200 << 20
    tracemalloc.stop()
    for i in rng.sample(range(100_000), 200):
        assert [m[0] for m in index.matches(b"some words before " + texts[i])] == [i]
    assert not index.matches(b" ".join(t[:25] for t in texts[:50]))
