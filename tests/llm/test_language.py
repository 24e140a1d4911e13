import zlib

import numpy as np

from pitchline.llm import language_id as lid
from pitchline.llm.queries import languages

from .conftest import DATA  # noqa: F401


def test_held_out_accuracy(documents, rows):
    got = {r.doc_id: r for r in languages(documents).collect()}
    assert len(got) == len(rows)
    right = total = 0
    for d, text, lang, _ in rows:
        assert got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= got[d].score <= 1
        if got[d].held_out:
            total += 1
            right += got[d].lang_pred == lang
    assert right / total > 0.95, right / total
    assert sum(r.rejected for r in got.values()) <= 3


def test_odd_rows(odd, odd_rows, empty):
    got = languages(odd).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        texts = [t for d, t, *_ in odd_rows if d == r.doc_id]
        if all(not t or not any(map(str.isalpha, t)) for t in texts):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        if len(texts) == 1 and texts[0] and any(map(str.isalpha, texts[0])):
            assert r.lang_pred in ("en", "fr")
    assert languages(empty).count() == 0


def test_nothing_learned(spark):
    df = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in languages(df).collect()} == {"und"}


def test_held_out_languages_teach_nothing(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    free = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, "the cat and the dog", "en") for i in free[:20]] + [(i, "der hund und die katze", "de") for i in held[:20]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in languages(df).collect()} == {"en"}


def test_far_texts_are_rejected(documents):
    model = lid.train(documents)
    _, score, far = model.nearest([b"qxzj vkqw zzxq jjqk " * 30, "だったのですこれは日本語".encode() * 20])
    assert far.all()


def test_counts_do_not_depend_on_pieces(monkeypatch):
    texts = ["Ein Text über Wörter ".encode() * 50, b"", b"short", b"x" * 5000]
    whole = lid.counts(texts)
    monkeypatch.setattr(lid, "PIECE", 97)
    assert np.array_equal(whole, lid.counts(texts))
    assert whole[0].sum() > 0 and whole[1].sum() == 0


def brute_counts(text):
    """Hashed 2- and 3-grams one by one; the last of two white-space bytes is in 3-grams alone."""
    kept = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text).split()
    whole = b" " + b" ".join(kept) + b"  "
    out = np.zeros(lid.DIMENSIONS)
    for n in (2, 3) if kept else ():
        for i in range(len(whole) - n + 1 - (n == 2)):
            h = 0
            for byte, factor in zip(whole[i : i + n], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
                h ^= byte * factor & 0xFFFFFFFF
            h ^= h >> 15
            out[(h * (0x2C1B3C6D + n - n % 2) & 0xFFFFFFFF) >> 20] += 1
    return out


def test_counts_one_by_one(rows):
    texts = [(t or "").encode() for _, t, *_ in rows if len(t or "") < 20_000][::25] + [b"", b"12", b"x", "über a b".encode()]
    for text, got in zip(texts, lid.counts(texts)):
        assert np.array_equal(got, brute_counts(text))


def cosine(a, b):
    n = np.sqrt((a * a).sum() * (b * b).sum())
    return float((a * b).sum() / n) if n else 0.0


def clustered(vectors):
    """The first centroid is the mean; the next ones are the vectors farthest from all; then twelve rounds."""
    centroids = [sum(vectors)]
    while len(centroids) < min(4, len(vectors)):
        centroids.append(min(vectors, key=lambda v: max(cosine(v, c) for c in centroids)))
    for _ in range(12):
        members = [[] for _ in centroids]
        for v in vectors:
            members[max(range(len(centroids)), key=lambda k: cosine(v, centroids[k]))].append(v / np.sqrt((v * v).sum()))
        centroids = [sum(m) if m else c for m, c in zip(members, centroids)]
    return centroids


def test_nearest_centroid_one_by_one(spark):
    """A small table, every step in plain numpy: sample, weights, clusters, nearest centroid, radius."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 20000")
    rows = docs.selectExpr("doc_id", "text", "lang", "pmod(xxhash64(doc_id, text), 1 << 30) as draw").collect()
    teach = sorted((r for r in rows if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1), key=lambda r: r.draw)
    raw = {(r.lang, r.draw): brute_counts((r.text or "").encode()) for r in teach}
    raw = {k: x for k, x in raw.items() if x.any()}
    held = sum(x > 0 for x in raw.values())
    idf = np.log((1 + len(raw)) / (1 + held)) + 1
    vector = lambda x: np.log1p(x) * idf
    model = {}
    for lang in sorted({k[0] for k in raw}):
        mine = [vector(x) for (of, _), x in raw.items() if of == lang]
        centroids = clustered([v / np.sqrt((v * v).sum()) for v in mine])
        model[lang] = centroids, max(1 - max(cosine(v, c) for c in centroids) for v in mine) + 0.1
    got = {r.doc_id: r for r in languages(docs).collect()}
    for r in rows:
        g = got[r.doc_id]
        if not any(map(str.isalpha, r.text or "")):
            assert (g.lang_pred, g.rejected) == ("und", True)
            continue
        v = vector(brute_counts(r.text.encode()))
        near = {lang: max(cosine(v, c) for c in centroids) for lang, (centroids, _) in model.items()}
        lang = max(near, key=lambda x: (near[x], [-ord(c) for c in x]))
        assert g.lang_pred == lang and abs(g.score - min(1, max(0, near[lang]))) < 1e-4
        assert g.rejected == (1 - near[lang] > model[lang][1]) or abs(1 - near[lang] - model[lang][1]) < 1e-4


def test_rows_that_share_an_id_are_drawn_apart(spark):
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 3 != 1)
    rows = [(one, f"the cat number {'abcdefghij'[i % 10]} and {'klmnop'[i % 6]} dogs", "en") for i in range(3000)] + [(one, "le chat et les chiens", "fr")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in languages(df).distinct().collect()} == {"en", "fr"}


def test_many_languages(spark, monkeypatch):
    monkeypatch.setattr(lid, "LANGUAGES", 3)
    rows = [(3 * i, f"words of language {'abcdefgh'[i % 8] * 5} here", "abcdefgh"[i % 8 if i % 8 < 4 else 0]) for i in range(64)]
    model = lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 3 and "a" in model.languages
