import struct
import zlib

import numpy as np
import pytest

from pitchline.llm import chunk_store as c
from pitchline.llm.common import Workspace, vocabulary

from .conftest import table

FILE = vocabulary("word_bpe_49k.json")


def streams(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    return [(d, t.encode(text or "", add_special_tokens=False).ids + [1]) for d, text, *_ in rows]


def brute(rows):
    made = streams(sorted(rows, key=lambda r: (r[0] is not None, r[0])))
    out, at = [], 0
    for d, ids in made:
        out.append((d, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_documents(documents, rows):
    assert table(c.encoded(documents, FILE), "doc_id", "start", "n_tokens", "ids_crc32") == brute(rows)


def test_odd_rows(odd, odd_rows, empty):
    got = table(c.encoded(odd, FILE), "doc_id", "start", "n_tokens", "ids_crc32")
    want = brute(odd_rows)
    assert sorted((x[2:] for x in got)) == sorted(x[2:] for x in want)
    ends = [x[1] + x[2] for x in sorted(got, key=lambda x: x[1])]
    assert [x[1] for x in sorted(got, key=lambda x: x[1])] == [0, *ends[:-1]]
    assert c.encoded(empty, FILE).count() == 0


def test_odd_characters_split_alike():
    texts = ["İstanbul ΑΣ Σ́ é don't I'LL a b a\x1cb a\x85b  x ½ 3.14 <|endoftext|>x <|startoftext|>", "x" * 5000, "é" * 300, "à ̀b"]
    coder = c.Encoder(FILE)
    for text, packed in zip(texts, coder.encode([t.encode() for t in texts])):
        assert np.frombuffer(packed, "<u2").tolist() == streams([(0, text)])[0][1]


def test_round_trip_and_single_copies(spark, documents, rows):
    path = Workspace(spark, "t").path
    c.write_store(documents, path, FILE)
    assert {r.doc_id: r.ids for r in c.read_ids(spark, path).collect()} == dict(streams(rows))
    chunks = spark.read.schema(c.CHUNK).parquet(f"{path}/staged").filter("data is not null")
    assert chunks.count() == chunks.select("address").distinct().count() > 0
    c.verify_manifest(spark, path)


def test_damage_is_found(spark, odd):
    path = Workspace(spark, "t").path
    c.write_store(odd, path, FILE)
    chunks = spark.read.schema(c.CHUNK).parquet(f"{path}/staged").filter("data is not null")
    bad = chunks.selectExpr("address", "concat(data, X'0000') as data").collect()
    spark.createDataFrame(bad, "address binary, data binary").write.mode("overwrite").parquet(f"{path}/staged")
    with pytest.raises(Exception, match="does not match its address"):
        c.read_store(spark, path).collect()


def test_crc_shift_joins_parts():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300, 70_000):
        a, b = rng.bytes(n), rng.bytes(2 * n + 1)
        shifted = c.crc_shift(np.array([zlib.crc32(a), zlib.crc32(b)]), np.array([len(b), 0]))
        assert int(shifted[0] ^ shifted[1]) == zlib.crc32(a + b)


def test_cuts_follow_content():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 49_000, 20_000).astype(np.uint16)
    ends = c.cuts(ids)
    assert ends[-1] == len(ids) and all(0 < b - a <= c.MOST for a, b in zip([0, *ends], ends))
    moved = c.cuts(np.concatenate((rng.integers(0, 49_000, 100).astype(np.uint16), ids)))
    assert len({e + 100 for e in ends} & set(moved)) > 0.8 * len(ends)


def test_other_files_and_texts_whole(tmp_path):
    import json

    with open(FILE, encoding="utf-8") as f:
        told = json.load(f)
    told["normalizer"] = {"type": "NFC"}
    path = f"{tmp_path}/other.json"
    with open(path, "w", encoding="utf-8") as f:
        json.dump(told, f)
    from tokenizers import Tokenizer

    known, other = c.Encoder(FILE), c.Encoder(path)
    assert known.known and not other.known
    texts = ["Some Text, don't", "", "Über  alles\n"]
    for text, packed in zip(texts, other.encode([t.encode() for t in texts])):
        assert np.frombuffer(packed, "<u2").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [1]


def test_text_ids(spark):
    rows = [("b", "two words", "en", "s"), ("a", "one", "en", "s"), ("c", None, "en", "s")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    assert table(c.encoded(df, FILE), "doc_id", "start", "n_tokens", "ids_crc32") == brute(rows)


@pytest.mark.parametrize("damage", ["doc_id + 1 as doc_id", "start + 1 as start", "n_tokens + 1 as n_tokens", "concat(root, X'00') as root"])
def test_damage_of_recipes_is_found(spark, odd, damage):
    path = Workspace(spark, "t").path
    c.write_store(odd, path, FILE)
    recipes = spark.read.parquet(f"{path}/recipes")
    name = damage.split()[-1]
    changed = recipes.selectExpr(*(damage if x == name else x for x in recipes.columns)).collect()
    spark.createDataFrame(changed, recipes.schema).write.mode("overwrite").parquet(f"{path}/recipes")
    with pytest.raises(ValueError, match="manifest"):
        c.verify_manifest(spark, path)


def test_damage_of_the_manifest_is_found(spark, odd):
    path = Workspace(spark, "t").path
    c.write_store(odd, path, FILE)
    c.verify_manifest(spark, path)
    manifest = spark.read.schema(c.MANIFEST).parquet(f"{path}/manifest")
    changed = manifest.selectExpr("part", "first_start", "n_tokens", "n_docs", "reverse(root) as root").collect()
    spark.createDataFrame(changed, manifest.schema).write.mode("overwrite").parquet(f"{path}/manifest")
    with pytest.raises(ValueError, match="manifest"):
        c.verify_manifest(spark, path)
