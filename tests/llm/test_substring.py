import hashlib
import random
import re

from pitchline.llm.queries import passages

from .conftest import SCHEMA, key, table

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows):
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t, *_ in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - 49):
                k = tuple(w[i : i + 50])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=key)


def check(df, rows):
    assert table(passages(df), "doc_id", "n_words", "n_removed", "kept_sha256") == brute(rows)


def test_documents(documents, rows):
    check(documents, rows)


def test_odd_rows(odd, odd_rows, empty):
    check(odd, odd_rows)
    check(empty, [])


def test_repeats_of_all_lengths_and_edits(spark):
    rng = random.Random(5)
    words = ["a", "b", "c", "d"] + [f"w{i}" for i in range(60)]
    pool = [[rng.choice(words) for _ in range(rng.randint(48, 130))] for _ in range(6)]
    rows = []
    for i in range(150):
        text = []
        for _ in range(rng.randint(1, 3)):
            p = list(rng.choice(pool))
            lo = rng.randint(0, 20)
            p = p[lo : lo + rng.randint(45, 120)]
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "edit"
            text += [rng.choice(words) for _ in range(rng.randint(0, 5))] + p
        rows.append((rng.randint(0, 120), " ".join(text), "en", "s"))
    rows += [(200, "a " * 300, "en", "s"), (201, "b " + "a " * 120 + "b", "en", "s"), (202, "a " * 49, "en", "s")]
    df = spark.createDataFrame([(*r, 1, 1, "", "", 1.0, "", 1) for r in rows], SCHEMA)
    check(df, rows)


def test_text_ids_and_repeated_rows(spark):
    p = " ".join(f"p{i}" for i in range(70))
    rows = [("b", "x " + p, "en", "s"), ("a", p + " y", "en", "s"), (None, p, "en", "s")] + [("c", "z z " + p, "en", "s")] * 20 + [("c", p + " c", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    check(df, rows)
