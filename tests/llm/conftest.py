import random

import pytest

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, h string, row string, value double, kind string, slot int"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows and ids, names that operators use themselves."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(70))
    long = " ".join(rng.choice(words) for _ in range(30_000))
    own = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [
        (None, "en", None), ("", None, "a"), (" \t\n ", "en", "a"), ("one", "en", "a"), ("One two", "fr", "b"),
        (passage, "en", "a"), (passage, "en", "a"), (own(30) + " " + passage + " " + own(30), "fr", "b"),
        (own(10) + "\n" + " ".join(passage.split()[:55]), None, None), (long, "en", "a"), (long + " tail", "en", "a"),
        ("mit license MIT  License. see GNU General Public License!", "en", "b"), ("12 34 ... ###", "en", "b"),
        ("mail a.b@c.de, 10.0.0.1 or 999.1.1.1, +1 (212) 555-0100 4111 1111 1111 1111 é@x.y", "fr", "b"),
        ("x y z " * 40, "fr", "a"), ("\n".join(["same line here"] * 5 + ["other | line #"]), "en", "b"),
    ]
    out = [(i, t, lang, source) for i, (t, lang, source) in enumerate(texts)]
    out += [out[5], (5, "another text under the same id " + passage, "en", "a"), (None, passage, "en", "a"), (None, "lonely text", None, None)]
    return out


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    rows = [(*r, None, 3, "x", "y", 1.5, "k", 9) for r in odd_rows]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is not None, x) for x in row)


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
