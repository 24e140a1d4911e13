import hashlib
import re

import numpy as np

from pitchline.llm import pii
from pitchline.llm.queries import personal_data

from .conftest import key, table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    spans = [
        *((m.start(), 0, "email", m.end()) for m in EMAIL.finditer(text)),
        *((m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))),
        *((m.start(), 2, "card", m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        *((m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15),
    ]
    spans.sort()
    said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return [sum(k == kind for _, _, k, _ in spans) for kind in pii.BASE_KINDS], said


def check(df, rows):
    got = table(personal_data(df), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    want = []
    for d, t, *_ in rows:
        n, said = brute(t)
        want.append((d, *n, hashlib.sha256(said.encode()).hexdigest()))
    assert got == sorted(want, key=key)


def test_documents(documents, rows):
    check(documents, rows)


def test_odd_rows(odd, odd_rows, empty):
    check(odd, odd_rows)
    check(empty, [])


def test_tricky_texts(spark):
    texts = [
        "a@b.c@d.e f@@g.h @a.b@c.d", "x@y z@w.", "1.2.3.4.5.6.7.8 1.2.3.256 0255.1.1.1 1.2.3", "4111-1111 1111-1111 4111111111111111 1234 5678",
        "++1 2 3 4 5 6 7 8 9 0 +1(212)555.0100- +123", "9" * 2000, "a." * 500 + "@b.c", "+1" + " " * 500 + "2", "é4111111111111111é mañana@correo.es 1..2",
    ]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), rows)


def test_base_spans_stay_among_all(documents, rows):
    texts = {d: t for d, t, *_ in rows}
    added = 0
    for r in personal_data(documents).collect():
        every = r.spans.split(",") if r.spans else []
        base = brute(texts[r.doc_id])[1]
        assert [s for s in every if s.split(":")[0] in pii.BASE_KINDS] == (base.split(",") if base else [])
        added += len(every) - len(base.split(",") if base else [])
    assert added > 0  # secrets, in these texts


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.6
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) * 2 - 1 for a in (0.95, 0.9, 0.6)], axis=1)
    patterns, weight = np.unique(votes, axis=0, return_counts=True)
    p, rates = pii.reliabilities(patterns, weight.astype(float))
    assert rates[0, 1, 2] > 0.9 and rates[2, 1, 2] < 0.7
    right = sum(w for q, w, pat in zip(p, weight, patterns) if (q > 0.5) == (pat[0] + pat[1] > 0 or pat[0] > 0))
    assert right / 4000 > 0.9


def test_classifier_takes_secrets_and_leaves_plain_values():
    text = "login password=c6d64b9a661f85b709 and token: abcdefgh"
    kinds = [(s.kind, text[s.start : s.end]) for s in pii.candidates(text)]
    assert ("secret", "c6d64b9a661f85b709") in kinds


def test_secrets_in_any_spelling_and_length():
    value = "eyJhbGciOiJIUzI1NiJ9." + "aB3x" * 100
    for name in ("apiKey", "ApiKey", "Pwd", "PassWord", "pAsSwD", "Api_Key", "API-key", "toKen", "SecRet"):
        text = f"so {name}={value} and on"
        start = text.index(value)
        assert ("secret", start, start + len(value)) in [tuple(x)[:3] for x in pii.candidates(text)]


def iban(country, digits):
    rest = f"{digits}{int(country[0], 36)}{int(country[1], 36)}00"
    return f"{country}{98 - int(rest) % 97:02d}{digits}"


def planted(rng):
    """(texts, true spans as (text, kind, start, end)): each kind in several forms, beside look-alikes that are none."""
    names = [f"{a} {b}" for a in ("Sarah", "Klaus", "Pierre", "Carmen", "David", "Anna") for b in ("Miller", "Weber", "Martin", "Lopez", "Novak")]
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexes = lambda n, sep=":": sep.join(f"{rng.randrange(256):02x}" for _ in range(n))
    good = {
        "ssn": lambda: (rng.choice(["my ssn is ", "social security number ", "the ssn on file: "]), f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"),
        "iban": lambda: (rng.choice(["pay to iban ", "bank account ", "my account is "]), iban("DE", digits(18)) if rng.random() < 0.5 else iban("FR", digits(23))),
        "mac": lambda: (rng.choice(["device mac ", "hardware address ", "seen from "]), hexes(6) if rng.random() < 0.5 else hexes(6, "-").upper()),
        "person": lambda: (rng.choice(["the author is ", "we met with Mr ", "signed by ", "please ask "]), rng.choice(names)),
        "secret": lambda: (rng.choice(["password=", "Token: ", "apiKey = ", "login secret: "]), "".join(rng.choice("abcdef0123456789XYZ") for _ in range(18)) + "a1"),
        "birth": lambda: (rng.choice(["born ", "date of birth ", "dob: "]), rng.choice([f"19{rng.randint(40, 99)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.19{rng.randint(50, 99)}"])),
    }
    bad = {
        "ssn": lambda: (rng.choice(["part ", "order ", "sku "]), f"{rng.choice(['000', '666', '912'])}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"),
        "iban": lambda: ("version ", "ZZ" + digits(20)),
        "mac": lambda: ("sample ", rng.choice(["00:00:00:00:00:00", "ff:ff:ff:ff:ff:ff"])),
        "person": lambda: ("we won. ", rng.choice(["Green Valley", "Northern Lights", "Blue Harbour", "Silver Bridge", "Grand Hotel"])),
        "secret": lambda: ("sample token: ", "placeholder"),
        "birth": lambda: ("release ", f"20{rng.randint(40, 99)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"),
    }
    fill = "some words here and there and more of them follow after that".split()
    texts, true, false = [], [], []
    for kind in good:
        for i in range(140):
            cue, value = (good if i < 80 else bad)[kind]()
            start = " ".join(rng.choice(fill) for _ in range(rng.randint(3, 9))) + " " + cue
            text = f"{start}{value} " + " ".join(rng.choice(fill) for _ in range(5))
            (true if i < 80 else false).append((len(texts), kind, len(start), len(start) + len(value)))
            texts.append(text)
    return texts, true, false


def test_added_kinds_are_found(spark):
    import random

    texts, true, false = planted(random.Random(3))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r.doc_id, s.kind, s.start, s.end) for r in pii.find(df).collect() for s in r.spans}
    for kind in pii.ADDED_KINDS:
        mine, none = ([x for x in part if x[1] == kind] for part in (true, false))
        found, wrong = sum(x in got for x in mine), sum(x in got for x in none)
        assert found >= 0.9 * len(mine), (kind, found, len(mine))
        assert found >= 0.9 * (found + wrong), (kind, found, wrong)


def test_prefilters_lose_nothing():
    import random

    rng = random.Random(4)
    patterns = {"ssn": pii._SSN, "iban": pii._IBAN, "mac": pii._MAC, "birth": pii._BIRTH, "person": pii._PERSON}
    pool = ["aa:bb:cc:dd:ee:ff", "AA-BB-CC-DD-EE-FF", "Pwd=abcdefg", "apiKey=abcdef", "API_KEY: zzzzzzz", "PassWord = 'qqqqqq'", "John Smith", "\u017fecret=abcdef", "to\u212aen=abcdefgh", "1.2.3.4", "x", "born 1990-01-02", "DE44500105175407324931"]
    for _ in range(3000):
        text = " ".join(rng.choice(pool) for _ in range(rng.randint(1, 4)))
        got = {(s.kind, s.start, s.end) for s in pii.candidates(text)}
        want = {(k, m.start(), m.end()) for k, p in patterns.items() for m in p.finditer(text)} | {("secret", m.start(2), m.end(2)) for m in pii._SECRET.finditer(text)}
        assert {s for s in got if s[0] in pii.ADDED_KINDS} == want
