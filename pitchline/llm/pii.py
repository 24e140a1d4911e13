"""Personal data by weak supervision.

Candidates are spans that a kind's regular expression finds; no list decides what a candidate is.  LABELERS vote on each: yes, no or
nothing, from its form (regex), from lists (gazetteer) and from the words around it (context).  The votes of all
candidates of the corpus are counted by pattern; expectation-maximisation estimates how reliable
each labeler is for each kind (its rates of yes and no on true and false spans) and how likely each
candidate is true.  A logistic span classifier is fitted to these probabilities, over kind, votes and form, and
decides on the kinds that the method adds.  Spans of the four base kinds always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, slices

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("ssn", "iban", "mac", "person", "secret", "birth")
KINDS = BASE_KINDS + ADDED_KINDS

_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A run of digits that fails from its start fails from each later digit too, so only starts of runs are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_MAC = re.compile(r"(?<![\w:-])[0-9A-Fa-f]{2}([:-])(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}(?![\w:-])")
_BIRTH = re.compile(r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2})(?![\w/-])")
_SECRET = re.compile(r"(?i)(?<![a-z])(password|passwd|pwd|token|secret|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?([^\s\"',;]{6,})")
#: A casefolded text without any of these has no match of _SECRET.
_KEYS = ("assword", "asswd", "pwd", "oken", "ecret", "key")

# Gazetteers.  Fixed values: public lists, or the rules by which public numbers are given out.
FIRST_NAMES = frozenset("""
James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles Karen
Christopher Lisa Daniel Nancy Matthew Betty Anthony Margaret Mark Sandra Donald Ashley Steven Kimberly Paul Emily Andrew Donna Joshua Michelle
Kenneth Carol Kevin Amanda Brian Dorothy George Melissa Edward Deborah Ronald Stephanie Timothy Rebecca Jason Sharon Jeffrey Laura Ryan Cynthia
Jacob Kathleen Gary Amy Nicholas Angela Eric Shirley Jonathan Anna Stephen Brenda Larry Pamela Justin Emma Scott Nicole Brandon Helen Benjamin
Samantha Samuel Katherine Gregory Christine Frank Debra Alexander Rachel Raymond Carolyn Patrick Janet Jack Catherine Dennis Maria Jerry Heather
Hans Greta Klaus Ursula Jürgen Sabine Wolfgang Monika Stefan Petra Uwe Heike Dieter Karin Pierre Marie Jean Camille Michel Nathalie Philippe Isabelle
Alain Sylvie Nicolas Françoise Juan María José Carmen Luis Ana Pedro Lucía Carlos Marta Miguel Elena Javier Pilar Giulia Marco Giovanni Francesca Ivan
Olga Mohammed Fatima Ahmed Aisha Wei Li Yuki Hiroshi Priya Raj
""".split())  # fmt: skip
_WORD = "[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{1,30}"
#: Two or three capitalised words, with or without an initial; titles are no part of the name.
_PERSON = re.compile(rf"(?<!\w)(?!(?:Mr|Mrs|Ms|Dr|Prof|Dear|Herr|Frau|Monsieur|Madame|Señora?)\b){_WORD}(?: [A-Z]\.)? {_WORD}(?: {_WORD})?(?!\w)")
#: Generic top domains; those of two letters are countries'.
TOP_DOMAINS = frozenset("com org net edu gov mil int io info biz name pro app dev online shop site tech cloud museum".split())
#: Ranges of the first digits of card numbers, by network.
CARD_RANGES = "4 51-55 2221-2720 34 37 300-305 36 38 39 6011 644-649 65 3528-3589 62 50 56-58 6304 6759 6761-6763"
_CARDS = [(len(r.split("-")[0]), int(r.split("-")[0]), int(r.split("-")[-1])) for r in CARD_RANGES.split()]
#: Calling codes: one digit, two digits, and the first two of those of three digits.
CALLING_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CALLING_AREAS = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 85 87 88 96 97 99".split())
#: Characters of an IBAN by country.
IBAN_SIZES = dict(re.fullmatch("([A-Z]{2})([0-9]+)", x).groups() for x in """
AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28
HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24
RS22 SA24 SE24 SI19 SK24 SM27 TN24 TR26 UA29 VG24 XK20
""".split())
NEAR = {
    "email": "mail contact write reach send", "ip": "ip host server address addr login client", "card": "card visa mastercard amex credit pay payment",
    "phone": "call tel phone mobile fax contact dial", "ssn": "ssn social security", "iban": "iban bank account konto", "mac": "mac hardware device",
    "person": "name mr mrs ms dr prof dear author signed by patient customer herr frau monsieur madame señor señora", "secret": "login user key access auth", "birth": "born birth birthday dob geboren",
}
_NEAR = {k: re.compile(r"(?i)\b(?:" + v.replace(" ", "|") + r")\b") for k, v in NEAR.items()}
_FAR = re.compile(r"(?i)\b(?:version|release|isbn|invoice|order|sku|part|sample|dummy|placeholder|build)\b")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part and domain: the run of local characters before each domain, not used before."""
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def _ip_ok(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def _card_ok(s: str) -> bool:
    d = _digits(s)
    return 14 <= len(d) <= 19 and luhn(d)


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool
    key: str


def _form(kind: str, s: str) -> int:
    """Regex labeler: the span's own check."""
    if kind == "email":
        return 1 if re.fullmatch(r"[A-Za-z]{2,}", s.rsplit(".", 1)[1]) else -1
    if kind == "ip":
        return 1 if _ip_ok(s) else -1
    if kind == "card":
        return 1 if _card_ok(s) else -1
    if kind == "phone":
        return 1 if 10 <= len(_digits(s)) <= 15 else -1
    if kind == "ssn":
        return -1 if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000" else 1
    if kind == "iban":
        return 1 if _iban_ok(s) else -1
    if kind == "secret":
        return 1 if _DIGIT.search(s) and re.search("[A-Za-z]", s) else -1
    if kind == "birth":
        year = int(re.search("(?:19|20)[0-9]{2}", s)[0]) if re.search("(?:19|20)[0-9]{2}", s) else 0
        return 1 if 1900 <= year <= 2020 else -1
    if kind == "mac":
        return -1 if len({p.lower() for p in re.split("[:-]", s)}) == 1 else 1
    return 0


def _listed(kind: str, s: str) -> int:
    """Gazetteer labeler."""
    if kind == "email":
        top = s.rsplit(".", 1)[1].lower()
        return 1 if top in TOP_DOMAINS or len(top) == 2 and top.isalpha() else 0
    if kind == "ip":
        return -1 if s.startswith(("0.", "127.", "255.")) else 0
    if kind == "card":
        d = _digits(s)
        return 1 if any(lo <= int(d[:n]) <= hi for n, lo, hi in _CARDS) else -1
    if kind == "phone":
        d = _digits(s)
        return 1 if d[0] in "17" or d[:2] in CALLING_CODES or d[:2] in CALLING_AREAS else -1
    if kind == "iban":
        return 1 if IBAN_SIZES.get(s[:2]) == str(len(s.replace(" ", ""))) else -1
    if kind == "person":
        return 1 if s.split()[0] in FIRST_NAMES else -1
    return 0


def _context(kind: str, text: str, start: int, end: int) -> int:
    before = text[max(0, start - 40) : start]
    if _NEAR[kind].search(before):
        return 1
    return -1 if _FAR.search(before) else 0


def _edges(kind: str, text: str, start: int, end: int) -> int:
    """Regex labeler: whether the span stands by itself; a name whose first word starts a sentence may owe its capital to that."""
    if kind == "person":
        before = text[max(0, start - 40) : start].rstrip(" \t")
        return -1 if not before or before[-1] in ".!?\n" else 1
    left, right = text[start - 1 : start], text[end : end + 1]
    return -1 if left.isalnum() or right.isalnum() or left in ("-", "/", "_") and left or right in ("/", "_") and right else 1


def _varied(kind: str, s: str) -> int:
    d = _digits(s)
    return -1 if len(d) > 5 and len(set(d)) < 3 else 0


LABELERS = ("form", "listed", "context", "edges", "varied")


def candidates(text: str) -> list[Span]:
    """All candidates of one text, in the order of their starts, then of KINDS."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("ssn", _SSN), ("iban", _IBAN), ("birth", _BIRTH)):
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if kind != "card" or m.end() - m.start() >= 12]
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)]
    folded = text.casefold()
    if any(k in folded for k in _KEYS):
        found += [("secret", m.start(2), m.end(2)) for m in _SECRET.finditer(text)]
    if ":" in text or "-" in text:
        found += [("mac", m.start(), m.end()) for m in _MAC.finditer(text)]
    found += [("person", m.start(), m.end()) for m in _PERSON.finditer(text)]
    out = []
    for kind, a, b in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]))):
        s = text[a:b]
        form = _form(kind, s)
        base = kind == "email" or kind in BASE_KINDS and form > 0
        votes = (form, _listed(kind, s), _context(kind, text, a, b), _edges(kind, text, a, b), _varied(kind, s))
        out.append(Span(kind, a, b, base, f"{kind}|{''.join('-0+'[v + 1] for v in votes)}|{min(3, (b - a) // 12)}"))
    return out


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,key:string>>"


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) with the candidates of each row and the key of what the labelers say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("key", pa.string())]))
        for batch in slices(batches):
            spans = [[s._asdict() for s in candidates(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def reliabilities(patterns: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(probability that each pattern's spans are true, rates[labeler, truth, vote]) by EM from the majority vote."""
    p = np.clip(0.5 + 0.2 * patterns.sum(axis=1), 0.1, 0.9)
    rates = np.full((patterns.shape[1], 2, 3), 1 / 3)
    for _ in range(rounds):
        prior = np.clip((weight * p).sum() / weight.sum(), 0.05, 0.95)
        for j in range(patterns.shape[1]):
            for truth, share in ((0, 1 - p), (1, p)):
                n = np.array([(weight * share)[patterns[:, j] == v].sum() for v in (-1, 0, 1)]) + 1
                rates[j, truth] = n / n.sum()
        odds = np.full(len(p), np.log(prior / (1 - prior)))
        for j in range(patterns.shape[1]):
            odds += np.log(rates[j, 1, patterns[:, j] + 1] / rates[j, 0, patterns[:, j] + 1])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, rates


def features(key: str) -> np.ndarray:
    """Votes and size, for all kinds alike and once more for the span's own kind."""
    kind, votes, size = key.split("|")
    v = np.array(["-0+".index(c) - 1 for c in votes], float)
    told = np.concatenate(([1.0], v, np.abs(v)))
    return np.concatenate((told, [float(size) / 3], *(told * (kind == k) for k in KINDS)))


def classifier(keys: list[str], target: np.ndarray, weight: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Logistic regression by gradient descent on soft targets; each key counts by the root of its spans, and kinds count alike."""
    x, w = np.array([features(k) for k in keys]), np.sqrt(weight)
    kinds = np.array([k.split("|")[0] for k in keys])
    for kind in set(kinds.tolist()):
        w[kinds == kind] /= w[kinds == kind].sum()
    w /= w.sum()
    theta = np.zeros(x.shape[1])
    for _ in range(rounds):
        theta -= 2.0 * (x.T @ (w * (1 / (1 + np.exp(-x @ theta)) - target)) + 1e-4 * theta)
    return theta


def accepted(counted: list[tuple[str, int]]) -> list[str]:
    """Keys whose spans the final classifier takes, from the counts of all keys."""
    if not counted:
        return []
    counted = sorted(counted)
    keys, weight = [k for k, _ in counted], np.array([n for _, n in counted], float)
    target = np.zeros(len(keys))
    for kind in KINDS:
        at = [i for i, k in enumerate(keys) if k.startswith(kind + "|")]
        if at:
            votes = np.array([["-0+".index(c) - 1 for c in keys[i].split("|")[1]] for i in at])
            target[at] = reliabilities(votes, weight[at])[0]
    theta = classifier(keys, target, weight)
    return [k for k in keys if features(k) @ theta >= 0]


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array of kind, start, end, base, key) of each row, starts and ends in code points.

    Null and empty texts have no spans.  Keys are few (kinds, votes and three sizes: under 10,000 whatever the
    input), and their counts cover all rows.  Repeated rows give repeated rows.  Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "pii")
    spans = work.save(extract(docs), "spans")
    counted = [(r["key"], r["count"]) for r in spans.select(F.explode("spans.key").alias("key")).groupBy("key").count().collect()]
    good = [k for k in accepted(counted) if k.split("|")[0] in ADDED_KINDS]
    # a list of more than ten becomes a hash set in the plan
    return spans.select("doc_id", F.filter("spans", lambda s: s.base | s.key.isin(good)).alias("spans"))
