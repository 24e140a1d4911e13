import re


from pitchline.llm import license_scan
from pitchline.llm.queries import licenses
from tests.llm.conftest import key, table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    hits = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def check(df, rows):
    got = table(licenses(df), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((d, *brute(t)) for d, t, *_ in rows), key=key)


def test_base_on_documents(documents, rows):
    check(documents, rows)


def test_base_on_odd_rows(odd, odd_rows, empty):
    check(odd, odd_rows)
    check(empty, [])


def test_labels_hold_the_base(documents):
    for r in licenses(documents).collect():
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert 0 <= r.score <= 1


def test_suppression_by_priority_and_containment():
    _, found = license_scan.scan(b"Licensed under the Apache License, Version 2.0, or the GNU GPL v3")
    labels = [d.label for d in found if not d.base]
    assert labels == ["apache-2.0", "gpl-3.0"]
    # one that only overlaps stays
    taken = license_scan._Taken()
    taken.add(5, 10)
    assert taken.covers(6, 10) and not taken.covers(4, 9) and not taken.covers(6, 11)


def test_prefilter_loses_nothing():
    for line in license_scan.SIGNATURES.strip().split("\n"):
        _, keyword, _, pattern = line.split(" ", 3)
        required = re.sub(r"\((?!\?)[^()]*(\([^()]*\)[^()]*)*\)\?", " ", pattern)  # optional groups go
        for choice in re.findall(r"\(([^()?][^()]*\|[^()]*)\)", required):
            required = required.replace(f"({choice})", " ") if not all(keyword in c.split() for c in choice.split("|")) else required
        assert keyword in re.split(r"[ ()|?]+", required), line


def test_hundreds_of_rules():
    assert len(license_scan.RULES) >= 200


def plain_scan(text):
    """All rules without the keyword gate; a detection goes if an earlier one in the order holds it."""
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    line = " " + " ".join(words) + " "
    found = []
    for r in license_scan.RULES:
        for m in re.finditer(r.pattern.pattern.decode(), line):
            start = line[: m.start()].count(" ") - 1
            found.append((r.label, r.priority, start, start + len(m[0].split()), r.base))
    kept = [d for d in found if d[4]]
    taken = []
    for d in sorted((d for d in found if not d[4]), key=lambda d: (d[1], d[2] - d[3], d[2], d[0])):
        if not any(a <= d[2] and d[3] <= b for a, b in taken):
            taken.append((d[2], d[3]))
            kept.append(d)
    return sorted(kept, key=lambda d: (d[2], d[3], d[0]))


def test_all_rules_without_the_gate(rows):
    import random

    rng = random.Random(2)
    phrases = [re.sub(r"\\S\+|\\d", "x1", re.sub(r"[()?*]|\{[0-9,]+\}", "", line.split(" ", 3)[3])) for line in license_scan.SIGNATURES.strip().split("\n")]
    phrases = [re.sub(r"\[cs\]", "s", p).replace("|", " ") for p in phrases] + ["Apache License, Version 2.0", "MIT License", "SPDX-License-Identifier: GPL-3.0-or-later", "see the LICENSE file for details", "Copyright (c) 2019", "licensed under the GNU General Public License"]
    fill = "the of this file is in source code version 2 0 or later and".split()
    texts = [" ".join(rng.choice(phrases) if rng.random() < 0.4 else rng.choice(fill) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    texts += [t for _, t, *_ in rows if t and len(t) < 20_000][::10]
    labels = set()
    for text in texts:
        got = [tuple(d) for d in license_scan.scan(text.encode())[1]]
        assert sorted(got) == sorted(plain_scan(text))
        labels |= {d[0] for d in got}
    assert len(labels) > 60
