"""License scans by ordered signature rules.

A text is reduced to its lower-case words.  Rules whose keyword the text does not hold are skipped.
Detections are taken in the order of priority, then length; one that lies inside a detection taken
before is suppressed.  The three base phrases are found at all places and never suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from .common import by_text
from .license_rules import BASE, IDENTIFIERS, SIGNATURES

#: Score of a detection by the priority of its rule.
TRUST = {1: 1.0, 2: 0.9, 3: 0.7, 4: 0.3}

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Rule(NamedTuple):
    priority: int
    keyword: bytes
    label: str
    pattern: re.Pattern
    base: bool


class Detection(NamedTuple):
    label: str
    priority: int
    start: int  # words
    end: int
    base: bool


def _rules() -> list[Rule]:
    def rule(line: str, base: bool) -> Rule:
        priority, keyword, label, pattern = line.split(" ", 3)
        return Rule(int(priority), keyword.encode(), label, re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )"), base)

    out = [rule(line, True) for line in BASE.strip().split("\n")]
    for name in re.split(r";|\n", IDENTIFIERS.strip()):
        words = re.sub(r"[-.]", " ", name.strip())
        tail = {"gpl": "( only| or later)?", "lgpl": "( only| or later)?", "agpl": "( only| or later)?", "gfdl": "( only| or later)?"}.get(words.split()[0], "")
        out.append(rule(f"1 spdx {name.strip()} spdx licen[cs]e identifier {words}{tail}", False))
    return out + [rule(line, False) for line in SIGNATURES.strip().split("\n")]


RULES = _rules()
KEYWORDS: dict[bytes, list[Rule]] = {}
for _r in RULES:
    KEYWORDS.setdefault(b" " + _r.keyword + b" ", []).append(_r)


class _Taken:
    """Intervals of which none lies in another; covers() and add() by binary search."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def covers(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start) - 1
        return at >= 0 and self.ends[at] >= end

    def add(self, start: int, end: int) -> None:
        lo, hi = bisect_left(self.starts, start), bisect_right(self.ends, end)
        self.starts[lo:hi], self.ends[lo:hi] = [start], [end]


def scan(text: bytes) -> tuple[int, list[Detection]]:
    """(number of words, detections in the order of their places) of one text."""
    words = text.translate(_WORDS).split()
    plain = b" " + b" ".join(words) + b" "
    found: list[Detection] = []
    spaces = None
    for keyword, rules in KEYWORDS.items():
        if keyword not in plain:
            continue
        for r in rules:
            for m in r.pattern.finditer(plain):
                if spaces is None:
                    spaces = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
                first, last = np.searchsorted(spaces, (m.start() - 1, m.end()))
                found.append(Detection(r.label, r.priority, int(first), int(last), r.base))
    kept = [d for d in found if d.base]
    taken = _Taken()
    for d in sorted((d for d in found if not d.base), key=lambda d: (d.priority, d.start - d.end, d.start, d.label)):
        if not taken.covers(d.start, d.end):
            taken.add(d.start, d.end)
            kept.append(d)
    return len(words), sorted(kept, key=lambda d: (d.start, d.end, d.label))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, detections array of label, priority, first word, end word, base) of each row.

    Null and empty texts have no words and no detections.  Rows are judged one by one, so repeated
    ids and texts give repeated rows.  Other columns are not read.
    """

    def row(text: bytes) -> tuple:
        n, found = scan(text)
        return n, [d._asdict() for d in found]

    return by_text(docs, row, "n_words long, detections array<struct<label:string,priority:int,start:long,end:long,base:boolean>>")
