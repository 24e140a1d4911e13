from math import isclose

from pitchline.llm.common import vocabulary
from pitchline.llm.token_counts import MARK, Terminals, Unigram, count_tokens

from .conftest import key

FILE = vocabulary("piece_bpe_32k.model")


def by_all_cuts(model, word):
    """The best score and its fewest pieces over every way to cut the word."""
    if not word:
        return (0.0, 0)
    ways = []
    for n in range(1, len(word) + 1):
        if word[:n] in model.pieces:
            s, k = by_all_cuts(model, word[n:])
            ways.append((s + model.pieces[word[:n]], k - 1))
    if not ways or not any(word[:1] == p for p in model.pieces):
        b = len(word[0].encode())
        s, k = by_all_cuts(model, word[1:])
        if not any(word[:1].endswith(p[-1]) for p in model.pieces):
            ways.append((s + b * model.byte_cost, k - b))
    return max(ways)


def test_all_cuts_of_short_words():
    model = Unigram({MARK: -3.0, "a": -2.0, "b": -2.5, "ab": -3.5, "aba": -5.0, MARK + "a": -4.0, "ba": -4.4, "c": -6.0}, -9.0)
    words = sorted({MARK + "".join(w) for n in range(6) for w in __import__("itertools").product("abcé", repeat=n)})
    for word, (n, s) in model.walk(words).items():
        ways = by_all_cuts(model, word)
        assert isclose(s, ways[0]) and (n == -ways[1] or isclose(s, ways[0])), word


def plain(model, word):
    best = [(0.0, 0)]
    for d in range(1, len(word) + 1):
        ways = [(best[d - n][0] + model.pieces[word[d - n : d]], best[d - n][1] - 1) for n in range(min(d, model.longest), 0, -1) if word[d - n : d] in model.pieces]
        if not ways:
            b = len(word[d - 1].encode())
            ways = [(best[d - 1][0] + b * model.byte_cost, best[d - 1][1] - b)]
        best.append(max(ways))
    return best[-1]


def test_against_one_word_at_a_time(documents, rows, odd, odd_rows, empty):
    model = Unigram.load(FILE)
    known = {}
    for df, data in ((documents, rows[:300]), (odd, odd_rows)):
        got = sorted((tuple(r) for r in count_tokens(df, FILE).collect()), key=key)
        want = []
        for d, t, *_ in data:
            found = [known.setdefault(w, plain(model, MARK + w)) for w in (x.decode() for x in (t or "").encode().split())]
            want.append((d, len(found), -sum(k for _, k in found), sum(s for s, _ in found)))
        ids = {d for d, *_ in data}
        got = [g for g in got if g[0] in ids]
        for g, w in zip(got, sorted(want, key=key), strict=True):
            assert g[:3] == w[:3] and isclose(g[3], w[3], rel_tol=1e-9, abs_tol=1e-9)
    assert count_tokens(empty, FILE).count() == 0


def test_a_full_store_forgets(monkeypatch):
    model = Unigram.load(FILE)
    store = Terminals(model)
    monkeypatch.setattr(Terminals, "LIMIT", 3)
    one = store.of([[b"alpha", b"beta", b"gamma", b"alpha", b"zeta"]])
    two = store.of([[b"delta"], [b"alpha", b"beta", b"gamma", b"alpha", b"zeta"], []])
    assert two[1][0] == one[0][0] and isclose(two[1][1], one[0][1]) and two[2] == (0, 0)
    store.of([[b"eta"]])
    assert len(store.counts) == len(store.scores) < 6


def test_long_words_keep_a_short_path(monkeypatch):
    import random

    rng = random.Random(1)
    model = Unigram({MARK: -3.0, "a": -2.0, "b": -2.5, "ab": -3.5, "aba": -5.0, MARK + "a": -4.0, "ba": -4.4, "abbab": -6.0}, -9.0)
    start = "".join(rng.choice("ab") for _ in range(300))
    words = sorted({MARK + start[: rng.randint(1, 300)] + "".join(rng.choice("abé") for _ in range(rng.randint(0, 200))) for _ in range(60)})
    want = {w: plain(model, w) for w in words}
    for held in (1, 7, 40):
        monkeypatch.setattr(Unigram, "HELD", held)
        for w, (n, s) in model.walk(words).items():
            assert n == -want[w][1] and isclose(s, want[w][0], rel_tol=1e-12)
