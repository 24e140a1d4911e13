from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchline.llm import mixing

from .conftest import DATA


def earliest_deadline_first(a, b, slots):
    """Two Pfair tasks, step by step: of the quanta released, the one with the earliest exact deadline."""
    total, done, out = a + b, [0, 0], []
    for t in range(slots):
        ready = [(Fraction((done[k] + 1) * total, w), -k, k) for k, w in enumerate((a, b)) if done[k] * total // w <= t]
        deadline, _, k = min(ready)
        assert -(-deadline.numerator // deadline.denominator) > t
        out.append(k)
        done[k] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(1, 60))
def test_the_closed_form_is_earliest_deadline_first(x, y):
    heavy, light = max(x, y), min(x, y)
    got = earliest_deadline_first(heavy, light, 3 * (heavy + light))
    for k, part in enumerate((heavy, light)):
        path = [(heavy + light, part, k == 0)]
        slots = [t for t, who in enumerate(got) if who == k]
        assert [mixing.slot_of(i, path) for i in range(len(slots))] == slots
        assert all(mixing.taken_by(t, path) == got[:t].count(k) for t in range(len(got) + 1))


def simulated(weights, slots):
    """The tree of pairs with each pair simulated: whose turn each slot is."""

    def turns(node, n):
        if node[0] == "leaf":
            return [node[2]] * n
        pair = earliest_deadline_first(node[2][1], node[3][1], n)
        sides = [iter(turns(node[2 + k], pair.count(k))) for k in (0, 1)]
        return [next(sides[k]) for k in pair]

    return turns(mixing.tree(weights), slots)


def mixed(quanta, weights):
    """The mix by simulation: (source, quantum) of each slot."""
    whole, used, out, left = mixing.whole_weights(weights), Counter(), [], dict(quanta)
    while left := {s: n for s, n in left.items() if n}:
        for s in simulated({s: whole[s] for s in left}, sum(left.values())):
            out.append((s, used[s]))
            used[s] += 1
            left[s] -= 1
            if not left[s]:
                break
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.tuples(st.integers(1, 80), st.floats(0.01, 5)), min_size=1))
def test_the_plan_is_the_simulated_mix(sources):
    quanta, weights = {s: n for s, (n, _) in sources.items()}, {s: w for s, (_, w) in sources.items()}
    got = {}
    for row in mixing.planned(quanta, weights):
        for i in range(row["n"]):
            t = row["start"] + mixing.slot_of(i, row["path"])
            assert t not in got
            got[t] = (row["source"], row["first"] + i)
    assert [got[t] for t in range(sum(quanta.values()))] == mixed(quanta, weights)


def deviation(quanta, weights):
    """(most behind, most ahead) of the given weights, in quanta, before and after every quantum of the first phase."""
    total = sum(map(Fraction, weights.values()))
    low = high = Fraction(0)
    seen = set()
    for row in mixing.planned(quanta, weights):
        if row["start"]:
            continue
        share = Fraction(weights[row["source"]]) / total
        for i in range(row["n"]):
            t = mixing.slot_of(i, row["path"])
            seen.add(t)
            low, high = min(low, i - share * t), max(high, i + 1 - share * (t + 1))
    assert seen == set(range(len(seen)))
    return low, high


MANY = {"hot": 2500} | {f"s{i}": 100 for i in range(200)}
GOLDEN = {f"f{i}": 1.618**i for i in range(24)}


@pytest.mark.parametrize(
    ("quanta", "weights"),
    [
        ({"a": 100_000, "b": 200_000}, {"a": 1.0, "b": 2.0}), ({"a": 300_000, "b": 31}, {"a": 9999.0, "b": 1.0}),
        ({s: 3000 * (8 - i) for i, s in enumerate("abcdef")}, {s: (8 - i) ** 0.3 / (i + 1) for i, s in enumerate("abcdef")}),
        (MANY, {"hot": 2_000_000**0.5} | {f"s{i}": 20_000**0.5 for i in range(200)}), ({s: int(40 * w) + 1 for s, w in GOLDEN.items()}, GOLDEN),
        ({f"e{i}": 40 for i in range(31)}, {f"e{i}": 1.0 for i in range(31)}), ({"a": 300, "b": 300, "c": 300, "d": 20}, {"a": 1.0, "b": 1.0, "c": 1.0, "d": 1e-9}),
    ],
)
def test_every_source_keeps_within_a_block_of_its_given_weight(quanta, weights):
    low, high = deviation(quanta, weights)
    assert low > -1 and high < 2.36
    assert max(-low, high) * mixing.QUANTUM < mixing.BLOCK


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(1e-6, 1e6), min_size=1, max_size=40))
def test_random_weights_keep_within_a_block(weights):
    named = {f"s{i}": w for i, w in enumerate(weights)}
    low, high = deviation(dict.fromkeys(named, 60), named)
    assert low > -1 and high < 2.36


def brute(rows, draws, block=8, quantum=2):
    """(doc_id, source, block, slot, place) by simulation; rows of different ids."""
    sizes = Counter(s for _, s in rows)
    quanta = {s: -(-n // quantum) for s, n in sizes.items()}
    slot = {x: t for t, x in enumerate(mixed(quanta, mixing.temperature(sizes)))}
    members = defaultdict(list)
    for d, s in rows:
        members[s].append((draws[d] % (1 << 64), d))
    out = []
    for s, mine in members.items():
        out += [(d, s, i // block, slot[s, i // quantum], i % quantum) for i, (_, d) in enumerate(sorted(mine))]
    return sorted(out)


def test_documents(documents, rows):
    draws = {r.doc_id: r.draw for r in documents.selectExpr("doc_id", "xxhash64(doc_id) as draw").collect()}
    got = mixing.mix(documents).select("doc_id", "source", "block", "slot", "place")
    assert sorted(map(tuple, got.collect())) == brute([(d, s) for d, _, _, s in rows], draws)


def test_the_query_is_the_mix(spark, documents):
    from pitchline.llm.queries import op6_mixing

    assert sorted(map(tuple, op6_mixing(spark, DATA).collect())) == sorted(map(tuple, mixing.mix(documents).collect()))


def whole(got, sizes):
    """Places are different, whole blocks have BLOCK documents, and every source has its rows."""
    assert len({(r.slot, r.place) for r in got}) == len(got)
    assert Counter(r.source for r in got) == sizes
    for (s, b), n in Counter((r.source, r.block) for r in got).items():
        assert n == min(mixing.BLOCK, sizes[s] - mixing.BLOCK * b)


def test_hot_ids(spark):
    hot = [(7 if i % 3 else i, "hot" if i % 2 else f"s{i % 5}") for i in range(900)] + [(None, None)] * 100
    df = spark.createDataFrame(hot, "doc_id long, source string")
    whole(mixing.mix(df).collect(), Counter(s for _, s in hot))


def test_odd_rows(spark, odd, odd_rows, empty):
    whole(mixing.mix(odd).collect(), Counter(s for *_, s in odd_rows))
    assert mixing.mix(empty).count() == 0
    assert {r.source for r in mixing.mix(odd).select("source").distinct().collect()} == {None, "a", "b"}
    back = mixing.mixed_documents(odd)
    assert back.columns == odd.columns and sorted(map(str, back.collect())) == sorted(map(str, odd.collect()))
    assert mixing.mixed_documents(empty).count() == 0
    text_ids = spark.createDataFrame([(f"x{i}", "t", "en", "s") for i in range(20)], "doc_id string, text string, lang string, source string")
    whole(mixing.mix(text_ids).collect(), Counter({"s": 20}))
    clash = odd.withColumnsRenamed({"kind": "_metadata", "slot": "whole", "row": "rank"})
    assert sorted(mixing.mixed_documents(clash).columns) == sorted(clash.columns)


def test_weights_must_be_positive(odd):
    with pytest.raises(ValueError, match="positive weight"):
        mixing.mix(odd, {"a": 1.0})


def test_a_plan_is_written_in_parts(spark, monkeypatch):
    from pitchline.llm.common import Workspace

    quanta, weights = {None: 70, "a": 300, "b": 5}, {None: 0.2, "a": 0.7, "b": 0.1}
    monkeypatch.setattr(mixing, "PLAN_ROWS", 2)
    table = mixing.plan_table(Workspace(spark, "t"), quanta, weights).collect()
    got = sorted((r.start, r.source or "", r.first, r.n, [(int(p.whole), int(p.part), p.heavy) for p in r.path]) for r in table)
    assert got == sorted((r["start"], r["source"] or "", r["first"], r["n"], r["path"]) for r in mixing.planned(quanta, weights))


def test_long_schedules_are_exact_in_columns(spark):
    from pyspark.sql import functions as F

    weights = mixing.whole_weights({f"s{i}": (1 + i) ** 0.5 for i in range(40)})
    roads = mixing.paths(weights)
    rows = [(s, i) for s in roads for i in (0, 1, 12345678901, 1 << 40)]
    kind = "s string, i long, path array<struct<whole:decimal(38,0),part:decimal(38,0),heavy:boolean>>"
    from decimal import Decimal

    df = spark.createDataFrame([(s, i, [(Decimal(a), Decimal(b), h) for a, b, h in roads[s]]) for s, i in rows], kind)
    got = {(r.s, r.i): r.t for r in df.select("s", "i", mixing.slot(F.col("i"), F.col("path")).alias("t")).collect()}
    assert got == {(s, i): mixing.slot_of(i, roads[s]) for s, i in rows}
