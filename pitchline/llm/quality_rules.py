"""Quality rules: fixed limits, then robust multivariate outliers.

Five counts are taken of each text.  Documents that pass the fixed limits become vectors of VARIABLES; for each language and source
the minimum-covariance-determinant estimate gives a centre and a covariance that outliers do not move.  The search
starts from three estimates (median and median deviation; spatial signs; mean and covariance).  Each step keeps the HALF
(75 %) of the documents that are nearest and takes mean and covariance of these, until the determinant falls no
more; the start that ends with the least determinant counts, and is reweighted: mean and covariance of all
documents within CUTOFF of it.  Documents whose squared Mahalanobis distance is over CUTOFF are rejected.

Most documents have no symbols and no repeats, so a covariance alone would be singular and any deviation infinite: FLOORS squared
are added to the variances, as deviations that a source is always allowed.  Alone, a variable rejects when word length is off by
10 % or more (more where the source's own words vary), with 1.3 % of symbols, 40 % of repeated lines or 28 % of repeated words.

Estimates are made for each language and source, each language and the corpus.  What judges a group is that of its own documents
mixed with PRIOR documents of its parent, so small groups follow their language, small languages the corpus, and large ones
themselves; the covariance is that of the mixture, so it is wide where a small group stands apart.

Vectors are whole numbers (thousandths), so sums are exact and results do not depend on how rows are
partitioned; quantiles are taken exactly over rounded values, of which there are few.  Equal vectors of a group are one row with a
weight from the start: the search reads these points alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

LEAST_WORDS, MOST_REPEATED, REPEAT = 20, 30, 8
VARIABLES = ("x0", "x1", "x2", "x3")  # log word length, log symbol rate, shares of repeated lines and of repeated words
FLOORS = (0.03, 0.25, 0.12, 0.085)
UNIT = 1000
HALF = 0.75
#: Steps of a start at most; it has ended when the determinant falls no more (after 2 to 4 steps on the test data).
STEPS = 20
#: Chi-square of 4 variables, quantile 0.975.
CUTOFF = 11.143
#: What makes the covariance of the nearest 75 % (97.5 %) of normal vectors in 4 dimensions that of all of them.
CONSISTENCY, REWEIGHTED = 1.486, 1.065
#: With how many documents of its parent a group is mixed, whatever its own number.
PRIOR = 40
#: Estimates are sent to the executors up to this number of rows (of 200 bytes), joined by key beyond it.
SENT_ROWS = 50_000

_SPACE = "[\\x20\\x09-\\x0D]+"


def _shift(a: Column, by: int) -> Column:
    return F.slice(a, by + 1, F.greatest(F.size(a), F.lit(1)))


def _pairs(a: Column, by: int) -> Column:
    return F.zip_with(a, _shift(a, by), lambda x, y: F.xxhash64(x, y))


def _repeated(windows: Column) -> Column:
    """Words in windows that occur twice or more: sort (hash, place), mark equal neighbours, add up what they cover."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = F.zip_with(placed, _shift(placed, 1), lambda x, y: F.coalesce(x.h == y.h, F.lit(False)))
    before = F.concat(F.array(F.lit(False)), same)
    both = F.zip_with(placed, F.zip_with(same, before, lambda x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))), lambda p, on: F.when(on, p.i))
    starts = F.sort_array(F.array_compact(both))
    covers = F.zip_with(starts, _shift(starts, 1), lambda x, y: F.least(F.lit(REPEAT), F.coalesce(y - x, F.lit(REPEAT))).cast("long"))
    return F.aggregate(covers, F.lit(0).cast("long"), lambda a, x: a + x)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, group keys and the counts of each row, and its vector (null for texts without words)."""
    text = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("g_lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("g_source"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    split = text.select("doc_id", "g_lang", "g_source", F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("lines"), F.array_remove(F.split("text", _SPACE), "").alias("words"))
    hashed = split.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    for_all = ["doc_id", "g_lang", "g_source", "n_symbols"]
    counted = hashed.select(*for_all, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "h1")
    for_all += ["n_words", "word_chars", "n_lines", "n_dup_lines"]
    two = counted.select(*for_all, _pairs(F.col("h1"), 1).alias("h2"))
    four = two.select(*for_all, _pairs(F.col("h2"), 2).alias("h4"))
    eight = four.select(*for_all, _pairs(F.col("h4"), 4).alias("h8"))
    windows = eight.select(*for_all, F.slice("h8", 1, F.greatest(F.size("h8") - REPEAT + 1, F.lit(0))).alias("windows"))
    again = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), _repeated(F.col("windows"))).otherwise(F.lit(0).cast("long"))
    found = windows.select(*for_all, again.alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    whole = lambda c: F.round(c * UNIT).cast("long")
    has = F.col("n_words") > 0
    vector = (
        F.log(F.col("word_chars") / F.col("n_words")),
        F.log1p(100 * F.col("n_symbols") / F.col("word_chars")),
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / F.col("n_words"),
    )
    return found.select("*", failed.alias("base_failed"), *(F.when(has, whole(v)).alias(x) for x, v in zip(VARIABLES, vector)))


def _distance(mean: list[Column], cov: dict[tuple[int, int], Column]) -> tuple[list[tuple[str, Column]], Column]:
    """(named steps of a Cholesky factor, squared distance by them) of the row's vector."""
    steps: list[tuple[str, Column]] = []
    n = len(VARIABLES)

    def name(what: str, c: Column) -> Column:
        steps.append((what, c))
        return F.col(what)

    low: dict[tuple[int, int], Column] = {}
    for i in range(n):
        for j in range(i + 1):
            rest = cov[j, i] - sum((low[i, k] * low[j, k] for k in range(j)), F.lit(0.0))
            low[i, j] = name(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / low[j, j])
    z: list[Column] = []
    for i in range(n):
        z.append((F.col(VARIABLES[i]) / UNIT - mean[i] - sum((low[i, k] * z[k] for k in range(i)), F.lit(0.0))) / low[i, i])
    return steps, sum((v * v for v in z[1:]), z[0] * z[0])


_PAIRS = [(i, j) for i in range(4) for j in range(i, 4)]
KEY = ["g_level", "g_lang", "g_source"]
_STATE = [*(f"m{i}" for i in range(4)), *(f"l{i}{j}" for i in range(4) for j in range(i + 1))]


def _factor(rows: DataFrame, keep: list[str], mean: list[Column], cov: dict[tuple[int, int], Column]) -> DataFrame:
    """keep, the centre, the Cholesky factor of the covariance and the logarithm of its determinant, of each row."""
    out = rows.select(*keep, *(m.alias(f"m{i}") for i, m in enumerate(mean)), *(c.alias(f"c{i}{j}") for (i, j), c in cov.items()))
    for what, c in _distance([F.col(f"m{i}") for i in range(4)], {k: F.col(f"c{k[0]}{k[1]}") for k in cov})[0]:
        out = out.withColumn(what, c)
    return out.select(*keep, *_STATE, sum((2 * F.log(f"l{i}{i}") for i in range(1, 4)), 2 * F.log("l00")).alias("logdet"))


def _squared() -> Column:
    return _distance([F.col(f"m{i}") for i in range(4)], {k: F.lit(0.0) for k in _PAIRS})[1]


def _bucket(d2: Column) -> Column:
    """Distances in steps of half a percent, so that few different values are counted."""
    return F.floor(F.log1p(d2) * 200).cast("long")


def _sums() -> list[Column]:
    """Number, sums and products of vectors, each as often as its weight says."""
    x = [F.col(v) for v in VARIABLES]
    w = F.col("w")
    return [F.sum(w).alias("n"), *(F.sum(w * x[i]).alias(f"s{i}") for i in range(4)), *(F.sum(w * x[i] * x[j]).alias(f"s{i}{j}") for i, j in _PAIRS)]


def _moments(factor: float) -> tuple[list[Column], dict[tuple[int, int], Column]]:
    """Mean and covariance from the columns of _sums(); the floors are added."""
    mean = [F.col(f"s{i}") / F.col("n") / UNIT for i in range(4)]
    cov = {}
    for i, j in _PAIRS:
        c = factor * (F.col(f"s{i}{j}") / F.col("n") / UNIT**2 - mean[i] * mean[j])
        cov[i, j] = F.greatest(c, F.lit(0.0)) + FLOORS[i] ** 2 if i == j else c
    return mean, cov


def starts(vectors: DataFrame, work: Workspace, sent) -> DataFrame:
    """Three estimates of each key, from which the search starts."""
    coarse = [F.round(F.col(x) / 20).cast("long") for x in VARIABLES]
    middle = work.save(vectors.groupBy(KEY).agg(*(F.percentile(c, 0.5, F.col("w")).alias(f"q{i}") for i, c in enumerate(coarse))), "medians")
    off = [F.percentile(F.abs(c - F.col(f"q{i}")).cast("long"), 0.5, F.col("w")).alias(f"d{i}") for i, c in enumerate(coarse)]
    middle = work.save(vectors.join(sent(middle), KEY).groupBy(*KEY, *(f"q{i}" for i in range(4))).agg(*off), "deviations")
    centre = [F.col(f"q{i}") * 20 / UNIT for i in range(4)]
    scale = [F.greatest(F.col(f"d{i}") * 20 / UNIT * 1.4826, F.lit(FLOORS[i])) for i in range(4)]
    z = [(F.col(x) / UNIT - centre[i]) / scale[i] for i, x in enumerate(VARIABLES)]
    signed = vectors.join(sent(middle), KEY).select(*KEY, *VARIABLES, "w", *(v.alias(f"z{i}") for i, v in enumerate(z)))
    length = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, 4)), F.col("z0") * F.col("z0")))
    unit = [F.when(length > 0, F.col(f"z{i}") / length).otherwise(0.0) for i in range(4)]
    # signs in millionths: whole numbers have the same sum in any order
    shape = [F.sum(F.col("w") * F.round(unit[i] * unit[j] * 1e6).cast("long")).alias(f"u{i}{j}") for i, j in _PAIRS]
    told = work.save(signed.groupBy(KEY).agg(*_sums(), *shape).join(middle, KEY), "spread")
    floor = lambda i, j: FLOORS[i] ** 2 if i == j else 0.0
    by_sign = {(i, j): 4 * F.col(f"u{i}{j}") / 1e6 / F.col("n") * scale[i] * scale[j] + floor(i, j) / 10 for i, j in _PAIRS}
    made = [(centre, {(i, j): scale[i] * scale[j] if i == j else F.lit(0.0) for i, j in _PAIRS}), (centre, by_sign), _moments(1.0)]
    parts = [_factor(told, KEY, *m).withColumn("start", F.lit(k)) for k, m in enumerate(made)]
    return reduce(DataFrame.unionByName, parts)


def estimates(vectors: DataFrame, work: Workspace, sent=lambda df: df) -> DataFrame:
    """Centre and factor of each key: KEY, _STATE and total, its number of documents.  sent: broadcasts a small table, if it is known to be one.

    Vectors may come with a weight w, how often each stands; without one each row counts once.
    """
    keys = [*KEY, "start"]
    weight = F.sum("w") if "w" in vectors.columns else F.count("*")
    vectors = work.save(vectors.groupBy(*KEY, *VARIABLES).agg(weight.alias("w")), "points")
    active = work.save(starts(vectors, work, sent), "start")
    ended: list[DataFrame] = []
    for step in range(STEPS):
        # one pass: sums by bucket of distance, of which a key has some hundreds; the nearest buckets are added up afterwards
        far = vectors.join(sent(active), KEY).withColumn("bucket", _bucket(_squared()))
        sums = work.save(far.groupBy(*keys, "bucket").agg(*_sums()), f"sums{step}")
        whole = Window.partitionBy(keys)
        told = sums.withColumn("all", F.sum("n").over(whole)).withColumn("nearer", F.sum("n").over(whole.orderBy("bucket")) - F.col("n"))
        near = told.filter(F.col("nearer") < F.ceil(HALF * F.col("all"))).groupBy(keys).agg(*(F.sum(c).alias(c) for c in sums.columns if c not in (*keys, "bucket")))
        new = _factor(near, keys, *_moments(CONSISTENCY))
        old = active.select(*keys, F.col("logdet").alias("last"))
        # what a start begins with is the covariance of no part of the rows, so its determinant does not count
        falls = F.lit(True) if step == 0 else F.col("logdet") < F.col("last") - 1e-9
        new = work.save(new.join(old, keys).withColumn("falls", falls).drop("last"), f"step{step}")
        if step:
            ended.append(active.join(new.filter("not falls").select(keys), keys, "left_semi").select(*keys, *_STATE, "logdet"))
        active = new.filter("falls").drop("falls")
        if active.isEmpty():
            break
    else:
        ended.append(active.select(*keys, *_STATE, "logdet"))
    every = reduce(DataFrame.unionByName, ended or [active.select(*keys, *_STATE, "logdet")])
    best = every.groupBy(KEY).agg(F.min(F.struct(F.round("logdet", 9).alias("logdet"), "start", *_STATE)).alias("b")).select(*KEY, *(F.col(f"b.{c}") for c in _STATE))
    best = work.save(best, "best")
    told = vectors.join(sent(best), KEY).withColumn("every", F.col("w")).withColumn("w", F.when(_squared() <= CUTOFF, F.col("w")).otherwise(0))
    near = told.groupBy(KEY).agg(F.sum("every").alias("total"), *_sums())
    return work.save(_factor(near, [*KEY, "total"], *_moments(REWEIGHTED)).drop("logdet"), "estimates")


def _mixed(rows: DataFrame, keep: list[str], parent: DataFrame, on: list[str]) -> DataFrame:
    """Estimates of rows mixed with PRIOR documents of their parent's."""
    above = parent.select(*on, *(F.col(c).alias(f"p_{c}") for c in _STATE))
    both = rows.join(above, on) if on else rows.crossJoin(above)  # the parent of all languages is one row
    own, share = F.col("total") / (F.col("total") + PRIOR), PRIOR / (F.col("total") + PRIOR)
    off = [F.col(f"m{i}") - F.col(f"p_m{i}") for i in range(4)]
    product = lambda p, i, j: sum((F.col(f"{p}l{j}{k}") * F.col(f"{p}l{i}{k}") for k in range(1, i + 1)), F.col(f"{p}l{j}0") * F.col(f"{p}l{i}0"))
    mean = [own * F.col(f"m{i}") + share * F.col(f"p_m{i}") for i in range(4)]
    cov = {(i, j): own * product("", i, j) + share * product("p_", i, j) + own * share * off[i] * off[j] for i, j in _PAIRS}
    return _factor(both, keep, mean, cov).drop("logdet")


def shrunk(made: DataFrame) -> DataFrame:
    """g_lang, g_source and _STATE of each group, from the estimates of all three levels."""
    of = lambda level: made.filter(F.col("g_level") == level)
    langs = _mixed(of(1), ["g_lang"], of(2), [])
    return _mixed(of(0), ["g_lang", "g_source"], langs, ["g_lang"])


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, the five counts, base_failed, kept, distance2) of each row.

    Null and empty texts have no words and fail.  Null languages and sources count as empty ones.  Repeated
    rows count as often as they stand and give equal rows.  The rule is one for groups and corpora of any size: a document that is
    alone in its group is judged by its language and corpus, and alone in the table it is kept.  distance2 is null where
    base_failed.  An empty table gives no rows.  Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "quality")
    measured = work.save(measures(docs), "measures")
    good = measured.filter("not base_failed")
    points = work.save(good.groupBy("g_lang", "g_source", *VARIABLES).agg(F.count("*").alias("w")), "vectors")
    number = points.select("g_lang", "g_source").distinct().count()
    sent = F.broadcast if number <= SENT_ROWS // 9 else lambda df: df  # at most three keys a group, three starts each
    levels = [(0, F.col("g_lang"), F.col("g_source")), (1, F.col("g_lang"), F.lit("")), (2, F.lit(""), F.lit(""))]
    keyed = F.inline(F.array(*(F.struct(F.lit(level).alias("g_level"), lang.alias("g_lang"), source.alias("g_source")) for level, lang, source in levels)))
    made = estimates(points.select(keyed, *VARIABLES, "w"), work, sent)
    state = shrunk(made).withColumnsRenamed({"g_lang": "of_l", "g_source": "of_s"})
    state = work.save(state, "state")
    work.only("measures", "state")
    told = measured.join(sent(state), (measured["g_lang"] == state["of_l"]) & (measured["g_source"] == state["of_s"]), "left")
    d2 = F.when(~F.col("base_failed"), _squared())
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return told.select("doc_id", *counts, "base_failed", (~F.col("base_failed") & F.coalesce(d2 <= CUTOFF, F.lit(True))).alias("kept"), d2.alias("distance2"))
