"""Language identification by the nearest centroid.

Features are hashed byte 2- and 3-grams of the lower-cased text, without digits and ASCII punctuation:
(1 + log count) * idf, normalised.  Each language's training vectors are clustered into CLUSTERS centroids
by spherical k-means; a text takes the language of the centroid with the largest cosine.  A text farther from
that centroid (1 - cosine) than the language's radius is rejected: the radius is the largest distance of
a training text of the language from its nearest centroid, plus SLACK.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_texts, slices

DIMENSIONS = 4096
CLUSTERS = 4
#: Most training documents in all, and the most of one language; texts are drawn by a hash of their ids and themselves.
SAMPLE, SAMPLE_OF_LANGUAGE = 4000, 800
#: Languages that are learned: the most frequent ones, if labels name more.
LANGUAGES = 1000
SLACK = 0.1
#: Bytes of texts whose n-grams are counted at once.
PIECE = 1 << 20

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
UNKNOWN = "und"


def counts(texts: list[bytes]) -> np.ndarray:
    """Hashed n-gram counts, a row for each text."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        if not held:
            return
        b = np.frombuffer(b"".join(x for _, x in held), np.uint8).astype(np.uint32)
        owner = np.repeat(np.arange(len(held)), [len(x) for _, x in held])
        two = (b[:-1] * np.uint32(0x9E3779B1)) ^ (b[1:] * np.uint32(0x85EBCA77))
        three = two[:-1] ^ (b[2:] * np.uint32(0xC2B2AE3D))
        whole = np.zeros(len(held) * DIMENSIONS, np.int64)
        for h, n in ((two, 2), (three, 3)):
            h = h ^ (h >> np.uint32(15))
            h = (h * np.uint32(0x2C1B3C6D + n - n % 2)) >> np.uint32(20)
            ok = owner[: len(h)] == owner[n - 1 :]
            if n == 2:  # a piece's last bytes stand first in the next piece as well, for their 3-grams
                ok[:-1] &= owner[: len(h) - 1] == owner[2:]
                ok[-1] = False
            whole += np.bincount(owner[: len(h)][ok] * DIMENSIONS + h[ok], minlength=len(whole))
        for row, part in zip((i for i, _ in held), whole.reshape(len(held), DIMENSIONS)):
            out[row] += part

    for i, text in enumerate(texts):
        plain = b" " + b" ".join(text.translate(_LETTERS).split()) + b"  "
        if len(plain) <= 3:
            continue
        for at in range(0, len(plain) - 2, PIECE):
            part = plain[at : at + PIECE + 2]
            if size + len(part) > PIECE or len(held) >= 256:
                flush()
                held, size = [], 0
            held.append((i, part))
            size += len(part)
    flush()
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    radius: np.ndarray

    def vectors(self, texts: list[bytes]) -> np.ndarray:
        return unit(np.log1p(counts(texts)) * self.idf)

    def nearest(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, cosine, whether it is rejected) of each text."""
        cosine = self.vectors(texts) @ self.centroids.T
        at = cosine.argmax(axis=1)
        best = np.clip(cosine[np.arange(len(at)), at], 0, 1).astype(float)
        owner = self.owner[at]
        return owner, best, 1 - best > self.radius[owner]


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from the farthest points; the same rows in the same order give the same centroids."""
    chosen = [unit(x.mean(axis=0, keepdims=True))[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(x[(x @ np.array(chosen).T).max(axis=1).argmin()])
    centroids = np.array(chosen)
    for _ in range(rounds):
        nearest = (x @ centroids.T).argmax(axis=1)
        centroids = np.array([unit(x[nearest == c].mean(axis=0, keepdims=True))[0] if (nearest == c).any() else centroids[c] for c in range(len(centroids))])
    return centroids


def fit(rows: list[tuple[str, np.ndarray]]) -> Model | None:
    """rows: (language, n-gram counts)."""
    rows = [(lang, x) for lang, x in rows if x.any()]
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    raw = np.array([x for _, x in rows])
    idf = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 1).astype(np.float32)
    x = unit(np.log1p(raw) * idf)
    label = np.array([languages.index(lang) for lang, _ in rows])
    parts = [k_means(x[label == i], CLUSTERS) for i in range(len(languages))]
    radius = [float((1 - (x[label == i] @ c.T).max(axis=1)).max()) + SLACK for i, c in enumerate(parts)]
    return Model(languages, idf, np.concatenate(parts).astype(np.float32), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.array(radius))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame) -> Model | None:
    """A model from the texts and languages of documents that are not held out.

    Null languages, and texts without a letter, teach nothing.  At most SAMPLE documents are used, drawn
    alike from each of the LANGUAGES most frequent languages by a hash of doc_id and text, equal rows once; their n-gram counts, of
    fixed size, go to the driver.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    if not sizes:
        return None
    quota = max(1, min(SAMPLE_OF_LANGUAGE, SAMPLE // len(sizes)))
    # a language is drawn to twice its quota, and a little: a draw that falls short of it is next to impossible
    share = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, (2.0 * quota + 20) / n))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    drawn = known.select("doc_id", "lang", "text", draw.alias("draw")).filter(F.col("draw") < share[F.col("lang")] * (1 << 30))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            packed = [x.astype("<u4").tobytes() for x in counts(byte_texts(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], ["lang", "draw", "counts"])

    made = drawn.select("lang", "text", "draw").mapInArrow(rows, "lang string, draw long, counts binary")
    first = Window.partitionBy("lang").orderBy("draw", "counts")
    # equal rows are one before they are ranked, so a language has about twice its quota here
    got = made.distinct().withColumn("at", F.row_number().over(first)).filter(F.col("at") <= quota).collect()
    return fit([(r["lang"], np.frombuffer(bytes(r["counts"]), "<u4").astype(np.float32)) for r in sorted(got, key=lambda r: (r["lang"], r["at"]))])


RESULT = "lang_pred string, score double, rejected boolean"


def predictor(docs: DataFrame, model: Model | None):
    """A Column function: text -> struct of RESULT.  Documents' other columns stay in the JVM."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 4,096 numbers for each centroid; the sample bounds the languages

    @F.arrow_udf(RESULT)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for column in batches:
            parts: list[tuple] = []
            for at in range(0, len(column), 256):
                texts = byte_texts(column.slice(at, 256))
                letters = [any(map(str.isalpha, t.decode())) for t in texts]
                if m is None:
                    parts += [(UNKNOWN, 0.0, True)] * len(texts)
                    continue
                for has, lang, score, far in zip(letters, *(v.tolist() for v in m.nearest(texts))):
                    parts.append((m.languages[lang], score, far) if has else (UNKNOWN, 0.0, True))
            cols = zip(*parts) if parts else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.bool_()))], ["lang_pred", "score", "rejected"])

    return predict


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of each row.

    lang_pred is always the nearest learned language, also for rejected texts, but `und`, score 0 and
    rejected for null texts and texts without a letter, and for all if nothing was learned.  Texts alone
    decide, so repeated rows give repeated rows; of equal cosines the first language in the alphabet wins.
    """
    found = predictor(docs, model)(F.col("text").cast("string"))
    return docs.select("doc_id", found.alias("r")).select("doc_id", "r.lang_pred", "r.score", "r.rejected")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows of docs whose language is known and not rejected, with their columns."""
    found = predictor(docs, model)(F.col("text").cast("string"))
    return docs.filter(~found.getField("rejected"))
