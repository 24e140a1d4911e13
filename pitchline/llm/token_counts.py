"""Token counts under a unigram model by dynamic programming over a trie.

Pre-tokens are runs without ASCII white space, with the word mark before them.  The different ones of
a batch are put into a trie that is walked depth first: in sorted order, the path from the root to
the current node is all of the trie that is needed, and the forward scores of a shared prefix are
computed once.  A node's score is the best sum of log-probabilities over the ways to cut its prefix into
pieces, with the number of pieces of that way.  Terminal nodes' counts are stored and looked up for each
occurrence.

Pieces come from a public vocabulary in the order of their scores; the piece of rank r has probability
proportional to 1 / (r + 1).  A character without a piece costs one byte piece for each byte of its UTF-8.
Of two ways with equal scores the one with fewer pieces counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, slices, vocabulary

MARK = "▁"


class Unigram:
    #: Characters of a word whose scores are kept for the next word.
    HELD = 4096

    def __init__(self, pieces: dict[str, float], byte_cost: float):
        self.pieces, self.byte_cost = pieces, byte_cost
        self.longest = max(map(len, pieces), default=1)
        # lengths of pieces by their last character: what can end at a node
        ends: dict[str, set[int]] = {}
        for p in pieces:
            ends.setdefault(p[-1], set()).add(len(p))
        self.ends = {c: sorted(n) for c, n in ends.items()}

    @classmethod
    def load(cls, path: str) -> Unigram:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary(path))
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        ids.sort(key=lambda i: (-model.get_score(i), i))
        total = sum(1 / (r + 1) for r in range(len(ids) + 256))
        pieces = {model.id_to_piece(i): -log(r + 1) - log(total) for r, i in enumerate(ids)}
        return cls(pieces, -log(len(ids) + 256) - log(total))

    def walk(self, words: list[str]) -> dict[str, tuple[int, float]]:
        """(pieces, score) of each word; words are sorted and different.

        The path holds the first HELD characters' scores for the words that share them; beyond, only as many as the longest piece
        looks back.
        """
        out: dict[str, tuple[int, float]] = {}
        path: list[tuple[float, int]] = [(0.0, 0)]  # (score, -pieces) of each prefix of the last word
        last, pieces, ends, none, held = "", self.pieces, self.ends, (), max(self.HELD, self.longest)
        for word in words:
            shared, most = 0, min(len(last), len(word), held)
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del path[shared + 1 :]
            far: list[tuple[float, int]] = []  # prefixes from gone + 1 on, where they are longer than held
            gone = held
            for d in range(shared + 1, len(word) + 1):
                best = None
                for n in ends.get(word[d - 1], none):
                    if n > d:
                        break
                    p = pieces.get(word[d - n : d])
                    if p is not None:
                        s, k = path[d - n] if d - n <= held else far[d - n - gone - 1]
                        if best is None or (s + p, k - 1) > best:
                            best = (s + p, k - 1)
                if best is None:
                    s, k = path[d - 1] if d - 1 <= held else far[d - 2 - gone]
                    b = len(word[d - 1].encode())
                    best = (s + b * self.byte_cost, k - b)
                if d <= held:
                    path.append(best)
                else:
                    far.append(best)
                    if len(far) >= 4 * held:
                        gone += len(far) - self.longest
                        del far[: len(far) - self.longest]
            last = word
            score, less = far[-1] if far else path[-1]
            out[word] = (-less, score)
        return out


class Terminals:
    """Counts and scores of the pre-tokens seen, up to LIMIT of them; the later half is forgotten first, as frequent ones come early."""

    LIMIT = 300_000

    def __init__(self, model: Unigram):
        self.model = model
        self.counts: dict[bytes, int] = {}
        self.scores: dict[bytes, float] = {}

    def of(self, texts: list[list[bytes]]) -> list[tuple[int, float]]:
        """(tokens, score) of each list of pre-tokens; new ones of all lists share one trie."""
        if len(self.counts) > self.LIMIT:
            for k in list(islice(self.counts, self.LIMIT // 2, None)):
                del self.counts[k], self.scores[k]
        new = set().union(*texts) - self.counts.keys()
        words = {MARK + r.decode(): r for r in new}
        for word, (n, score) in self.model.walk(sorted(words)).items():
            run = words[word]
            self.counts[run], self.scores[run] = n, score
        count, score_of = self.counts.__getitem__, self.scores.__getitem__
        return [(sum(map(count, t)), sum(map(score_of, t))) for t in texts]


@lru_cache(maxsize=4)
def _terminals(path: str) -> Terminals:
    return Terminals(Unigram.load(path))


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, log_prob) of each row; model: path, or name of a public file, of a sentencepiece vocabulary.

    Null and empty texts have no pre-tokens, no tokens and log_prob 0.  Each row is counted by itself,
    so repeated rows give repeated rows.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t.split() for t in byte_texts(batch.column(1))]
            tokens, scores = zip(*_terminals(model).of(texts))
            columns = [pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array(map(float, scores), pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_pretokens", "n_tokens", "log_prob"])

    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_pretokens long, n_tokens long, log_prob double")
