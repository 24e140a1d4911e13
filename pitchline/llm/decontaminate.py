"""Benchmark decontamination.

Words are runs of letters and digits, lower-cased; shingles are SHINGLE = 5 words.  A document's windows have the item's
number of words (a shorter document is one window).  A window matches at a weighted Jaccard similarity of
SIMILARITY = 0.8 or more of their shingles, repeats counted.

Candidates are found in three steps, each of which loses no match:
1. A match lacks at most a fifth of the item's shingles.  So of any fifth of them plus one, some stand in the window: the item is
   indexed by its rarest ones, and a document's shingles are looked up there.
2. Windows around such places and their items have 128-bit SimHashes.  A match and its item differ by a known number of shingles at most, so a bit
   whose vote was won by more cannot differ: it is firm.  A window whose fingerprint differs from the item's in a firm bit goes.  The other bits are the item's
   radius: how many of them may differ follows from its votes, about half of them for 10 shingles and nearly all for 1000.
3. The rest is verified by the exact similarity, for all windows of a stretch at once.

A benchmark of more than BLOCK_BYTES is matched in blocks of that size, one after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, Workspace, byte_texts, mix, slices, window_hashes

SHINGLE, SIMILARITY = 5, 0.8
#: UTF-8 bytes of items that are sent to the executors at a time; a task's index takes about four times as much.
BLOCK_BYTES = 16 << 20
#: Bits of the address of the bitmap that is asked before the index.
MAYBE = 22

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_seen = WordHashes()


def shingles(text: bytes) -> tuple[int, np.ndarray]:
    """(number of words, hashes of the shingles; a text of fewer words is one shingle)."""
    h = _seen.of(text.translate(_WORDS).split())
    return len(h), window_hashes(h, min(SHINGLE, len(h))) if len(h) else h


def bit_rows(s: np.ndarray) -> np.ndarray:
    """The 128 bits that each shingle votes with."""
    both = np.stack((s, mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))), axis=1)
    return np.unpackbits(both.view(np.uint8), axis=1)


def prints(ones: np.ndarray, count: int) -> np.ndarray:
    return np.packbits(2 * ones > count, axis=1)


def least_common(a: int, b: int) -> int:
    """How many shingles two texts of a and b shingles share at least, repeats counted, if they match."""
    return int(np.ceil(SIMILARITY * (a + b) / (1 + SIMILARITY) - 1e-9))


def firm_bits(votes: np.ndarray, differing: int) -> np.ndarray:
    """The bits that stay as they are when so many shingles go or come.  votes: ones less zeros; a bit is one above zero."""
    return np.packbits((votes > differing) | (votes <= -differing))


class Items:
    """The texts of a block, ready for lookup: flat arrays, an entry for each text or for each of its shingles."""

    def __init__(self, texts: list[bytes]):
        self.number, sizes, lengths, parts, fingers, votes = [], [], [], [], [], []
        for i, text in enumerate(texts):
            n, s = shingles(text)
            if n:
                self.number.append(i)
                sizes.append(n)
                lengths.append(len(s))
                parts.append(np.sort(s))
                ones = bit_rows(s).sum(axis=0, dtype=np.int64)
                fingers.append(prints(ones[None, :], len(s))[0])
                votes.append(np.clip(2 * ones - len(s), -(1 << 15) + 1, (1 << 15) - 1).astype(np.int16))
        self.sizes, self.lengths = np.array(sizes, np.int64), np.array(lengths, np.int64)
        self.fingers, self.votes = np.array(fingers, np.uint8).reshape(-1, 16), np.array(votes, np.int16).reshape(-1, 128)
        every = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(parts)), self.lengths)
        # different shingles of each item with their counts
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        self.keys, owned = every[first], owner[first]
        self.counts = np.diff(np.append(first, len(every)))
        self.ends = np.searchsorted(owned, np.arange(len(parts) + 1))
        # an item is indexed by the rarest of its shingles: as many, repeats counted, as a match cannot lack all of
        _, back, held = np.unique(self.keys, return_inverse=True, return_counts=True)
        order = np.lexsort((self.keys, held[back], owned))
        before = np.cumsum(self.counts[order]) - self.counts[order]
        base = np.zeros(len(parts), np.int64)
        base[1:] = np.cumsum(self.lengths)[:-1]
        most = np.floor((1 - SIMILARITY) * self.lengths + 1e-9).astype(np.int64)
        rare = order[before - base[owned[order]] <= most[owned[order]]]
        rare = rare[np.argsort(self.keys[rare], kind="stable")]
        self.index, start = np.unique(self.keys[rare], return_index=True)
        self.post, self.post_at = owned[rare], np.append(start, len(rare))
        self.maybe = np.zeros(1 << MAYBE, bool)
        self.maybe[(self.index & np.uint64((1 << MAYBE) - 1)).astype(np.int64)] = True

    def matches(self, text: bytes) -> list[tuple[int, float, int, int]]:
        """(number of the text, similarity, first word, words) of the best window of each text that is found in this one."""
        n, s = shingles(text)
        if not n or not len(self.index):
            return []
        hit = np.flatnonzero(self.maybe[(s & np.uint64((1 << MAYBE) - 1)).astype(np.int64)])
        at = np.searchsorted(self.index, s[hit])
        at[at == len(self.index)] = 0
        real = self.index[at] == s[hit]
        hit, at = hit[real], at[real]
        if not len(hit):
            return []
        many = self.post_at[at + 1] - self.post_at[at]
        skip = np.repeat(self.post_at[at] - np.concatenate(([0], np.cumsum(many)[:-1])), many)
        items, places = self.post[skip + np.arange(many.sum())], np.repeat(hit, many)
        order = np.argsort(items, kind="stable")
        items, places = items[order], places[order]
        out = []
        edges = edges_of(items)
        for lo, hi in zip(edges[:-1], edges[1:]):
            best = self._best(s, n, int(items[lo]), places[lo:hi])
            if best:
                out.append(best)
        return out

    def _best(self, s: np.ndarray, n: int, i: int, places: np.ndarray) -> tuple[int, float, int, int] | None:
        words = min(int(self.sizes[i]), n)
        wide = max(1, words - SHINGLE + 1)
        last, length = len(s) - wide, int(self.lengths[i])
        common = least_common(length, wide)
        if common > min(length, wide):
            return None
        firm = firm_bits(self.votes[i].astype(np.int64), length + wide - 2 * common)
        lo, hi = np.maximum(0, places - wide + 1), np.minimum(places, last)
        # stretches of windows, so that sums stay small; places ascend
        cut = np.flatnonzero(lo[1:] > hi[:-1] + 1) + 1
        best = None
        for a, z in zip(lo[np.append(0, cut)].tolist(), hi[np.append(cut - 1, len(hi) - 1)].tolist()):
            for a in range(a, z + 1, 4096):
                e = min(z, a + 4095)
                total = np.concatenate((np.zeros((1, 128), np.int32), np.cumsum(bit_rows(s[a : e + wide]), axis=0, dtype=np.int32)))
                fingers = prints(total[wide : wide + e - a + 1] - total[: e - a + 1], wide)
                starts = np.flatnonzero(~((fingers ^ self.fingers[i]) & firm).any(axis=1))
                if not len(starts):
                    continue
                sims = self._similar(s[a : e + wide], starts, wide, i)
                at = int(sims.argmax())
                if sims[at] >= SIMILARITY and (best is None or sims[at] > best[1]):
                    best = (self.number[i], float(sims[at]), a + int(starts[at]), words)
        return best

    def _similar(self, part: np.ndarray, starts: np.ndarray, wide: int, i: int) -> np.ndarray:
        """Weighted similarity of the windows of part at given starts with an item."""
        keys, counts = (x[self.ends[i] : self.ends[i + 1]] for x in (self.keys, self.counts))
        at = np.searchsorted(keys, part)
        at[at == len(keys)] = 0
        place = np.flatnonzero(keys[at] == part)
        used, column = np.unique(at[place], return_inverse=True)
        same = np.zeros(len(starts), np.int64)
        for k in range(0, len(used), 256):  # so many of the item's shingles at a time
            mine = (column >= k) & (column < k + 256)
            seen = np.zeros((len(part) + 1, min(256, len(used) - k)), np.int32)
            seen[place[mine] + 1, column[mine] - k] = 1
            np.cumsum(seen, axis=0, out=seen)
            same += np.minimum(seen[starts + wide] - seen[starts], counts[used[k : k + 256]]).sum(axis=1)
        return same / (wide + int(self.lengths[i]) - same)


def edges_of(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start, and the end."""
    return np.append(np.flatnonzero(np.append(True, x[1:] != x[:-1])), len(x))


#: The index of the block that a worker's tasks use.
_held: dict[str, Items] = {}


def _index(block: str, texts: list[bytes]) -> Items:
    if block not in _held:
        _held.clear()
        _held[block] = Items(texts)
    return _held[block]


FOUND = "key string, similarity double, first_word long, words long"


def _matched(docs: DataFrame, texts: list[tuple[str, bytes]]) -> DataFrame:
    """(doc_id, key, similarity, first_word, words) for the documents in which the texts of a block are found."""
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    block = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(block, [t for _, t in shared.value])
        keys = [k for k, _ in shared.value]
        types = (pa.string(), pa.float64(), pa.int64(), pa.int64())
        for batch in slices(batches):
            rows = [(at, keys[m[0]], *m[1:]) for at, t in enumerate(byte_texts(batch.column(1))) for m in index.matches(t)]
            at, *cols = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, types))], ["doc_id", "key", "similarity", "first_word", "words"])
        _seen.clear()

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, words): the best window of each document and item that match.

    Null and empty texts and items match nothing; an empty benchmark gives no rows.  Of windows alike the
    first counts.  Items that share an id count as one, by their best window; so do rows that share
    a doc_id.  Ids keep their types.  Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "benchmark")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    items = work.save(items.select("item_id", "text", F.md5("text").alias("key")), "items")
    different = items.groupBy("key").agg(F.min("text").alias("text"))
    size = different.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size * 5 // (4 * BLOCK_BYTES)))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks))
    found = []
    for i in range(blocks):
        some = [(r["key"], r["text"].encode()) for r in different.filter(block == i).orderBy("key").collect()]
        part = _matched(texts, some)
        # a table for each block, so that one block at a time is held by the executors
        found.append(part if blocks == 1 else work.save(part, f"found{i}"))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    top = F.max(F.struct("similarity", (-F.col("first_word")).alias("first"), "words")).alias("top")
    best = out.join(items.select("item_id", "key"), "key").groupBy("doc_id", "item_id").agg(top)
    return best.select("doc_id", "item_id", "top.similarity", (-F.col("top.first")).alias("first_word"), "top.words")
