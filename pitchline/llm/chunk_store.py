"""Token ids in a content-addressed store.

A rolling hash over the last 16 ids cuts each document's id stream into chunks.  A chunk's address
is the BLAKE2b hash of its ids; equal chunks are stored once.  A recipe lists a document's chunks in
order; its root is the hash of their addresses (a Merkle node), the roots of a file of recipes hash
to the file's root, and those to the manifest's root.

Layout under the store's path:
    staged/    chunks: address binary, data binary (ids, little-endian unsigned 16-bit, or 32-bit if width is 4)
    recipes/   part, doc_id, start, n_tokens, addresses, sizes, root; ascending start over the parts
    manifest/  part, first_start, n_tokens, n_docs, root of each part and, with part null, of the store
Reading verifies every chunk against its address, each recipe against its root and the manifest.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Workspace, byte_texts, mix, partitions, slices, vocabulary

END_ID = 1
ROLL_IDS = 16
#: A chunk ends, on average, every 512 ids; it has 64 at least (but for a document's last) and 4096 at most.
CUT_BITS, LEAST, MOST = 9, 64, 4096
ADDRESS_BYTES = 16


def _address(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=ADDRESS_BYTES).digest()


#: Texts without any of these are normalised and cut here: ASCII white space, printable ASCII and precomposed Latin-1
#: letters have plain lower cases, compositions and byte characters.  Other texts go through the whole tokenizer.
_EVEN = bytes([*range(9, 14), *range(32, 127)])
_ODD = re.compile("[^\t-\r -~À-ÖØ-öø-ÿ]|<\\|")
#: The normaliser and pre-tokenizer of files whose texts are cut here; texts of other files are encoded whole.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: That pre-tokenizer over such texts in lower case.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")


def _byte_characters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


class Held(dict):
    """A dict of up to LIMIT entries between texts; the later half is forgotten first, as frequent keys come early."""

    LIMIT = 800_000

    def trim(self) -> None:
        if len(self) > self.LIMIT:
            for k in list(islice(self, self.LIMIT // 2, None)):
                del self[k]


class Pieces(Held):
    """Packed ids of pre-tokens, asked of the library's model."""

    def __init__(self, tokenizer, code: str):
        letters = _byte_characters()
        self.tokenize, self.code = tokenizer.model.tokenize, code
        self.bytes_of = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}

    def __missing__(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.translate(self.bytes_of)
        made = self[piece] = array(self.code, [t.id for t in self.tokenize(spelled)]).tobytes()
        return made


class Runs(Held):
    """Packed ids of white-space-free runs, encoded by the whole tokenizer."""

    LIMIT = 100_000

    def __init__(self, tokenizer, code: str):
        self.encode, self.code = tokenizer.encode, code

    def __missing__(self, run: bytes) -> bytes:
        made = self[run] = array(self.code, self.encode(run.decode(), add_special_tokens=False).ids).tobytes()
        return made


class Encoder:
    """Ids of whole texts from a tokenizers file.

    If the file has the known normaliser and pre-tokenizer, which never cross white space, the ids of a pre-token, and of a
    white-space-free run, do not depend on their neighbours: each different one is encoded once by the library and
    remembered.  By other files texts are encoded whole.
    """

    made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        path = vocabulary(path)
        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        special = all(t["content"].startswith("<|") and t["special"] for t in told["added_tokens"])
        self.known = (told["normalizer"], told["pre_tokenizer"], told["post_processor"]) == (_NORMALIZER, _PRE_TOKENIZER, None) and special
        self.width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.tokenizer, self.pieces, self.runs = tokenizer, Pieces(tokenizer, self.code), Runs(tokenizer, self.code)
        self.end = array(self.code, [END_ID]).tobytes()

    @classmethod
    def at(cls, path: str) -> Encoder:
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text, its end id included."""
        if not self.known:
            return [array(self.code, self.tokenizer.encode(t.decode(), add_special_tokens=False).ids).tobytes() + self.end for t in texts]
        self.pieces.trim()
        self.runs.trim()
        piece, run, end, odd, cut = self.pieces.__getitem__, self.runs.__getitem__, self.end, _ODD.search, _PIECES.findall
        out = []
        for t in texts:
            text = t.decode()
            plain = b"<|" not in t and not t.translate(None, _EVEN) if t.isascii() else not odd(text)
            ids = map(piece, cut(text.lower())) if plain else map(run, t.split())
            out.append(b"".join(ids) + end)
        return out


_GEAR = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream, decided by the ids alone."""
    n = len(ids)
    if n <= LEAST:
        return [n]
    with np.errstate(over="ignore"):
        g = _GEAR[ids & 0xFFFF]
        total = np.cumsum(g, dtype=np.uint64)
        rolled = total.copy()
        rolled[ROLL_IDS:] -= total[:-ROLL_IDS]
        marks = np.flatnonzero(mix(rolled) >> np.uint64(64 - CUT_BITS) == 0) + 1
    out, at = [], 0
    for m in [*marks.tolist(), n]:
        while m - at > MOST:
            at += MOST
            out.append(at)
        if m - at >= LEAST or m == n and m > at:
            at = m
            out.append(at)
    return out


def _ids_to_chunks(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows of recipes (addresses set), and of chunks (data set) that this task has not sent yet."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    coder = Encoder.at(path)
    width = coder.width
    sent: set[bytes] = set()
    names = ["doc_id", "major", "minor", "n_tokens", "addresses", "sizes", "address", "data"]
    types = (pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary(), pa.binary())
    for batch in slices(batches):
        rows: list[tuple] = []
        for row, data in enumerate(coder.encode(byte_texts(batch.column(1)))):
            ids = np.frombuffer(data, dtype=f"<u{width}")
            addresses, sizes, at = [], [], 0
            for end in cuts(ids):
                part = data[at * width : end * width]
                addresses.append(a := _address(part))
                sizes.append(end - at)
                at = end
                if a not in sent:
                    if len(sent) >= 1_000_000:
                        sent.clear()
                    sent.add(a)
                    rows.append((None, None, None, None, a, part))
            rows.append((row, len(ids), addresses, sizes, _address(b"".join(addresses)), None))
        of, *cols = zip(*rows)
        of = pa.array(of, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(i).take(of) for i in (0, 2, 3)), *(pa.array(c, t) for c, t in zip(cols, types))], names)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by address, the first of each chunk; recipes, whose roots are no chunk's address, pass."""
    last = b""
    for batch in batches:
        if not batch.num_rows:
            continue
        address = batch.column(6)
        before = pa.concat_arrays([pa.array([last], pa.binary()), address.slice(0, batch.num_rows - 1)])
        last = address[-1].as_py()
        yield batch.filter(pc.or_(pc.is_null(batch.column(7)), pc.not_equal(address, before)))


def write_store(docs: DataFrame, path: str, tokenizer: str, order: tuple[Column, Column] | None = None) -> None:
    """Write the store of docs' texts in the given order of two columns, else of doc_id, which keeps its type.

    Null texts count as empty: their stream is the end id alone.  Rows that share their place are separate
    documents, ordered by their roots; null doc_ids come first.  Other columns are not read.  An empty table gives
    an empty store.
    """
    spark = docs.sparkSession
    major, minor = order or (F.col("doc_id"), F.lit(0))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), major.alias("major"), minor.alias("minor"))
    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in ("doc_id", "major", "minor")) + ", n_tokens long, addresses array<binary>, sizes array<int>, address binary, data binary"
    made = texts.mapInArrow(lambda b: _ids_to_chunks(b, tokenizer), schema)
    n = partitions(spark)
    # a recipe's root may be common, so recipes are dealt by their place as well
    dealt = made.repartition(n, "address", "major", "minor").sortWithinPartitions("address")
    dealt.mapInArrow(_once, schema).write.option("compression", "zstd").parquet(f"{path}/staged")
    staged = spark.read.schema(schema).parquet(f"{path}/staged").filter("data is null")
    place = ["major", "minor", "root"]
    sorted_ = staged.select("doc_id", "major", "minor", "n_tokens", "addresses", "sizes", F.col("address").alias("root")).repartitionByRange(n, *place).sortWithinPartitions(*place).withColumn("part", F.spark_partition_id())
    sorted_.write.option("compression", "zstd").parquet(f"{path}/sorted")
    ordered = spark.read.schema(sorted_.schema).parquet(f"{path}/sorted")
    totals = ordered.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    parts = totals.withColumn("first_start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    within = Window.partitionBy("part").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.join(F.broadcast(parts.select("part", "first_start")), "part").withColumn("start", F.col("first_start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    recipes = starts.select("part", "doc_id", "start", "n_tokens", "addresses", "sizes", "root")
    recipes.write.option("compression", "zstd").parquet(f"{path}/recipes")
    _manifest(spark, path).write.parquet(f"{path}/manifest")


CHUNK = "address binary, data binary"
MANIFEST = "part int, first_start long, n_tokens long, n_docs long, root string"


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """Roots over the recipes as they are stored: of a row (id, place, length and root of the document), of a part in the order of start, of all parts."""
    recipes = spark.read.parquet(f"{path}/recipes")
    node = F.sha2(F.to_json(F.struct("doc_id", "start", "n_tokens", F.hex("root").alias("root"))), 256)
    # blocks of ids keep each list short; a part's root hashes its blocks' roots
    leaves = recipes.select("part", "start", "n_tokens", (F.col("start") / (1 << 22)).cast("long").alias("block"), node.alias("node"))
    blocks = leaves.groupBy("part", "block").agg(F.min("start").alias("first_start"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "node"))), lambda x: x.node), ""), 256).alias("root"))
    parts = blocks.groupBy("part").agg(F.min("first_start").alias("first_start"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_docs").alias("n_docs"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "root"))), lambda x: x.root), ""), 256).alias("root"))
    store = parts.agg(F.lit(None).cast("int").alias("part"), F.min("first_start").alias("first_start"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_docs").alias("n_docs"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "root"))), lambda x: x.root), ""), 256).alias("root"))
    return parts.unionByName(store)


def _matrix_powers(count: int) -> np.ndarray:
    """CRC-32 after 2**k zero bytes, as lookup tables: [k, byte of the register, its value]."""
    step = np.array([zlib.crc32(b"\0", x ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for x in (1 << np.arange(32)).tolist()], dtype=np.uint32)

    def apply(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for bit in range(32):
            out ^= np.where(x >> np.uint32(bit) & np.uint32(1), columns[bit], np.uint32(0))
        return out

    tables = []
    for _ in range(count):
        tables.append([apply(step, np.arange(256, dtype=np.uint32) << np.uint32(8 * b)) for b in range(4)])
        step = apply(step, step)
    return np.array(tables)


_TABLES: list[np.ndarray] = []


def crc_shift(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What a part with this CRC-32 gives to the CRC-32 of a whole in which so many bytes follow it."""
    if not _TABLES:
        _TABLES.append(_matrix_powers(48))
    crc = crc.astype(np.uint32)
    for k in range(int(zeros.max(initial=0)).bit_length()):
        on = (zeros >> k & 1).astype(bool)
        x, t = crc[on], _TABLES[0][k]
        crc[on] = t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]
    return crc


def _verified(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs, counts = [], []
        for address, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if _address(data) != address:
                raise ValueError(f"chunk {address.hex()} does not match its address")
            ids = np.frombuffer(data, dtype=f"<u{width}").astype("<u4")
            crcs.append(zlib.crc32(ids.tobytes()))
            counts.append(len(ids))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(crcs, pa.int64()), pa.array(counts, pa.int32())], ["address", "crc", "ids"])


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Recipes checked against their roots; one row for each chunk with the bytes that follow it."""
    names = ["start", "address", "size", "after"]
    for batch in slices(batches, 2000):
        rows = []
        for start, addresses, sizes, root in zip(*(c.to_pylist() for c in batch.columns)):
            if _address(b"".join(addresses)) != root:
                raise ValueError(f"the recipe at {start} does not match its root")
            after = sum(sizes)
            for a, size in zip(addresses, sizes):
                after -= size
                rows.append((start, a, size, 4 * after))
        cols = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int32(), pa.int64()))], names)


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = crc_shift(batch.column(1).to_numpy(), batch.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(crc.astype(np.int64)), batch.column(3)], ["start", "crc", "size"])


def verify_manifest(spark: SparkSession, path: str) -> None:
    """Recompute every root from the recipes and compare; raises ValueError on the first difference."""
    stored = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    if not stored.exceptAll(_manifest(spark, path)).isEmpty():
        raise ValueError("the manifest does not match the recipes")


def read_store(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files; every chunk and recipe is verified on the way.

    The CRC of a document is put together from the CRCs of its stored chunks, so ids are read once and
    never shuffled.
    """
    recipes = spark.read.parquet(f"{path}/recipes")
    chunks = spark.read.schema(CHUNK).parquet(f"{path}/staged").filter("data is not null")
    sums = chunks.mapInArrow(lambda b: _verified(b, width), "address binary, crc long, ids int")
    uses = recipes.select("start", "addresses", "sizes", "root").mapInArrow(_rooted, "start long, address binary, size int, after long")
    found = uses.join(sums, "address", "left")
    whole = found.select("start", F.when(F.col("ids") == F.col("size"), F.col("crc")).otherwise(F.raise_error(F.lit("a recipe asks for a chunk that is not stored"))).cast("long").alias("crc"), "after", "size")
    each = whole.mapInArrow(_shifted, "start long, crc long, size int").groupBy("start").agg(F.bit_xor("crc").alias("ids_crc32"), F.sum("size").alias("n_tokens"))
    return recipes.select("doc_id", "start").join(each, "start").select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")


def read_ids(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """(doc_id, start, ids array<int>): the id streams rebuilt from recipes and chunks."""
    recipes = spark.read.parquet(f"{path}/recipes")
    chunks = spark.read.schema(CHUNK).parquet(f"{path}/staged").filter("data is not null")
    uses = recipes.select("doc_id", "start", F.posexplode("addresses").alias("at", "address")).join(chunks, "address")
    lists = uses.groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("at", "data"))).alias("parts"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            ids = [np.frombuffer(b"".join(p["data"] for p in parts), dtype=f"<u{width}").astype(np.int32) for parts in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    return lists.mapInArrow(unpack, f"doc_id {lists.schema['doc_id'].dataType.simpleString()}, start long, ids array<int>")


def encoded(docs: DataFrame, tokenizer: str, order: tuple[Column, Column] | None = None) -> DataFrame:
    """Write a store of docs below the shared folder, check its manifest, and read it back.  tokenizer: a path, or the name of a public file."""
    work = Workspace(docs.sparkSession, "store")
    path = f"{work.path}/store"
    write_store(docs, path, tokenizer, order)
    verify_manifest(docs.sparkSession, path)
    return read_store(docs.sparkSession, path, Encoder.at(tokenizer).width)
