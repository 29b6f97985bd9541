"""Token-id shards with a minimal perfect hash index.

A shard is one file: a header, the index, the keys in ascending order, and the raw ids. The index maps a document key to
a slot by levels of bit arrays: a key whose place in a level is its own sets that bit, the others go on to the next level;
the slot is the rank of the bit. Each slot stores a fingerprint of its key, and where the key's ids begin and end, so a
lookup takes constant time and rejects nearly all strangers. Shards hold consecutive documents in ascending key order.
"""

from __future__ import annotations

import array
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.files import read_blobs, write_blobs
from tidemark.llm.texts import mixed, steps

MAGIC = b"TMIDS001"
HEADER = "<8sIIqqqq"
#: Ids in one shard file, unless a single document has more.
SHARD_IDS = 1 << 21
END_ID = 2
#: Pieces whose ids a worker process keeps at hand.
CACHE_PIECES = 600_000
#: Bytes of text encoded at once: different pieces are looked up once in each step.
ENCODE_BYTES = 4 << 20

_LEVEL = 0xD1B54A32D192ED03


def _key_hashes(keys: np.ndarray, ordinals: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    return mixed(mixed(keys.view(np.uint64)) + ordinals.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + nulls.astype(np.uint64))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit key hashes."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x) - 1 for x in levels]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        levels = []
        while len(hashes):
            size = max(64, 2 * len(hashes))
            place = cls._place(hashes, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            hashes = hashes[~alone[place]]
        return cls(levels)

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(hashes + np.uint64(_LEVEL * (level + 1) % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where no level has its bit."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for n, bits in enumerate(self.levels):
            place = self._place(hashes[open_], n, len(bits))
            hit = bits[place]
            out[open_[hit]] = self.before[n] + self.ranks[n][place[hit]]
            open_ = open_[~hit]
        return out


def pack(keys: np.ndarray, ordinals: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray, part: int, start: int) -> bytes:
    """A shard: `counts` ids belong to each key, in order; `start` ids of partition `part` come before."""
    hashes = _key_hashes(keys, ordinals, nulls)
    index = PerfectHash.build(hashes)
    slot, ends = index.slots(hashes), np.cumsum(counts)
    prints, begin, end = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    prints[slot], begin[slot], end[slot] = (hashes >> np.uint64(32)).astype(np.uint32), ends - counts, ends
    return b"".join([
        struct.pack(HEADER, MAGIC, ids.dtype.itemsize, len(index.levels), part, start, len(keys), len(ids)),
        np.array([len(x) for x in index.levels], np.int64).tobytes(), *(np.packbits(x).tobytes() for x in index.levels),
        prints.tobytes(), begin.tobytes(), end.tobytes(), keys.tobytes(), ordinals.astype(np.int32).tobytes(), nulls.astype(np.uint8).tobytes(), ids.tobytes()])


class Shard:
    """A shard file in memory."""

    def __init__(self, content: bytes | memoryview):
        magic, width, n_levels, self.part, self.start, n, self.n_ids = struct.unpack_from(HEADER, content)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self._content, self._at = content, struct.calcsize(HEADER)
        sizes = self._take(np.int64, n_levels)
        levels = [np.unpackbits(self._take(np.uint8, -(-int(s) // 8)), count=int(s)).astype(bool) for s in sizes]
        self.index = PerfectHash(levels)
        self.prints, self.begin, self.end = self._take(np.uint32, n), self._take(np.int64, n), self._take(np.int64, n)
        self.keys, self.ordinals, self.nulls = self._take(np.int64, n), self._take(np.int32, n), self._take(np.uint8, n)
        self.ids = self._take(np.dtype(f"u{width}"), self.n_ids)

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self._content, kind, n, self._at)
        self._at += out.nbytes
        return out

    def spans(self, keys: np.ndarray, ordinals: np.ndarray, nulls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each key begin and end; -1 for keys that the shard does not hold."""
        hashes = _key_hashes(keys, ordinals, nulls)
        slot = self.index.slots(hashes)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == (hashes[known] >> np.uint64(32)).astype(np.uint32)
        begin, end = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
        begin[known], end[known] = self.begin[slot[known]], self.end[slot[known]]
        return begin, end

    def get(self, key: int | None, ordinal: int = 0) -> np.ndarray | None:
        """The ids of a document, or None."""
        begin, end = self.spans(np.array([key or 0], np.int64), np.array([ordinal], np.int32), np.array([key is None], np.uint8))
        return None if begin[0] < 0 else self.ids[begin[0] : end[0]]


# Classes of bytes for cutting texts where the tokenizer cuts as well: white space, ASCII letters, other ASCII, bytes
# next to which nothing is cut (outside ASCII, and those of contractions and of special tokens), and digits.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[0x80:] = _CLASS[[0x27, 0x7C]] = 3
_CLASS[0x30:0x3A] = 4
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = 1
_CLASS[[0x20, 0x0A]] = 0
# By 8 times the class of a byte, plus that of the next: whether the next begins a piece. Each digit is a piece.
_CUTS = np.zeros(64, bool)
_CUTS[[1, 2, 3, 4, 10, 12, 17, 20, 33, 34, 36]] = True
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[0x41:0x5B] += 32
_PLAIN[0x0A] = 0x20


class PieceEncoder:
    """Ids of whole texts, by cutting them into pieces that the tokenizer encodes one by one and keeping the pieces' ids.

    For tokenizers that drop white space, lower-case, and split letters, single digits and other signs from one another.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.flat, self.ends = array.array("I"), array.array("q", [0])

    def _learn(self, pieces: list[str]) -> None:
        hard = [p for p in pieces if not (p.isascii() and p.isalpha() and p.islower())]
        other = dict(zip(hard, (e.ids for e in self.whole.encode_batch_fast(hard, add_special_tokens=False)))) if hard else {}
        for p in pieces:
            self.flat.extend(other[p] if p in other else [t.id for t in self.model.tokenize(p)])
            self.code[p] = len(self.ends) - 1
            self.ends.append(len(self.flat))

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, and how many each row has."""
        n = len(at) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        special = b"<|" in data.tobytes()  # special tokens are matched before lower-casing
        kinds = _CLASS[data]
        edge = np.zeros(len(data), bool)
        before, here = kinds[:-1], kinds[1:]
        edge[1:] = (before == 0) & (here != 0) if special else _CUTS[before * 8 + here]
        edge[at[:-1][at[:-1] < len(data)]] = True
        starts = np.flatnonzero(edge)
        plain = np.ascontiguousarray(data if special else _PLAIN[data])
        cut = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(plain)).dictionary_encode()
        pieces = [p.rstrip(" ") for p in cut.dictionary.to_pylist()]
        if len(self.code) > CACHE_PIECES:
            self._clear()
        self._learn([*dict.fromkeys(p for p in pieces if p not in self.code)])
        codes = np.fromiter((self.code[p] for p in pieces), np.int64, len(pieces))[cut.indices.to_numpy(zero_copy_only=False)]
        ends, flat = np.array(self.ends), np.array(self.flat, np.uint32)
        begin, size = ends[codes], ends[codes + 1] - ends[codes]
        total = np.cumsum(size)
        ids = flat[np.arange(int(total[-1])) + np.repeat(begin - (total - size), size)]
        return ids, np.bincount(np.searchsorted(at, starts, "right") - 1, weights=size, minlength=n).astype(np.int64)

    def vocabulary(self) -> int:
        return self.whole.get_vocab_size(with_added_tokens=True)


@lru_cache(maxsize=1)
def _loaded(path: str, changed: float) -> PieceEncoder:
    return PieceEncoder(path)


def worker_encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process, which keeps its pieces from task to task."""
    return _loaded(path, os.path.getmtime(path))


def _packer(path: str, end_id: int, shard_ids: int):
    def pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        kind = np.uint16 if max(encoder.vocabulary(), end_id + 1) <= 1 << 16 else np.uint32
        part, start, held, size = TaskContext.get().partitionId(), 0, [], 0
        last, ordinal = object(), 0

        def shard() -> pa.RecordBatch:
            columns = [np.concatenate([h[k] for h in held]) for k in range(5)]
            return pa.RecordBatch.from_arrays([pa.array([pack(*columns, part, start)], pa.binary())], ["shard"])

        for rows, data, at in steps(batches, "text", ENCODE_BYTES):
            ids, counts = encoder.encode(data, at)
            ids = np.insert(ids.astype(kind), np.cumsum(counts), end_id)
            counts = counts + 1
            column = rows.column("doc_id")
            nulls = np.asarray(column.is_null().to_numpy(zero_copy_only=False), np.uint8)
            keys = column.fill_null(0).to_numpy().astype(np.int64)
            ordinals = np.zeros(len(keys), np.int32)
            for k, key in enumerate(zip(keys.tolist(), nulls.tolist())):
                ordinal = ordinal + 1 if key == last else 0
                last, ordinals[k] = key, ordinal
            at_ids, lo = np.concatenate([[0], np.cumsum(counts)]), 0
            while lo < len(keys):
                hi = max(lo + 1, int(np.searchsorted(at_ids, at_ids[lo] + shard_ids - size, "right")) - 1)
                held.append((keys[lo:hi], ordinals[lo:hi], nulls[lo:hi], counts[lo:hi], ids[at_ids[lo] : at_ids[hi]]))
                size += int(at_ids[hi] - at_ids[lo])
                if size >= shard_ids or hi < len(keys):
                    yield shard()
                    start, held, size = start + size, [], 0
                lo = hi
        if held:
            yield shard()

    return pack_all


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode every text and write its ids, then `end_id`, into shard files under `folder`.

    Documents stand in ascending doc_id order, null ids first, rows of one id in the order of their texts (null first) and
    numbered by an ordinal. A null or empty text has the end id only. An empty table makes no shard.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    write_blobs(rows.mapInArrow(_packer(tokenizer, end_id, shard_ids), "shard binary"), "shard", folder, "\n")


def _each(content: pa.Array) -> Iterator[Shard]:
    for value in content:
        yield Shard(value.as_buffer())


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = [struct.unpack_from(HEADER, v.as_buffer()) for v in batch.column("content")]
        yield pa.RecordBatch.from_arrays([pa.array([h[3] for h in heads], pa.int64()), pa.array([h[6] for h in heads], pa.int64())], ["part", "n"])


def _reader(starts: dict[int, int]):
    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in _each(batch.column("content")):
                begin, end = shard.spans(shard.keys, shard.ordinals, shard.nulls)
                if (begin < 0).any():
                    raise ValueError("a key is missing from its shard's index")
                crc = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(begin, end)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys, pa.int64(), mask=shard.nulls.astype(bool)), pa.array(starts[shard.part] + shard.start + begin),
                     pa.array(end - begin), pa.array(crc, pa.int64()), pa.array(shard.ordinals, pa.int32())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ordinal"])

    return read_all


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document, found through the index of its shard: global start, number and checksum of its ids.

    Only the number of ids in each written partition passes through the driver.
    """
    blobs = read_blobs(spark, folder)
    sums = {r.part: r.n for r in blobs.mapInArrow(_totals, "part bigint, n bigint").groupBy("part").agg(F.sum("n").alias("n")).collect()}
    starts, total = {}, 0
    for part in sorted(sums):
        starts[part] = total
        total += sums[part]
    return blobs.mapInArrow(_reader(starts), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ordinal int")


def _ids(wanted: list[int]):
    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.array(wanted, np.int64)
        for batch in batches:
            for shard in _each(batch.column("content")):
                begin, end = shard.spans(keys, np.zeros(len(keys), np.int32), np.zeros(len(keys), np.uint8))
                # A fingerprint lets one stranger in 2 ** 32 pass; the stored key settles it.
                for k in np.flatnonzero(begin >= 0):
                    place = np.searchsorted(shard.keys, keys[k])
                    if place < len(shard.keys) and shard.keys[place] == keys[k]:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([keys[k]], pa.int64()), pa.array([shard.ids[begin[k] : end[k]].astype(np.int32)], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return lookup


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known = [shard.keys[shard.nulls == 0] for shard in _each(batch.column("content"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), *(pa.array([int(pick(k)) if len(k) else None for k in known], pa.int64()) for pick in (np.min, np.max))], ["path", "first", "last"])


def write_directory(spark: SparkSession, folder: str) -> None:
    """Write beside the shards which file holds which range of doc_ids, for `fetch`; reads every shard once. Null ids are in no range."""
    read_blobs(spark, folder).mapInArrow(_ranges, "path string, first bigint, last bigint").write.mode("overwrite").parquet(f"{folder}/_directory")


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the given documents (the first row of a repeated id), looked up in the index of the shards that can hold them.

    Needs the directory of `write_directory`; of it, only the paths of those shards come to the driver. Unknown ids give no row.
    """
    asked = sorted(set(doc_ids))
    holds = F.exists(F.lit(asked).cast("array<bigint>"), lambda k: k.between(F.col("first"), F.col("last")))
    paths = [r.path for r in spark.read.parquet(f"{folder}/_directory").where(holds).select("path").collect()] if asked else []
    if not paths:
        return spark.createDataFrame([], "doc_id bigint, ids array<int>")
    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(_ids(asked), "doc_id bigint, ids array<int>")
