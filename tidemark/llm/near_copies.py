"""Near copies by n-gram Jaccard similarity: MinHash banding, then verification on full n-gram sets.

Documents with the same n-gram set are one class from the start, so copies cost one row each. Classes meet in buckets of equal
band hashes; buckets that hold the same classes as one of an earlier band are dropped. A large bucket is dealt into blocks,
and pairs of blocks are the groups that are compared, so no task holds more than two blocks. Groups give back, for each
class, its number of links and the least class that it is linked to there, not the pairs. A pair belongs to the first
band that both share and is counted once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.files import settled
from tidemark.llm.texts import mixed, runs_of, steps, word_table

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.9999
#: Most MinHash values of a signature.
MOST_HASHES = 128
#: Classes and n-grams of a block, about.
BLOCK_CLASSES, BLOCK_VALUES = 512, 1 << 20


def banding(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows, and so the fewest chance candidates, whose bands reach the recall."""
    best = None
    for rows in range(1, most + 1):
        hit = similarity**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit)) if hit > 1e-12 else most + 1
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def shingle_sets(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row's runs of `words` lower-cased words, and the n + 1 offsets of the rows.

    A row of fewer words, but not none, has the run of all its words.
    """
    n = len(at) - 1
    hashes, _, _, rows = word_table(data, at)
    runs = runs_of(hashes, words)
    place = np.flatnonzero(rows[: len(runs)] == rows[words - 1 :]) if len(runs) else np.zeros(0, np.int64)
    value, row = runs[place], rows[place]
    count = np.bincount(rows, minlength=n)
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        first = np.cumsum(count) - count
        short = np.array([runs_of(hashes[first[r] : first[r] + count[r]], int(count[r]))[0] for r in few], np.uint64)
        value, row = np.concatenate([value, short]), np.concatenate([row, few])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return value, np.searchsorted(row, np.arange(n + 1))


def band_hashes(values: np.ndarray, at: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per row and band of the row's MinHash signature; rows without values get 0."""
    n = len(at) - 1
    out = np.zeros((n, bands), np.uint64)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return out
    seeds = mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    for b in range(bands):
        for r in range(rows):
            k = b * rows + r
            x = values * seeds[k]
            x ^= x >> np.uint64(32)
            x *= seeds[(k + 7) % len(seeds)]
            out[full, b] = mixed(out[full, b] + np.minimum.reduceat(x, at[:-1][full]))
        out[full, b] = mixed(out[full, b] + np.uint64(b + 1))
    return out


def set_key(values: np.ndarray) -> bytes:
    """128 bits that stand for an n-gram set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _signer(words: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in steps(batches, "text"):
            values, v_at = shingle_sets(data, at, words)
            size = np.diff(v_at)
            keys = [set_key(values[a:b]) if b > a else None for a, b in zip(v_at, v_at[1:])]
            flat = band_hashes(values, v_at, bands, rows).view(np.int64).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(size), lists], ["doc_id", "key", "n", "bands"])

    return sign


def _sets(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in steps(batches, "text"):
            values, v_at = shingle_sets(data, at, words)
            pieces = [values[a:b] for a, b in zip(v_at, v_at[1:]) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(p) for p in pieces], pa.binary()), pa.array([p.tobytes() for p in pieces], pa.binary())], ["key", "grams"])

    return sets


def links(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of sorted value sets whose Jaccard similarity reaches the least, from counts of shared values."""
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, code, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(many[code] > 1)
    kept, code = np.unique(code[shared], return_inverse=True)
    owner = owner[shared]
    both = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for lo in range(0, len(kept), 4096):
        a, b = np.searchsorted(code, [lo, lo + 4096])
        held = np.zeros((len(sets), min(4096, len(kept) - lo)), np.float32)
        held[owner[a:b], code[a:b] - lo] = 1
        both += held @ held.T
    # Exact in integers: |A and B| / |A or B| >= s.
    union = size[:, None] + size[None, :] - both
    i, j = np.nonzero(np.triu((both > 0) & (both >= similarity * union - 1e-9), 1))
    return i, j


def _compare(similarity: float):
    kind = pa.schema([("key", pa.binary()), ("n_links", pa.int64()), ("near", pa.binary())])

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        keys = table.column("key").to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("grams")]
        bands = np.array(table.column("bands").to_pylist(), np.int64)
        block = table.column("block").to_numpy()
        band, first, second = (table.column(c)[0].as_py() for c in ("band", "first", "second"))
        i, j = links(sets, similarity)
        # A pair across two blocks belongs to their group, a pair in one block to that block's own.
        i, j = (x[(block[i] == block[j]) == (first == second)] for x in (i, j))
        own = np.argmax(bands[i] == bands[j], axis=1) == band if len(i) else np.zeros(0, bool)
        i, j = i[own], j[own]
        count = np.bincount(i, minlength=len(keys)) + np.bincount(j, minlength=len(keys))
        root = np.arange(len(keys))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(i.tolist(), j.tolist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        on = np.flatnonzero(count)
        return pa.table([pa.array([keys[k] for k in on], pa.binary()), pa.array(count[on]), pa.array([keys[find(k)] for k in on], pa.binary())], schema=kind)

    return compare


def _verified(docs: DataFrame, classes: DataFrame, words: int, bands: int, similarity: float) -> DataFrame:
    """(key, n_links, near) of every class and group in which it has links."""
    spread = classes.select("key", "n", F.posexplode("bands").alias("band", "hash"))
    mark = F.xxhash64("key")
    buckets = spread.groupBy("hash").agg(
        F.count("*").alias("size"), F.sum("n").alias("total"), F.min("band").alias("band"), F.sum(mark % F.lit(1 << 40)).alias("m1"), F.bit_xor(F.xxhash64("key", F.lit(7))).alias("m2")).where("size > 1")
    cells = buckets.groupBy("size", "total", "m1", "m2").agg(F.min(F.struct("band", "hash")).alias("cell"))
    cells = cells.select("cell.band", "cell.hash", F.ceil(F.greatest(F.col("size") / BLOCK_CLASSES, F.col("total") / BLOCK_VALUES)).cast("int").alias("blocks"))
    members = settled(spread.select("key", "hash").join(cells, "hash"), "near-cells")
    ids = classes.join(members.select("key").distinct(), "key").where("doc_id is not null").select("doc_id").distinct()
    # Of documents that repeat an id or have none, the others' sets are read as well and find no member.
    named = docs.where("doc_id is not null").select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left_semi").select("text")
    sets = named.unionByName(docs.where("doc_id is null").select("text")).mapInArrow(_sets(words), "key binary, grams binary").dropDuplicates(["key"])
    sets = sets.join(classes.select("key", "bands"), "key")
    own = F.pmod(F.xxhash64("key", F.lit(3)), F.col("blocks")).cast("int")
    pairs = members.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("key", "hash", "band", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    return pairs.join(sets, "key").groupBy("hash", "first", "second").applyInArrow(_compare(similarity), "key binary, n_links bigint, near binary")


def _classified(docs: DataFrame, words: int, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key) of all documents, and of every key its text_id, class_id, copies, n_links and whether it leads its class.

    A class is led by the key of the least doc_id, of several by the least key; keys without a doc_id come last.
    """
    bands, rows = banding(similarity, recall)
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = settled(docs.select("doc_id", "text").mapInArrow(_signer(words, bands, rows), f"doc_id {kind}, key binary, n bigint, bands array<bigint>"), "near-signatures")
    # Rows of the same key have the same bands.
    classes = settled(signed.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "near-classes")
    found = settled(_verified(docs, classes, words, bands, similarity), "near-links")
    count = found.groupBy("key").agg(F.sum("n_links").alias("n_links"))
    named = classes.select("key", "doc_id", "copies").join(count, "key", "left").join(components(found.select(F.col("key").alias("a"), F.col("near").alias("b"))), "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("leader"))
    named = named.join(least, "root").select("key", F.col("doc_id").alias("text_id"), F.col("leader.doc_id").alias("class_id"), "copies", "n_links", (F.col("key") == F.col("leader.key")).alias("leads"))
    return signed.select("doc_id", "key"), named


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """A row per document: doc_id, class_id, text_id, n_copies, n_links.

    text_id is the least doc_id with the same n-gram set and n_copies the number of other documents that have it; n_links
    counts the different n-gram sets of at least the similarity, each once; class_id is the least doc_id that links and
    copies lead to. Texts without words (null and empty ones too) have no copies and no links and are their own class.
    Rows with a null doc_id get the class of their text; a text or class without any doc_id has a null id, and its links
    count like others. An empty table gives no rows.
    """
    signed, named = _classified(docs, words, similarity, recall)
    out = signed.join(named, "key", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("text_id")).alias("text_id"),
        F.coalesce(F.col("copies") - 1, zero).alias("n_copies"), F.coalesce("n_links", zero).alias("n_links"))


def _keyed(rows: DataFrame, words: int) -> DataFrame:
    """The rows with `_key`, that of their n-gram set; texts without words have a longer one of their own."""
    names = rows.columns

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in steps(batches, "text"):
            values, v_at = shingle_sets(data, at, words)
            texts = batch.column("text")
            keys = [set_key(values[a:b]) if b > a else None if not texts[k].is_valid else b"=" * 17 + data[at[k] : at[k + 1]].tobytes() for k, (a, b) in enumerate(zip(v_at, v_at[1:]))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*names, "_key"])

    return rows.mapInArrow(key, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema) + "_key binary")


def _first_of(rows: DataFrame, names: list[str]) -> DataFrame:
    """Of the rows of each doc_id and key that of the least text."""
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    return rows.groupBy("doc_id", "_key").agg(F.min_by(row, F.struct(F.col("text").isNull().alias("none"), "text")).alias("row")).select("row.*")


def one_of_each(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One document of every class, with its columns: of its leading text the row of least doc_id.

    Rows are told apart by doc_id and text: different texts under one doc_id are judged each by itself, repeated rows are
    copies, of which one stays. Rows with a null doc_id give way to any copy that has one; else one of a class stays.
    Texts without words stay, once for each doc_id and text.
    """
    names = [c for c in docs.columns if c != "_key"]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    signed, named = _classified(docs, words, similarity, recall)
    judged = signed.join(named, "key", "left").select(
        "doc_id", "key", (F.col("key").isNull() | (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("stays"))
    judged = settled(judged, "near-judged")
    with_id = judged.where("doc_id is not null")
    lost = with_id.groupBy("doc_id").agg(F.max(F.col("stays").cast("int")).alias("stays"), F.count("*").alias("n"))
    gone = settled(lost.where("stays = 0 or n > 1"), "near-gone")
    gone_ids, again = gone.select("doc_id"), gone.where("stays = 1").select("doc_id")
    # Both joins read the same exchange, so texts move once, and the plan is the same for few and many ids.
    ids = docs.where("doc_id is not null")
    once = ids.join(gone_ids.hint("shuffle_hash"), "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in names))
    several = ids.join(again.hint("shuffle_hash"), "doc_id", "left_semi").select(*(F.col(f"`{c}`") for c in names))
    kept = with_id.join(again, "doc_id", "left_semi").where("stays and key is not null").select("doc_id", F.col("key").alias("_key")).distinct()
    several = _keyed(several, words)
    wordless = F.col("_key").isNull() | (F.length("_key") > 16)
    several_kept = several.where(~wordless).join(kept, ["doc_id", "_key"], "left_semi").unionByName(several.where(wordless))
    nameless = _keyed(docs.where("doc_id is null"), words)
    led = judged.where("doc_id is null and stays and key is not null").select(F.col("key").alias("_key")).distinct()
    nameless_kept = nameless.where(~wordless).join(led, "_key", "left_semi").unionByName(nameless.where(wordless))
    return once.unionByName(_first_of(several_kept, names)).unionByName(_first_of(nameless_kept, names))
