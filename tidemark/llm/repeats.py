"""Removal of repeated byte strings by bucket-pointer refinement of suffixes.

A string of `length` bytes that occurs twice holds, at the same place in both, the same least q-gram. So only those q-grams'
suffixes are kept (one for about 150 bytes), each with the run of window starts that chose it. They fall into buckets by
q-gram. A bucket is refined by the bytes around it: the windows that a suffix stands for lie at offsets lo..hi before it; what
they all share decides the bucket, what any of them holds tells members apart. Members that agree on all of it are repeated;
a bucket with one member is done; the rest is split into parts of the offsets, whose buckets
are the old bucket's identifier joined with that of the bytes further on, and so on down to single windows. Small buckets are
finished where they are, by sorting the identifiers of all their windows; only large ones are dealt out again.

Only identifiers are shuffled until the end; texts are read again for members of mixed buckets and for what is left of them.

Passages that another text holds too, however few bytes they have, fall into buckets the same way, with words in place of bytes;
members of mixed buckets are told apart by all of their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import settled
from tidemark.llm.texts import BYTE_VALUES, STEP_BYTES, mixed, powers, row_counts, span_hashes, steps, words

LENGTH, GRAM = 400, 100
#: Words of the shortest passage that counts as shared with another text, and of the grams that place it.
PASSAGE, PASSAGE_GRAM = 51, 13
#: Members of a bucket that one task finishes; larger ones are refined first.
SMALL_BUCKET = 128
#: Parts that a large bucket's offsets are split into.
PARTS = 8
#: Rows whose windows are sorted at once.
STEP_ROWS = 2048
#: Most document ids that are broadcast to read their texts again; more are joined by a shuffle.
BROADCAST_IDS = 1 << 20

_BASES = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4F)
#: Bytes of a passage's words: all but blanks and control characters.
_WORD_BYTES = np.arange(256) > 0x20


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


@lru_cache(4)
def _usual_powers(base: int) -> np.ndarray:
    return powers(STEP_BYTES + LENGTH, base)


def _powers(n: int, base: int) -> np.ndarray:
    return _usual_powers(base)[:n] if n <= STEP_BYTES + LENGTH else powers(n, base)


class Prints:
    """Position-free hashes of any span of some bytes, or of some 64-bit values, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((BYTE_VALUES[data] if data.dtype == np.uint8 else data) * _powers(n, base), out=self.sums[1:])
        self.back = _powers(n + 1, _inverse(base))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    m = len(values) - width + 1
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:m], behind[width - 1 : width - 1 + m])


def suffixes(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, place, lo, hi, bucket and member hash of each kept suffix.

    Its windows start lo..hi bytes before its place; the bucket is its q-gram's hash, the member hash covers all its windows.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    if len(data) < length:
        return none
    starts = np.arange(len(data) - length + 1)
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(starts)]
    good = starts + length <= at[1:][rows]
    if not good.any():
        return none
    first = Prints(data, _BASES[0])
    grams = np.arange(len(data) - gram + 1)
    keys = (first.spans(grams, grams + gram) & np.uint64(0xFFFFFFFF00000000)) | grams.astype(np.uint64)
    place = (_sliding_least(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts, rows, place = starts[good], rows[good], place[good]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(fresh)
    s0, s1 = starts[begin], starts[np.append(begin[1:], len(starts)) - 1]
    row, place = rows[begin], place[begin]
    lo, hi = place - s1, place - s0
    member = Prints(data, _BASES[1]).spans(s0, s1 + length) + mixed((lo * 4096 + hi).astype(np.uint64))
    return row, place - at[row], lo, hi, first.spans(place, place + gram), member


def _as_bytes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, at


def _as_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the n + 1 offsets of the rows' words."""
    starts, ends, rows = words(data, at, _WORD_BYTES)
    return span_hashes(data, starts, ends), np.append(0, np.cumsum(row_counts(rows, len(at) - 1)))


def _text_key(raw: bytes) -> tuple[int, int, str]:
    digest = hashlib.sha256(raw)
    a, b = np.frombuffer(digest.digest()[:16], np.int64).tolist()
    return a, b, digest.hexdigest()


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, at in steps(batches, "text"):
        keys = [_text_key(data[a:b].tobytes()) for a, b in zip(at, at[1:])]
        n_words = row_counts(words(data, at, _WORD_BYTES)[2], len(at) - 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([k[n] for k in keys], pa.int64()) for n in (0, 1)), pa.array(np.diff(at)), pa.array(n_words), pa.array([k[2] for k in keys])],
            ["doc_id", "t1", "t2", "n_bytes", "n_words", "sha256"])


_SUFFIX = "bucket bigint, member bigint, t1 bigint, t2 bigint, place bigint, lo int, hi int"


def _suffix_rows(length: int, gram: int, symbols=_as_bytes):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in steps(batches, "text"):
            row, place, lo, hi, bucket, member = suffixes(*symbols(data, at), length, gram)
            keys = np.array([_text_key(data[a:b].tobytes())[:2] for a, b in zip(at, at[1:])], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.view(np.int64)), pa.array(member.view(np.int64)), pa.array(keys[row, 0]), pa.array(keys[row, 1]), pa.array(place),
                 pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["bucket", "member", "t1", "t2", "place", "lo", "hi"])

    return emit


def _texts(docs: DataFrame, keys: DataFrame, wanted: DataFrame) -> DataFrame:
    """(t1, t2, text) of the wanted texts, once each, from the documents of least id that have them."""
    ids = keys.where("doc_id is not null").join(wanted, ["t1", "t2"]).groupBy("t1", "t2").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    ids = settled(ids, "text-ids")
    found = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi").select("text")
    nameless = docs.where("doc_id is null").select("text")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in steps(batches, "text"):
            k = [_text_key(data[a:b].tobytes()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in k], pa.int64()), pa.array([x[1] for x in k], pa.int64()), batch.column("text")], ["t1", "t2", "text"])

    return found.unionByName(nameless).mapInArrow(keyed, "t1 bigint, t2 bigint, text string")


_MEMBER = "sub bigint, bucket bigint, member bigint, lo int, hi int, content binary, place int, uni bigint, partner boolean"
_MEMBER_ARROW = pa.schema([
    ("sub", pa.int64()), ("bucket", pa.int64()), ("member", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("content", pa.binary()),
    ("place", pa.int32()), ("uni", pa.int64()), ("partner", pa.bool_())])


def _contents(length: int):
    """The bytes of all windows of each wanted member, with its place in them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in steps(batches, "text"):
            out = []
            for r, members in enumerate(batch.column("members").to_pylist()):
                raw = data[at[r] : at[r + 1]]
                for m in members:
                    a, b = m["place"] - m["hi"], m["place"] - m["lo"] + length
                    out.append((m["bucket"], m["bucket"], m["member"], m["lo"], m["hi"], raw[a:b].tobytes(), m["hi"], m["member"], m["n"] > 1))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _MEMBER_ARROW)], schema=_MEMBER_ARROW)

    return cut


def _refined(length: int):
    """Each row's parts of the offsets, under the identifiers of what is shared and held there."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sub, bucket, member, lo, hi, content, place, partner, low, high in zip(*(batch.column(c).to_pylist() for c in (
                    "sub", "bucket", "member", "lo", "hi", "content", "place", "partner", "low", "high"))):
                width = -(-(high - low + 1) // PARTS)
                for part, a in enumerate(range(low, high + 1, width)):
                    b = min(a + width - 1, high)
                    x, y = max(a, lo), min(b, hi)
                    if x > y:
                        continue
                    shared = content[max(0, place - a) : place + length - b]
                    # A member whose windows do not reach over the whole part still shares the bytes of the windows it has.
                    mark = hashlib.blake2b(b"%d:%d:%d:" % (sub, part, place - max(0, place - a)) + shared, digest_size=8).digest()
                    held = hashlib.blake2b(b"%d:%d:" % (x, y) + content[place - y : place - x + length], digest_size=8).digest()
                    out.append((int.from_bytes(mark, "little", signed=True), bucket, member, x, y, content, place, int.from_bytes(held, "little", signed=True), partner, a, b))
            if out:
                schema = pa.schema([*_MEMBER_ARROW, ("low", pa.int32()), ("high", pa.int32())])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return split


def _finish(length: int):
    """Offsets at which windows of small buckets are repeated; rows come sorted by bucket."""

    def sort_windows(rows: pa.Table) -> pa.RecordBatch:
        n = rows.num_rows
        content = [x.as_buffer() for x in rows.column("content")]
        size, place = np.array([len(c) for c in content]), rows.column("place").to_numpy().astype(np.int64)
        lo, hi = (rows.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
        flat = np.frombuffer(b"".join(content), np.uint8)
        begin = np.cumsum(size) - size + place
        prints = Prints(flat, _BASES[1])
        count = hi - lo + 1
        owner = np.repeat(np.arange(n), count)
        offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - lo, count)
        start = begin[owner] - offset
        windows = prints.spans(start, start + length)
        sub = mixed(rows.column("sub").to_numpy().view(np.uint64))[owner]
        keys = mixed(windows + mixed(offset.astype(np.uint64))) ^ sub
        order = np.lexsort((windows, keys))
        same = (keys[order][1:] == keys[order][:-1]) & (windows[order][1:] == windows[order][:-1]) & (sub[order][1:] == sub[order][:-1])
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        twice &= ~rows.column("partner").to_numpy(zero_copy_only=False)[owner]
        where = np.flatnonzero(twice)
        # Runs of neighbouring offsets of one row.
        fresh = np.ones(len(where), bool)
        fresh[1:] = (where[1:] != where[:-1] + 1) | (owner[where[1:]] != owner[where[:-1]])
        a = where[fresh]
        b = where[np.append(np.flatnonzero(fresh)[1:], len(where)) - 1] if len(where) else where
        return pa.RecordBatch.from_arrays(
            [rows.column(c).combine_chunks().take(pa.array(owner[a])) for c in ("bucket", "member")] + [pa.array(offset[a].astype(np.int32)), pa.array(offset[b].astype(np.int32))],
            ["bucket", "member", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            for k in range(0, batch.num_rows, STEP_ROWS):
                piece = batch.slice(k, STEP_ROWS)
                held.append(piece)
                n += piece.num_rows
                if n >= STEP_ROWS:
                    table = pa.Table.from_batches(held).combine_chunks()
                    sub = table.column("sub").to_numpy()
                    cut = int(np.searchsorted(sub, sub[-1]))  # the last bucket may go on
                    if cut:
                        yield sort_windows(table.slice(0, cut))
                    held, n = table.slice(cut).to_batches(), table.num_rows - cut
        if n:
            yield sort_windows(pa.Table.from_batches(held).combine_chunks())

    return run


def _mixed_buckets(members: DataFrame, length: int, gram: int) -> DataFrame:
    """(bucket, member, lo, hi): offsets of repeated windows of the members of buckets that hold several."""
    widest = length - gram
    rows = settled(members.withColumns({"low": F.lit(0), "high": F.lit(widest)}), "members")
    done = None
    while True:
        # In each bucket one row stands for all that hold the same bytes; of those, the rest is repeated as a whole.
        same = rows.groupBy("sub", "uni").agg(F.count("*").alias("n"), F.max("partner").alias("known"), F.min(F.struct("bucket", "member")).alias("head"))
        sizes = same.groupBy("sub").agg(F.count("*").alias("size"), F.min((F.col("known") | (F.col("n") > 1)).cast("int")).alias("all_known"))
        told = rows.join(same.select("sub", "uni", "n", "head"), ["sub", "uni"])
        whole = told.where("n > 1 and not partner").select("bucket", "member", "lo", "hi")
        head = (F.col("bucket") == F.col("head.bucket")) & (F.col("member") == F.col("head.member"))
        left = told.where(head).withColumn("partner", F.col("partner") | (F.col("n") > 1)).drop("n", "head").dropDuplicates(["sub", "uni"])
        left = left.join(sizes.where("size > 1 and all_known = 0").select("sub", "size"), "sub")
        left = settled(left, "left")
        small = left.where(F.col("size") <= SMALL_BUCKET).drop("size").repartition("sub").sortWithinPartitions("sub")
        found = whole.unionByName(small.mapInArrow(_finish(length), "bucket bigint, member bigint, lo int, hi int"))
        done = found if done is None else done.unionByName(found)
        large = left.where(F.col("size") > SMALL_BUCKET).drop("size")
        if large.isEmpty():
            return done
        rows = settled(large.mapInArrow(_refined(length), _MEMBER + ", low int, high int"), "members")


def _windows(length: int):
    """All windows of words of each wanted member, by bucket and hash."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in steps(batches, "text"):
            values, at = _as_words(data, at)
            members = batch.column("members")
            bucket, member, place, lo, hi = (x.to_numpy(zero_copy_only=False) for x in members.flatten().flatten())
            row = np.repeat(np.arange(batch.num_rows), members.value_lengths().to_numpy(zero_copy_only=False))
            lo, count = lo.astype(np.int64), hi.astype(np.int64) - lo + 1
            owner = np.repeat(np.arange(len(member)), count)
            offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - lo, count)
            start = (at[row] + place)[owner] - offset
            window = Prints(values, _BASES[1]).spans(start, start + length)
            t1 = batch.column("t1").to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[owner]), pa.array(window.view(np.int64)), pa.array(member[owner]), pa.array(offset.astype(np.int32)), pa.array(t1[owner])],
                ["bucket", "window", "member", "offset", "t1"])

    return expand


def shared_words(docs: DataFrame, keys: DataFrame, length: int = PASSAGE, gram: int = PASSAGE_GRAM) -> DataFrame:
    """(t1, t2, n_shared_words): how many words of each text lie in passages of `length` words that another text holds too.

    `keys` has t1 and t2 of every row of `docs`. Words are what blanks and control characters part; how they are parted
    does not count. Texts without such a passage have no row.
    """
    rows = settled(docs.select("text").mapInArrow(_suffix_rows(length, gram, _as_words), _SUFFIX), "word-suffixes")
    counts = rows.groupBy("bucket", "member").agg(F.min("t1").alias("low"), F.max("t1").alias("high"))
    buckets = counts.groupBy("bucket").agg(F.max(F.col("low") == F.col("high")).alias("mixed"), F.min("low").alias("first"), F.max("high").alias("last")).where("first < last")
    live = counts.join(buckets, "bucket").select("bucket", "member", (F.col("low") < F.col("high")).alias("whole"), "mixed")
    seen = settled(rows.join(live, ["bucket", "member"]), "word-occurrences")

    # Of mixed buckets, every member's windows are drawn from one of its texts; a member that several texts hold is known to be shared.
    heads = seen.where("mixed").groupBy("bucket", "member", "whole").agg(F.min(F.struct("t1", "t2", "place", "lo", "hi")).alias("at"))
    heads = settled(heads, "word-heads")
    asked = heads.groupBy("at.t1", "at.t2").agg(F.collect_list(F.struct("bucket", "member", "at.place", "at.lo", "at.hi")).alias("members"))
    asked = settled(asked, "word-asked")
    texts = _texts(docs, keys, asked.select("t1", "t2")).dropDuplicates(["t1", "t2"])
    windows = texts.join(asked, ["t1", "t2"]).select("text", "t1", "members").mapInArrow(_windows(length), "bucket bigint, window bigint, member bigint, offset int, t1 bigint")
    windows = settled(windows.join(heads.select("bucket", "member", "whole"), ["bucket", "member"]), "word-windows")
    held = windows.groupBy("bucket", "window").agg(F.max("whole").alias("known"), F.min("t1").alias("low"), F.max("t1").alias("high")).where("known or low < high")
    found = windows.where("not whole").join(held.select("bucket", "window"), ["bucket", "window"], "left_semi").groupBy("bucket", "member").agg(F.collect_list("offset").alias("offsets"))

    def span(hi, lo):
        return F.struct((F.col("place") - hi).alias("a"), (F.col("place") - lo + length).alias("b"))

    whole = seen.where("whole").select("t1", "t2", F.array(span(F.col("hi"), F.col("lo"))).alias("spans"))
    part = seen.where("not whole").join(found, ["bucket", "member"]).select("t1", "t2", F.transform("offsets", lambda o: span(o, o)).alias("spans"))
    spans = whole.unionByName(part).groupBy("t1", "t2").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    zero = F.lit(0).cast("bigint")
    covered = F.aggregate("spans", F.struct(zero.alias("n"), zero.alias("end")), lambda x, s: F.struct(
        (x["n"] + F.greatest(s["b"] - F.greatest(s["a"], x["end"]), zero)).alias("n"), F.greatest(x["end"], s["b"]).alias("end")))
    return spans.select("t1", "t2", covered["n"].alias("n_shared_words"))


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, at in steps(batches, "text"):
        out = []
        for r, spans in enumerate(batch.column("spans").to_pylist()):
            raw = data[at[r] : at[r + 1]]
            gone = np.zeros(len(raw) + 1, np.int64)
            for s in spans:
                gone[s["a"]] += 1
                gone[s["b"]] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = raw[~gone].tobytes()
            out.append((int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("t1"), batch.column("t2"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out]),
             pa.array([x[3] for x in out], pa.binary())], ["t1", "t2", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bytes_too: bool = True, passage: int = 0, passage_gram: int = PASSAGE_GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and `kept` (the remaining bytes; null where nothing was removed).

    Removed are all bytes of strings of `length` bytes that also start elsewhere, in the same text or another; overlapping
    occurrences count, and nothing removed changes what is repeated. A text that occurs in several rows is removed
    from each. Null is empty. Every row gives one row, whatever its doc_id. With `passage`, n_shared_words follows: the words
    of the row in passages of so many words that another row holds too, which says nothing of what is removed.
    """
    keys = settled(docs.select("doc_id", "text").mapInArrow(_keys, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, t1 bigint, t2 bigint, n_bytes bigint, n_words bigint, sha256 string"), "texts")
    rows = settled(docs.select("text").mapInArrow(_suffix_rows(length, gram), _SUFFIX), "suffixes")
    counts = rows.groupBy("bucket", "member").agg(F.count("*").alias("n"))
    buckets = counts.groupBy("bucket").agg(F.count("*").alias("members"), F.max("n").alias("most"), F.min("n").alias("least")).where("members > 1 or most > 1")
    live = counts.join(buckets.drop("most"), "bucket").where("n > 1 or members > 1")
    seen = settled(rows.join(live, ["bucket", "member"]), "occurrences")
    # Copies of whole texts need no spans: all of their windows are repeated.
    text_counts = keys.groupBy("t1", "t2").agg(F.count("*").alias("rows"))

    heads = seen.where("members > 1 and least = 1").groupBy("bucket", "member").agg(F.min(F.struct("t1", "t2", "place", "lo", "hi")).alias("at"), F.first("n").alias("n"))
    asked = settled(heads.groupBy("at.t1", "at.t2").agg(F.collect_list(F.struct("bucket", "member", "at.place", "at.lo", "at.hi", "n")).alias("members")), "asked")
    texts = _texts(docs, keys, asked.select("t1", "t2")).dropDuplicates(["t1", "t2"])
    members = texts.join(asked, ["t1", "t2"]).select("text", "members").mapInArrow(_contents(length), _MEMBER)
    found = settled(_mixed_buckets(members, length, gram), "found")

    whole = seen.where("n > 1").select("t1", "t2", (F.col("place") - F.col("hi")).alias("a"), (F.col("place") - F.col("lo") + length).alias("b"))
    offsets = found.select("bucket", "member", F.col("lo").alias("l"), F.col("hi").alias("h"))
    part = seen.where("n = 1").select("bucket", "member", "t1", "t2", "place").join(offsets, ["bucket", "member"])
    part = part.select("t1", "t2", (F.col("place") - F.col("h")).alias("a"), (F.col("place") - F.col("l") + length).alias("b"))
    once = text_counts.where("rows = 1").select("t1", "t2")
    spans = whole.unionByName(part).join(once, ["t1", "t2"]).groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    spans = settled(spans, "spans")
    changed = _texts(docs, keys, spans.select("t1", "t2")).join(spans, ["t1", "t2"]).mapInArrow(_cleaner, "t1 bigint, t2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    if not bytes_too:
        changed = changed.drop("kept")

    named = text_counts.join(changed, ["t1", "t2"], "left")
    if passage:
        named = named.join(shared_words(docs, keys, passage, passage_gram), ["t1", "t2"], "left")
    all_gone = (F.col("rows") > 1) & (F.col("n_bytes") >= length)
    out = keys.join(named, ["t1", "t2"], "left")
    columns = [
        "doc_id", "n_bytes", F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(all_gone, F.lit(1).cast("bigint")).otherwise(F.coalesce("n_spans", F.lit(0).cast("bigint"))).alias("n_spans"),
        F.when(all_gone, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256")]
    if bytes_too:
        columns.append(F.when(all_gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    if passage:
        copied = (F.col("rows") > 1) & (F.col("n_words") >= passage)
        columns.append(F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_shared_words", F.lit(0).cast("bigint"))).alias("n_shared_words"))
    return out.select(*columns)


def report(docs: DataFrame, passage: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document; with `passage`, n_shared_words too."""
    return without_repeats(docs, bytes_too=False, passage=passage)
