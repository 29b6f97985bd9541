"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are runs of `window` of its words (a shorter item is one window). Each window becomes the set of its
word shingles, ordered by how rare they are in the corpus. As containment must be complete, the rarest shingle alone is
the necessary prefix: only documents that hold it can hold the window. A shingle that the corpus lacks rules its window
out. Candidates join on the prefix shingle; its place in the window fixes where the window would start, which must lie in
the document with room for all its words; then every word is compared.

Items are drawn and travel to the tasks in blocks of bounded size, one pass over the documents for each block, whose result
is saved before the next block is drawn; so the benchmark may be of any length. Documents are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import settled
from tidemark.llm.texts import LOWER, row_counts, runs_of, steps, word_table

SHINGLE_WORDS = 3
#: Words of items that one pass over the documents carries.
BLOCK_WORDS = 200_000

_FOUND = "hits array<struct<first:int,last:int>>, items array<string>, n_words bigint"


class _Block:
    """The windows of some items, by prefix shingle."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.ids: list[str] = []
        parts: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        for item, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            _, starts, ends, _ = word_table(data, np.array([0, len(data)]))
            low = LOWER[data].tobytes()
            words = [low[a:b] for a, b in zip(starts, ends)]
            number = len(self.ids)
            self.ids.append(item)
            for k in range(max(1, len(words) - window + 1) if words else 0):
                parts[tuple(words[k : k + window])].add(number)
        self.words = list(parts)
        self.items = [sorted(parts[w]) for w in self.words]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.width = window
        self.hashes = np.zeros((len(self.words), window), np.uint64)
        for n, w in enumerate(self.words):
            joined = np.frombuffer(b" ".join(w), np.uint8)
            self.hashes[n, : len(w)] = word_table(joined, np.array([0, len(joined)]))[0]
        self.probes: dict[int, tuple[np.ndarray, ...]] = {}

    def shingles(self) -> dict[int, np.ndarray]:
        """Distinct shingles by their number of words: SHINGLE_WORDS, or all words of a shorter window."""
        out = defaultdict(list)
        for n, length in enumerate(self.lengths):
            size = min(SHINGLE_WORDS, int(length))
            out[size].append(runs_of(self.hashes[n, :length], size))
        return {size: np.unique(np.concatenate(x)) for size, x in out.items()}

    def prefer(self, counts: dict[tuple[int, int], int]) -> None:
        """Keep each window's rarest shingle and its offset; drop windows with a shingle that never occurs."""
        chosen = defaultdict(list)
        for n, length in enumerate(self.lengths):
            size = min(SHINGLE_WORDS, int(length))
            ranked = sorted((counts.get((size, int(h)), 0), int(h), k) for k, h in enumerate(runs_of(self.hashes[n, :length], size)))
            if ranked[0][0]:
                chosen[size].append((ranked[0][1], n, ranked[0][2]))
        for size, rows in chosen.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            self.probes[size] = (*_lookup(keys), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64))


def _lookup(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted keys: the distinct ones, where each begins and ends, and a bitmap of their leading bits."""
    distinct, begin = np.unique(keys, return_index=True)
    bitmap = np.zeros(1 << 20, bool)
    bitmap[distinct >> np.uint64(44)] = True
    return distinct, begin, np.append(begin[1:], len(keys)), bitmap


def _found(values: np.ndarray, distinct: np.ndarray, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in `values` that hold one of the distinct keys, and which."""
    near = np.flatnonzero(bitmap[values >> np.uint64(44)])
    which = np.searchsorted(distinct, values[near])
    which[which == len(distinct)] = 0
    same = distinct[which] == values[near]
    return near[same], which[same]


def _counter(wanted: dict[int, np.ndarray]):
    tables = {size: _lookup(x) for size, x in wanted.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {size: np.zeros(len(x), np.int64) for size, x in wanted.items()}
        for _, data, at in steps(batches, "text"):
            hashes, _, _, rows = word_table(data, at)
            for size, (distinct, _, _, bitmap) in tables.items():
                runs = runs_of(hashes, size)
                place, which = _found(runs, distinct, bitmap)
                which = which[rows[place] == rows[place + size - 1]]
                totals[size] += np.bincount(which, minlength=len(distinct))
        for size, total in totals.items():
            on = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(on), size, np.int32)), pa.array(wanted[size][on].view(np.int64)), pa.array(total[on])], ["size", "shingle", "n"])

    return count


def _matcher(block: _Block, first_pass: bool, names: list[str]):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_in, data, at in steps(batches, "text"):
            n = rows_in.num_rows
            hashes, starts, ends, rows = word_table(data, at)
            counts = row_counts(rows, n)
            begin = np.cumsum(counts) - counts
            spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
            items: list[set[str]] = [set() for _ in range(n)]
            low = LOWER[data] if len(block.probes) else data
            for size, (distinct, lo, hi, bitmap, window, offset) in block.probes.items():
                place, which = _found(runs_of(hashes, size), distinct, bitmap)
                many = hi[which] - lo[which]
                place, entry = np.repeat(place, many), np.repeat(lo[which], many) + _within(many)
                w, start = window[entry], place - offset[entry]
                row, last = rows[place], start + block.lengths[w]
                fits = (start >= begin[row]) & (last <= begin[row] + counts[row])
                w, start, row, last = w[fits], start[fits], row[fits], last[fits]
                same = np.ones(len(w), bool)
                for k in range(block.width):
                    used = k < block.lengths[w]
                    same &= ~used | (hashes[np.where(used, start + k, 0)] == block.hashes[w, k])
                for i in np.flatnonzero(same):
                    if all(low[starts[start[i] + k] : ends[start[i] + k]].tobytes() == word for k, word in enumerate(block.words[w[i]])):
                        spans[row[i]].append((int(start[i] - begin[row[i]]), int(last[i] - begin[row[i]])))
                        items[row[i]].update(block.ids[x] for x in block.items[w[i]])
            if not first_pass:
                for r, (old, known) in enumerate(zip(rows_in.column("hits").to_pylist(), rows_in.column("items").to_pylist())):
                    spans[r] += [(x["first"], x["last"]) for x in old]
                    items[r].update(known)
            yield pa.RecordBatch.from_arrays(
                [*(rows_in.column(c) for c in names),
                 pa.array([_joined(x) for x in spans], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(counts)],
                [*names, "hits", "items", "n_words"])

    return match


def _within(many: np.ndarray) -> np.ndarray:
    total = int(many.sum())
    return np.arange(total) - np.repeat(np.cumsum(many) - many, many)


def _joined(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """The union of [first, last) spans."""
    out: list[list[int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"first": a, "last": b} for a, b in out]


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str]]]:
    held, size = [], 0
    for item, text in benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), "text").toLocalIterator():
        held.append((item, text))
        size += len(text) // 5
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _nonempty(blocks: Iterator[list[tuple[str, str]]]) -> Iterator[list[tuple[str, str]]]:
    yield next(blocks, [])
    yield from blocks


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents with `hits` (runs of word numbers [first, last) covered by item windows), `items` and `n_words`.

    Columns named like these in `docs` are replaced. A null text has no words. Items without words, id or text match
    nothing; repeated items count once. Every document row gives one row, repeated rows as well.
    """
    out = docs.drop("hits", "items", "n_words")
    names = out.columns
    text = docs.select("text")
    first = True
    # A benchmark without items still makes one, empty, pass.
    for items in _nonempty(_blocks(benchmark, block_words)):
        if not first:  # what earlier blocks found is saved, so that neither the plan nor the driver holds more than one block
            out = settled(out, "item-hits")
        block = _Block(items, window)
        wanted = block.shingles()
        if wanted:
            found = text.mapInArrow(_counter(wanted), "size int, shingle bigint, n bigint").groupBy("size", "shingle").agg(F.sum("n").alias("n"))
            block.prefer({(r.size, r.shingle % (1 << 64)): r.n for r in found.collect()})
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names) + ", " + _FOUND
        out = out.mapInArrow(_matcher(block, first, names), schema)
        first = False
    return out


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents in which no item window occurs, with the columns of `docs`."""
    return contamination(docs, benchmark, window).where(F.size("hits") == 0).select(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """A row per document: word and hit counts, the number and digest of its items."""
    found = contamination(docs.select("doc_id", "text"), benchmark, window)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
