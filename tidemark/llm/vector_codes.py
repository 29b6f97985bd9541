"""Vector code compression: product codes with memoised grid cells.

Vectors become integers and are cut into equal consecutive parts, each with a codebook of its own. The nearest entry of a
part is found by the cell of a coarse grid that the part lies in: over the cell's box every entry has a least and a
greatest squared distance, and an entry whose least lies above another's greatest is dominated, so it is nearest to no
point of the box. The entries left are kept in memory by the cell, and only those are evaluated exactly. Codebooks are
bounded (parts x entries), so they pass through the driver between rounds; rows stay in their tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Cells are 2 ** CELL_BITS wide in every component.
CELL_BITS = 5
#: Entries of cells that a task keeps before it begins anew.
CACHE_ENTRIES = 4_000_000
#: Pairs of part and entry that one step evaluates.
STEP_PAIRS = 1 << 16
#: Sums of squares stay below this, so that 64 bits hold them.
_MOST = 1 << 62


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that take part, their sizes, and all their components scaled and floored, one after the other.

    Null and empty vectors and those with null or non-finite components take no part.
    """
    at = column.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(at)
    values = np.asarray(column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]], np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ok = (bad[at[1:] - at[0]] == bad[at[:-1] - at[0]]) & (sizes > 0)
    if column.null_count:
        ok &= column.is_valid().to_numpy(zero_copy_only=False)
    whole = np.floor(values[np.repeat(ok, sizes)] * SCALE)
    if len(whole) and np.abs(whole).max() >= 2.0**31:
        raise ValueError("components beyond 2 ** 21 have no exact integer distances")
    return np.flatnonzero(ok), sizes[ok], whole.astype(np.int64)


def _matrix(sizes: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class CellBook:
    """One part's codebook with the entries of the cells met so far."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS):
        self.entries, self.bits = entries, bits
        self.cells: dict[bytes, np.ndarray] = {}
        self.held = self.asked = self.hits = self.evaluated = 0

    def undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries, ascending, that may be nearest to a point of its box."""
        least = np.zeros((len(cells), len(self.entries)), np.int64)
        most = np.zeros_like(least)
        for k in range(cells.shape[1]):
            coordinates, which = np.unique(cells[:, k], return_inverse=True)
            lo = (coordinates << self.bits)[:, None]
            under, over = lo - self.entries[:, k], self.entries[:, k] - (lo + (1 << self.bits) - 1)
            least += (np.maximum(np.maximum(under, over), 0) ** 2)[which]
            most += (np.maximum(-under, -over) ** 2)[which]
        keep = least <= most.min(axis=1, keepdims=True)
        return np.split(np.nonzero(keep)[1].astype(np.int32), np.cumsum(keep.sum(axis=1))[:-1])

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, ties to the lower index, and its squared distance."""
        index, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        if not len(rows) or not rows.shape[1]:
            return index, distance
        cells = np.ascontiguousarray(rows >> self.bits)
        keys = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
        keys, first, which = np.unique(keys, return_index=True, return_inverse=True)
        names = [key.tobytes() for key in keys]
        if self.held > CACHE_ENTRIES:
            self.cells, self.held = {}, 0
        new = [k for k, name in enumerate(names) if name not in self.cells]
        self.asked += len(rows)
        self.hits += len(rows) - len(new)
        for lo in range(0, len(new), 1024):
            some = new[lo : lo + 1024]
            for k, kept in zip(some, self.undominated(cells[first[some]])):
                self.cells[names[k]] = kept
                self.held += len(kept) + 64
        kept = [self.cells[name] for name in names]
        size = np.fromiter(map(len, kept), np.int64, len(kept))
        flat, begin = np.concatenate(kept), np.cumsum(size) - size
        many = size[which]
        ends = np.cumsum(many)
        lo = 0
        while lo < len(rows):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - many[lo] + STEP_PAIRS, "right")))
            n, total = many[lo:hi], int(many[lo:hi].sum())
            starts = np.cumsum(n) - n
            entry = flat[np.arange(total) + np.repeat(begin[which[lo:hi]] - starts, n)]
            square = ((np.repeat(rows[lo:hi], n, axis=0) - self.entries[entry]) ** 2).sum(axis=1)
            best = np.minimum.reduceat(square, starts)
            place = np.where(square == np.repeat(best, n), np.arange(total), total)
            index[lo:hi], distance[lo:hi] = entry[np.minimum.reduceat(place, starts)], best
            self.evaluated += total
            lo = hi
        return index, distance


def _shape(vectors: DataFrame, column: str) -> int:
    """The widest vector that takes part, rounded up to a multiple of PARTS; 0 when none does."""

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = top = 0
        for batch in batches:
            _, sizes, values = _vectors(batch.column(0))
            width, top = max(width, int(sizes.max(initial=0))), max(top, int(np.abs(values).max(initial=0)))
        yield pa.RecordBatch.from_pydict({"width": pa.array([width], pa.int64()), "top": pa.array([top], pa.int64())})

    width, top = vectors.select(column).mapInArrow(widest, "width bigint, top bigint").agg(F.max("width"), F.max("top")).first()
    width = -(-(width or 0) // PARTS) * PARTS
    if width * (2 * (top or 0) + 1) ** 2 >= _MOST:
        raise ValueError("squared distances of these vectors don't fit 64 bits")
    return width


def _first(vectors: DataFrame, key: str, column: str, width: int) -> np.ndarray:
    """The integer vectors of the ENTRIES least keys; equal keys by vector, null keys last."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, values = _vectors(batch.column(1))
            flat = _matrix(sizes, values, width).ravel()
            at = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.ListArray.from_arrays(at, pa.array(flat))], ["key", "v"])

    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(key, column).mapInArrow(whole, f"key {kind}, v array<bigint>").orderBy(F.col("key").asc_nulls_last(), "v").limit(ENTRIES)
    return np.array([r.v for r in rows.select("v").collect()], np.int64).reshape(-1, width)


def _sums(vectors: DataFrame, column: str, books: list[np.ndarray], width: int) -> list[tuple[int, int]]:
    """(slot, sum): for each part and entry the sums of its parts' components, then their count."""
    part = width // PARTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders, out = [CellBook(b) for b in books], [np.zeros((len(b), part + 1), np.int64) for b in books]
        for batch in batches:
            _, sizes, values = _vectors(batch.column(0))
            rows = _matrix(sizes, values, width)
            for p, finder in enumerate(finders):
                mine = rows[:, p * part : (p + 1) * part]
                index, _ = finder.nearest(mine)
                np.add.at(out[p], (index, slice(0, part)), mine)
                out[p][:, part] += np.bincount(index, minlength=len(out[p]))
        flat = np.concatenate([o.ravel() for o in out])
        used = np.concatenate([np.repeat(o[:, part] > 0, part + 1) for o in out])
        yield pa.RecordBatch.from_pydict({"slot": pa.array(np.flatnonzero(used), pa.int64()), "sum": pa.array(flat[used], pa.int64())})

    summed = vectors.select(column).mapInArrow(add, "slot bigint, sum bigint").groupBy("slot").agg(F.sum("sum").alias("sum"))
    return [(r.slot, r["sum"]) for r in summed.collect()]  # at most PARTS * ENTRIES * (width / PARTS + 1) rows


def codebooks(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", rounds: int = ROUNDS) -> list[np.ndarray]:
    """The entries of each part position after `rounds` rounds; fewer than ENTRIES where fewer vectors take part."""
    width = _shape(vectors, column)
    part = width // PARTS
    seeds = _first(vectors, key, column, width) if width else np.zeros((0, 0), np.int64)
    books = [np.ascontiguousarray(seeds[:, p * part : (p + 1) * part]) for p in range(PARTS)]
    for _ in range(rounds if len(seeds) else 0):
        total = np.zeros((PARTS, len(seeds), part + 1), np.int64)
        for slot, value in _sums(vectors, column, books, width):
            total.reshape(-1)[slot] = value
        for p, book in enumerate(books):
            used = total[p, :, part] > 0
            book[used] = total[p, used, :part] // total[p, used, part:]
    return books


def encode(vectors: DataFrame, books: list[np.ndarray], column: str = "embedding") -> DataFrame:
    """The rows that take part with `code` (two hex digits a part) and `error` (squared distances, summed); columns so named are replaced."""
    kept = vectors.drop("code", "error")
    names, part = kept.columns, books[0].shape[1]
    at = names.index(column)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [CellBook(b) for b in books]
        for batch in batches:
            rows, sizes, values = _vectors(batch.column(at))
            ints = _matrix(sizes, values, part * PARTS)
            codes, error = np.zeros((len(rows), PARTS), np.uint8), np.zeros(len(rows), np.int64)
            for p, finder in enumerate(finders):
                codes[:, p], distance = finder.nearest(ints[:, p * part : (p + 1) * part])
                error += distance
            digits = codes.tobytes().hex()
            code = pa.array([digits[k : k + 2 * PARTS] for k in range(0, len(digits), 2 * PARTS)], pa.string())
            mine = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*mine.columns, code, pa.array(error)], [*names, "code", "error"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    return kept.mapInArrow(assign, schema + "code string, error bigint")


def decode(spark: SparkSession, codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The rows with `vector`: the integer components of the entries that `code` names; null codes give null."""
    kept = codes.drop("vector")
    table = F.lit([[[int(x) for x in entry] for entry in book] for book in books])
    entry = lambda p: F.element_at(F.element_at(table, p + 1), F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1)
    return kept.withColumn("vector", F.when(F.col("code").isNotNull(), F.concat(*(entry(p) for p in range(PARTS)))))


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal text, comma-joined, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def report(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """A row per vector that takes part: code, error, the error of all rows of its label, and the codebooks' digest.

    Vectors null, empty or with null or non-finite components drop out; shorter ones count as padded with zeros up to the
    widest, and that up to a multiple of four. Repeated rows and keys keep their rows; null keys seed last, null labels
    are one label. No vector at all: no rows. Components beyond 2 ** 21, or distances beyond 64 bits, raise ValueError.
    """
    books = codebooks(vectors, key, column)
    coded = encode(vectors.select(key, label, column), books, column).drop(column)
    salts = 16  # a label may hold most rows: its total meets them in as many groups
    totals = coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    totals = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = coded.withColumn("_salt", F.pmod(F.xxhash64(key, "code"), F.lit(salts)).cast("int"))
    joined = rows.join(totals, rows[label].eqNullSafe(totals["_label"]) & (rows["_salt"] == totals["_salt"]))
    return joined.select(key, "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
