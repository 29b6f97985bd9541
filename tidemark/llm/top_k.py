"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Candidates and queries are dealt into blocks of bounded size; each pair of blocks is one group, so no task holds more than
a block of either. Within a candidate block every dimension has its list of rows in ascending order. A query reads each
list from the end that its own component favours, some depth at a time; rows that come up are scored in full. No row
further down can score more than the query's products with the lists' current ends, and once that bound falls below the
k-th score the block is done. The k best of all blocks are merged last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
#: How much deeper each round reads the lists.
DEPTH = 8


def integer_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v): floor(scale * x) of each component. Vectors null, empty or with null or non-finite components, and rows with a null id, take no part.

    Of rows with the same id only the least vector counts.
    """
    x = F.transform(F.col(column), lambda e: e.cast("double"))
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & (F.size(F.coalesce(column, F.array())) > 0) & F.coalesce(whole, F.lit(False)))
    ints = rows.select(F.col(key).cast("bigint").alias("id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))
    return ints.groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _reach(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min()))


class SortedLists:
    """A block of candidates with its per-dimension lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.order = np.argsort(self.vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, self.order, axis=0)

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the query's k best rows (ties to smaller ids, never its own id), and how many rows were scored."""
        n = len(self.ids)
        live = np.flatnonzero(query)
        seen = self.ids == query_id
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step, scored = 0, DEPTH, 0
        up = query[live] > 0
        while depth < n:
            to = min(n, depth + step)
            if len(live):
                ranks = np.arange(depth, to)[:, None]
                rows = self.order[np.where(up, n - 1 - ranks, ranks), live].ravel()
                fresh = np.unique(rows[~seen[rows]])
                end = np.where(up, n - to, to - 1)
                bound = int(query[live] @ self.sorted[end, live])
            else:  # every score is 0
                fresh, bound, to = np.flatnonzero(~seen)[:k], 0, n
            seen[fresh] = True
            scored += len(fresh)
            found = np.concatenate([found, fresh])
            scores = np.concatenate([scores, self.vectors[fresh] @ query])
            if len(found) > k:
                top = np.lexsort((found, -scores))[:k]
                found, scores = found[top], scores[top]
            if len(found) >= k and bound < scores.min():
                break
            depth, step = to, step * 2
        top = np.lexsort((found, -scores))[:k]
        return self.ids[found[top]], scores[top], scored


def _search(k: int):
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows and b.num_rows:
            rows, asks = a.column("v").combine_chunks(), b.column("v").combine_chunks()
            width = max(int(np.diff(x.offsets.to_numpy()).max()) for x in (rows, asks))
            lists = SortedLists(a.column("id").to_numpy(), _matrix(rows, width))
            queries = _matrix(asks, width)
            if width * _reach(lists.vectors) * _reach(queries) >= 1 << 63:
                raise OverflowError("inner products of these vectors may exceed 64 bits")
            out = [[], [], []]
            for query_id, query in zip(b.column("id").to_pylist(), queries):
                ids, scores, _ = lists.best(query_id, query, k)
                out[0].append(np.full(len(ids), query_id)), out[1].append(ids), out[2].append(scores)
            return pa.table([pa.array(np.concatenate(x), pa.int64()) for x in out], schema=kind)
        return kind.empty_table()

    return search


def search(candidates: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of every query's k highest inner products among the other ids; both inputs (id, v).

    Shorter vectors count as padded with zeros; ties go to the smaller id. Fewer than k candidates give fewer rows. Blocks
    whose greatest components could take a sum beyond 64 bits raise an OverflowError. Candidates x queries is the work that is asked for; it is dealt in blocks of `block_rows` each.
    """
    n_blocks = -(-candidates.count() // block_rows)
    q_blocks = -(-queries.count() // block_rows)
    if not n_blocks or not q_blocks:
        return candidates.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    cut = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.array_repeat(F.lit(0), n)) if n == 1 else F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = candidates.select(cut(n_blocks, 0).alias("block"), every(q_blocks).alias("part"), "id", "v")
    asks = queries.select(every(n_blocks).alias("block"), cut(q_blocks, 1).alias("part"), "id", "v")
    near = rows.groupBy("block", "part").cogroup(asks.groupBy("block", "part")).applyInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    # Spark keeps the k best of each query in every task before it merges them.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k best of each row whose id is divisible by `every`."""
    ints = integer_vectors(embeddings)
    return search(ints, ints.where(F.col("id") % every == 0), k)
