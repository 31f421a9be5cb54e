"""Exact top-k inner products by MaxScore over shards of an inverted index.

A vector is a document and a dimension with a sign is a term: the term's postings are the
vectors whose component has that sign, its impacts their components. A query's terms are
the dimensions it uses, with the sign that raises the score; where a vector's component
has the other sign the score falls, which no upper bound has to count.

Terms are ordered by their greatest possible share of the score in a shard. The terms at
the end that together cannot reach the score to beat are non-essential: only vectors in
the postings of an essential term can get in. Vectors are scored on a query's essential
terms first; those that can still reach the score to beat are probed on its other terms,
one group after another, while they stay competitive. The score to beat is the k-th best
so far, at the start that of a sample of all vectors, which is a lower bound in every
shard. The shards' best are merged.

Queries go to the vectors, not the other way round: a block of queries is broadcast, and
each task reads its vectors once for it.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches
from scholaris.sources.workspace import stored

K = 20
# Vectors of a shard, and of the sample that the scores to beat come from.
SHARD = 4096
# Vectors that a task reads, at the most; components of the queries that are broadcast at a time.
TASK_VECTORS = 1 << 17
BLOCK_CELLS = 1 << 22
# Queries that meet a shard together.
TOGETHER = 128
# Non-essential terms probed before vectors are dropped again.
PROBE = 8
# One in so many vectors still competitive after the essential terms is many.
MANY = 64
# Below every score.
LOWEST = -(2**62)


class Best:
    """The k best so far of some queries, in rows (query, score, vec_id, row)."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least.copy()
        self.full = np.zeros(len(least), bool)
        self.rows = np.zeros((4, 0), np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        rows = np.concatenate((self.rows, np.stack((query, score.astype(np.int64), ids, row))), axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        last = rows[:, place == self.k - 1]
        self.least[last[0]] = np.maximum(self.least[last[0]], last[1])
        self.full[last[0]] = True
        self.rows = rows[:, place < self.k]


class Shard:
    """The inverted index of some vectors: components by term, and each term's greatest impact."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray):
        self.ids, self.rows, self.components = ids, rows, np.ascontiguousarray(vectors.T)
        # Row 0: of the positive terms, row 1: of the negative ones.
        self.impacts = np.stack([self.components.max(axis=1, initial=0), -self.components.min(axis=1, initial=0)])

    def terms(self, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each query's terms by their greatest share, what term i and all after it can add, and how many are essential."""
        dimensions = queries.shape[1]
        shares = np.abs(queries) * self.impacts[(queries < 0).astype(np.int64), np.arange(dimensions)]
        order = np.argsort(-shares, axis=1, kind="stable")
        open_after = np.zeros((len(queries), dimensions + 1), shares.dtype)
        open_after[:, :-1] = np.cumsum(np.take_along_axis(shares, order, axis=1)[:, ::-1], axis=1)[:, ::-1]
        return order, open_after, np.minimum((open_after >= least[:, None]).sum(axis=1), dimensions)

    def search(self, queries: np.ndarray, own: np.ndarray, best: Best) -> None:
        """Add this shard's vectors to the best of some queries, without the query's own row.

        Where k are known from vectors of smaller ids, equal scores come too late.
        """
        dimensions = queries.shape[1]
        least = best.least + best.full
        order, open_after, essential = self.terms(queries, least)
        weights = np.take_along_axis(queries, order, axis=1)
        scattered = np.zeros_like(queries)
        np.put_along_axis(scattered, order, np.where(np.arange(dimensions) < essential[:, None], weights, 0), axis=1)
        partial = scattered @ self.components
        # A vector in no essential posting has nothing above 0 here, and falls out with the bound.
        competitive = partial + open_after[np.arange(len(queries)), essential][:, None] >= least[:, None]
        if np.count_nonzero(competitive) * MANY > competitive.size:
            # So many are left that probing them all at once on the other terms costs least.
            partial += (queries - scattered) @ self.components
            competitive &= partial >= least[:, None]
            essential = np.full(len(queries), dimensions)
        query, vector = np.nonzero(competitive)
        partial, at = partial[query, vector], essential[query]
        while (more := at < dimensions).any():
            done = ~more
            probe = np.minimum(at[:, None] + np.arange(PROBE), dimensions - 1)
            real = at[:, None] + np.arange(PROBE) < dimensions
            terms = order[query[:, None], probe]
            partial = partial + (weights[query[:, None], probe] * self.components[terms, vector[:, None]] * real).sum(axis=1)
            at = np.minimum(at + PROBE, dimensions)
            left = done | (partial + open_after[query, at] >= least[query])
            query, vector, partial, at = query[left], vector[left], partial[left], at[left]
        good = (partial >= least[query]) & (self.rows[vector] != own[query])
        if good.any():
            best.add(query[good], partial[good], self.ids[vector[good]], self.rows[vector[good]])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, shorter ones filled with 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(pa.compute.list_value_length(lists))
    values = np.zeros((len(lengths), width), np.int64)
    values[np.arange(width) < lengths[:, None]] = np.asarray(lists.flatten())
    return values


def search(ids, rows, vectors, queries, own, least, k: int) -> np.ndarray:
    """(query, score, vec_id, row) of the k best of each query among some vectors, shard by shard."""
    # Whole numbers in doubles are exact, and faster, as long as no score can pass 2**53.
    bound = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(queries.shape[1], 1)
    kind = np.float64 if bound < 2.0**53 else np.int64
    order = np.lexsort((rows, ids))
    asked = queries.astype(kind)
    groups = [slice(at, at + TOGETHER) for at in range(0, len(asked), TOGETHER)]
    bests = [Best(least[group], k) for group in groups]
    for start in range(0, len(order), SHARD):
        part = order[start : start + SHARD]
        shard = Shard(ids[part], rows[part], vectors[part].astype(kind))
        for group, best in zip(groups, bests, strict=True):
            shard.search(asked[group], own[group], best)
    found = [best.rows + [[group.start], [0], [0], [0]] for group, best in zip(groups, bests, strict=True)]
    return np.concatenate(found or [np.zeros((4, 0), np.int64)], axis=1)


def whole_vectors(table: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(row, vec_id, v array<long>): floor(scale * component) of every vector that takes part.

    Null ids, null vectors and vectors with a null or non-finite component take no part.
    Every other row does, also where rows share an id or are equal; `row` tells them apart.
    """
    x = F.col(vector_column)
    fit = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    rows = table.where(F.col(id_column).isNotNull() & x.isNotNull() & fit)
    scaled = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long"))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("vec_id"), scaled.alias("v"))


def with_starts(asked: DataFrame, sample: pa.Table, width: int, k: int) -> DataFrame:
    """The queries with `least`, their k-th best score in the sample, or the lowest number if it has fewer others."""
    ids, rows = np.asarray(sample.column("vec_id")), np.asarray(sample.column("row"))
    given = asked.sparkSession.sparkContext.broadcast((ids, rows, matrix(sample.column("v"), width)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(0))
            start = np.full(len(own), LOWEST, np.int64)
            found = search(*given.value, matrix(batch.column(2), width), own, start, k)
            place = np.arange(found.shape[1]) - np.searchsorted(found[0], found[0])
            start[found[0][place == k - 1]] = found[1][place == k - 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(start)], ["row", "vec_id", "v", "least"])

    return map_batches(asked, work, "row long, vec_id long, v array<long>, least long")


def best_of_tasks(vectors: DataFrame, block: pa.Table, width: int, k: int) -> DataFrame:
    """(query_row, query_id, vec_id, score): the k best of a block of queries among each task's vectors."""
    queries = tuple(np.asarray(block.column(c)) for c in ("row", "vec_id", "least"))
    given = vectors.sparkSession.sparkContext.broadcast((*queries, matrix(block.column("v"), width)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, query_ids, least, asked = given.value
        parts = [(np.asarray(b.column(1)), np.asarray(b.column(0)), matrix(b.column(2), width)) for b in batches]
        if parts:
            ids, rows, held = (np.concatenate(p) for p in zip(*parts, strict=True))
            query, score, found, _ = search(ids, rows, held, asked, own, least, k)
            columns = [pa.array(x) for x in (own[query], query_ids[query], found, score)]
            yield pa.RecordBatch.from_arrays(columns, ["query_row", "query_id", "vec_id", "score"])

    return map_batches(vectors, work, "query_row long, query_id long, vec_id long, score long")


def top_k(
    table: DataFrame, every: int = 20, k: int = K, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding",
    task_vectors: int = TASK_VECTORS, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """(query_id, rank int, vec_id, score): each query's k greatest inner products.

    Queries are the rows whose id is divisible by `every`; candidates are all rows but the
    query's own. Ties go to the smaller id, rows of one id and score are alike; fewer than k
    candidates are all returned. A query id on several rows is as many queries, each ranked
    from 1. Vectors of different lengths are compared as if the shorter ended in zeros.
    Scores must fit in 62 bits. A table without vectors gives no rows.

    The vectors are written down, dealt by a hash of their row into tasks of `task_vectors`
    at the most, so that equal vectors spread like any others. Queries are taken in blocks of
    `block_cells` components, one block at a time in memory, and a block's best are written
    down before the next.
    """
    spark = table.sparkSession
    vectors = stored(whole_vectors(table, id_column, vector_column, scale), "vectors")
    asked = vectors.where(F.col("vec_id") % every == 0)
    size = vectors.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    n, width = size["n"], size["width"]
    schema = "query_row long, query_id long, vec_id long, score long"
    parts = [spark.createDataFrame([], schema)]
    n_asked = asked.count()
    if n_asked:
        each = min(task_vectors, max(SHARD, -(-n // (2 * spark.sparkContext.defaultParallelism))))
        dealt = stored(vectors.repartition(-(-n // each), "row"), "dealt")
        sample = vectors.orderBy(F.xxhash64("row"), "row").limit(SHARD).toArrow()
        queries = stored(with_starts(asked, sample, width, k), "queries")
        blocks = -(-n_asked * max(width, 1) // block_cells)
        for number in range(blocks):
            block = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).toArrow()
            if block.num_rows:
                parts.append(stored(best_of_tasks(dealt, block, width, k), "best"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    # The limit on the rank also holds within each task, before rows are shuffled by query.
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
