"""Exact search for the highest integer inner products, by distributed histogram selection.

Vector components x become floor(scale * x). Queries go in blocks of bounded size against
all rows. Every task scores its rows and only counts scores into equal bins per query; the
summed histogram tells in which bin the kth highest score lies, and the next round spreads
that bin over new bins, until each bin is one score. With the exact kth scores known, a last
pass keeps higher scores, and of equal ones the smallest ids that still have a place. What
leaves a task is bounded by bins or by k per query, whatever the data.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do
rows without an id. Of several vectors under one id the smallest counts. Only vectors of equal
length are compared. Scores beyond 64 bits end at the ends of that range.
Empty table, or a query without candidates: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportarium.llm.common import staged

#: Query vectors of one block; what is broadcast is at most this many vectors.
BLOCK = 2048
BINS = 1024
#: Rows scored at once inside a task.
STEP = 1024
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v: one finite, non-empty vector per id."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return (
        vectors.filter(F.col(key).isNotNull() & (F.size(vector) > 0) & finite)
        .groupBy(F.col(key).cast("long").alias("id"))
        .agg(F.min(vector).alias("v"))
    )


def integers(rows: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of equally long vectors; floats while exact, Python ints beyond."""
    values = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = values.reshape(len(rows), -1)
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0) < 2**53:
        return scaled
    return np.array([[_floor(x, scale) for x in row] for row in values.tolist()], dtype=object)


def _floor(x: float, scale: int) -> int:
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers."""
    if queries.dtype != object and rows.dtype != object:
        most = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * rows.shape[1]
        if most < 2**53:
            return (queries @ rows.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m.tolist()] for m in (queries, rows)]
    return np.array(
        [
            [min(max(sum(a * b for a, b in zip(q, r)), LOW), HIGH) for r in whole[1]]
            for q in whole[0]
        ],
        dtype=np.int64,
    ).reshape(len(queries), len(rows))


class Block:
    """Queries of one block with, for each, the score range that still holds its kth value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors = ids, vectors
        order = np.argsort(ids)
        self.order, self.sorted = order, ids[order]
        self.low = np.zeros(len(ids), dtype=object)
        self.width = 1  # of a bin, for all queries
        self.need = np.full(len(ids), k, dtype=np.int64)

    def scored(
        self, batch: pa.RecordBatch, scale: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids and scores of rows, step by step, and which (query, row) pairs count."""
        for start in range(0, len(batch), STEP):
            part = batch.slice(start, STEP)
            ids = part.column("id").to_numpy()
            values = scores(self.vectors, integers(part.column("v"), scale))
            counts = np.ones(values.shape, dtype=bool)
            at = np.minimum(np.searchsorted(self.sorted, ids), len(self.ids) - 1)
            own = self.sorted[at] == ids
            counts[self.order[at[own]], np.flatnonzero(own)] = False
            yield ids, values, counts

    def bins(self, values: np.ndarray) -> np.ndarray:
        """Bin of each score in its query's range; outside it, negative or beyond the bins."""
        reach = max([self.width * BINS, *map(abs, self.low.tolist())])
        if reach < HIGH >> 2:
            near = np.clip(values, -(HIGH >> 1), HIGH >> 1) - self.low.astype(np.int64)[:, None]
            return np.clip(near // self.width, -1, BINS)
        rows = zip(self.low.tolist(), values.tolist(), strict=True)
        places = [[min(max((x - low) // self.width, -1), BINS) for x in row] for low, row in rows]
        return np.array(places, dtype=np.int64).reshape(values.shape)


def _histogram(rows: DataFrame, block: Block, scale: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(len(own.ids) * BINS, dtype=np.int64)
        for batch in batches:
            for _, values, counts in own.scored(batch, scale):
                bins = own.bins(values)
                counts &= (bins >= 0) & (bins < BINS)
                flat = bins + np.arange(len(own.ids))[:, None] * BINS
                total += np.bincount(flat[counts], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at // BINS), pa.array(at % BINS), pa.array(total[at])],
            names=["query", "bin", "rows"],
        )

    found = rows.mapInArrow(count, "query long, bin long, rows long")
    return found.groupBy("query", "bin").agg(F.sum("rows").alias("rows"))


def _refine(rows: DataFrame, block: Block, scale: int, k: int) -> None:
    """Narrow each query's range to the bin of its kth score, until a bin is one score."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = rows.agg(F.max(square)).first()[0] ** 0.5 * scale + block.vectors.shape[1] + 1
    lengths = (block.vectors.astype(np.float64) ** 2).sum(axis=1) ** 0.5
    # No score is beyond the product of the lengths, nor beyond 64 bits.
    bound = int(min(float(lengths.max(initial=0)) * longest + 1, float(-LOW)))
    block.low = np.full(len(block.ids), -bound, dtype=object)
    block.width = 1
    while block.width * BINS <= 2 * bound:
        block.width *= BINS
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    while True:
        sums = _histogram(rows, block, scale).withColumn(
            "above", F.sum("rows").over(down) - F.col("rows")
        )
        wanted = F.element_at(F.lit(block.need.tolist()), (F.col("query") + 1).cast("int"))
        kth = sums.filter((F.col("above") < wanted) & (F.col("above") + F.col("rows") >= wanted))
        found = {r["query"]: r for r in kth.drop("rows").collect()}  # a row per query
        for q in range(len(block.ids)):
            if q in found:
                block.low[q] += found[q]["bin"] * block.width
                block.need[q] -= found[q]["above"]
            else:  # fewer candidates than places: all of them stay
                block.low[q], block.need[q] = LOW - 1, k
        if block.width == 1:
            return
        block.width //= BINS


def _selected(rows: DataFrame, block: Block, scale: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        bounded = own.low >= LOW
        kth = np.where(bounded, own.low, LOW).astype(np.int64)[:, None]
        ties: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(own.ids)
        for batch in batches:
            for ids, values, counts in own.scored(batch, scale):
                higher = counts & ((values > kth) | ~bounded[:, None])
                q, r = np.nonzero(higher)
                yield _rows(own.ids[q], ids[r], values[q, r])
                equal = counts & (values == kth) & bounded[:, None]
                for q in np.flatnonzero(equal.any(axis=1)):
                    ties[q] = np.sort(np.concatenate([ties[q], ids[equal[q]]]))[: own.need[q]]
        for q, tied in enumerate(ties):
            if len(tied):
                yield _rows(np.full(len(tied), own.ids[q]), tied, np.full(len(tied), kth[q, 0]))

    def _rows(query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(x.astype(np.int64)) for x in (query, ids, score)]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "id", "score"])

    return rows.mapInArrow(select, "query_id long, id long, score long")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, ``key``, score: the k highest of all other rows, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``.
    """
    rows = staged(usable(vectors, key, vector).withColumn("length", F.size("v")), "vectors")
    queries = rows.filter(is_query)
    sizes = queries.groupBy("length").count().collect()  # a row per vector length
    results = []
    for length, number in sorted((r["length"], r["count"]) for r in sizes):
        alike = rows.filter(F.col("length") == length).select("id", "v")
        blocks = -(-number // block)
        for part in range(blocks):
            # A block's rows are at most about ``block``: ids are dealt evenly by their hash.
            own = queries.filter(
                (F.col("length") == length)
                & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == part)
            ).select("id", "v")
            taken = own.toArrow().combine_chunks()
            if not len(taken):
                continue
            ids = taken.column("id").to_numpy()
            chosen = Block(ids, integers(taken.column("v").combine_chunks(), scale), k)
            _refine(alike, chosen, scale, k)
            results.append(_selected(alike, chosen, scale))
    if not results:
        empty = "query_id long, rank int, id long, score long"
        return vectors.sparkSession.createDataFrame([], empty).withColumnRenamed("id", key)
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (
        found.withColumn("rank", place)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(key), "score")
    )
