"""Approximate nearest neighbours over balanced posting lists.

Fit, on a bounded sample: vectors are split in halves again and again along their main
direction, so that lists are of equal size; the means of the lists are the centroids. The
largest inner product becomes the smallest distance by one more coordinate that gives all
vectors the same length. A graph links each centroid with its nearest ones; every search for
centroids walks this graph in memory.

Index, over all rows: a vector goes to the list of its nearest centroid and, near a boundary,
to a few further ones whose distance is hardly larger. Lists are stored in blocks of bounded
size.

Search: a query visits the lists whose centroid is within a ratio of the nearest one's
distance, and the few nearest in any case. The ratio is the least one that finds enough
neighbours within the sample. The nearest list comes first, and its kth best bounds what the
blocks of the others hand on; nothing but the lists visited answers a query.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
do rows without an id. Of several vectors under one id the smallest counts. Only vectors of
equal length are compared. Equal scores: the smaller id first. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportarium.llm.common import staged
from reportarium.llm.exact_topk import usable

#: Rows the index is fitted on, at most: those with the smallest hash of their id.
SAMPLE = 16_384
#: Vectors of a list before replication, until there are as many lists as allowed.
LIST_ROWS = 800
LISTS = 4096
#: Lists one vector may be stored in, and how much farther a further centroid may be.
COPIES = 2
BOUNDARY = 1.15
#: Nearest lists that are visited whatever their distance.
VISITS = 4
#: Share of the true neighbours within the sample that the ratio must find.
FOUND = 0.965
#: Rows of a stored block, and queries scored with it at once.
BLOCK = 2048
NEIGHBOURS = 24
#: Vectors that a task places at once.
STEP = 512


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres."""
    d = (points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T
    return np.maximum(d, 0)


def balanced_centroids(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of equal halves of halves: two means, then a cut at the median between them."""
    if lists <= 1 or len(points) < 2 * max(1, lists):
        return points.mean(axis=0, keepdims=True) if lists <= 1 or len(points) < 2 else points
    left = lists // 2
    cut = len(points) * left // lists
    centred = points - points.mean(axis=0)
    axis = centred[np.argmax((centred**2).sum(axis=1))]
    for _ in range(8):
        axis = centred.T @ (centred @ axis)
        axis = axis / (np.linalg.norm(axis) or 1.0)
    order = np.argsort(centred @ axis, kind="stable")
    for _ in range(4):
        a, b = points[order[:cut]].mean(axis=0), points[order[cut:]].mean(axis=0)
        order = np.argsort(points @ (b - a), kind="stable")
    return np.concatenate(
        [
            balanced_centroids(points[order[:cut]], left),
            balanced_centroids(points[order[cut:]], lists - left),
        ]
    )


@dataclass
class Index:
    """What every task holds: at most ``LISTS`` centroids with their graph."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    reach: float
    ratio: float = 1.0

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Stored vectors with the coordinate that makes all of them equally long."""
        rest = np.maximum(self.reach**2 - (vectors**2).sum(axis=1), 0)
        return np.column_stack([vectors, np.sqrt(rest)])

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        """Queries in the same space: only their direction matters."""
        length = np.sqrt((queries**2).sum(axis=1, keepdims=True))
        return np.column_stack([queries / length * self.reach, np.zeros(len(queries))])

    def near(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids and their distances, by best-first walks along the graph.

        All points walk at once: each keeps its ``width`` best centroids so far and goes on
        from the best one it has not yet left, until there is none.
        """
        number, width = len(self.centroids), min(width, len(self.centroids))
        lengths = (self.centroids**2).sum(axis=1)
        own = (points**2).sum(axis=1)
        seen = np.zeros((len(points), number), dtype=bool)
        entries = np.unique(self.entries)
        seen[:, entries] = True
        beam = np.tile(entries, (len(points), 1))
        far = own[:, None] + lengths[entries] - 2 * points @ self.centroids[entries].T
        left = np.zeros(beam.shape, dtype=bool)
        walking = np.arange(len(points))
        while len(walking):
            open_far = np.where(left[walking], np.inf, far[walking])
            best = open_far.argmin(axis=1)
            going = np.isfinite(open_far[np.arange(len(walking)), best])
            walking, best = walking[going], best[going]
            if not len(walking):
                break
            left[walking, best] = True
            next_ones = self.graph[np.maximum(beam[walking, best], 0)]
            # A centroid that a row of the graph names twice is met once.
            order = np.argsort(next_ones, axis=1, kind="stable")
            ordered = np.take_along_axis(next_ones, order, 1)
            again = np.zeros(next_ones.shape, dtype=bool)
            np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], 1)
            fresh = ~seen[walking[:, None], next_ones] & ~again
            seen[walking[:, None], next_ones] = True
            new_far = (
                own[walking, None]
                + lengths[next_ones]
                - 2 * np.einsum("pd,pnd->pn", points[walking], self.centroids[next_ones])
            )
            new_far[~fresh] = np.inf
            all_far = np.concatenate([far[walking], new_far], axis=1)
            all_beam = np.concatenate([beam[walking], next_ones], axis=1)
            all_left = np.concatenate([left[walking], ~fresh], axis=1)
            keep = np.argsort(all_far, axis=1, kind="stable")[:, :width]
            if far.shape[1] < keep.shape[1]:  # beams grow to their width once
                more = keep.shape[1] - far.shape[1]
                far = np.pad(far, ((0, 0), (0, more)), constant_values=np.inf)
                beam = np.pad(beam, ((0, 0), (0, more)), constant_values=-1)
                left = np.pad(left, ((0, 0), (0, more)), constant_values=True)
            far[walking] = _padded(np.take_along_axis(all_far, keep, 1), far.shape[1], np.inf)
            beam[walking] = _padded(np.take_along_axis(all_beam, keep, 1), far.shape[1], -1)
            kept_left = np.take_along_axis(all_left, keep, 1)
            left[walking] = _padded(kept_left, far.shape[1], True) | ~np.isfinite(far[walking])
        order = np.argsort(far, axis=1, kind="stable")[:, :width]
        return np.take_along_axis(beam, order, 1), np.sqrt(
            np.maximum(np.take_along_axis(far, order, 1), 0)
        )

    def lists_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the lists that store them: the nearest, and others across a boundary."""
        points = self.lifted(vectors)
        lists, far = self.near(points, 4 * COPIES)
        take = np.zeros(lists.shape, dtype=bool)
        take[:, 0] = True
        for j in range(1, lists.shape[1]):
            ok = np.isfinite(far[:, j]) & (far[:, j] <= BOUNDARY * far[:, 0]) & (take.sum(1) < COPIES)
            take[:, j] = ok
        rows, places = np.nonzero(take)
        return rows, lists[rows, places]

    def lists_for(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries and the lists they visit: all within the ratio, however many."""
        points, width = self.aimed(queries), 32
        lists, far = self.near(points, width)
        while width < len(self.centroids) and (far[:, -1] <= self.ratio * far[:, 0]).any():
            width *= 2
            lists, far = self.near(points, width)
        take = far <= self.ratio * far[:, :1] + 1e-12
        take[:, :VISITS] = True
        rows, places = np.nonzero(take & np.isfinite(far))
        return rows, lists[rows, places]


def _padded(values: np.ndarray, width: int, fill) -> np.ndarray:
    return np.pad(values, ((0, 0), (0, width - values.shape[1])), constant_values=fill)


def fit(sample: np.ndarray, total: int, reach: float, k: int) -> Index:
    """Centroids, graph and ratio from a bounded sample of all ``total`` vectors."""
    lists = max(1, min(LISTS, -(-total // LIST_ROWS), len(sample) // 4 or 1))
    index = Index(np.zeros((0, 0)), np.zeros((0, 0), int), np.zeros(0, int), reach)
    points = index.lifted(sample)
    index.centroids = balanced_centroids(points, lists)
    number = len(index.centroids)
    links = []
    for start in range(0, number, 512):
        far = _squares(index.centroids[start : start + 512], index.centroids)
        near = np.argsort(far, axis=1, kind="stable")[:, : NEIGHBOURS + 1]
        links.append(near)
    # Beside its nearest ones, each centroid is linked with the next in the order of splits,
    # a ring that keeps the graph in one piece.
    ring = np.column_stack([(np.arange(number) + 1) % number, (np.arange(number) - 1) % number])
    index.graph = np.column_stack([np.concatenate(links), ring])
    index.entries = np.unique(np.linspace(0, number - 1, min(number, 16)).astype(int))
    index.ratio = _ratio(index, sample, total, k)
    return index


def _ratio(index: Index, sample: np.ndarray, total: int, k: int) -> float:
    """Least distance ratio whose lists hold enough of the sample's true neighbours."""
    queries = np.arange(min(len(sample), 256))
    wanted = max(1, round(k * len(sample) / total))
    if len(sample) <= wanted + 1 or len(index.centroids) < 2:
        return np.inf
    inner = sample[queries] @ sample.T
    inner[np.arange(len(queries)), queries] = -np.inf
    true = np.argsort(-inner, axis=1, kind="stable")[:, :wanted]
    rows, lists = index.lists_of(sample)
    stored = np.zeros((len(sample), len(index.centroids)), dtype=bool)
    stored[rows, lists] = True
    far = np.sqrt(_squares(index.aimed(sample[queries]), index.centroids))
    share = far / np.maximum(far.min(axis=1, keepdims=True), 1e-12)
    # Ratio at which each true neighbour is first met.
    met = np.where(stored[true], share[:, None, :], np.inf).min(axis=2).ravel()
    return float(np.quantile(met, FOUND, method="higher"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in the order of components."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of one block for each query, none worse than its bound; ties by id."""
    if not len(queries) or not len(rows):
        return pd.DataFrame({"query_id": [], "id": [], "score": []})
    q, r = _matrix(queries["v"]), _matrix(rows["v"])
    query_ids, ids = queries["id"].to_numpy(), rows["id"].to_numpy()
    rough = q @ r.T
    rough[query_ids[:, None] == ids] = -np.inf
    place = min(k, len(ids)) - 1
    kth = -np.partition(-rough, place, axis=1)[:, place]
    # Sums in another order differ by rounding: whatever may reach the kth is summed again.
    slack = 1e-12 * np.sqrt((q**2).sum(axis=1) * (r**2).sum(axis=1).max()) * q.shape[1]
    bound = queries["bound"].to_numpy()
    least = np.maximum(np.maximum(kth, bound) - slack, -1.7e308)
    a, b = np.nonzero(rough >= least[:, None])
    score = _products(q[a], r[b])
    found = pd.DataFrame({"query_id": query_ids[a], "id": ids[b], "score": score})[score >= bound[a]]
    found = found.sort_values(["query_id", "score", "id"], ascending=[True, False, True])
    return found.groupby("query_id").head(k)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, ``key``, score: about the k largest inner products with other rows.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    nonzero = F.exists("v", lambda x: x != 0)
    rows = staged(
        usable(vectors, key, vector).filter(nonzero).withColumn("length", F.size("v")), "vectors"
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy("length").agg(
        F.count(F.lit(1)).alias("rows"), F.max(square).alias("square")
    )
    results = [
        _search(rows.filter(F.col("length") == s["length"]), is_query, s["rows"], s["square"] ** 0.5, k)
        for s in sorted(sizes.collect())  # a row per vector length
    ]
    if not results:
        empty = "query_id long, rank int, id long, score double"
        return spark.createDataFrame([], empty).withColumnRenamed("id", key)
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (
        found.withColumn("rank", place)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(key), "score")
    )


def _search(rows: DataFrame, is_query: Column, total: int, reach: float, k: int) -> DataFrame:
    spark = rows.sparkSession
    sample = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    index = spark.sparkContext.broadcast(fit(_matrix(sample["v"]), total, reach, k))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stored vectors, once per list that holds them."""
        for batch in batches:
            for start in range(0, len(batch), STEP):
                part = batch.slice(start, STEP)
                values = part.column("v").flatten().to_numpy().astype(np.float64)
                at, lists = index.value.lists_of(values.reshape(len(part), -1))
                part = part.take(pa.array(at))
                columns = [part.column("id"), part.column("v"), pa.array(lists, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "v", "list"])

    def visiting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries, once per list they visit; the nearest one is marked."""
        for batch in batches:
            for start in range(0, len(batch), STEP):
                part = batch.iloc[start : start + STEP]
                at, lists = index.value.lists_for(_matrix(part["v"]))
                closest = np.zeros(len(at), dtype=bool)
                closest[np.unique(at, return_index=True)[1]] = True  # lists come nearest first
                yield part.iloc[at].assign(list=lists, nearest=closest)

    kind = rows.schema["v"].dataType.simpleString()
    narrow = rows.select("id", "v")
    queries = narrow.filter(is_query)
    stored = staged(narrow.mapInArrow(listed, f"id long, v {kind}, list long"), "postings")
    visits = staged(
        queries.mapInPandas(visiting, f"id long, v {kind}, list long, nearest boolean"), "visits"
    )

    def blocks(table: DataFrame, name: str) -> DataFrame:
        """How many blocks each list has: a row per list."""
        return table.groupBy("list").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name)
        )

    def dealt(table: DataFrame, grid: DataFrame, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        """Each row in its own block, once for each block of the other side."""
        return (
            table.join(grid, "list")
            .withColumn(names[0], F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
            .withColumn(names[1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("row_blocks", "query_blocks")
        )

    def scored(own: DataFrame) -> DataFrame:
        """Each block of the stored lists with the queries (id, v, bound, list) that visit it."""
        grid = blocks(stored, "row_blocks").join(blocks(own, "query_blocks"), "list")
        key = ["list", "row_block", "query_block"]
        left = dealt(stored, grid, "row_blocks", "query_blocks", ("row_block", "query_block"))
        right = dealt(own, grid, "query_blocks", "row_blocks", ("query_block", "row_block"))
        return (
            left.groupBy(*key)
            .cogroup(right.groupBy(*key))
            .applyInPandas(lambda r, q: _best(q, r, k), "query_id long, id long, score double")
        )

    # The kth best of its nearest list bounds what a query takes from the others.
    unbounded = F.lit(float("-inf"))
    near = visits.filter("nearest").drop("nearest").withColumn("bound", unbounded)
    first = staged(scored(near), "first")
    last = first.groupBy("query_id").agg(
        F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)).alias("__bound")
    )
    others = visits.filter("not nearest").drop("nearest")
    others = others.join(last, others.id == last.query_id, "left").select(
        "id", "v", "list", F.coalesce("__bound", unbounded).alias("bound")
    )
    best = first.unionByName(scored(others))
    return best.distinct()  # a row is stored in several lists
