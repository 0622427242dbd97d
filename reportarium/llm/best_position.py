"""Ranked lexical search by the Best Position Algorithm over impact lists.

A term's impact in a document is an integer, so scores are exact sums. One pass counts the
documents, their terms, and how many documents hold each query term. In a second pass every
task turns its documents, some at a time, into impact lists of the query terms (highest impact
first) and searches them for all queries: it reads the lists in parallel, looks each new document
up in all lists of the query (direct access), and marks every position met on the way. A
list's best position is the end of its marked beginning; the impacts there add up to a bound on
all documents not yet seen, lower than the one of the last positions read. The search stops
where the bound is strictly below the kth score found by the task so far, so no tie is lost.
What leaves a task is k rows per query; the documents themselves are never shuffled.

Terms are runs of ASCII letters, digits and all bytes beyond ASCII, A-Z lower-cased. A null text
has no terms. Documents without an id count in the statistics, but are not ranked; rows that
repeat an id are ranked each for itself. Rows that repeat a query's id are one query with the
terms of all; queries without an id or terms find nothing. Long texts are read whole. Empty
tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportarium.llm.common import steps
from reportarium.llm.words import cut, marked

BETWEEN = marked((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: Bytes of query texts searched in one pass; what tasks are sent holds no more.
BLOCK = 8 << 20
#: Entries of the impact lists that a task holds at once.
ENTRIES = 1 << 20
#: Positions read of each list at first; every further reading doubles them.
READ = 8


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Queries:
    """Queries of one pass: their ids, and the distinct terms with the places each one uses."""

    ids: np.ndarray
    terms: pa.LargeStringArray
    uses: list[np.ndarray]
    weights: np.ndarray | None = None
    documents: int = 0
    words: int = 0


def _queries(ids: np.ndarray, texts: pa.Array) -> Queries:
    words, first, _ = cut(texts, BETWEEN)
    coded = words.dictionary_encode()
    places = coded.indices.to_numpy()
    distinct, of = np.unique(ids, return_inverse=True)
    uses: list[list[np.ndarray]] = [[] for _ in distinct]
    for row, query in enumerate(of.tolist()):
        uses[query].append(places[first[row] : first[row + 1]])
    return Queries(
        distinct, coded.dictionary.cast(pa.large_string()), [np.unique(np.concatenate(u)) for u in uses]
    )


def _counts(texts: pa.Array, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each document; and of query terms: document, term, number of times."""
    words, first, _ = cut(texts, BETWEEN)
    sizes = np.diff(first)
    places = pc.index_in(words, value_set=queries.terms)
    at = np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False))
    terms = places.drop_null().to_numpy().astype(np.int64)
    documents = np.repeat(np.arange(len(sizes)), sizes)[at]
    codes, times = np.unique(documents * len(queries.terms) + terms, return_counts=True)
    return sizes, codes // max(len(queries.terms), 1), codes % max(len(queries.terms), 1), times


def _statistics(documents: DataFrame, queries: Queries) -> None:
    """Fill in the number of documents, of all terms, and the weights."""
    shared = documents.sparkSession.sparkContext.broadcast(queries)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        holding = np.zeros(len(own.terms) + 2, dtype=np.int64)
        for batch in steps(batches):
            sizes, _, terms, _ = _counts(batch.column("text"), own)
            holding[:-2] += np.bincount(terms, minlength=len(own.terms))
            holding[-2:] += (int((sizes > 0).sum()), int(sizes.sum()))
        at = np.flatnonzero(holding)
        columns = [pa.array(at), pa.array(holding[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "number"])

    sums = documents.select("text").mapInArrow(count, "place long, number long")
    found = sums.groupBy("place").agg(F.sum("number").alias("number")).toArrow()
    holding = np.zeros(len(queries.terms) + 2, dtype=np.int64)
    holding[found.column("place").to_numpy()] = found.column("number").to_numpy()
    queries.documents, queries.words = int(holding[-2]), int(holding[-1])
    weights = [weight(queries.documents, n) for n in holding[:-2].tolist()]
    queries.weights = np.array(weights, dtype=np.int64)


def impacts(times: np.ndarray, sizes: np.ndarray, weights: np.ndarray, queries: Queries) -> np.ndarray:
    """weight * (10**9 tf div (1000 tf + 8 m)), m = 10 + (90 n N) div L, in 64-bit integers."""
    length = 10 + 90 * sizes.astype(np.int64) * queries.documents // max(queries.words, 1)
    return weights * (10**9 * times.astype(np.int64) // (1000 * times + 8 * length))


class ImpactLists:
    """The lists of some documents: per term the documents by descending impact."""

    def __init__(self, ids: np.ndarray, documents: np.ndarray, terms: np.ndarray, impact: np.ndarray):
        """Entries are (document, term, impact), documents as places in ``ids``."""
        self.ids = ids
        order = np.lexsort((ids[documents], -impact, terms))
        self.document, self.impact = documents[order], impact[order]
        listed = terms[order]
        self.terms, self.start = np.unique(listed, return_index=True)
        self.end = np.append(self.start[1:], len(listed))
        # For direct access: where (term, document) is in the lists.
        codes = listed * len(ids) + self.document
        self.entry = np.argsort(codes)
        self.codes = codes[self.entry]
        self.accesses = 0

    def _entries(self, lists: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """Entries of the documents in the lists; -1 where a list does not hold one."""
        codes = self.terms[lists][:, None] * len(self.ids) + documents[None, :]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        self.accesses += codes.size
        return np.where(self.codes[at] == codes, self.entry[at], -1)

    def best(self, terms: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best documents, among them all that reach ``least``.

        What cannot reach ``least`` may be left out.
        """
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        lists = np.flatnonzero(np.isin(self.terms, terms, assume_unique=True))
        if not len(lists):
            return ids, scores
        start, size = self.start[lists], self.end[lists] - self.start[lists]
        offset = np.concatenate([[0], np.cumsum(size)])
        entries = np.arange(offset[-1]) + np.repeat(start - offset[:-1], size)
        marked_at = np.zeros(len(entries), dtype=bool)
        place = np.arange(len(entries))
        seen = np.zeros(len(self.ids), dtype=bool)
        read, more = 0, READ
        while True:
            within = np.arange(read, read + more)
            rows = (offset[:-1, None] + within)[within < size[:, None]]
            fresh = np.unique(self.document[entries[rows]])
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            found = self._entries(lists, fresh)
            held = found >= 0
            score = np.where(held, self.impact[found], 0).sum(axis=0)
            shift = np.broadcast_to((offset[:-1] - start)[:, None], found.shape)
            marked_at[(found + shift)[held]] = True
            ids = np.concatenate([ids, self.ids[fresh]])
            scores = np.concatenate([scores, score])
            first = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[first], scores[first]
            kth = max(least, int(scores[-1]) if len(scores) == k else 0)
            # The first position of each list that is not marked yet.
            unseen = np.where(marked_at, len(entries), place)
            unseen = np.minimum.reduceat(unseen, offset[:-1])
            open_list = unseen < offset[1:]
            last = np.where(unseen > offset[:-1], unseen - 1, unseen)[open_list]
            bound = int(self.impact[entries[last]].sum())
            read, more = read + more, 2 * more
            if bound < kth or not open_list.any():
                positive = scores > 0
                return ids[positive], scores[positive]


def _search(documents: DataFrame, queries: Queries, k: int) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none)] * len(own.ids)
        held: list[tuple[np.ndarray, ...]] = []

        def settle() -> None:
            shift = np.cumsum([0] + [len(h[0]) for h in held])
            ids = np.concatenate([h[0] for h in held])
            at = np.concatenate([h[1] + s for h, s in zip(held, shift)])
            lists = ImpactLists(ids, at, *(np.concatenate([h[i] for h in held]) for i in (2, 3)))
            for query, terms in enumerate(own.uses):
                before = best[query]
                least = int(before[1][-1]) if len(before[1]) == k else 0
                found = lists.best(terms, k, least)
                both = [np.concatenate(x) for x in zip(before, found)]
                first = np.lexsort((both[0], -both[1]))[:k]
                best[query] = (both[0][first], both[1][first])
            held.clear()

        for batch in steps(batches):
            sizes, rows, terms, times = _counts(batch.column("text"), own)
            impact = impacts(times, sizes[rows], own.weights[terms], own)
            named = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = pc.fill_null(batch.column("doc_id"), 0).cast(pa.int64()).to_numpy()
            useful = named[rows] & (impact > 0)
            # Only documents that are in a list.
            places, of = np.unique(rows[useful], return_inverse=True)
            if len(places):
                held.append((ids[places], of, terms[useful], impact[useful]))
            if sum(len(h[2]) for h in held) >= ENTRIES:
                settle()
        if held:
            settle()
        number = [len(ids) for ids, _ in best]
        if sum(number):
            columns = [np.repeat(own.ids, number), *map(np.concatenate, zip(*best))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], names=["item_id", "doc_id", "score"]
            )

    return documents.select("doc_id", "text").mapInArrow(
        search, "item_id long, doc_id long, score long"
    )


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, ties to the smaller id."""
    items = items.filter(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    spark = documents.sparkSession
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK)
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks):
        # Rows of one id go together; a block holds about BLOCK bytes.
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        texts = own.column("text").combine_chunks().cast(pa.large_string())
        if not len(texts):
            continue
        queries = _queries(own.column("item_id").to_numpy(), texts)
        _statistics(documents, queries)
        found = found.unionByName(_search(documents, queries, k))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
