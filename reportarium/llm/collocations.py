"""Phrases of several words that occur together more often than their parts suggest.

Direct-address tiling. Words are ranked by frequency; the ranks of two neighbours address a
cell of a tile of 256 by 256 cells. Inside a task, tiles that many pairs fall into are counted
by one dense ``bincount`` and kept for the whole task, all others as sorted coordinates. Pairs that
are frequent are ranked again and play the words of the next round: two frequent phrases of
m words that overlap in m - 1 form one of m + 1. A phrase can only be frequent if both are, so
each round counts no more than the last one left over.

The first ``HEAD`` ranks are sent to all tasks. What is frequent beyond them is known by its
hash (62 bits), let through by a bitmap of fixed size and counted as coordinates. Counts are
exact: whatever the bitmap lets through too much falls short of the least count.

Texts that are null have no words; a language that is null is ``und``. Repeated rows count as
often as they occur; ids and other columns are not looked at. Long texts are one row of word
ids each. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from reportarium.llm.common import staged, steps
from reportarium.llm.membership import Bitmap, bitmap
from reportarium.llm.shingles import mix, word_hashes
from reportarium.llm.words import cut, marked

#: Bytes that end a piece: . , ; : ! ? and line ends. Words lie between these, blanks and tabs.
BREAKS = marked(*map(ord, ".,;:!?"), (0x0A, 0x0D))
BETWEEN = BREAKS | marked(0x20, 0x09)
#: Ranks known to every task, and ranks to a side of a tile, as powers of two.
HEAD_BITS, SIDE_BITS = 16, 8
HEAD = 1 << HEAD_BITS
CELLS = 1 << (2 * SIDE_BITS)
#: Pairs of one step that make a tile dense, and dense tiles held by a task.
DENSE, TILES = CELLS // 16, 192
#: Word ids handled at once.
STEP = 1 << 20
NONE = -1
_TAIL = np.int64(1 << 62)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


class Known:
    """Frequent items of one round: ranks of the most frequent, a bitmap for the others."""

    def __init__(self, keys: np.ndarray, others: Bitmap | None):
        """``keys`` are the hashes by descending frequency."""
        self.ranks = np.argsort(keys)
        self.keys, self.others = keys[self.ranks], others

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Rank, or marked hash, or ``NONE`` for what is not frequent."""
        ids = np.full(len(keys), NONE, dtype=np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            ranked = self.keys[at] == keys
            ids[ranked] = self.ranks[at[ranked]]
        if self.others is not None:
            tail = (ids == NONE) & self.others.may_hold(keys)
            ids[tail] = (keys[tail] >> np.uint64(2)).astype(np.int64) | _TAIL
        return ids


def word_keys(words: pa.LargeStringArray, lang: str) -> np.ndarray:
    """Hashes of the words of one language."""
    _, bounds, data = words.buffers()
    ends = np.frombuffer(bounds, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    own = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    salt = hashlib.blake2b(lang.encode(), digest_size=8).digest()
    return mix(word_hashes(own, ends[:-1], ends[1:]) ^ np.frombuffer(salt, dtype=np.uint64))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left.view(np.uint64) * _LEFT + np.uint64(1)) + right.view(np.uint64) * _RIGHT)


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Languages and their texts, step by step."""
    for batch in steps(batches):
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            yield lang, batch.column("text").filter(pc.equal(langs, lang))


def _words(documents: DataFrame, least: int) -> DataFrame:
    """lang, word, key and f of the frequent words; a row without word counts all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _by_language(batches):
            words, _, _ = cut(texts, BETWEEN)
            found = pc.value_counts(words)
            distinct = found.field("values").cast(pa.large_string())
            if not len(distinct):
                continue
            keys = word_keys(distinct, lang).view(np.int64)
            columns = [
                pa.array([lang] * (len(distinct) + 1), pa.string()),
                pa.concat_arrays([distinct.cast(pa.string()), pa.nulls(1, pa.string())]),
                pa.array(np.append(keys, 0)),
                pa.array(np.append(found.field("counts").to_numpy(), len(words))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "key", "f"])

    counts = documents.mapInArrow(count, "lang string, word string, key long, f long")
    counts = counts.groupBy("lang", "word").agg(F.max("key").alias("key"), F.sum("f").alias("f"))
    return staged(counts.filter(F.col("word").isNull() | (F.col("f") >= least)), "words")


def _known(items: DataFrame) -> Known:
    """What tasks need to know of frequent items (key, f)."""
    number = items.count()
    first = items.orderBy(F.desc("f"), "key").limit(HEAD).select("key").toArrow()
    keys = first.column("key").to_numpy().view(np.uint64)
    return Known(keys, bitmap(items, "key", number) if number > len(keys) else None)


def _with_ids(items: DataFrame, known: Known) -> DataFrame:
    """Items with the ids that tasks give them."""
    shared = items.sparkSession.sparkContext.broadcast(known)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = shared.value.ids(batch.column("key").to_numpy().view(np.uint64))
            yield batch.append_column("id", pa.array(ids))

    return items.mapInArrow(name, StructType([*items.schema.fields, StructField("id", LongType())]))


def _lists(ids: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """Lists of ids, with nothing but one ``NONE`` between runs of frequent ones."""
    keep = ids != NONE
    keep[1:] |= ids[:-1] != NONE
    ends = np.concatenate([[0], np.cumsum(keep)])[offsets]
    lists = pa.LargeListArray.from_arrays(ends, pa.array(ids[keep]))
    lists = lists.filter(pa.array(np.diff(ends) > 1)).cast(pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([lists], names=["ids"])


def _word_ids(documents: DataFrame, known: Known) -> DataFrame:
    """A list of word ids for each text, with ``NONE`` for rare words and between pieces."""
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _by_language(batches):
            words, first, fresh = cut(texts, BETWEEN, BREAKS)
            coded = words.dictionary_encode()
            ids = shared.value.ids(word_keys(coded.dictionary.cast(pa.large_string()), lang))
            ids = ids[coded.indices.to_numpy()]
            # A place of its own before each word that starts a piece.
            at = np.arange(len(ids)) + np.cumsum(fresh)
            spread = np.full(len(ids) + int(fresh.sum()), NONE, dtype=np.int64)
            spread[at] = ids
            before = np.concatenate([[0], np.cumsum(fresh)])
            yield _lists(spread, first + before[first])

    return staged(documents.mapInArrow(encode, "ids array<long>"), "ids")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of some lists and where each list starts and ends, some million ids at a time."""
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy()
        row = 0
        while row < len(lists):
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP, side="right")) - 1)
            yield values[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
            row = stop


def _neighbours(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places whose item and the next one are frequent and in one list."""
    both = ids != NONE
    both[:-1] &= both[1:]
    both[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(both)


class Tiles:
    """Counts of pairs: dense tiles for the whole task, coordinates step by step."""

    def __init__(self):
        self.dense: dict[int, np.ndarray] = {}

    def add(self, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
        head = (left < HEAD) & (right < HEAD)
        x, y = left[head], right[head]
        tile = (x >> SIDE_BITS << (HEAD_BITS - SIDE_BITS)) | (y >> SIDE_BITS)
        crowded = np.bincount(tile, minlength=CELLS) >= DENSE
        for at in self.dense:
            crowded[at] = True
        within = crowded[tile]
        order = np.flatnonzero(within)[np.argsort(tile[within], kind="stable")]
        side = (1 << SIDE_BITS) - 1
        cell = ((x[order] & side) << SIDE_BITS) | (y[order] & side)
        tiles, starts = np.unique(tile[order], return_index=True)
        for at, a, b in zip(tiles.tolist(), starts, [*starts[1:], len(order)]):
            counts = np.bincount(cell[a:b], minlength=CELLS).astype(np.int32)
            self.dense[at] = self.dense[at] + counts if at in self.dense else counts
        codes, rows = np.unique((x[~within] << HEAD_BITS) | y[~within], return_counts=True)
        yield _pairs(codes >> HEAD_BITS, codes & (HEAD - 1), rows)
        x, y = left[~head], right[~head]
        if len(x):
            order = np.lexsort((y, x))
            x, y = x[order], y[order]
            new = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
            yield _pairs(x[new], y[new], np.diff(np.append(new, len(x))))
        if len(self.dense) > TILES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        side = (1 << SIDE_BITS) - 1
        for at, counts in self.dense.items():
            cells = np.flatnonzero(counts)
            x = (at >> (HEAD_BITS - SIDE_BITS) << SIDE_BITS) | (cells >> SIDE_BITS)
            y = ((at & side) << SIDE_BITS) | (cells & side)
            yield _pairs(x, y, counts[cells])
        self.dense = {}


def _pairs(left: np.ndarray, right: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(c.astype(np.int64)) for c in (left, right, rows)]
    return pa.RecordBatch.from_arrays(columns, names=["left", "right", "f"])


def _frequent_pairs(lists: DataFrame, least: int) -> DataFrame:
    """left, right, f and key of neighbours that occur often enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = Tiles()
        for ids, offsets in _parts(batches):
            at = _neighbours(ids, offsets)
            yield from tiles.add(ids[at], ids[at + 1])
        yield from tiles.rest()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pair_keys(batch.column("left").to_numpy(), batch.column("right").to_numpy())
            columns = [*batch.columns, pa.array(keys.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["left", "right", "f", "key"])

    pairs = "left long, right long, f long"
    counts = lists.mapInArrow(count, pairs).groupBy("left", "right").agg(F.sum("f").alias("f"))
    return staged(
        counts.filter(F.col("f") >= least).mapInArrow(hashed, pairs + ", key long"), "pairs"
    )


def _pair_ids(lists: DataFrame, known: Known) -> DataFrame:
    """The lists of the next round: at each place the id of the pair that starts there."""
    shared = lists.sparkSession.sparkContext.broadcast(known)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, offsets in _parts(batches):
            at = _neighbours(ids, offsets)
            paired = np.full(len(ids), NONE, dtype=np.int64)
            paired[at] = shared.value.ids(pair_keys(ids[at], ids[at + 1]))
            yield _lists(paired, offsets)

    return staged(lists.mapInArrow(encode, "ids array<long>"), "ids")


def frequent_phrases(documents: DataFrame, least: int, longest: int) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, n), and for each length the frequent phrases.

    A phrase has lang, id, f, phrase, its last word, the ids of its first and its last words
    but one (left, right), and the counts of its beginnings and of its ends, longest cut last.
    """
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counted = _words(texts, least)
    totals = counted.filter(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    words = counted.filter(F.col("word").isNotNull())
    none = F.array().cast("array<long>")
    phrases = words.select("lang", "key", "f", F.col("word").alias("phrase"), F.col("word").alias("last"))
    phrases = phrases.withColumns({"left": F.lit(None).cast("long"), "right": F.lit(None).cast("long")})
    phrases = phrases.withColumns({"heads": none, "tails": none})
    known = _known(phrases)
    rounds = [staged(_with_ids(phrases, known), "phrases")]
    lists = _word_ids(texts, known)
    for length in range(2, longest + 1):
        pairs = _frequent_pairs(lists, least)
        own = [F.col(c).alias(f"__{c}") for c in ("id", "last", "f", "tails")]
        left = rounds[-1].select("lang", "phrase", "heads", F.col("id").alias("left"), F.col("f").alias("__head"))
        phrases = (
            pairs.join(left, "left")
            .join(rounds[-1].select(*own), F.col("right") == F.col("__id"))
            .select(
                "lang",
                "key",
                "f",
                F.concat_ws(" ", "phrase", "__last").alias("phrase"),
                F.col("__last").alias("last"),
                "left",
                "right",
                F.array_append("heads", F.col("__head")).alias("heads"),
                F.array_prepend("__tails", F.col("__f")).alias("tails"),
            )
        )
        known = _known(pairs)
        rounds.append(staged(_with_ids(phrases, known), "phrases"))
        if length < longest:
            lists = _pair_ids(lists, known)
    return totals, rounds


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n and score, from a, n, heads and tails; products as decimals."""
    thousand = F.lit(1000).cast("decimal(4,0)") * F.col("n").cast("decimal(18,0)")
    above = F.col("a").cast("decimal(15,0)") * thousand.cast("decimal(22,0)")
    worst = F.expr(
        "array_min(transform(arrays_zip(heads, tails), (c, i) -> struct(above div cast("
        "cast(c.heads AS decimal(18,0)) * cast(c.tails AS decimal(18,0)) AS decimal(38,0)"
        ") AS score, i AS k, c.heads AS l, c.tails AS r)))"
    )
    found = phrases.withColumn("above", above.cast("decimal(38,0)")).withColumn("cut", worst)
    return found.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(documents: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the highest-scoring phrases of each language.

    A phrase scores floor(1000 * a * n / (l * r)) by its worst cut into two parts, which occur
    l and r times. One inside a longer candidate of the same count is left out.
    """
    totals, rounds = frequent_phrases(documents, least, longest)
    kept = None
    for at, phrases in enumerate(rounds[1:], 1):
        if at + 1 < len(rounds):
            # Inside a longer one of equal count: then inside one that is a word longer.
            more = rounds[at + 1]
            begun = more.filter(F.col("f") == F.element_at("heads", -1)).select(F.col("left").alias("id"))
            ended = more.filter(F.col("f") == F.element_at("tails", 1)).select(F.col("right").alias("id"))
            phrases = phrases.join(begun.unionByName(ended).distinct(), "id", "left_anti")
        columns = phrases.select("lang", "phrase", F.col("f").alias("a"), "heads", "tails")
        kept = columns if kept is None else kept.unionByName(columns)
    found = scored(kept.join(totals, "lang"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
