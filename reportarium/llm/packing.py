"""Pack documents into sequences of a fixed size by the histogram of their lengths.

A document's ids are cut into pieces of the full size and one rest. The driver sees only how
many pieces have each length (at most ``size`` numbers): lengths are placed longest first,
each into the packs that are shortest so far, many packs of one pattern at a time. Pieces
then find their place by length and rank. The pieces of patterns that stay badly filled are
cut into powers of two, which fill sequences without padding.

Null text: the end id alone. Null or repeated document ids: every row is a document of its
own. Empty table: no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reportarium.llm.common import staged, steps
from reportarium.llm.tokens import word_ids

SIZE = 4096
END_ID = 2
#: A pattern filled to less than this share is cut anew.
FILLED = 0.97

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("number", T.LongType()),
        T.StructField("cuts_crc32", T.ArrayType(T.LongType())),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)


def powers(length: int) -> list[int]:
    """The powers of two that add up to a length, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def pieces(
    documents: DataFrame,
    vocabulary: str,
    size: int = SIZE,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents; ``number`` counts those of one length within a partition, and
    ``cuts_crc32`` has the checksums of the piece cut into powers of two."""
    schema = T.StructType([f for f in PIECES if keep_ids or f.name != "ids"])
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_ids(vocabulary), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in steps(batches):
            bounds, ids = encoder.encode(batch.column("text"))
            rows = {name: [] for name in schema.names}
            for k, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[bounds[k] : bounds[k + 1]], end_id).astype("<u4")
                for start in range(0, len(own), size):
                    piece = own[start : start + size]
                    whole, stops = piece.tobytes(), np.cumsum(powers(len(piece))) * 4
                    rows["doc_id"].append(doc)
                    rows["start"].append(start)
                    rows["length"].append(len(piece))
                    rows["ids_crc32"].append(zlib.crc32(whole))
                    rows["doc_tokens"].append(len(own))
                    rows["part"].append(part)
                    rows["number"].append(seen[len(piece)])
                    rows["cuts_crc32"].append(
                        [zlib.crc32(whole[a:b]) for a, b in zip([0, *stops], stops)]
                    )
                    if keep_ids:
                        rows["ids"].append(piece.astype(np.int32))
                    seen[len(piece)] += 1
            yield pa.RecordBatch.from_pydict(rows, schema=arrow)

    return documents.select("doc_id", "text").mapInArrow(cut, schema)


@dataclass
class Layout:
    """Where pieces go. ``slots``: by length, (first rank, first sequence, offset); from rank
    ``anew`` on, pieces are cut into powers of two: ``full`` more sequences, then those that
    start at ``tail`` of all the cuts laid end to end."""

    size: int
    slots: dict[int, list[tuple[int, int, int]]]
    anew: dict[int, int]
    firsts: dict[tuple[int, int], int]
    sequences: int
    full: int
    tail: list[int]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slots by one ascending key of length and rank."""
        rows = sorted(
            (length * RANKS + rank, sequence, offset)
            for length, slots in self.slots.items()
            for rank, sequence, offset in slots
        )
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()

    def cuts(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """Start within the piece, length, sequence and offset of each cut."""
        out, start = [], 0
        for power in powers(length):
            at = self.firsts[power, length] + (rank - self.anew[length]) * power
            sequence, offset = divmod(at, self.size)
            if sequence >= self.full:
                sequence = self.full + bisect_right(self.tail, at) - 1
                offset = at - self.tail[sequence - self.full]
            out.append((start, power, self.sequences + sequence, offset))
            start += power
        return out


#: More ranks than one length has.
RANKS = 1 << 50


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Packing patterns and their counts, shortest pack first over the histogram of lengths."""
    open_packs: dict[int, list[tuple[list[int], int]]] = defaultdict(list)  # by free room
    rooms: list[int] = []  # the keys of open_packs, ascending
    closed: list[tuple[list[int], int]] = []

    def put(pattern: list[int], count: int, room: int) -> None:
        if room == 0:
            closed.append((pattern, count))
            return
        if not open_packs[room]:
            rooms.insert(bisect_right(rooms, room), room)
        open_packs[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = rooms[-1] if rooms else 0
            if room < length:
                put([length], left, size - length)
                break
            pattern, count = open_packs[room].pop()
            if not open_packs[room]:
                rooms.pop()
            # As many pieces as bring the shortest packs level with the next ones.
            below = rooms[-1] if rooms else 0
            deep = max(1, min((room - below) // length, room // length, left // count))
            if count > left:
                put(pattern, count - left, room)
                count, deep = left, 1
            put(pattern + [length] * deep, count, room - length * deep)
            left -= count * deep
    return closed + [pack for room in rooms for pack in open_packs[room]]


def layout(histogram: dict[int, int], size: int = SIZE, filled: float = FILLED) -> Layout:
    """Give the ranks of each length their sequences and offsets, pattern by pattern.

    The last ranks of a length are those of badly filled patterns. Their cuts lie end to end,
    larger powers first, so that none crosses the end of a sequence; what remains after the
    last full sequence becomes sequences of powers of two.
    """
    good, bad = [], []
    for pattern, count in plan(histogram, size):
        (good if sum(pattern) >= filled * size else bad).append((pattern, count))
    slots, ranks, sequences = defaultdict(list), defaultdict(int), 0
    for pattern, count in good:
        offset = 0
        for length in pattern:
            slots[length].append((ranks[length], sequences, offset))
            ranks[length] += count
            offset += length
        sequences += count
    left = {n: histogram[n] - ranks[n] for pattern, _ in bad for n in pattern}
    firsts, total = {}, 0
    for bit in range(size.bit_length() - 1, -1, -1):
        for length in sorted(n for n in left if n >> bit & 1):
            firsts[1 << bit, length] = total
            total += left[length] << bit
    full, rest = divmod(total, size)
    tail = [full * size + sum(powers(rest)[:i]) for i in range(len(powers(rest)))]
    return Layout(size, slots, {n: ranks[n] for n in left}, firsts, sequences, full, tail)


def pack(
    documents: DataFrame,
    vocabulary: str,
    size: int = SIZE,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """Every piece with its sequence and offset: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and the ids themselves with ``keep_ids``. ``size`` is a power of two."""
    spark = documents.sparkSession
    table = staged(pieces(documents, vocabulary, size, end_id, keep_ids), "pieces")
    counts = table.groupBy("length", "part").agg(F.count(F.lit(1)).alias("pieces"))
    histogram = counts.groupBy("length").agg(F.sum("pieces").alias("pieces"))
    lengths = {r.length: r.pieces for r in histogram.collect()}  # at most ``size`` rows
    places = layout(lengths, size)
    slots = spark.sparkContext.broadcast(places.arrays())  # bounded by the patterns' lengths
    anew = places.anew
    places.slots = {}

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("length").alias("__length"),
        F.col("part").alias("__part"),
        F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("__base"),
    )
    narrow = table.drop("ids")
    numbered = narrow.join(
        bases, (F.col("length") == F.col("__length")) & (F.col("part") == F.col("__part"))
    ).withColumn("rank", F.col("__base") + F.col("number"))
    key = ["part", "number"]
    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields += [*key, "piece_length", "piece_start"]
    schema = T.StructType([T.StructField(name, T.LongType()) for name in fields])
    arrow = to_arrow_schema(schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, sequences, offsets = slots.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            whole = rank < np.array([anew.get(n, RANKS) for n in length.tolist()], dtype=np.int64)
            kept = batch.filter(pa.array(whole))
            at = (length * RANKS + rank)[whole]
            slot = np.searchsorted(starts, at, side="right") - 1
            rows = {c: kept.column(c) for c in fields[:5] + key}
            rows["sequence_id"] = pa.array(sequences[slot] + at - starts[slot])
            rows["offset"] = pa.array(offsets[slot])
            rows["piece_length"] = kept.column("length")
            rows["piece_start"] = pa.array(np.zeros(len(at), dtype=np.int64))
            yield pa.RecordBatch.from_pydict(rows, schema=arrow)
            cut = []
            for row in batch.filter(pa.array(~whole)).to_pylist():
                parts = places.cuts(row["length"], row["rank"])
                for (start, part, sequence, offset), crc in zip(parts, row["cuts_crc32"], strict=True):
                    cut.append(
                        (row["doc_id"], row["start"] + start, part, crc, row["doc_tokens"])
                        + (sequence, offset, row["part"], row["number"], row["length"], start)
                    )
            if cut:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(fields, r, strict=True)) for r in cut], schema=arrow
                )

    placed = numbered.select(*fields[:5], *key, "cuts_crc32", "rank").mapInArrow(place, schema)
    if not keep_ids:
        return placed.select(*fields[:7])
    ids = table.select(*key, F.col("length").alias("piece_length"), F.col("ids").alias("__ids"))
    cut_ids = F.slice("__ids", (F.col("piece_start") + 1).cast("int"), F.col("length").cast("int"))
    return placed.join(ids, [*key, "piece_length"]).select(*fields[:7], cut_ids.alias("ids"))
