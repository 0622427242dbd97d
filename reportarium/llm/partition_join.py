"""Jaccard join of word n-grams by partitions of the universe and the pigeonhole principle.

A document's set holds the hashes of its n-grams. Sets go to bands by their size, and each band
cuts the universe of hashes into so many ranges that two near sets, which differ in at most H
elements, agree in the subsets of all but H of them. A set looks for smaller partners (or equal
ones) in its own band and the one below, with the ranges of that band. It spends H + 1 points:
one point on a range finds the sets with the same subset there, a second one those whose subset
differs by one element (its own subset with one element left out meets whole ones, and the other
way round). A pair missed by all would differ in more than H elements.

Which ranges get points is a matter of cost. A subset that no other set has costs nothing, and
is no row: a set with H + 1 of these has no partner and is settled by counting alone, which is
the fate of nearly all. What the others still need goes to their rarest subsets, or to
neighbourhoods of unique ones where that is cheaper than a crowded subset.

Sets that share an entry are compared with the entry's best connected one first, on their full
sets. What is then still outside that one's group meets others of the entry by the rarest
elements in which both differ from it, so no group is expanded into its pairs. Equal sets are one
throughout. Subsets and sets are known by 64-bit hashes; confirmations use full sets.

Null or empty text, or one without words: an empty set, linked with nothing. Rows with one id are
one document for grouping, with a row each in the result. A row without an id has no group.
Empty table: no rows. Long texts are one set each. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportarium.llm.common import staged, steps
from reportarium.llm.membership import Bitmap, bitmap
from reportarium.llm.shingles import mix, shingle_sets
from reportarium.llm.super_minhash import grouped

PERCENT = 80
#: Growth of a band's sizes, and ranges beyond those that H asks for, as a share of these.
GROWTH, SPARE = 1.5, 8
#: Rows that looking up one subset with an element left out is taken to cost.
NEIGHBOUR = 4
#: Size of the table of how often elements of differences occur: 8 MB to each task.
TABLE_BITS = 20
#: Bytes of text whose sets are held at once.
TEXTS = 1 << 20
_ELEMENT, _CHECK = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_ONE_OFF = np.uint64(0xC2B2AE3D27D4EB4F)


class Bands:
    """Bands of set sizes for one least share, with the ranges of each and the points needed."""

    def __init__(self, percent: int):
        self.percent = percent
        tops, growth = [1], max(GROWTH, 100 / percent)
        while tops[-1] < 1 << 40:
            tops.append(max(tops[-1] + 1, int(tops[-1] * growth)))
        self.tops = np.array(tops, dtype=np.int64)
        widest = (self.tops + self.tops * 100 // percent) * (100 - percent) // (100 + percent)
        self.ranges = widest + 1 + (widest + 1) // SPARE

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, sizes)

    def _differ(self, size: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Elements in which a set can differ from a near one of a size in that span; else -1."""
        together = 100 + self.percent
        cycle = together // math.gcd(self.percent, together)  # what is beyond it repeats lower
        best = np.full(len(size), -1, dtype=np.int64)
        for less in range(cycle):
            total = size + most - less
            differ = total - 2 * -(-self.percent * total // together)
            best = np.where(most - less >= least, np.maximum(best, differ), best)
        return best

    def _least(self, sizes: np.ndarray) -> np.ndarray:
        return -(-self.percent * sizes // 100)

    def points(self, sizes: np.ndarray, below: bool) -> np.ndarray:
        """H + 1 of each set against its own band or the one below; 0 without partners there."""
        band = self.of(sizes) - below
        bottom = np.where(band > 0, self.tops[band - 1], 0) + 1
        most = np.minimum(sizes, self.tops[np.maximum(band, 0)])
        points = self._differ(sizes, np.maximum(self._least(sizes), bottom), most) + 1
        return np.where(band >= 0, points, 0)

    def met(self, sizes: np.ndarray) -> np.ndarray:
        """Elements in which a set can differ from a near one of its size or larger."""
        return self._differ(sizes, sizes, sizes * 100 // self.percent)


class Subsets:
    """The subsets of some sets in the ranges of one band each, in order of sets and ranges."""

    def __init__(self, sets: list[np.ndarray], bands: Bands, below: bool):
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.points = bands.points(sizes, below) if len(sets) else sizes
        hashes = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        if below:  # only those with partners there
            inside = (self.points > 0)[owner]
            hashes, owner = hashes[inside], owner[inside]
        band = np.maximum(bands.of(sizes) - below, 0)
        self.band, self.number = band.astype(np.uint64), bands.ranges[band]
        ranges = (hashes >> np.uint64(32)) * self.number.astype(np.uint64)[owner] >> np.uint64(32)
        new = np.append(True, (owner[1:] != owner[:-1]) | (ranges[1:] != ranges[:-1]))
        start = np.flatnonzero(new) if len(hashes) else np.zeros(0, dtype=np.int64)
        self.elements = mix(hashes ^ _ELEMENT)
        self.sums = np.add.reduceat(self.elements, start) if len(start) else self.elements
        self.owner, self.range = owner[start], ranges[start]
        self.size = np.diff(np.append(start, len(hashes)))
        self.places = self._places(self.owner, self.range)
        self.keys = mix(self.sums + self.places)
        #: Ranges with elements of each set.
        self.held = np.bincount(self.owner, minlength=len(sets))

    def _places(self, owner: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        return mix((self.band[owner] << np.uint64(40)) + ranges + np.uint64(1))

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all subsets without one of their elements, and which subset each is of."""
        of = np.repeat(np.arange(len(self.size)), self.size)
        return mix(self.sums[of] - self.elements + self.places[of]), of

    def empty(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the ranges without elements of the marked sets, and whose they are."""
        rows = np.flatnonzero(wanted)
        number = self.number[rows]
        owner = np.repeat(rows, number)
        ranges = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        held = np.isin((owner << 32) | ranges, (self.owner << 32) | self.range.astype(np.int64))
        owner, ranges = owner[~held], ranges[~held].astype(np.uint64)
        return mix(self._places(owner, ranges)), owner


#: Sets up to this size can lie in so few ranges that points on empty ones are needed;
#: beyond it the chance of that is below 1e-15.
FEW = 128


def contents(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two checksums of each set."""
    sums = [
        np.array([mix(s ^ salt).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        for salt in (_ELEMENT, _CHECK)
    ]
    return mix(sums[0]), mix(sums[1])


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _shared(documents: DataFrame, size: int, bands: Bands) -> DataFrame:
    """key and rows of the subsets that different sets have in common."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in steps(batches, limit=TEXTS):
            sets = [s for s in shingle_sets(batch.column("text"), size) if len(s)]
            content, _ = contents(sets)
            new = []
            for i, c in enumerate(content.tolist()):  # a copy in the same task adds nothing
                if c not in seen:
                    seen.add(c)
                    new.append(i)
            if len(seen) > 1 << 20:
                seen.clear()
            sets, content = [sets[i] for i in new], content[new]
            for below in (False, True):
                parts = Subsets(sets, bands, below)
                columns = [_signed(parts.keys), _signed(content[parts.owner])]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "content"])

    keys = documents.select("text").mapInArrow(cut, "key long, content long")
    counts = keys.groupBy("key").agg(
        F.min("content").alias("a"), F.max("content").alias("z"), F.count(F.lit(1)).alias("rows")
    )
    return staged(counts.filter("a != z").select("key", "rows"), "shared")


def _open(parts: Subsets, shared: Bitmap, most: np.ndarray) -> np.ndarray:
    """Sets of which at most so many subsets are theirs alone."""
    alone = np.bincount(parts.owner[~shared.may_hold(parts.keys)], minlength=len(most))
    return alone <= most


def _settled(documents: DataFrame, size: int, bands: Bands, shared: Bitmap) -> DataFrame:
    """A row per document: its set's size and checksums, and its hashes if it may have partners."""
    known = documents.sparkSession.sparkContext.broadcast(shared)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch in steps(batches, limit=TEXTS):
            sets = shingle_sets(batch.column("text"), size)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            content, check = contents(sets)
            own, below = Subsets(sets, bands, False), Subsets(sets, bands, True)
            keep = _open(own, known.value, bands.met(sizes))
            keep |= (below.points > 0) & _open(below, known.value, below.points - 1)
            keep &= sizes > 0
            ids = batch.column("doc_id").cast(pa.int64())
            for i, (own_id, c) in enumerate(zip(ids.to_pylist(), content.tolist())):
                # Of equal sets the one with the smallest id speaks for all.
                if not keep[i] or own_id is None or least.get(c, own_id + 1) <= own_id:
                    keep[i] = False
                else:
                    least[c] = own_id
            if len(least) > 1 << 20:
                least.clear()
            columns = [ids, pa.array(sizes)]
            columns += [_signed(content), _signed(check), _listed(sets, keep)]
            names = ["doc_id", "n_shingles", "content", "check", "hashes"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_shingles long, content long, check long, hashes array<long>"
    return staged(documents.select("doc_id", "text").mapInArrow(settle, schema), "settled")


def _listed(sets: list[np.ndarray], keep: np.ndarray) -> pa.Array:
    kept = [s if k else s[:0] for s, k in zip(sets, keep.tolist())]
    offsets = np.cumsum([0] + [len(s) for s in kept])
    flat = np.concatenate(kept) if kept else np.zeros(0, dtype=np.uint64)
    lists = pa.LargeListArray.from_arrays(pa.array(offsets), _signed(flat), mask=pa.array(~keep))
    return lists.cast(pa.list_(pa.int64()))


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    lists = batch.column("hashes")
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy().view(np.uint64)
    return [flat[a:b] for a, b in zip(offsets, offsets[1:])]


def _hits(sets: DataFrame, bands: Bands, shared: Bitmap) -> DataFrame:
    """id and key of the subsets that may be shared."""
    known = sets.sparkSession.sparkContext.broadcast(shared)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids = _sets(batch), batch.column("id").to_numpy()
            for below in (False, True):
                parts = Subsets(hashes, bands, below)
                hit = known.value.may_hold(parts.keys)
                columns = [pa.array(ids[parts.owner[hit]]), _signed(parts.keys[hit])]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key"])

    return sets.select("id", "hashes").mapInArrow(look, "id long, key long")


def allocate(parts: Subsets, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points on each subset, and which sets need points on empty ranges as well.

    ``rows`` tells how many rows share each subset, 0 for those of one set alone.
    """
    alone = rows == 0
    left = parts.points - np.bincount(parts.owner[alone], minlength=len(parts.points))
    # First points on shared subsets, second points on all that hold more than one element.
    first, second = np.flatnonzero(~alone), np.flatnonzero(parts.size > 1)
    subset = np.concatenate([first, second])
    cost = np.concatenate([rows[first], rows[second] + NEIGHBOUR * (parts.size[second] + 1)])
    owner = parts.owner[subset]
    order = np.lexsort((cost, owner))
    start = np.searchsorted(owner[order], np.arange(len(left)))
    bought = order[np.arange(len(order)) - start[owner[order]] < left[owner[order]]]
    points = np.bincount(subset[bought], minlength=len(rows))
    # What nobody shares has its first point for free.
    points[alone] += 1
    points[(left <= 0)[parts.owner]] = 0
    return points, left > np.bincount(owner, minlength=len(left))


def _probes(sets: DataFrame, bands: Bands) -> DataFrame:
    """key, id, n and score for all that sets (id, n, hashes, counts) look up."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids = _sets(batch), batch.column("id").to_numpy()
            known = batch.column("counts").flatten()
            key = known.field("key").to_numpy().view(np.uint64)
            key, at = np.unique(key, return_index=True)
            rows = known.field("rows").to_numpy()[at]
            score = batch.column("score").to_numpy()
            for below in (False, True):
                parts = Subsets(hashes, bands, below)
                place = np.minimum(np.searchsorted(key, parts.keys), max(len(key) - 1, 0))
                found = np.zeros(len(parts.keys), dtype=np.int64)
                if len(key):
                    same = key[place] == parts.keys
                    found[same] = rows[place[same]]
                points, empty = allocate(parts, found)
                one_off, of = parts.neighbours()
                two = points[of] > 1
                some, twice = (points > 0) & (found > 0), points > 1
                blank, blank_owner = parts.empty(empty)
                keys = [parts.keys[some], parts.keys[twice] ^ _ONE_OFF, one_off[two], blank]
                owners = [parts.owner[some], parts.owner[twice], parts.owner[of[two]], blank_owner]
                yield _entries(np.concatenate(keys), np.concatenate(owners), ids, hashes, score)

    return sets.select("id", "hashes", "counts", "score").mapInArrow(probe, _ENTRY)


_ENTRY = "key long, id long, n long, score long"


def _entries(
    keys: np.ndarray, owner: np.ndarray, ids: np.ndarray, sets: list[np.ndarray], score: np.ndarray
) -> pa.RecordBatch:
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    columns = [_signed(keys), *(pa.array(c[owner]) for c in (ids, sizes, score))]
    return pa.RecordBatch.from_arrays(columns, names=["key", "id", "n", "score"])


def _index(sets: DataFrame, bands: Bands, wanted: Bitmap) -> DataFrame:
    """key, id, n and score of the subsets, whole and one element short, that may be looked up."""
    known = sets.sparkSession.sparkContext.broadcast(wanted)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ids = _sets(batch), batch.column("id").to_numpy()
            parts = Subsets(hashes, bands, False)
            one_off, of = parts.neighbours()
            few = np.array([len(s) <= FEW for s in hashes], dtype=bool)
            blank, blank_owner = parts.empty(few)
            keys = np.concatenate([parts.keys, one_off ^ _ONE_OFF, blank])
            owner = np.concatenate([parts.owner, parts.owner[of], blank_owner])
            held = known.value.may_hold(keys)
            score = batch.column("score").to_numpy()
            yield _entries(keys[held], owner[held], ids, hashes, score)

    return sets.select("id", "hashes", "score").mapInArrow(index, _ENTRY)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least that share of their union in common."""
    a = sets.select(F.col("id").alias("a"), F.col("hashes").alias("__a"))
    b = sets.select(F.col("id").alias("b"), F.col("hashes").alias("__b"))
    shared = F.size(F.array_intersect("__a", "__b")).cast("long")
    union = F.size("__a").cast("long") + F.size("__b") - shared
    both = pairs.join(a, "a").join(b, "b")
    return both.filter(100 * shared >= percent * union).select("a", "b")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with the group of their id, which is the id itself where it has no link."""
    if labels is None:
        return rows.withColumn("component", F.col("id"))
    own = labels.withColumnRenamed("id", "__id")
    return (
        rows.join(own, F.col("id") == F.col("__id"), "left")
        .withColumn("component", F.coalesce("component", "id"))
        .drop("__id")
    )


def _links(sets: DataFrame, probes: DataFrame, index: DataFrame, percent: int) -> list[DataFrame]:
    """Confirmed pairs (a, b) that connect all sets which near ones connect."""
    fits = (F.least("n", "__n") * 100 >= F.greatest("n", "__n") * percent) & (
        F.col("id") != F.col("__id")
    )
    links: list[DataFrame] = []

    def labels() -> DataFrame | None:
        every = None
        for found in links:
            every = found if every is None else every.unionByName(found)
        return None if every is None else grouped(staged(every, "edges"))

    # Every entry's best connected set, with all others of the entry.
    entries = staged(probes.unionByName(index).distinct(), "entries")
    best = entries.groupBy("key").agg(
        F.max_by(F.struct("id", "n"), F.struct("score", "id")).alias("best"),
        F.count(F.lit(1)).alias("sets"),
    )
    best = staged(
        best.filter("sets > 1").select(
            "key", F.col("best.id").alias("__id"), F.col("best.n").alias("__n")
        ),
        "best",
    )
    hubs = staged(
        entries.join(best, "key")
        .filter(fits)
        .groupBy(F.col("__id").alias("a"), F.col("id").alias("b"))
        .agg(F.count(F.lit(1)).alias("together")),
        "hubs",
    )
    first = hubs.groupBy("b").agg(F.max_by("a", F.struct("together", "a")).alias("a"))
    links.append(staged(_confirmed(first.select("a", "b"), sets, percent), "links"))
    grouping = labels()
    others = hubs.select("a", "b").join(first, ["a", "b"], "left_anti")
    left = _labelled(others.withColumnRenamed("a", "id"), grouping).select(
        F.col("id").alias("a"), F.col("b").alias("id"), F.col("component").alias("__a")
    )
    left = _labelled(left, grouping).filter(F.col("__a") != F.col("component"))
    links.append(
        staged(_confirmed(left.select("a", F.col("id").alias("b")), sets, percent), "links")
    )
    grouping = labels()
    # What is outside the group of its entry's best connected set.
    placed = staged(_labelled(entries.select("key", "id", "n"), grouping), "placed")
    hub = _labelled(best.select("key", F.col("__id").alias("id")), grouping)
    hub = hub.select("key", F.col("id").alias("hub"), F.col("component").alias("__group"))
    rows = placed.join(hub, "key").withColumn("outside", F.col("component") != F.col("__group"))
    rows = staged(rows.select("key", "hub", "id", "n", "component", "outside"), "rows")
    mixed = rows.filter("outside").select("key").distinct()
    members = rows.join(mixed, "key", "left_semi").drop("key").distinct()
    pairs = staged(_drifted(staged(members, "members"), sets, percent), "pairs")
    links.append(staged(_confirmed(pairs, sets, percent), "links"))
    return links


def _drifted(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one hub that can be near, at least one of them outside its group.

    Differences from the hub make up for the distance of two members: what the two differ in
    is what only one of the differences holds. Near ones differ in at most H elements; a set
    that is not near the hub differs from it in more. So the differences x and y of near
    members must share o = (x + y - H) / 2 elements, which is never none, and then one among the
    first x - o + 1 and y - o + 1, rarest first. Members that drifted apart meet few others.
    """
    own = sets.select("id", F.col("hashes").alias("__own"))
    of_hub = sets.select(F.col("id").alias("hub"), F.col("hashes").alias("__hub"))
    apart = F.concat(F.array_except("__own", "__hub"), F.array_except("__hub", "__own"))
    columns = ["hub", "id", "n", "component", "outside"]
    differing = staged(
        members.join(own, "id")
        .filter(F.size("__own") == F.col("n"))  # several sets of one id
        .join(of_hub, "hub")
        .select(*columns, F.size("__hub").cast("long").alias("of"), apart.alias("apart")),
        "differing",
    )
    rows = staged(_rarest(differing, percent), "rarest")
    names = ["id", "n", "component", "d", "place"]
    other = rows.select("hub", "element", *[F.col(c).alias(f"__{c}") for c in names])
    together = 100 + percent
    least = F.expr(
        f"greatest((d + __d - (n + __n) + 2 * (({percent} * (n + __n) + {together - 1}) div {together})"
        " + 1) div 2, 1)"
    )
    return (
        rows.filter("outside")
        .join(other, ["hub", "element"])
        .filter(
            (F.col("component") != F.col("__component"))
            & (F.least("n", "__n") * 100 >= F.greatest("n", "__n") * percent)
            & (F.col("place") <= F.col("d") - least)
            & (F.col("__place") <= F.col("__d") - least)
        )
        .select(F.least("id", "__id").alias("a"), F.greatest("id", "__id").alias("b"))
        .distinct()
    )


def _slots(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _table(differing: DataFrame) -> np.ndarray:
    """How often elements of differences occur, by the first bits of their hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << TABLE_BITS, dtype=np.int64)
        for batch in batches:
            elements = batch.column("apart").flatten().to_numpy().view(np.uint64)
            total += np.bincount(_slots(elements), minlength=len(total))
        at = np.flatnonzero(total)
        columns = [pa.array(at), pa.array(total[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "number"])

    parts = differing.select("apart").mapInArrow(count, "slot long, number long")
    found = parts.groupBy("slot").agg(F.sum("number").alias("number")).toArrow()
    total = np.zeros(1 << TABLE_BITS, dtype=np.int64)
    total[found.column("slot").to_numpy()] = found.column("number").to_numpy()
    return total


def _rarest(differing: DataFrame, percent: int) -> DataFrame:
    """The first elements of each difference, rarest first, as far as any partner asks for."""
    table = differing.sparkSession.sparkContext.broadcast(_table(differing))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("apart")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            n, of = batch.column("n").to_numpy(), batch.column("of").to_numpy()
            d = np.diff(offsets).astype(np.int64)
            # A partner's difference is as large but for the H elements between the two ...
            most = n * (100 + 100 * 100 // percent) // 100 * (100 - percent) // (100 + percent) + 1
            shared = np.maximum(d - most, 1)
            # ... and with a partner outside, more than half of it is in common.
            inside = ~batch.column("outside").to_numpy(zero_copy_only=False)
            half = (d - np.abs(n - of) - 1) // 2
            shared[inside] = np.maximum(shared, half)[inside]
            rows, elements, places = [], [], []
            for row, (a, b) in enumerate(zip(offsets, offsets[1:])):
                own = flat[a:b]
                number = table.value[_slots(own.view(np.uint64))]
                order = np.lexsort((own, number))[: max(len(own) - int(shared[row]) + 1, 0)]
                kept = np.flatnonzero(number[order] > 1)  # one of a kind meets nothing
                rows.append(np.full(len(kept), row))
                elements.append(own[order[kept]])
                places.append(kept)
            if not rows:
                continue
            at = pa.array(np.concatenate(rows))
            columns = [batch.column(c).take(at) for c in ("hub", "id", "n", "component", "outside")]
            columns += [pa.array(d).take(at), *(pa.array(np.concatenate(c)) for c in (elements, places))]
            names = ["hub", "id", "n", "component", "outside", "d", "element", "place"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        "hub long, id long, n long, component long, outside boolean, d long, element long, place long"
    )
    return differing.mapInArrow(first, schema)


def similar_groups(documents: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of the documents."""
    bands = Bands(percent)
    shared = _shared(documents, size, bands)
    crowded = bitmap(shared, "key", shared.count())
    settled = _settled(documents, size, bands, crowded)
    content = ["n_shingles", "content", "check"]
    full = settled.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    narrow = full.select("doc_id", *content)
    classes = staged(narrow.groupBy(*content).agg(F.min("doc_id").alias("id")), "classes")
    # Rows of one id in several classes join these.
    members = narrow.join(classes, content)
    several = members.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("__z"))
    joined = members.join(several.filter("a != __z"), "doc_id").select("a", F.col("id").alias("b"))
    edges = staged(joined.filter("a != b").distinct(), "links")

    # One set of each class that may have partners.
    held = full.filter(F.col("hashes").isNotNull())
    one = held.join(
        classes.withColumnRenamed("id", "doc_id"), ["doc_id", *content], "left_semi"
    ).dropDuplicates(["doc_id", *content])
    sets = staged(one.select(F.col("doc_id").alias("id"), *content, "hashes"), "sets")
    # An id with several sets has each under the id of its class; classes are told apart here.
    counts = (
        _hits(sets, bands, crowded)
        .join(shared, "key")
        .groupBy("id")
        .agg(F.collect_set(F.struct("key", "rows")).alias("counts"), F.sum("rows").alias("score"))
    )
    none = F.array().cast("array<struct<key:bigint,rows:bigint>>")
    counted = staged(
        sets.select("id", "hashes")
        .join(counts, "id", "left")
        .withColumns({"counts": F.coalesce("counts", none), "score": F.coalesce("score", F.lit(0))}),
        "counted",
    )
    probes = staged(_probes(counted, bands).distinct(), "probes")
    wanted = bitmap(probes, "key", probes.count())
    index = staged(_index(counted, bands, wanted).distinct(), "index")
    met = index.join(probes.select("key").distinct(), "key", "left_semi")
    looked = probes.join(index.select("key").distinct(), "key", "left_semi")
    links = _links(counted, staged(looked, "looked"), staged(met, "met"), percent)

    every = edges
    for more in links:
        every = every.unionByName(more)
    labels = grouped(staged(every, "edges"))
    placed = _labelled(classes, labels).select(
        *[F.col(c).alias(f"__{c}") for c in content], F.col("component").alias("component_id")
    )
    same = F.lit(True)
    for c in content:
        same = same & (F.col(c) == F.col(f"__{c}"))
    found = settled.select("doc_id", *content).join(staged(placed, "groups"), same, "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id")
    )
