"""Near duplicates by SuperMinHash signatures, banding, verification and union-find grouping.

Each shingle draws a random permutation of the signature's registers, and for its jth place a
value between j and j + 1; a register keeps its least value. The ranks of one shingle are
thus spread over all registers, which lowers the variance. Drawing stops as soon as no
register can change: after the first places for texts of some length.

Documents of equal shingle sets form a class, and one of them stands for it. Two classes that
agree in all registers of a band are candidates, confirmed on their full sets of hashes
(64 bits a shingle). No bucket is expanded into all its pairs: its members are compared with
its smallest one first; members that are then still in different groups are compared where
they share one of their rarest shingles, which no near pair can do without. Groups come from
hooking each group onto a smaller one and jumping along the hooks, in logarithmically many
rounds.

Null or empty text: no shingles, linked with nothing. A very long text costs time and memory by
its length, in one task. Other columns of the documents, of whatever name, do not matter. Rows with one id are one document for
grouping, with a row each in the result. A row without an id has no group and is kept.
Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportarium.llm.common import ranked, staged, steps
from reportarium.llm.shingles import mix, shingle_sets

#: Two sets with 0.8 of their union in common agree in a band with probability 0.8 ** ROWS;
#: that they agree in none of the bands has a probability of 3e-6.
BANDS, ROWS = 32, 5
PERCENT = 80
_LEVEL = np.uint64(52)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1B54A32D192ED03)
_STEPS = np.arange(1, 1 << 12, dtype=np.uint64) * _STEP
#: Places of a permutation that are looked up in its list of swaps, before it is written out.
LISTED = 8
#: Size of the table of shingle frequencies.
TABLE_BITS = 18
#: Bytes of text whose shingles are held at once.
TEXTS = 1 << 20


def _draw(elements: np.ndarray, j: int, registers: int) -> tuple[np.ndarray, np.ndarray]:
    """For place j: the value (j and 52 random bits) and a random place from j on."""
    bits = mix(elements + _STEPS[j])
    high = mix(bits ^ _OTHER) >> np.uint64(32)
    place = (high * np.uint64(registers - j)) >> np.uint64(32)
    return (bits >> np.uint64(12)) | (np.uint64(j) << _LEVEL), place.astype(np.int64) + j


def signatures(sets: list[np.ndarray], registers: int = BANDS * ROWS) -> np.ndarray:
    """One row of registers per non-empty set."""
    sizes = np.array([len(s) for s in sets])
    least = np.full((len(sets), registers), np.iinfo(np.uint64).max, dtype=np.uint64)
    if not len(sets):
        return least
    flat = least.ravel()
    elements, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    swapped: list[tuple[np.ndarray, np.ndarray]] = []
    written = None
    for j in range(registers):
        values, place = _draw(elements, j, registers)
        if written is None and j < LISTED:
            at, mine = place.copy(), np.full(len(place), j, dtype=np.int64)
            for old_place, old_value in swapped:
                at = np.where(old_place == place, old_value, at)
                mine = np.where(old_place == j, old_value, mine)
            swapped.append((place, mine))
        else:
            rows = np.arange(len(elements))
            if written is None:
                written = np.tile(np.arange(registers, dtype=np.int16), (len(elements), 1))
                for old_place, old_value in swapped:
                    written[rows, old_place] = old_value
                swapped = []
            at = written[rows, place].astype(np.int64)
            written[rows, place] = written[:, j]
        np.minimum.at(flat, owner * registers + at, values)
        # A text is done when no value of the next place could be the least of a register.
        open_text = least.max(axis=1) >= (np.uint64(j + 1) << _LEVEL)
        going = open_text[owner]
        if not going.any():
            break
        if not going.all():
            elements, owner = elements[going], owner[going]
            swapped = [(a[going], b[going]) for a, b in swapped]
            written = None if written is None else written[going]
    return least


def band_hashes(least: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One hash per band, different for equal registers in different bands."""
    parts = least.reshape(len(least), bands, least.shape[1] // bands)
    total = np.zeros(parts.shape[:2], dtype=np.uint64)
    for r in range(parts.shape[2]):
        total = mix(total * _STEP + parts[:, :, r])
    return mix(total + np.arange(1, bands + 1, dtype=np.uint64) * _OTHER)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.uint64)
    return pa.ListArray.from_arrays(ends, _signed(flat))


def signed_documents(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, two checksums of the set, and its band hashes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, limit=TEXTS):
            sets = shingle_sets(batch.column("text"), size)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands = band_hashes(signatures([sets[i] for i in full]))
            rows: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * len(sets)
            for i, own in zip(full, bands, strict=True):
                rows[i] = own
            sums = [
                np.array([mix(s ^ salt).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                for salt in (_STEP, _OTHER)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(_signed(sums[0])),
                    pa.array(_signed(sums[1])),
                    _lists(rows),
                ],
                names=["doc_id", "n_shingles", "sum_a", "sum_b", "bands"],
            )

    schema = "doc_id long, n_shingles long, sum_a long, sum_b long, bands array<long>"
    return documents.select("doc_id", "text").mapInArrow(sign, schema)


def hashed_sets(documents: DataFrame, size: int) -> DataFrame:
    """id and its sorted set of shingle hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, limit=TEXTS):
            sets = _lists(shingle_sets(batch.column("text"), size))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets], names=["id", "hashes"])

    return documents.select("doc_id", "text").mapInArrow(hashed, "id long, hashes array<long>")


def grouped(edges: DataFrame) -> DataFrame:
    """id and component (its smallest id) for every id of the edges (a, b)."""
    ids = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = staged(ids.withColumn("component", F.col("id")), "labels")
    ends = edges
    while True:
        a = labels.select(F.col("id").alias("a"), F.col("component").alias("__a"))
        b = labels.select(F.col("id").alias("b"), F.col("component").alias("__b"))
        crossing = ends.join(a, "a").join(b, "b").filter(F.col("__a") != F.col("__b"))
        hooks = staged(
            crossing.groupBy(F.greatest("__a", "__b").alias("id")).agg(
                F.min(F.least("__a", "__b")).alias("root")
            ),
            "hooks",
        )
        if hooks.isEmpty():
            return labels
        while True:
            above = hooks.select(F.col("id").alias("root"), F.col("root").alias("__next"))
            jumped = staged(
                hooks.join(above, "root", "left").select(
                    "id",
                    F.coalesce("__next", "root").alias("root"),
                    F.col("__next").isNotNull().alias("moved"),
                ),
                "jumps",
            )
            hooks = jumped.select("id", "root")
            if jumped.filter("moved").isEmpty():
                break
        roots = hooks.select(F.col("id").alias("component"), "root")
        labels = staged(
            labels.join(roots, "component", "left").select(
                "id", F.coalesce("root", "component").alias("component")
            ),
            "labels",
        )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have at least that share of their union in common."""
    a = sets.select(F.col("id").alias("a"), F.col("hashes").alias("__a"))
    b = sets.select(F.col("id").alias("b"), F.col("hashes").alias("__b"))
    both = pairs.join(a, "a").join(b, "b")
    shared = F.size(F.array_intersect("__a", "__b")).cast("long")
    union = F.size("__a").cast("long") + F.size("__b") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def _frequencies(held: DataFrame) -> np.ndarray:
    """How often shingles occur, by the first bits of their hash: a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << TABLE_BITS, dtype=np.int64)
        for batch in batches:
            hashes = batch.column("hashes").flatten().to_numpy().view(np.uint64)
            total += np.bincount(_places(hashes), minlength=len(total))
        used = np.flatnonzero(total)
        columns = [pa.array(used), pa.array(total[used])]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "rows"])

    parts = held.mapInArrow(count, "place long, rows long")
    sums = parts.groupBy("place").agg(F.sum("rows").alias("rows")).toArrow()  # of fixed size
    table = np.zeros(1 << TABLE_BITS, dtype=np.int64)
    table[sums.column("place").to_numpy()] = sums.column("rows").to_numpy()
    return table


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _prefixes(held: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each set, with their place, as many as a near pair may need.

    Two sets of n <= m shingles must share c = ceil(t(n + m) / (1 + t)) of them, and then
    share one among the first n - c + 1 and m - c + 1, in any order of shingles that holds
    for both. So a set needs n - ceil(2tn / (1 + t)) + 1 towards sets of its size or larger
    ones (``short``), and n - ceil(tn) + 1 towards smaller ones.
    """
    counts = held.sparkSession.sparkContext.broadcast(_frequencies(held))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            bounds = lists.offsets.to_numpy()
            hashes = lists.values.to_numpy().view(np.uint64)
            rows, shingles, places, short = [], [], [], []
            for row, (a, b) in enumerate(zip(bounds, bounds[1:])):
                own, n = hashes[a:b], int(b - a)
                order = np.lexsort((own, counts.value[_places(own)]))
                first = n - (percent * n + 99) // 100 + 1
                alike = n + (-2 * percent * n) // (100 + percent) + 1
                rows.append(np.full(first, row))
                shingles.append(own[order[:first]])
                places.append(np.arange(first))
                short.append(places[-1] < alike)
            if not rows:
                continue
            at = pa.array(np.concatenate(rows))
            sizes = pa.array(np.diff(bounds).astype(np.int64)).take(at)
            columns = [batch.column(c).take(at) for c in ("id", "component", "outside")]
            columns += [sizes, pa.array(_signed(np.concatenate(shingles)))]
            columns += [pa.array(np.concatenate(places)), pa.array(np.concatenate(short))]
            yield pa.RecordBatch.from_arrays(
                columns, names=["id", "component", "outside", "n", "shingle", "place", "short"]
            )

    schema = (
        "id long, component long, outside boolean, n long, shingle long, place long, short boolean"
    )
    rows = held.select("id", "component", "outside", "hashes").mapInArrow(prefixes, schema)
    return staged(rows, "prefixes")


def _prefix_pairs(held: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different groups that can be near, at least one of them outside.

    Rarest shingles first, members of a large group that have drifted apart meet few others.
    The smaller set of a pair brings its short prefix only. Pages of one template that differ
    too much to be near have as many rare shingles as that: what the template repeats in all
    of them never meets itself.
    """
    rows = _prefixes(held, percent)
    names = ["id", "component", "n", "place"]
    outside = rows.filter("outside").select(
        "shingle", "short", *[F.col(c).alias(f"__{c}") for c in names]
    )
    common = F.floor((percent * (F.col("n") + F.col("__n")) + (99 + percent)) / (100 + percent))
    smaller = outside.filter("short").drop("short").join(rows, "shingle").filter("__n <= n")
    larger = outside.drop("short").join(rows.filter("short"), "shingle").filter("__n > n")
    return (
        smaller.drop("short")
        .unionByName(larger.drop("short"))
        .filter(
            (F.col("component") != F.col("__component"))
            & (F.least("n", "__n") * 100 >= F.greatest("n", "__n") * percent)
            & (F.col("place") <= F.col("n") - common)
            & (F.col("__place") <= F.col("__n") - common)
        )
        .select(F.least("id", "__id").alias("a"), F.greatest("id", "__id").alias("b"))
        .distinct()
    )


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with the component of their id, which is the id itself where it has no edge."""
    if labels is None:
        return rows.withColumn("component", F.col("id"))
    own = labels.withColumnRenamed("id", "__id")
    return (
        rows.join(own, F.col("id") == F.col("__id"), "left")
        .withColumn("component", F.coalesce("component", "id"))
        .drop("__id")
    )


def near_duplicates(documents: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of the documents."""
    signed = staged(signed_documents(documents, size), "signed")
    full = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    content = ["n_shingles", "sum_a", "sum_b"]
    classes = staged(
        full.groupBy(*content).agg(F.min("doc_id").alias("id")).select(*content, "id"), "classes"
    )
    members = full.select("doc_id", *content).join(classes, content)
    # Rows of one id in several classes join these.
    several = members.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("__z"))
    joined = members.join(several.filter("a != __z"), "doc_id").select("a", F.col("id").alias("b"))
    edges = [staged(joined.filter("a != b").distinct(), "links")]
    one_of = full.join(classes.withColumnRenamed("id", "doc_id"), [*content, "doc_id"], "left_semi")
    bands = staged(
        one_of.select(F.col("doc_id").alias("id"), "n_shingles", F.explode("bands").alias("band"))
        .distinct(),
        "bands",
    )
    shared = bands.groupBy("band").agg(
        F.min("id").alias("hub"), F.count(F.lit(1)).alias("members")
    )
    buckets = staged(
        bands.join(shared.filter("members > 1"), "band").select("band", "id", "n_shingles", "hub"),
        "buckets",
    )
    sets = staged(
        hashed_sets(
            documents.join(
                buckets.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"
            ),
            size,
        )
        .filter(F.size("hashes") > 0)
        .distinct(),
        "sets",
    )
    sizes = sets.groupBy("id").agg(
        F.min(F.size("hashes")).alias("fewest"), F.max(F.size("hashes")).alias("most")
    )

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow the share."""
        for side in "ab":
            own = [F.col(c).alias(f"__{c}_{side}") for c in ("fewest", "most")]
            pairs = pairs.join(sizes.select(F.col("id").alias(side), *own), side)
        return pairs.filter(
            (F.col("__most_a") * 100 >= F.col("__fewest_b") * percent)
            & (F.col("__most_b") * 100 >= F.col("__fewest_a") * percent)
        ).select("a", "b")

    def more(pairs: DataFrame) -> DataFrame:
        """Confirm pairs, add them to the edges, and group anew."""
        edges.append(staged(_confirmed(possible(pairs), sets, percent), "links"))
        every = edges[0]
        for links in edges[1:]:
            every = every.unionByName(links)
        return grouped(staged(every, "edges"))

    # Each class with the hub it shares most buckets with.
    hubs = staged(
        buckets.filter("id != hub")
        .groupBy(F.col("hub").alias("a"), F.col("id").alias("b"))
        .agg(F.count(F.lit(1)).alias("together")),
        "hubs",
    )
    first = hubs.groupBy("b").agg(F.max_by("a", F.struct("together", "a")).alias("a"))
    labels = more(first.select("a", "b"))
    # Then with its other hubs, as far as they are in other groups.
    others = hubs.select("a", "b").join(first, ["a", "b"], "left_anti")
    left = _labelled(others.withColumnRenamed("a", "id"), labels).select(
        F.col("id").alias("a"), F.col("b").alias("id"), F.col("component").alias("__a")
    )
    left = _labelled(left, labels).filter(F.col("__a") != F.col("component"))
    labels = more(left.select("a", F.col("id").alias("b")))
    # In buckets that still hold several groups, what is outside the largest one meets others
    # by the rarest shingles of both.
    placed = staged(_labelled(buckets.select("band", "id"), labels), "placed")
    groups = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("rows"))
    most = groups.groupBy("band").agg(
        F.max(F.struct("rows", "component")).alias("__most"), F.count(F.lit(1)).alias("groups")
    )
    several = most.filter("groups > 1").select("band", F.col("__most.component").alias("__main"))
    mixed = placed.join(several, "band").groupBy("id", "component")
    outside = F.max(F.col("component") != F.col("__main")).alias("outside")
    held = staged(sets.join(mixed.agg(outside), "id"), "held")
    labels = more(_prefix_pairs(held, percent))

    placed_classes = _labelled(classes, labels).select(
        *[F.col(c).alias(f"__{c}") for c in content], F.col("component").alias("component_id")
    )
    same = F.lit(True)
    for c in content:
        same = same & (F.col(c) == F.col(f"__{c}"))
    found = signed.select("doc_id", *content).join(staged(placed_classes, "groups"), same, "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return found.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def deduplicated(documents: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """The documents whose row of ``near_duplicates`` is kept, with all their columns.

    Of several rows of one kept id, the one with the smallest text hash stays; rows without
    an id all stay.
    """
    found = near_duplicates(documents, size, percent).filter(F.col("kept") & F.col("doc_id").isNotNull())
    kept = staged(found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows")), "kept")
    rows = documents.join(kept.select("doc_id"), "doc_id", "left_semi")
    if not kept.filter("__rows > 1").isEmpty():
        text = F.struct(F.xxhash64("text"), F.col("text"))
        first = F.min_by(F.struct(*documents.columns), text).alias("__row")
        rows = rows.groupBy(F.col("doc_id").alias("__id")).agg(first).select("__row.*")
    return rows.select(*documents.columns).unionByName(
        documents.filter(F.col("doc_id").isNull())
    )


def deduplicated_rows(documents: DataFrame, size: int, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near rows, with all its columns, whatever ids repeat.

    Rows of one id with different texts stand for themselves, so a text that is near no other
    stays, as does one group's row under an id that another group has, too. Of a group, the
    row with the smallest id stays. Rows equal in id and text are one; rows without an id all stay.
    """
    columns = documents.columns
    named = documents.filter(F.col("doc_id").isNotNull())
    times = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__rows"))
    repeated = staged(times.filter("__rows > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return deduplicated(documents, size, percent)
    several = named.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    rows = named.join(repeated, "doc_id", "left_anti").unionByName(several)
    # Numbers in the order of the ids, written down since equal hashes have no order.
    order = ["doc_id", F.xxhash64("text")]
    numbered = ranked(rows.withColumn("__all", F.lit(0)), ["__all"], order, "__row")
    numbered = staged(numbered.drop("__all"), "numbered")
    found = near_duplicates(
        numbered.select(F.col("__row").alias("doc_id"), "text"), size, percent
    )
    kept = found.filter("kept").select(F.col("doc_id").alias("__row"))
    return (
        numbered.join(kept, "__row", "left_semi")
        .select(*columns)
        .unionByName(documents.filter(F.col("doc_id").isNull()))
    )
