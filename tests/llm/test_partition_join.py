import random

import numpy as np
import pytest

from conftest import SMALL
from plain import near_groups, odd_documents, shingles
from reportarium.llm import registry
from reportarium.llm.partition_join import Bands, Subsets, allocate, similar_groups


def near(a, b, percent):
    common = len(np.intersect1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


def mutated(rng, base, percent):
    """A set that is about as far from the base as near ones can be."""
    n = len(base)
    gone = rng.integers(0, max(1, n * (100 - percent) // 100) + 1)
    more = rng.integers(0, max(1, n * (100 - percent) // 100) + 1)
    return np.unique(np.concatenate([rng.permutation(base)[gone:], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_points_find_every_near_pair(percent):
    """Whatever subsets are taken for shared or unique, an allocation meets all near sets."""
    rng = np.random.default_rng(percent)
    bands, met, pairs = Bands(percent), 0, 0
    for _ in range(1500):
        base = np.unique(rng.integers(0, 1 << 63, rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 14, 30, 90, 400]), dtype=np.uint64))
        other = mutated(rng, base, percent)
        if not len(other) or not near(base, other, percent):
            continue
        large, small = sorted([base, other], key=len, reverse=True)
        pairs += 1
        size = np.array([len(small)])
        index = Subsets([small], bands, False)
        one_off = index.neighbours()[0]
        blank = index.empty(np.array([True]))[0]
        found = False
        for below in (False, True):
            probe = Subsets([large], bands, below)
            if not len(probe.keys):
                continue
            # Subsets the other has are shared; of the rest some are, by others.
            shared = np.isin(probe.keys, index.keys)
            rows = np.where(shared | (rng.random(len(shared)) < 0.5), rng.integers(2, 500, len(shared)), 0)
            points, empty = allocate(probe, rows)
            own_off, of = probe.neighbours()
            two = points[of] > 1
            found |= np.isin(probe.keys[points > 0], index.keys).any()
            found |= np.isin(probe.keys[points > 1], one_off).any()
            found |= np.isin(own_off[two], index.keys).any()
            found |= bool(empty.any()) and np.isin(probe.empty(empty)[0], blank).any()
        assert found, (len(large), len(small))
        # Both sides stay in by what they have alone.
        met += 1
        own = Subsets([small], bands, False)
        same_band = bands.of(np.array([len(large)])) == bands.of(size)
        against = Subsets([large], bands, not same_band[0])
        unlike = ~np.isin(own.keys, against.keys)
        assert unlike.sum() <= bands.met(size)[0]
        assert (~np.isin(against.keys, own.keys)).sum() < against.points[0]
    assert pairs > 400


def test_points_are_the_most_that_near_sets_can_differ():
    bands = Bands(80)
    for n in range(1, 120):
        size = np.array([n])
        for below in (False, True):
            band = bands.of(size)[0] - below
            low = bands.tops[band - 1] if band > 0 else 0
            most = -1
            for m in range(low + 1, min(n, bands.tops[band]) + 1 if band >= 0 else 0):
                common = -(-80 * (n + m) // 180)
                if common <= m:
                    most = max(most, n + m - 2 * common)
            assert bands.points(size, below)[0] >= most + 1
            assert bands.points(size, below)[0] <= max(most, 0) + 1 + (most < 0)


def check(spark, rows, size=5):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_groups(rows, size)
    got = {r.doc_id: r for r in similar_groups(df, size).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    for i, text in rows:
        assert got[i].n_shingles == len(shingles(text, size))
    return want


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = near_groups(rows, 5)
    got = registry.op12_partition_join(spark, SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert len(set(want.values())) < len(want)


def test_chains_stars_templates_and_short_texts(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    rows, text = [], rnd.sample(words, 120)
    for _ in range(80):  # neighbours are near, ends are not
        rows.append(" ".join(text))
        text = list(text)
        text[rnd.randrange(120)] = rnd.choice(words)
    star = rnd.sample(words, 150)
    for _ in range(120):  # near the middle of the star, often not near each other
        near_one = list(star)
        for _ in range(rnd.randint(1, 4)):
            near_one[rnd.randrange(150)] = rnd.choice(words)
        rows.append(" ".join(near_one))
    rows += [" ".join(star)] * 20
    rows += [f"one two three four {w} six seven eight nine" for w in rnd.sample(words, 60)]
    passage = " ".join(rnd.sample(words, 60))
    rows += [passage + " " + " ".join(rnd.sample(words, 12)) for _ in range(60)]
    for _ in range(150):
        start = rnd.randrange(40)
        rows.append(" ".join(words[start : start + rnd.randint(1, 14)]))
    rnd.shuffle(rows)
    want = check(spark, list(enumerate(rows)))
    assert 100 < len(set(want.values())) < 400


def test_templates_that_are_not_near_meet_in_proportion(spark, monkeypatch):
    """A crowded subset is passed over for the neighbourhood of a unique one."""
    from reportarium.llm import partition_join

    counted = []
    confirmed = partition_join._confirmed
    monkeypatch.setattr(
        partition_join, "_confirmed", lambda pairs, *a: (counted.append(pairs.count()), confirmed(pairs, *a))[1]
    )
    for number in (300, 1200):
        rows = [(i, f"page of {i} holds the same few words") for i in range(number)]
        found = similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
        assert found.filter("component_id <> doc_id").isEmpty()
    assert sum(counted[3:]) <= 6 * max(sum(counted[:3]), 300)


def test_odd_rows(spark):
    documents = odd_documents(spark)
    got = similar_groups(documents).collect()
    assert len(got) == documents.count()
    rows = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert rows[0, 0] == 0 and rows[None, 1] is None and rows[11, 4] == 10
    assert similar_groups(documents.limit(0)).collect() == []


def test_an_id_with_two_texts_joins_their_groups(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, a), (7, a), (7, b), (9, b), (11, "x y z u v w"), (12, ""), (12, a), (13, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in similar_groups(df).collect()}
    assert found == {(5, 2, 5), (7, 2, 5), (9, 2, 5), (11, 2, 11), (12, 0, 12), (12, 2, 5), (13, 0, 13)}
