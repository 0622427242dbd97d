import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMALL
from plain import near_groups, odd_documents, shingles
from reportarium.llm import registry
from reportarium.llm.shingles import shingle_sets
from reportarium.llm.super_minhash import (
    _prefix_pairs,
    _prefixes,
    band_hashes,
    deduplicated,
    grouped,
    near_duplicates,
    signatures,
)

TEXTS = st.lists(st.text(st.sampled_from("aAbé \t\n\x0b.\x1c"), max_size=30), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 6))
def test_sets_have_the_sizes_and_overlaps_of_plain_shingles(texts, size):
    sets = shingle_sets(pa.array(texts, pa.large_string()), size)
    want = [shingles(t, size) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for a, x in zip(sets, want):
        for b, y in zip(sets, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_long_words_and_texts_hash_alike_anywhere():
    long = "x" * 3_000_000
    texts = [f"a b {long} c", f"{'w ' * 900_000}a b {long} c", ""]
    short, wide, none = shingle_sets(pa.array(texts, pa.large_string()), 4)
    assert len(short) == 1 and len(none) == 0 and np.isin(short, wide).all()


@pytest.mark.parametrize("number, share", [(3, 0.5), (20, 0.8), (200, 0.5), (2000, 0.8)])
def test_registers_agree_as_often_as_the_sets(number, share):
    rng = np.random.default_rng(number)
    differences = []
    for _ in range(150):
        common = round(number * share * 2 / (1 + share))
        a = rng.integers(0, 1 << 63, number, dtype=np.uint64)
        b = np.concatenate([a[:common], rng.integers(0, 1 << 63, number - common, dtype=np.uint64)])
        two = signatures([np.sort(a), np.sort(b)])
        differences.append((two[0] == two[1]).mean() - common / (2 * number - common))
    assert abs(np.mean(differences)) < 0.01
    plain = (share * (1 - share) / 160) ** 0.5
    assert np.std(differences) < 1.05 * plain


def test_a_signature_depends_on_its_set_alone():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 2, 7, 40, 160, 900, 5000)]
    together = signatures(sets)
    assert all((signatures([s])[0] == row).all() for s, row in zip(sets, together))
    assert len(np.unique(band_hashes(together))) == len(sets) * 32


def check(spark, rows, size=4):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_groups(rows, size)
    got = {r.doc_id: r for r in near_duplicates(df, size).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    for i, text in rows:
        assert got[i].n_shingles == len(shingles(text, size))
        assert got[i].kept == (want[i] == i)
    return want


def test_query_equals_brute_force(spark):
    folder = SMALL.replace("0.001", "0.01")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = near_groups(rows, 4)
    got = registry.op4_super_minhash(spark, folder)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert {r.doc_id: r.component_id for r in got.collect()} == want
    assert len(set(want.values())) < len(want)


def test_chains_of_slowly_changing_copies(spark):
    """Neighbours are near, ends are not: links must not be lost behind a bucket's hub."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    rows, text = [], rnd.sample(words, 120)
    for i in range(150):
        rows.append((i, " ".join(text)))
        text = list(text)
        text[rnd.randrange(120)] = rnd.choice(words)
        if i % 2:
            text[rnd.randrange(120)] = rnd.choice(words)
    rnd.shuffle(rows)
    assert len(set(check(spark, rows).values())) < 20


def test_large_groups_of_copies_and_a_common_passage(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    base, passage = rnd.sample(words, 100), " ".join(rnd.sample(words, 60))
    rows = [(i, " ".join(base)) for i in range(0, 300)]
    for i in range(300, 600):
        near = list(base)
        near[rnd.randrange(100)] = rnd.choice(words)
        rows.append((i, " ".join(near)))
    rows += [(i, passage + " " + " ".join(rnd.sample(words, 30))) for i in range(600, 800)]
    check(spark, rows)


def test_odd_rows(spark):
    documents = odd_documents(spark)
    got = near_duplicates(documents, 4).collect()
    assert len(got) == documents.count()
    rows = {(r.doc_id, r.n_shingles): r for r in got}
    assert rows[0, 0].kept and rows[0, 0].component_id == 0
    assert rows[None, 1].kept and rows[None, 1].component_id is None
    assert rows[11, 5].component_id == 10 and not rows[11, 5].kept
    assert near_duplicates(documents.limit(0), 4).collect() == []
    kept = deduplicated(documents, 4)
    assert kept.schema == documents.schema
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [i for i in range(14) if i != 11]
    assert ids.count(None) == 1


def test_an_id_with_two_texts_joins_their_groups(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(5, a), (7, a), (7, b), (9, b), (11, "x y z u v w")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in near_duplicates(df, 4).collect()}
    assert found == {(5, 5), (7, 5), (9, 5), (11, 11)}


def test_empty_texts_of_repeated_ids_link_nothing(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, ""), (1, a), (2, None), (2, b), (3, a), (4, b), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df, 4).collect()}
    assert found == {(1, 0, 1), (1, 3, 1), (2, 0, 2), (2, 3, 2), (3, 3, 1), (4, 3, 2), (5, 0, 5)}


def test_grouping_follows_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 400) if i != 200], "a long, b long")
    found = {r.id: r.component for r in grouped(edges).collect()}
    assert found == {i: 0 if i <= 200 else 201 for i in range(401)}


def held_sets(spark, sets, outside=lambda i: True):
    rows = [(i, i, outside(i), [int(x) for x in own]) for i, own in enumerate(sets)]
    schema = "id long, component long, outside boolean, hashes array<long>"
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.mark.parametrize("seed", range(3))
def test_prefixes_meet_every_near_pair(spark, seed):
    rng = np.random.default_rng(seed)
    words = rng.integers(-(1 << 62), 1 << 62, 40)
    sets = []
    for _ in range(60):
        base = rng.choice(words, rng.integers(1, 30), replace=False)
        sets += [base, *(rng.permutation(base)[k:] for k in range(1, 4) if k < len(base))]
        sets.append(np.union1d(base, rng.choice(words, 2)))
    plain = [set(map(int, own)) for own in sets]
    near = {
        (i, j)
        for j in range(len(plain))
        for i in range(j)
        if 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j]) and (i % 3 == 0 or j % 3 == 0)
    }
    met = _prefix_pairs(held_sets(spark, sets, lambda i: i % 3 == 0), 80).collect()
    assert len(near) > 100 and near <= {(r.a, r.b) for r in met}


@pytest.mark.parametrize("shared, own", [(4, 1), (16, 4), (80, 14)])
def test_pages_of_a_template_meet_in_proportion(spark, shared, own):
    """Pages that differ in too many shingles to be near: joined rows grow as the pages do."""
    rng = np.random.default_rng(shared)
    template = rng.integers(-(1 << 62), 1 << 62, shared)
    joined = {}
    for pages in (1000, 4000):
        sets = [np.append(template, rng.integers(-(1 << 62), 1 << 62, own)) for _ in range(pages)]
        sums = _prefixes(held_sets(spark, sets), 80).groupBy("shingle").agg(
            F.count(F.lit(1)).alias("long"), F.sum(F.col("short").cast("long")).alias("short")
        )
        joined[pages] = sums.agg(F.sum(F.col("long") * F.col("short"))).first()[0]
    assert joined[4000] <= 5 * joined[1000]
