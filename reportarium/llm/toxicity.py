"""Toxicity by weak supervision: voters, a label model over them, and a linear classifier.

A bounded sample of labelled rows trains it. Words and word beginnings of several lengths are
counted by kind; each length gives a lexicon of patterns that mark toxic rows. Voters are
these lexicons, fixed word lists, the shape of the text, and the annotator. A row is voted on
with lexicons from the other half of the sample, so that no voter has seen its label. A
generative model estimates how far each voter can be trusted, the annotator too, and which
repeat each other (see ``weak_labels``); a logistic classifier on the patterns' counts learns
its posterior labels, which differ from the annotator's where the others agree against it. Scores come from that classifier alone, from
the whole text.

Null or empty text: scored by the classifier's bias. Several labels for one id: toxic if any
says so; labels without id or kind are not used. Without labelled rows all scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportarium.llm.common import staged, steps
from reportarium.llm.shingles import buffers, word_bounds, word_hashes
from reportarium.llm.weak_labels import fit_label_model, fit_linear

#: Labelled rows used for training, at most: those with the smallest hash of their id.
LABELLED = 20_000
#: Bytes of a word's beginning that make a pattern; 0 is the whole word.
LENGTHS = (3, 4, 5, 6, 7, 8, 10, 0)
BITS = 18
SPACE = len(LENGTHS) << BITS
#: Bytes of text whose patterns are held at once.
TEXTS = 1 << 18
#: Patterns the classifier has at most.
PATTERNS = 4096
#: A lexicon's patterns: their likelihood ratio at least (beyond what the best of a million
#: patterns has by chance) and their share of toxic rows.
SIGNAL, PRECISE = 28.0, 0.9
#: Word lists of voters.
WORD_LISTS = {
    "insults": "idiot moron loser clown fool jerk imbecile dumbass cretin dimwit",
    "contempt": "stupid pathetic worthless disgusting useless ugly vile repulsive hateful",
    "filth": "scum trash garbage filth vermin parasite bastard bitch shit fuck",
}

_WORD = np.ones(256, dtype=bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1)]] = False
_WORD[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False


def patterns(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's different patterns as numbers below SPACE, with their counts."""
    data, bounds = buffers(texts)
    starts, ends = word_bounds(data, bounds, _WORD)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    keys = []
    for place, length in enumerate(LENGTHS):
        long = ends - starts >= length
        first = starts[long]
        hashes = word_hashes(data, first, first + length if length else ends[long])
        number = (hashes >> np.uint64(64 - BITS)).astype(np.int64) + (place << BITS)
        keys.append(owner[long] * SPACE + number)
    found, counts = np.unique(np.concatenate(keys), return_counts=True)
    return found // SPACE, found % SPACE, counts


def _word_numbers(words: str) -> np.ndarray:
    """The numbers of whole words."""
    _, numbers, _ = patterns(pa.array(words.split(), pa.large_string()))
    return numbers[numbers >> BITS == LENGTHS.index(0)]


@dataclass
class Model:
    """Column and weight of each pattern number; -1 is no pattern of the classifier."""

    columns: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        owner, numbers, counts = patterns(texts)
        columns = self.columns[numbers]
        known = columns >= 0
        values = np.sqrt(counts[known]) * self.weights[columns[known]]
        odds = self.bias + np.bincount(owner[known], values, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _counted(sample: DataFrame) -> DataFrame:
    """Rows that hold each pattern, by half of the sample and kind."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, SPACE), dtype=np.int32)
        for batch in steps(batches, limit=TEXTS):
            owner, numbers, _ = patterns(batch.column("text"))
            kind = batch.column("half").to_numpy() * 2 + batch.column("toxic").to_numpy()
            np.add.at(total, (kind[owner], numbers), 1)
        used = np.flatnonzero(total.any(axis=0))
        columns = [pa.array(used), *(pa.array(row[used]) for row in total)]
        yield pa.RecordBatch.from_arrays(columns, names=["pattern", "n0", "n1", "n2", "n3"])

    schema = "pattern long, n0 int, n1 int, n2 int, n3 int"
    parts = sample.mapInArrow(count, schema)
    return parts.groupBy("pattern").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(4)])


def _signal(toxic: np.ndarray, clean: np.ndarray, rows: tuple[int, int]) -> np.ndarray:
    """Likelihood ratio of a pattern that marks toxic rows; 0 if it marks clean ones."""
    total = toxic + clean
    expected = total * rows[1] / max(sum(rows), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (
            np.where(toxic > 0, toxic * np.log(toxic / expected), 0)
            + np.where(clean > 0, clean * np.log(clean / (total - expected)), 0)
        )
    return np.where(toxic > expected, ratio, 0)


def _votes(texts: pa.Array, half: np.ndarray, toxic: np.ndarray, owner: np.ndarray,
           numbers: np.ndarray, lexicons: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """One row of votes per text; the last voter is the annotator."""
    sure = np.zeros((len(texts), len(LENGTHS)), dtype=bool)
    hit = lexicons[half[owner], numbers]
    sure[owner[hit], numbers[hit] >> BITS] = True
    listed = np.zeros((len(texts), len(lists)), dtype=bool)
    for i, words in enumerate(lists):
        listed[owner[words[numbers]], i] = True
    words = [text.split() for text in texts.to_pylist()]
    loud = [sum(w.endswith("!") or w.isupper() and len(w) > 2 for w in own) for own in words]
    votes = [
        sure,
        np.where(sure.any(axis=1), 0, -1)[:, None],
        listed,
        (np.array(loud) > [len(own) / 5 for own in words])[:, None],
        np.where(toxic == 1, 1, -1)[:, None],
    ]
    return np.concatenate(votes, axis=1).astype(np.int64)


def fit(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """The classifier, from at most ``labelled`` rows of labels with doc_id and toxic."""
    spark = documents.sparkSession
    ids = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(labelled)
        .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    )
    ids = F.broadcast(staged(ids, "labelled"))  # at most ``labelled`` narrow rows
    texts = documents.select("doc_id", "text").join(ids, "doc_id")
    sample = staged(texts.select("text", "toxic", "half"), "sample")
    sizes = sample.groupBy("half", "toxic").count().collect()
    by_kind = {(r["half"], r["toxic"]): r["count"] for r in sizes}
    rows = [by_kind.get((half, kind), 0) for half in (0, 1) for kind in (0, 1)]
    if not sum(rows):
        return Model(np.full(SPACE, -1, dtype=np.int16), np.zeros(1), -500.0)
    toxic, clean = F.col("n1") + F.col("n3"), F.col("n0") + F.col("n2")
    more = toxic * (rows[0] + rows[2]) > clean * (rows[1] + rows[3])
    # At most as many rows as there are pattern numbers.
    table = _counted(sample).filter((toxic >= 2) & more).toArrow()
    number = table.column("pattern").to_numpy()
    n = np.array([table.column(f"n{i}").to_numpy() for i in range(4)])

    signal = _signal(n[1] + n[3], n[0] + n[2], (rows[0] + rows[2], rows[1] + rows[3]))
    best = np.lexsort((number, -signal))[:PATTERNS]
    columns = np.full(SPACE, -1, dtype=np.int16)
    columns[number[best]] = np.arange(len(best))

    lexicons = np.zeros((2, SPACE), dtype=bool)
    for half in (0, 1):  # rows of one half are judged by the other
        clean, toxic = n[2 - 2 * half], n[3 - 2 * half]
        sure = _signal(toxic, clean, (rows[2 - 2 * half], rows[3 - 2 * half])) >= SIGNAL
        lexicons[half, number[sure & (toxic >= PRECISE * (toxic + clean))]] = True
    lists = np.zeros((len(WORD_LISTS), SPACE), dtype=bool)
    for i, words in enumerate(WORD_LISTS.values()):
        lists[i, _word_numbers(words)] = True
    shared = spark.sparkContext.broadcast((columns, lexicons, lists))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, lexicons, lists = shared.value
        for batch in steps(batches, limit=TEXTS):
            texts = batch.column("text")
            owner, numbers, counts = patterns(texts)
            half, toxic = (batch.column(c).to_numpy() for c in ("half", "toxic"))
            votes = _votes(texts, half, toxic, owner, numbers, lexicons, lists)
            known = columns[numbers] >= 0
            ends = np.searchsorted(owner[known], np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(votes)),
                    pa.ListArray.from_arrays(ends, columns[numbers[known]].astype(np.int32)),
                    pa.ListArray.from_arrays(ends, np.sqrt(counts[known])),
                ],
                names=["votes", "columns", "counts"],
            )

    schema = "votes array<long>, columns array<int>, counts array<double>"
    found = sample.mapInArrow(vote, schema).toArrow().combine_chunks()  # ``labelled`` rows
    votes = np.array(found.column("votes").to_pylist(), dtype=np.int64)
    target = fit_label_model(votes, alone=votes.shape[1] - 1).posterior(votes)
    lists_of = found.column("columns").combine_chunks()
    owner = np.repeat(np.arange(len(votes)), np.diff(lists_of.offsets.to_numpy()))
    values = found.column("counts").combine_chunks().flatten().to_numpy()
    bias, weights = fit_linear(
        owner, lists_of.flatten().to_numpy(), values, (len(votes), max(len(best), 1)), target
    )
    return Model(columns, weights, bias)


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The same rows with a column of scores from 0 to 1."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = [
                own.scores(part.column("text"))
                for part in steps(iter([batch.select(["text"])]), limit=TEXTS)
            ]
            all_scores = pa.array(np.concatenate([np.zeros(0), *scores]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, all_scores], names=[*batch.schema.names, name]
            )

    return documents.mapInArrow(run, schema)


def held_out(key: str = "doc_id") -> Column:
    """A fifth of the ids, never trained on; rows without an id are not among them."""
    remainder = F.crc32(F.col(key).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))
