import numpy as np
from pyspark.sql import functions as F

from plain import odd_documents
from reportarium.llm import registry, toxicity
from reportarium.llm.weak_labels import fit_label_model, fit_linear

FOLDER = "/root/testdata/sf0.1"


def test_label_model_finds_accuracies_and_repeated_voters():
    rng = np.random.default_rng(1)
    toxic = rng.random(6000) < 0.2
    truth = np.where(toxic, 1, -1)
    accuracies = [0.95, 0.85, 0.8, 0.75]
    votes = [np.where(rng.random(6000) < a, truth, -truth) for a in accuracies]
    votes += [votes[3], votes[3]]  # two voters that repeat the worst one
    votes = np.stack(votes, axis=1) * (rng.random((6000, 6)) < 0.9)
    votes[:, 4:] = votes[:, [3, 3]]
    model = fit_label_model(votes)
    assert np.abs(model.accuracies[:3] - accuracies[:3]).max() < 0.05
    assert model.correlations[3, 4] > 0.9 > 0.3 > abs(model.correlations[0, 1])
    assert model.weights[4] < 0.5 < model.weights[0]
    right = ((model.posterior(votes) > 0.5) == toxic).mean()
    assert right > ((votes.sum(axis=1) > 0) == toxic).mean() and right > 0.93


def test_annotator_is_estimated_and_overruled():
    rng = np.random.default_rng(3)
    toxic = rng.random(8000) < 0.2
    truth = np.where(toxic, 1, -1)
    votes = [np.where(rng.random(8000) < a, truth, -truth) for a in (0.92, 0.9, 0.88)]
    for wrong in (0.0, 0.1):
        person = np.where(rng.random(8000) < wrong, -truth, truth)
        every = np.stack([*votes, person], axis=1)
        model = fit_label_model(every, alone=3)
        assert abs(model.accuracies[3] - (1 - wrong)) < 0.02
        decided = model.posterior(every) > 0.5
        against = (every[:, :3] == -person[:, None]).all(axis=1)
        if wrong:
            assert (decided == (person < 0))[against].all() and against.sum() > 300
            assert (decided == toxic).mean() > 0.97
        else:
            assert (decided == toxic).mean() > 0.995


def test_wrong_labels_are_overruled_where_voters_agree(spark, monkeypatch):
    """A tenth of the toxic rows marked clean: those that most lexicons mark are turned round."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter(~toxicity.held_out())
    turned = (F.col("toxic") == 1) & (F.crc32(F.concat(F.lit("x"), "doc_id")) % 10 == 0)
    noisy = labels.withColumn("toxic", F.when(turned, 0).otherwise(F.col("toxic")))
    fitted = []

    def kept(votes, alone):
        fitted.append((votes, fit_label_model(votes, alone).posterior(votes)))
        return fit_label_model(votes, alone)

    monkeypatch.setattr(toxicity, "fit_label_model", kept)
    toxicity.fit(documents, noisy)
    votes, target = fitted[0]
    marked = (votes[:, : len(toxicity.LENGTHS)] == 1).sum(axis=1) >= len(toxicity.LENGTHS) // 2
    against = marked & (votes[:, -1] == -1)
    assert against.sum() >= 10 and (target[against] > 0.5).all()
    silent = (votes[:, :-1] != 1).all(axis=1)
    assert (target[silent & (votes[:, -1] == -1)] < 0.05).all()


def test_linear_classifier_learns_soft_labels():
    rng = np.random.default_rng(2)
    x = (rng.random((2000, 30)) < 0.2).astype(float)
    weights = rng.normal(size=30) * 2
    odds = x @ weights - 1
    rows, columns = np.nonzero(x)
    soft = 1 / (1 + np.exp(-odds))
    bias, found = fit_linear(rows, columns, x[rows, columns], x.shape, soft, penalty=0.01, rounds=3000)
    assert np.abs(found - weights).max() < 0.2 and abs(bias + 1) < 0.2


def test_held_out_rows_are_told_apart(spark):
    got = registry.op5_toxicity(spark, FOLDER)
    assert dict(got.dtypes) == {
        "doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int",
    }
    rows = got.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").filter("held_out")
    cell = {(r.predicted, r.toxic): r["count"] for r in rows.groupBy("predicted", "toxic").count().collect()}
    caught, missed, wrong = cell.get((1, 1), 0), cell.get((0, 1), 0), cell.get((1, 0), 0)
    assert caught >= 0.85 * (caught + missed)
    assert wrong <= 0.02 * caught


def test_held_out_labels_do_not_matter(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(1500)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    changed = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    models = [toxicity.fit(documents, x.filter(~toxicity.held_out())) for x in (labels, changed)]
    assert (models[0].weights == models[1].weights).all()


def test_odd_rows(spark):
    documents = odd_documents(spark).drop("score")
    labels = spark.createDataFrame(
        [(3, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, 0), (5, 0, 0), (99, 1, 0)],
        "doc_id long, toxic int, quality int",
    )
    model = toxicity.fit(documents, labels)
    rows = toxicity.score(documents, model).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert rows[0].score == rows[1].score
    assert toxicity.score(documents.limit(0), model).collect() == []
    unlearnt = toxicity.fit(documents, labels.limit(0))
    assert {r.score < 1e-9 for r in toxicity.score(documents, unlearnt).collect()} == {True}
    held = documents.select("doc_id", toxicity.held_out().alias("held")).collect()
    assert [r.held for r in held if r.doc_id is None] == [False]
