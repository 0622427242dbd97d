"""A generative model of voters: how often each is right, and which say the same twice.

Votes are 1 (toxic), -1 (clean) and 0 (no opinion). Expectation maximisation finds, without
labels, the share of toxic rows and how each voter votes on either kind. What two voters still
have in common once the kind is known is their correlation: a voter's weight falls with the
number of voters it repeats, and the model is fitted again with these weights.

One voter may be a source of its own, such as a person who read the texts: it repeats nobody,
and its share of toxic votes is the share of toxic rows. How far it can be trusted is estimated
like any other voter's, from a start that the others alone give.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 50
#: Pseudo-votes per voter, kind and vote.
SMOOTH = 1.0
#: Correlation of votes from which two voters are taken for one before anything is known.
SAME = 0.9


@dataclass
class LabelModel:
    prior: float
    #: log P(vote | toxic) - log P(vote | clean), by voter and vote + 1.
    evidence: np.ndarray
    weights: np.ndarray
    correlations: np.ndarray
    accuracies: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that each row is toxic."""
        rows = self.evidence[np.arange(votes.shape[1]), votes + 1] * self.weights
        odds = np.log(self.prior / (1 - self.prior)) + rows.sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _fitted(
    votes: np.ndarray, weights: np.ndarray, first: np.ndarray, share: float | None
) -> LabelModel:
    number = votes.shape[1]
    kinds = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    toxic, model = first, None
    for _ in range(ROUNDS):
        prior = float(np.clip(toxic.mean(), 1e-3, 0.5)) if share is None else share
        by_toxic = np.einsum("r,rvk->vk", toxic, kinds) + SMOOTH
        by_clean = np.einsum("r,rvk->vk", 1 - toxic, kinds) + SMOOTH
        by_toxic /= by_toxic.sum(axis=1, keepdims=True)
        by_clean /= by_clean.sum(axis=1, keepdims=True)
        right = prior * by_toxic[:, 2] + (1 - prior) * by_clean[:, 0]
        given = prior * (1 - by_toxic[:, 1]) + (1 - prior) * (1 - by_clean[:, 1])
        evidence = np.log(by_toxic) - np.log(by_clean)
        evidence[:, 1] = 0  # no opinion is no evidence
        accuracies = right / np.maximum(given, 1e-9)
        model = LabelModel(prior, evidence, weights, np.eye(number), accuracies)
        toxic, before = model.posterior(votes), toxic
        if np.abs(toxic - before).max(initial=0) < 1e-6:
            break
    return model


def _correlations(votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Correlation of each two voters' votes within the kinds of rows."""
    rest = votes.astype(float)
    for share in (toxic, 1 - toxic):
        mean = (share @ votes) / max(share.sum(), 1e-9)
        rest = rest - share[:, None] * mean
    cov = rest.T @ rest / max(len(rest), 1)
    size = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return cov / size[:, None] / size


def fit_label_model(votes: np.ndarray, alone: int | None = None) -> LabelModel:
    """The model; ``alone`` is the voter that is a source of its own."""
    others = np.arange(votes.shape[1]) != (-1 if alone is None else alone)
    share = None
    if alone is not None:
        given = votes[:, alone]
        share = float(np.clip((given > 0).sum() / max((given != 0).sum(), 1), 1e-3, 1 - 1e-3))

    def weights(repeats: np.ndarray) -> np.ndarray:
        among = np.where(np.outer(others, others), repeats, 0)
        return 1 / np.maximum(among.sum(axis=1), 1)

    total = votes[:, others].sum(axis=1)
    first = np.where(total > 0, 0.95, np.where(total < 0, 0.03, 0.2))
    # Voters that hardly ever differ would outvote the others from the start.
    nearly = (_correlations(votes, np.zeros(len(votes))) > SAME).astype(float)
    start = weights(nearly)
    toxic = _fitted(votes[:, others], start[others], first, share).posterior(votes[:, others])
    if alone is not None:
        toxic = _fitted(votes, start, toxic, share).posterior(votes)
    shared = _correlations(votes, toxic)
    model = _fitted(votes, weights(np.maximum(shared, nearly)), toxic, share)
    model.correlations = shared
    return model


def fit_linear(
    rows: np.ndarray,
    columns: np.ndarray,
    values: np.ndarray,
    shape: tuple[int, int],
    target: np.ndarray,
    penalty: float = 0.3,
    rounds: int = 300,
) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic classifier of sparse rows (values not negative), on soft
    labels: accelerated gradient steps, as long in each column as its curvature allows."""
    by_row = np.bincount(rows, values, minlength=shape[0]) + 1
    by_column = np.bincount(columns, values * by_row[rows], minlength=shape[1])
    step = 4 / np.append(by_column + 4 * penalty, max(by_row.sum(), 1))
    weights = np.zeros(shape[1] + 1)
    ahead, pace = weights, 1.0
    for _ in range(rounds):
        odds = ahead[-1] + np.bincount(rows, values * ahead[columns], minlength=shape[0])
        miss = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target
        slope = np.bincount(columns, values * miss[rows], minlength=shape[1])
        new = ahead - step * np.append(slope + penalty * ahead[:-1], miss.sum())
        next_pace = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / next_pace * (new - weights)
        weights, pace = new, next_pace
    return float(weights[-1]), weights[:-1]
