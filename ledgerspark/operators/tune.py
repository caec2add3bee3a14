"""Search for model parameters that catch the most frauds on the validation rows.

Trials are drawn at random, with a seed, from the configured ranges.  Several run at once,
each a distributed fit.  ``random_search`` fits all of them on all rows; ``halving_search``
fits them on few rows first and goes on with the best ones.
"""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.evaluate import evaluate
from ledgerspark.operators.models import balanced_weights, has_effect, predict, train_model
from ledgerspark.operators.split import class_counts
from ledgerspark.sources.small import small_table

# Parameters that are whole numbers.
WHOLE_PARAMETERS = ("max_depth", "n_estimators", "min_samples_split", "min_samples_leaf")


@dataclass
class SearchResult:
    best: dict[str, Any]  # the drawn parameters of the winning trial
    trials: DataFrame  # trial, params, recall; of halving also rung and share of the rows


def draw_trials(space: dict[str, list], n: int, seed: int) -> list[dict[str, Any]]:
    """``n`` parameter sets, uniform in their ranges; whole ones are truncated."""
    dice = random.Random(seed)
    out = []
    for _ in range(n):
        drawn = {k: dice.uniform(low, high) for k, (low, high) in space.items()}
        out.append({k: int(v) if k in WHOLE_PARAMETERS else v for k, v in drawn.items()})
    return out


def random_search(train: DataFrame, valid: DataFrame, kind: str, base: dict[str, Any],
                  search: dict[str, Any], *, label: str, features: str = "features",
                  parallelism: int = 4) -> SearchResult:
    """Fit each trial on ``train`` and rank by recall on ``valid``; first one wins ties.

    Trials start from the base parameters, so weights and seed apply to them.
    """
    trials = _trials(kind, search)
    recalls = _recalls(train, valid, kind, [{**base, **t} for t in trials], label, features, parallelism)
    best = max(range(len(trials)), key=lambda i: (recalls[i], -i))
    table = small_table(
        train.sparkSession,
        [(i, json.dumps(t, sort_keys=True), r)
         for i, (t, r) in enumerate(zip(trials, recalls))],
        "trial long, params string, recall double")
    return SearchResult(trials[best], table)


def halving_search(train: DataFrame, valid: DataFrame, kind: str, base: dict[str, Any],
                   search: dict[str, Any], *, label: str, id_col: str, features: str = "features",
                   eta: int = 3, rungs: int = 3, parallelism: int = 4) -> SearchResult:
    """The same trials in ``rungs`` turns: each fits the best one in ``eta`` of the turn before on
    ``eta`` times the rows and trees, the last one on all of them.

    What a trial reaches on few rows decides whether it gets more, so the search needs some
    ``rungs / eta ** (rungs - 1)`` of the fitted rows of the random one.  The rows of a turn are
    those whose seeded hash of the id is small: the same in every run, and part of the next
    turn's.  Ranked by recall on all of ``valid``; the first trial wins ties.  A class that
    a small turn misses makes its trials score 0.
    """
    trials = _trials(kind, search)
    seed = int(search.get("random_state", 42))
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string")), F.lit(1 << 30))
    alive, rows = list(range(len(trials))), []
    for rung in range(rungs):
        share = eta ** (rung + 1 - rungs)
        part = train if share == 1 else train.where(place < int(share * (1 << 30)))
        asked = [_with_trees({**base, **trials[i]}, share) for i in alive]
        several = part.select(label).distinct().limit(2).count() > 1
        got = _recalls(part, valid, kind, asked, label, features, parallelism) if several else [0.0] * len(alive)
        recalls = dict(zip(alive, got))
        rows += [(i, json.dumps(trials[i], sort_keys=True), recalls[i], rung, float(share)) for i in alive]
        ranked = sorted(alive, key=lambda i: (-recalls[i], i))
        alive = sorted(ranked[:max(1, len(ranked) // eta)]) if rung < rungs - 1 else ranked[:1]
    table = small_table(train.sparkSession, rows,
                        "trial long, params string, recall double, rung long, share double")
    return SearchResult(trials[alive[0]], table)


def _with_trees(params: dict[str, Any], share: float) -> dict[str, Any]:
    trees = params.get("n_estimators")
    return {**params, "n_estimators": max(1, math.ceil(trees * share))} if trees else params


def _trials(kind: str, search: dict[str, Any]) -> list[dict[str, Any]]:
    n = int(search.get("init_points", 5)) + int(search.get("n_iter", 20))
    # Parameters that change nothing for this learner are not part of a trial.
    space = {k: v for k, v in search["search_space"].items() if has_effect(kind, k)}
    return draw_trials(space, n, search.get("random_state", 42))


def _recalls(train: DataFrame, valid: DataFrame, kind: str, asked: list[dict[str, Any]], label: str,
             features: str, parallelism: int) -> list[float]:
    """The recall that a fit with each of the parameter sets reaches on the validation rows.

    The classes are counted once for all balanced fits.
    """
    if any(params.get("class_weight") == "balanced" for params in asked):
        balanced = balanced_weights(class_counts(train, label))
        asked = [{**p, "class_weight": balanced} if p.get("class_weight") == "balanced" else p for p in asked]

    @inheritable_thread_target(train.sparkSession)
    def run(params: dict[str, Any]) -> float:
        model = train_model(train, kind, params, label=label, features=features)
        scored = predict(valid.select(features, label), model, features)
        return float(evaluate(scored, label, "prediction")["recall"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(run, asked))
