"""Random search over the learner's settings by successive halving.

All trials fit to one stored matrix whose columns were cut into bins once. In every rung the
trials still in the race are taken up to the rung's number of rounds, several at a time; the
better part of them goes on from where it stands, the others stop.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml.feature import QuantileDiscretizer, VectorAssembler
from pyspark.sql import DataFrame

from slotcast.operators.boosting import Boosting, TreeParams
from slotcast.session import materialize, replaced

# The ranges that the forecast's description names. Its numbers of leaves, 64 to 512, are depths 6 to 9 here.
DEPTHS = (6, 9)
STEPS = (0.01, 0.1)
FEATURE_SHARES = (0.6, 1.0)
LEAF_SIZES = (20, 200)


def random_trials(n: int, seed: int = 42, base: TreeParams = TreeParams()) -> list[TreeParams]:
    """``n`` settings: whole numbers and shares uniform in their range, steps uniform in their logarithm."""
    rng = random.Random(seed)
    return [replace(
        base, depth=rng.randint(*DEPTHS), step=math.exp(rng.uniform(*map(math.log, STEPS))),
        feature_share=round(rng.uniform(*FEATURE_SHARES), 3), min_leaf=rng.randint(*LEAF_SIZES)) for _ in range(n)]


def binned(rows: DataFrame, columns: Sequence[str], keep: Sequence[str], bins: int = 64) -> DataFrame:
    """``keep`` columns and ``features``, the bin numbers of ``columns``; stored. Missing values have a bin of their own.

    Finding the cuts and applying them are two passes: the values are stored in between, so ``rows`` is computed once.
    """
    numeric = materialize(rows.selectExpr(*keep, *[f"coalesce(cast({c} as double), double('NaN')) as {c}" for c in columns if c not in keep]))
    coded = [f"_bin_{i}" for i in range(len(columns))]
    cut = QuantileDiscretizer(inputCols=list(columns), outputCols=coded, numBuckets=bins - 1, handleInvalid="keep", relativeError=1e-3)
    with replaced(numeric):
        marked = cut.fit(numeric).transform(numeric)
        return materialize(VectorAssembler(inputCols=coded, outputCol="features").transform(marked).select(*keep, "features"))


@dataclass
class Search:
    """The fits by trial number, the rounds and loss of every trial in every rung, and the winner."""

    fits: list[Boosting]
    log: list[tuple[int, int, int, float]]  # rung, trial, rounds, loss
    best: int

    def table(self, spark) -> DataFrame:
        """One row per rung and trial that took part in it; ``goes_on`` marks those of the next rung."""
        later = {(rung - 1, trial) for rung, trial, _, _ in self.log}
        data = [(rung, trial, rounds, float(loss), (rung, trial) in later or (trial == self.best and rung == self.log[-1][0]),
                 p.depth, p.step, p.feature_share, p.min_leaf)
                for rung, trial, rounds, loss in self.log for p in [self.fits[trial].params]]
        return spark.createDataFrame(data, "rung int, trial int, rounds int, loss double, goes_on boolean, depth int, step double, "
                                           "feature_share double, min_leaf int")


def successive_halving(
    matrix: DataFrame, trials: Sequence[TreeParams], rungs: Sequence[int] = (16, 48, 144, 432), keep: float = 1 / 3,
    pool: int = 4, row_id: str = "Index", target: str = "y_log",
) -> Search:
    """Trains ``trials`` on fold -1 of ``matrix`` and judges them by their smallest loss so far on fold 0.

    After every rung the best ``keep`` of the trials go on, one at least; equal losses go to
    the smaller trial number. With ``keep`` 1 the search is exhaustive.
    """
    fits = [Boosting(matrix, p, row_id, target, keep_predictions=False) for p in trials]
    alive, log = list(range(len(fits))), []
    with ThreadPoolExecutor(pool) as workers:
        for r, rounds in enumerate(rungs):
            list(workers.map(lambda t: fits[t].advance(rounds - len(fits[t].trees)), alive))
            log += [(r, t, rounds, min(fits[t].losses)) for t in alive]
            alive = sorted(alive, key=lambda t: (min(fits[t].losses), t))[:max(1, math.floor(len(alive) * keep))]
    return Search(fits, log, alive[0])
