"""Adaptive search by Parzen estimators over finished trials.

Finished trials are split into the good ones (the best `GOOD` share) and the
others. Every parameter has one density over each group: a mixture of normal
kernels at the trials' values, as wide as the gaps beside them, and one broad
kernel over the whole range, so that no value is ever ruled out. A proposal
is the best of `DRAWS` draws from the good density by the ratio of the two.
Parameters are taken one by one; a range is searched on a linear scale, on a
logarithmic one (`log`), or on whole numbers (`int`).

The trials table is the whole state of a search: proposal number k of a batch
follows from the seed, the space, the finished trials and k alone, so a
search that stops and resumes from its table proposes the same points.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np

GOOD, MOST_GOOD = 0.25, 25
DRAWS = 24
STARTUP = 10              # trials drawn at random before the densities are trusted

Space = dict[str, tuple[float, float, str]]


def _to_unit(x: float, lo: float, hi: float, kind: str) -> float:
    if hi == lo:
        return 0.5
    if kind == "log":
        return (math.log(x) - math.log(lo)) / (math.log(hi) - math.log(lo))
    if kind == "int":
        return (x - lo + 0.5) / (hi - lo + 1)
    return (x - lo) / (hi - lo)


def _from_unit(u: float, lo: float, hi: float, kind: str):
    u = min(max(u, 0.0), 1.0)
    if kind == "log":
        return min(max(math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))), lo), hi)
    if kind == "int":
        return int(min(lo + math.floor(u * (hi - lo + 1)), hi))
    return lo + u * (hi - lo)


class Parzen:
    """Density on [0, 1]: kernels at the points and one broad kernel."""

    def __init__(self, points: Sequence[float]):
        self.mean = np.append(np.sort(np.asarray(points, float)), 0.5)
        n = len(self.mean) - 1
        edge = np.concatenate([[0.0], self.mean[:-1], [1.0]])
        gap = np.maximum(edge[1:-1] - edge[:-2], edge[2:] - edge[1:-1]) if n else np.zeros(0)
        self.width = np.append(np.clip(gap, 1.0 / min(100, n + 2), 1.0), 1.0)
        #: what a kernel has inside the range
        self.mass = np.array([_normal_cdf((1 - m) / s) - _normal_cdf(-m / s) for m, s in zip(self.mean, self.width)])

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        out = []
        while len(out) < n:
            k = rng.integers(len(self.mean))
            x = rng.normal(self.mean[k], self.width[k])
            if 0.0 <= x <= 1.0:
                out.append(x)
        return np.array(out)

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.mean) / self.width
        each = np.exp(-0.5 * z * z) / (self.width * math.sqrt(2 * math.pi) * self.mass)
        return np.log(each.mean(axis=1))


def _normal_cdf(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def propose(space: Space, finished: Sequence[tuple[dict, float]], count: int, seed: int, startup: int = STARTUP) -> list[dict]:
    """The next `count` points, given finished trials as (params, value) in
    trial order; the larger value is the better one. A trial without a value
    (NaN) counts among the worst."""
    out = []
    order = sorted(range(len(finished)), key=lambda i: (-finished[i][1] if finished[i][1] == finished[i][1] else math.inf, i))
    n_good = min(MOST_GOOD, math.ceil(GOOD * len(finished)))
    for k in range(len(finished), len(finished) + count):
        rng = np.random.default_rng((seed, k))
        point = {}
        for name, (lo, hi, kind) in space.items():
            if len(finished) < max(startup, 1):
                u = float(rng.random())
            else:
                unit = [_to_unit(float(finished[i][0][name]), lo, hi, kind) for i in order]
                good, rest = Parzen(unit[:n_good]), Parzen(unit[n_good:])
                x = good.draw(rng, DRAWS)
                u = float(x[np.argmax(good.log_density(x) - rest.log_density(x))])
            point[name] = _from_unit(u, lo, hi, kind)
        out.append(point)
    return out


def search(space: Space, n_trials: int, evaluate: Callable[[list[dict]], list[dict]], seed: int, batch: int = 10,
           finished: Sequence[dict] = (), save: Callable[[list[dict]], None] | None = None,
           value: str = "cv_auc_mean", startup: int = STARTUP) -> list[dict]:
    """Run trials up to `n_trials` in batches that end at multiples of `batch`.

    `evaluate` takes the points of one batch and gives a dict of results for
    each; a trial is {"trial", "params", **results}. `finished` are trials of
    an earlier run (params may be text, as a trials table keeps them); `save`
    is called with every finished batch.
    """
    trials = sorted(({**t, "params": _typed(space, t["params"])} for t in finished), key=lambda t: t["trial"])
    while len(trials) < n_trials:
        whole = trials[:len(trials) - len(trials) % batch]  # what the batch at hand was proposed from
        points = propose(space, [(t["params"], t[value]) for t in whole], min(batch, n_trials - len(whole)), seed, startup)
        points = points[len(trials) - len(whole):]
        new = [{"trial": len(trials) + i, "params": p, **r} for i, (p, r) in enumerate(zip(points, evaluate(points), strict=True))]
        if save:
            save(new)
        trials += new
    return trials


def _typed(space: Space, params: dict) -> dict:
    return {k: int(float(params[k])) if kind == "int" else float(params[k]) for k, (_, _, kind) in space.items()}
