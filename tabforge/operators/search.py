"""M4: a learning search over a parsed hyper-parameter space.

Tree-structured Parzen estimators: the trials so far are split into the best
ones and the others; for each parameter a density is fitted to either part, and
of some draws from the good density the one with the largest ratio of good to
other is proposed. Numeric parameters live on [0, 1] (logarithmic ones after
the logarithm, stepped ones as cells of equal width), where a density is a
mixture of truncated normals around the trials and a uniform prior; categorical
ones are smoothed counts.

Everything follows from the seed, the trial's number and the scores told, so a
search is repeatable however its trials were run.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

from tabforge.spec import ParamDist

#: trials drawn at random before densities are fitted
STARTUP = 10
#: draws from the good density
DRAWS = 24


def at(p: ParamDist, u: float):
    """The value of a parameter at the place ``u``: a number in [0, 1), or the
    index of a choice."""
    if p.kind == "categorical":
        v = list(p.args[0])[int(u)]
    elif p.kind == "uniform":
        v = float(p.args[0] + u * (p.args[1] - p.args[0]))
    elif p.kind == "loguniform":
        lo, hi = p.args
        v = float(min(hi, max(lo, math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo))))))
    elif p.kind == "discrete_uniform":
        lo, hi, q = p.args
        v = round(float(lo + q * _cell(u, int(math.floor((hi - lo) / q + 1e-9)) + 1)), 12)
    else:
        lo, hi, step, log = p.args
        if log:
            v = int(min(hi, max(lo, round(math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo)))))))
        else:
            v = int(lo) + int(step) * _cell(u, (int(hi) - int(lo)) // int(step) + 1)
    return int(v) if p.cast == "int" else float(v) if p.cast == "float" else v


def _cell(u: float, cells: int) -> int:
    return min(cells - 1, int(u * cells))


class _Mixture:
    """Truncated normals on [0, 1] around points, and the uniform density."""

    def __init__(self, points: list[float]):
        x = np.sort(np.array(points))
        ends = np.concatenate([[0.0], x, [1.0]])
        gap = np.maximum(ends[1:-1] - ends[:-2], ends[2:] - ends[1:-1])
        self.mean, self.width = x, np.clip(gap, 1.0 / (5 * (1 + len(x))), 1.0)
        low, high = [np.vectorize(_normal, otypes=[float])((end - x) / self.width) for end in (0.0, 1.0)]
        self.mass = np.maximum(high - low, 1e-12)

    def density(self, u: np.ndarray) -> np.ndarray:
        z = (u[:, None] - self.mean[None]) / self.width[None]
        parts = np.exp(-0.5 * z * z) / (math.sqrt(2 * math.pi) * self.width * self.mass)[None]
        return (parts.sum(axis=1) + 1.0) / (len(self.mean) + 1)

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        out = np.empty(n)
        for k in range(n):
            c = int(rng.integers(len(self.mean) + 1))
            u = float(rng.random())
            if c < len(self.mean):
                for _ in range(100):
                    u = float(rng.normal(self.mean[c], self.width[c]))
                    if 0.0 <= u < 1.0:
                        break
                u = min(max(u, 0.0), math.nextafter(1.0, 0.0))
            out[k] = u
        return out


def _normal(z: float) -> float:
    return 0.5 * (1.0 + math.erf(z / math.sqrt(2.0)))


@dataclass
class Study:
    """Proposals for one loss: ``ask`` for trials, ``tell`` their scores."""

    space: list[ParamDist]
    seed: int
    sign: float = 1.0           # 1: larger scores are better
    startup: int = STARTUP
    places: list[dict] = field(default_factory=list)
    scores: list[float | None] = field(default_factory=list)

    def ask(self, n: int = 1) -> list[tuple[int, dict]]:
        """(number, parameters) of the next ``n`` trials, proposed from the
        scores told so far."""
        out = []
        for _ in range(n):
            number = len(self.places)
            rng = np.random.default_rng([self.seed, number])
            known = [(s, p) for s, p in zip(self.scores, self.places) if s is not None]
            place = self._random(rng) if len(known) < self.startup else self._proposed(rng, known)
            self.places.append(place)
            self.scores.append(None)
            out.append((number, self.params(number)))
        return out

    def tell(self, number: int, score: float) -> None:
        """A score that is not a number counts as the worst."""
        self.scores[number] = -math.inf if math.isnan(score) else self.sign * score

    def params(self, number: int) -> dict:
        return {p.name: at(p, self.places[number][p.name]) for p in self.space}

    def best(self) -> int:
        """The number of the best trial, the first of equal ones."""
        return max((k for k, s in enumerate(self.scores) if s is not None), key=lambda k: (self.scores[k], -k))

    def _random(self, rng) -> dict:
        return {p.name: float(rng.integers(len(p.args[0]))) if p.kind == "categorical" else float(rng.random())
                for p in self.space}

    def _proposed(self, rng, known: list) -> dict:
        ranked = [p for _, p in sorted(known, key=lambda sp: -sp[0])]
        good = ranked[:max(1, min(25, math.ceil(0.15 * len(ranked))))]
        rest = ranked[len(good):]
        out = {}
        for p in self.space:
            a, b = [g[p.name] for g in good], [g[p.name] for g in rest]
            if p.kind == "categorical":
                k = len(p.args[0])
                fine, other = [(np.bincount(np.array(x, int), minlength=k) + 1.0) for x in (a, b)]
                drawn = rng.choice(k, DRAWS, p=fine / fine.sum())
                ratio = (fine / fine.sum())[drawn] / (other / other.sum())[drawn]
                out[p.name] = float(drawn[int(ratio.argmax())])
            else:
                fine, other = _Mixture(a), _Mixture(b)
                drawn = fine.draw(rng, DRAWS)
                out[p.name] = float(drawn[int((fine.density(drawn) / other.density(drawn)).argmax())])
        return out


def random_trials(space: list[ParamDist], n: int, seed: int) -> Study:
    """A study that never fits densities."""
    return Study(space, seed, startup=n + 1)
