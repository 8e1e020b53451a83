"""Guided search: draws by the ratio of two Parzen densities of the trials so far.

Finished trials are split at a quantile of their scores. Each parameter has a density of the good trials and
one of the others: a mixture of normals cut off at the ends of its range, around the tried values and the
middle of the range, or counts of its choices. Of some draws from the good density the one of the largest
ratio of good to other is tried next.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from statistics import NormalDist
from typing import Any

# Trials drawn at random first, share and number of good trials, draws compared.
STARTUP, GOOD_SHARE, MOST_GOOD, CANDIDATES = 10, 0.1, 25, 24


class Range:
    """Density over low to high, around the values tried."""

    def __init__(self, tried: Sequence[float], low: float, high: float):
        self.low, self.high = low, high
        width = high - low
        marks = sorted([*((v, False) for v in tried), ((low + high) / 2, True)])
        least = width / min(100, len(marks) + 1)
        self.parts = []
        for k, (mark, prior) in enumerate(marks):
            before = mark - (marks[k - 1][0] if k else low)
            after = (marks[k + 1][0] if k + 1 < len(marks) else high) - mark
            spread = width if prior else min(max(before, after, least), width)
            normal = NormalDist(mark, spread or 1.0)
            self.parts.append((normal, normal.cdf(low), normal.cdf(high)))

    def draw(self, generator: random.Random) -> float:
        normal, a, b = generator.choice(self.parts)
        share = min(max(a + (b - a) * generator.random(), 1e-12), 1 - 1e-12)
        return min(max(normal.inv_cdf(share), self.low), self.high)

    def log_density(self, value: float) -> float:
        total = sum(normal.pdf(value) / max(b - a, 1e-12) for normal, a, b in self.parts)
        return math.log(max(total / len(self.parts), 1e-300))


class Choices:
    """Density over a list of choices: how often each was tried, and once more."""

    def __init__(self, tried: Sequence[Any], choices: Sequence[Any]):
        self.choices = list(choices)
        self.weights = [1 + sum(t == c and type(t) is type(c) for t in tried) for c in choices]

    def draw(self, generator: random.Random) -> Any:
        return generator.choices(self.choices, self.weights)[0]

    def log_density(self, value: Any) -> float:
        at = next(i for i, c in enumerate(self.choices) if c == value and type(c) is type(value))
        return math.log(self.weights[at] / sum(self.weights))


def _inner(part: Mapping[str, Any], value: Any) -> Any:
    """A parameter's value on the scale its density has."""
    return math.log(value) if part["type"] != "categorical" and part["log"] else value


def _density(part: Mapping[str, Any], tried: Sequence[Any]) -> Range | Choices:
    if part["type"] == "categorical":
        return Choices(tried, part["choices"])
    margin = 0.5 if part["type"] == "int" else 0.0  # a whole number stands for the range that rounds to it
    return Range(tried, _inner(part, part["low"] - margin), _inner(part, part["high"] + margin))


def guided_draw(
    space: Mapping[str, Mapping[str, Any]], trials: Sequence[tuple[Mapping[str, Any], float]], generator: random.Random
) -> dict[str, Any]:
    """Next parameter set after the finished (parameters, score) trials; a higher score is better, ties go to the earlier trial.

    A score that is NaN or missing counts as the worst.
    """
    worth = [s if s is not None and not math.isnan(s) else -math.inf for _, s in trials]
    order = sorted(range(len(trials)), key=lambda i: (-worth[i], i))
    good = order[: min(MOST_GOOD, max(1, math.ceil(GOOD_SHARE * len(trials))))]
    rest = order[len(good) :]
    chosen: dict[str, Any] = {}
    for name, part in space.items():
        better, other = (_density(part, [_inner(part, trials[i][0][name]) for i in group]) for group in (good, rest))
        drawn = [better.draw(generator) for _ in range(CANDIDATES)]
        value = max(drawn, key=lambda v: better.log_density(v) - other.log_density(v))
        if part["type"] != "categorical":
            value = math.exp(value) if part["log"] else value
            value = min(max(round(value) if part["type"] == "int" else value, part["low"]), part["high"])
        chosen[name] = value
    return chosen
