"""Settings by the job that consumes them, each checked against a table of rules."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

from cohorta.operators.promotion import DEFAULT_MIN_DELTA, DEFAULT_WEIGHTS


@dataclass(frozen=True)
class Rule:
    """What one setting may be: a type, a closed range, a list of values; for a dict, its keys' values."""

    name: str
    kind: type
    low: float = -math.inf
    high: float = math.inf
    allowed: tuple = ()

    def problem(self, value: Any) -> str | None:
        if not isinstance(value, self.kind) or isinstance(value, bool):
            return f"is no {getattr(self.kind, '__name__', 'number')}"
        if self.allowed and value not in self.allowed:
            return f"is not one of {self.allowed}"
        numbers = value if isinstance(value, (int, float)) else len(value)
        if not math.isfinite(numbers) or not self.low <= numbers <= self.high:
            return f"is outside {self.low} to {self.high}"
        return None


class Checked:
    """Base of the settings: every rule is checked when they are made."""

    RULES: tuple[Rule, ...] = ()

    def __post_init__(self) -> None:
        problems = [(r.name, r.problem(getattr(self, r.name))) for r in self.RULES]
        listing = ", ".join(f"{name} {what}" for name, what in problems if what)
        if listing:
            raise ValueError(f"{type(self).__name__}: {listing}.")


@dataclass(frozen=True)
class Fitting(Checked):
    """One fit: the catalogue model, how gaps are filled, calibration folds and bins."""

    model: str
    params: dict[str, Any] = field(default_factory=dict)
    fill_numbers: str = "median"
    fill_words: str = "most_frequent"
    # Default folds and bins.
    folds: int = 3
    bins: int = 10

    RULES = (
        Rule("model", str, low=1),
        Rule("params", dict),
        Rule("folds", int, low=2),
        Rule("bins", int, low=1),
    )


@dataclass(frozen=True)
class Search(Checked):
    """The parameter search before a fit."""

    # Default budget, metric and seed of the search.
    trials: int = 50
    folds: int = 4
    metric: str = "roc_auc"
    seed: int = 26
    parallelism: int = 1

    RULES = (
        Rule("trials", int, low=1),
        Rule("folds", int, low=2),
        Rule("metric", str, allowed=("roc_auc", "pr_auc")),
        Rule("parallelism", int, low=1),
    )


@dataclass(frozen=True)
class Release(Checked):
    """When a registered version becomes champion: required gain, and the weights of its score."""

    min_delta: float = DEFAULT_MIN_DELTA
    weights: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))

    RULES = (Rule("min_delta", (int, float), low=0), Rule("weights", dict, low=1, high=len(DEFAULT_WEIGHTS)))

    def __post_init__(self) -> None:
        super().__post_init__()
        share = Rule("weight", (int, float), low=0)
        wrong = [m for m, w in self.weights.items() if m not in DEFAULT_WEIGHTS or share.problem(w)]
        if wrong or not sum(self.weights.values()):
            raise ValueError(f"Release: weights need known metrics and a positive total, not {self.weights}.")


@dataclass(frozen=True)
class JobPlan:
    """Settings of the whole training job."""

    fitting: Fitting
    search: Search = Search()
    release: Release = field(default_factory=Release)
