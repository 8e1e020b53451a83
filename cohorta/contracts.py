"""Use-case contracts: which columns a table has, their types and their rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Builder = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ColumnRule:
    """Type, presence and value rule of one column."""

    name: str
    dtype: str
    required: bool = True
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()

    def typed(self) -> Column:
        return F.col(self.name).try_cast(self.dtype).alias(self.name)

    def failures(self) -> list[tuple[str, Column]]:
        """(rule name, condition that is true on a broken row); at most one holds per row."""
        raw = F.col(self.name)
        value = raw.try_cast(self.dtype)
        nothing = F.coalesce(F.isnan(value), F.lit(False)) if self.dtype in ("double", "float") else F.lit(False)
        found = [
            ("missing_value", raw.isNull() | nothing),
            ("wrong_type", raw.isNotNull() & value.isNull()),
        ]
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (value < F.lit(self.low))
        if self.high is not None:
            outside = outside | (value > F.lit(self.high))
        if self.low is not None or self.high is not None:
            found.append(("out_of_range", F.coalesce(outside & ~nothing, F.lit(False))))
        if self.allowed:
            found.append(("not_allowed", F.coalesce(~value.isin(*self.allowed), F.lit(False))))
        return found


def no_features(df: DataFrame) -> DataFrame:
    """Builder for contracts without engineered features."""
    return df


@dataclass(frozen=True)
class UseCase:
    """Everything the jobs need to know about one classification problem."""

    name: str
    target_column: str
    time_column: str
    feature_columns: tuple[str, ...]
    rules: tuple[ColumnRule, ...]
    feature_builder: Builder = no_features
    engineered_columns: tuple[str, ...] = ()
    key_column: str | None = None
    extra_check: Builder | None = None
    request_rules: tuple[ColumnRule, ...] = field(default=())

    def __post_init__(self) -> None:
        for label, value in (
            ("name", self.name),
            ("target_column", self.target_column),
            ("time_column", self.time_column),
            ("feature_columns", self.feature_columns),
        ):
            if not value:
                raise ValueError(f"A use case needs a non-empty {label}.")
        clash = {self.target_column, self.time_column} & set(self.feature_columns)
        if clash:
            raise ValueError(f"Target and time cannot be features: {sorted(clash)}.")

    @property
    def feature_rules(self) -> tuple[ColumnRule, ...]:
        """Rules of the feature columns: what a scoring request must satisfy."""
        if self.request_rules:
            return self.request_rules
        return tuple(rule for rule in self.rules if rule.name in self.feature_columns)

    def names_out(self, names_in: Sequence[str]) -> list[str]:
        """Input names followed by the engineered ones."""
        return [*names_in, *self.engineered_columns]


_REGISTRY: dict[str, UseCase] = {}


def register_use_case(use_case: UseCase) -> UseCase:
    _REGISTRY[use_case.name] = use_case
    return use_case


def get_use_case(name: str) -> UseCase:
    if name not in _REGISTRY:
        known = ", ".join(sorted(_REGISTRY))
        raise ValueError(f"No use case named {name!r}; known ones: {known}.")
    return _REGISTRY[name]


def _churn() -> UseCase:
    from cohorta.functions.features import ENGINEERED, engineer

    # Column order, bounds and category lists of the churn contract.
    rules = (
        ColumnRule("customerid", "bigint", required=False),
        ColumnRule("age", "bigint", low=18, high=115),
        ColumnRule("tenure", "bigint", low=0),
        ColumnRule("usage_frequency", "bigint", low=0),
        ColumnRule("support_calls", "bigint", low=0),
        ColumnRule("payment_delay", "bigint", low=0),
        ColumnRule("last_interaction", "bigint", low=0),
        ColumnRule("total_spend", "double", low=0),
        ColumnRule("gender", "string", allowed=("Female", "Male")),
        ColumnRule("subscription_type", "string", allowed=("Basic", "Standard", "Premium")),
        ColumnRule("contract_length", "string", allowed=("Annual", "Monthly", "Quarterly")),
        ColumnRule("churn", "bigint", required=False, allowed=(0, 1)),
        ColumnRule("reference_date", "timestamp_ntz", required=False),
    )
    features = tuple(r.name for r in rules if r.name not in {"customerid", "churn", "reference_date"})
    return UseCase(
        name="churn",
        target_column="churn",
        time_column="reference_date",
        feature_columns=features,
        rules=rules,
        feature_builder=engineer,
        engineered_columns=ENGINEERED,
        key_column="customerid",
    )


CHURN = register_use_case(_churn())
