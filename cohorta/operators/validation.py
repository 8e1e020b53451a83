"""Contract checks: coerce, count violations, split good rows from bad ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.contracts import ColumnRule, UseCase
from cohorta.functions.scalars import require_columns


class ContractError(ValueError):
    """Rows or columns break the contract; ``failures`` maps (column, rule) to a row count."""

    def __init__(self, message: str, failures: dict[tuple[str, str], int] | None = None):
        super().__init__(message)
        self.failures = failures or {}


def present_rules(df: DataFrame, rules: Sequence[ColumnRule]) -> list[ColumnRule]:
    """Rules whose column exists; an absent required column is an error."""
    absent = [rule.name for rule in rules if rule.required and rule.name not in df.columns]
    if absent:
        raise ContractError(f"Required columns are absent: {', '.join(absent)}.")
    return [rule for rule in rules if rule.name in df.columns]


def typed(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Declared columns only, each in its contract type (null where the cast fails)."""
    return df.select(*[rule.typed() for rule in present_rules(df, rules)])


def _failures(df: DataFrame, rules: Sequence[ColumnRule]) -> list[tuple[str, str, Column]]:
    return [
        (rule.name, label, broken)
        for rule in present_rules(df, rules)
        for label, broken in rule.failures()
    ]


def violations(df: DataFrame, use_case: UseCase) -> DataFrame:
    """(column_name, rule, failed_rows) for every rule: one map-side aggregate over the table."""
    found = _failures(df, use_case.rules)
    counts = df.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(found)])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(label).alias("rule"),
                F.col(f"c{i}").alias("failed_rows"),
            )
            for i, (name, label, _) in enumerate(found)
        ]
    )
    return counts.select(F.inline(rows))


def validate(df: DataFrame, use_case: UseCase) -> DataFrame:
    """The typed table, or a ContractError naming every broken column and rule."""
    broken = violations(df, use_case).where("failed_rows > 0").collect()
    if broken:
        failures = {(r["column_name"], r["rule"]): r["failed_rows"] for r in broken}
        listing = ", ".join(f"{c}/{rule}: {n}" for (c, rule), n in sorted(failures.items()))
        raise ContractError(f"Contract {use_case.name!r} is broken ({listing}).", failures)
    checked = typed(df, use_case.rules)
    return use_case.extra_check(checked) if use_case.extra_check else checked


def with_reasons(df: DataFrame, rules: Sequence[ColumnRule], name: str = "reasons") -> DataFrame:
    """Add the list of ``column:rule`` labels each row breaks."""
    labels = [F.when(broken, F.lit(f"{c}:{label}")) for c, label, broken in _failures(df, rules)]
    return df.withColumn(name, F.array_compact(F.array(*labels)))


def quarantine(df: DataFrame, use_case: UseCase) -> tuple[DataFrame, DataFrame]:
    """(valid typed rows, invalid raw rows with ``reasons``); no action is run."""
    marked = with_reasons(df, use_case.rules)
    valid = typed(marked.where(F.size("reasons") == 0), use_case.rules)
    return valid, marked.where(F.size("reasons") > 0)


def select_features(df: DataFrame, columns: Sequence[str], label: str = "data") -> DataFrame:
    """The declared feature columns in their declared order."""
    require_columns(df, columns, label)
    return df.select(*columns)
