"""Registered model versions and their aliases as small append-only tables.

Every version and every change of aliases is one commit file, created only if it is absent. Two jobs that
register one model at the same time get two numbers, and changes of aliases have one order.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.operators.promotion import CHAMPION, FORMER_CHAMPION, current_aliases, metrics_by_alias
from cohorta.sources.commits import append_commit, numbered_commit

VERSIONS = "model_name string, model_version int, run_id string, use_case string, threshold double, model_path string"
ALIASES = "model_name string, alias string, model_version int, assigned_at bigint"
METRICS = "run_id string, metric string, value double"


class ModelRegistry:
    """Reads and appends the version, alias and metric tables below one folder.

    Only single records of one model reach the driver.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).json(f"{self.folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def versions(self) -> DataFrame:
        return self._read("versions", VERSIONS)

    def alias_history(self) -> DataFrame:
        return self._read("aliases", ALIASES)

    def metrics(self) -> DataFrame:
        return self._read("metrics", METRICS)

    def register(
        self,
        model_name: str,
        run_id: str,
        use_case: str,
        threshold: float,
        model_path: str,
        metrics: dict[str, float] | None = None,
    ) -> int:
        """Add the next version of a model and return its number.

        The metrics are there before the version is, so no reader sees a version without them.
        """
        if metrics:
            rows = [(run_id, name, float(value)) for name, value in metrics.items() if value is not None]
            append_commit(self.spark, f"{self.folder}/metrics", self.spark.createDataFrame(rows, METRICS))
        model = hashlib.md5(model_name.encode()).hexdigest()

        def last() -> tuple[int, None]:
            known = self.versions().where(F.col("model_name") == model_name)
            return known.agg(F.max("model_version")).first()[0] or 0, None

        def record(number: int, _) -> DataFrame:
            row = (model_name, number, run_id, use_case, threshold, model_path)
            return self.spark.createDataFrame([row], VERSIONS)

        return numbered_commit(self.spark, lambda n: f"{self.folder}/versions/{model}-{n:09d}.json", last, record)

    def _assign(self, model_name: str, version: int, alias: str, former: str | None = None) -> None:
        """Point an alias to a version and, in the same commit, ``former`` to the version it had."""
        held = (F.col("model_name") == model_name) & (F.col("alias") == alias)

        def last() -> tuple[int, int | None]:
            own = F.max_by("model_version", F.when(held, F.col("assigned_at")))
            row = self.alias_history().agg(F.max("assigned_at").alias("last"), own.alias("own")).first()
            return row["last"] or 0, row["own"]

        def records(number: int, before: int | None) -> DataFrame:
            rows = [(model_name, alias, version, number)]
            if former is not None and before is not None:
                rows.append((model_name, former, before, number))
            return self.spark.createDataFrame(rows, ALIASES)

        numbered_commit(self.spark, lambda n: f"{self.folder}/aliases/{n:012d}.json", last, records)

    def set_alias(self, model_name: str, alias: str, version: int) -> None:
        self._assign(model_name, version, alias)

    def version_of(self, model_name: str, alias: str) -> int | None:
        row = (
            current_aliases(self.alias_history())
            .where((F.col("model_name") == model_name) & (F.col("alias") == alias))
            .first()
        )
        return None if row is None else row["model_version"]

    def metrics_of(self, model_name: str, alias: str) -> dict[str, float]:
        found = metrics_by_alias(self.alias_history(), self.versions(), self.metrics()).where(
            (F.col("model_name") == model_name) & (F.col("alias") == alias)
        )
        return {row["metric"]: row["value"] for row in found.collect()}

    def resolve(
        self, model_name: str, use_case: str, alias: str | None = None, version: int | None = None
    ) -> dict:
        """Record of one version, chosen by exactly one of alias and version."""
        if (alias is None) == (version is None):
            raise ValueError("Choose a model by exactly one of alias and version.")
        wanted = version if version is not None else self.version_of(model_name, alias)
        row = (
            self.versions()
            .where((F.col("model_name") == model_name) & (F.col("model_version") == F.lit(wanted)))
            .first()
        )
        if row is None:
            raise LookupError(f"No version of {model_name!r} for alias {alias!r} / version {version!r}.")
        if row["use_case"] != use_case:
            raise ValueError(f"Run {row['run_id']} belongs to use case {row['use_case']!r}, not {use_case!r}.")
        return row.asDict()

    def promote(self, model_name: str, version: int, promote: bool) -> None:
        """Make a version the champion; a replaced champion stays known as the former one."""
        if not promote:
            raise ValueError("Only a candidate with a positive decision can be promoted.")
        self._assign(model_name, version, CHAMPION, FORMER_CHAMPION)
