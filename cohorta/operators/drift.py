"""Drift of model inputs and estimated performance, per model version and period.

Nothing loops over versions: the version is part of every group key. The distance and
estimator definitions follow the published methods; limits are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohorta.functions.scalars import numeric_columns, ratio, string_columns, to_long
from cohorta.operators.cohorts import PERIOD, PREDICTED, PROBABILITY, VERSION, report_keys
from cohorta.operators.isotonic import IsotonicMap
from cohorta.operators.joins import join_on_keys
from cohorta.operators.metrics import ranked, roc_auc_value, rows_where
from cohorta.operators.prefix import quantile_cuts
from cohorta.operators.profile import most_frequent
from cohorta.operators.ranks import grouped_percentiles
from cohorta.operators.scores import apply_calibrators
from cohorta.session import materialize

# Default limits of the drift methods.
JENSEN_SHANNON_LIMIT = 0.1
CATEGORY_LIMIT = 50
CATEGORY_SHARE = 0.1
KEPT_VARIANCE = 0.65
DEVIATIONS = 3.0
REFERENCE = "reference"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def feature_kinds(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """(continuous, categorical) features by column type."""
    return numeric_columns(df, features), string_columns(df, features)


def drift_population(analysis: DataFrame, errors: DataFrame | None, keep: Sequence[str]) -> DataFrame:
    """Monitored inputs: scored requests plus failed ones."""
    if errors is None:
        return analysis.select(*keep)
    return analysis.select(*keep).unionByName(errors.select(*keep))


def jensen_shannon(
    reference_bins: DataFrame, chunk_bins: DataFrame, chunk_keys: Sequence[str]
) -> DataFrame:
    """Base-2 Jensen-Shannon distance of each chunk's bin shares to the reference shares.

    Inputs are counts: (model_version, feature, bin, n) and (chunk keys, feature, bin, n). Bins
    only the reference has contribute half their share, bins only the chunk has half of theirs,
    so one left join is enough and no chunk x bin grid is built.
    """
    reference_total = reference_bins.groupBy(VERSION, "feature").agg(F.sum("n").alias("total"))
    reference_share = (
        join_on_keys(reference_bins, reference_total, [VERSION, "feature"], "inner")
        .select(VERSION, "feature", "bin", ratio(F.col("n"), F.col("total")).alias("p"))
    )
    per_chunk = [*chunk_keys, "feature"]
    chunk_total = chunk_bins.groupBy(*per_chunk).agg(F.sum("n").alias("total"))
    chunk_share = join_on_keys(chunk_bins, chunk_total, per_chunk, "inner").select(
        *per_chunk, "bin", ratio(F.col("n"), F.col("total")).alias("q")
    )
    matched = chunk_share.join(reference_share, [VERSION, "feature", "bin"], "left")
    p, q = F.col("p"), F.col("q")
    both = p * F.log2(2 * p / (p + q)) + q * F.log2(2 * q / (p + q))
    divergence = (
        F.sum(F.coalesce(both, q)) + 1 - F.coalesce(F.sum(p), F.lit(0.0))
    ) / 2
    return matched.groupBy(*per_chunk).agg(
        F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("distance")
    )


def continuous_bins(reference: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per (version, feature): low, high, bin count (Doane rule) and whether values act as categories.

    The distinct count decides only whether a number has few levels. A sketch rules out the
    features with many levels, so that the exact count never shuffles their values.
    """
    spark = reference.sparkSession
    long = to_long(reference, features, [VERSION], "double").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    n = F.col("rows").cast("double")
    spread = F.col("high") - F.col("low")
    skew_error = F.sqrt(6 * (n - 2) / ((n + 1) * (n + 3)))
    doane = F.when(
        (n > 2) & (F.col("deviation") > 0),
        1 + F.log2(n) + F.log2(1 + F.abs("skew") / skew_error),
    ).otherwise(F.lit(1.0))
    whole = [name for name in features if isinstance(reference.schema[name].dataType, _INTEGRAL)]
    by_width = F.when(F.col("feature").isin(*whole), F.least(doane, spread)) if whole else doane
    flat = spread == 0
    figures = []
    for name in features:
        value = F.col(name).cast("double")
        value = F.when(~F.isnan(value), value)
        figures.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.count(value).alias("rows"),
                F.approx_count_distinct(value).alias("sketch"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                F.stddev_pop(value).alias("deviation"),
                F.skewness(value).alias("skew"),
            )
        )
    stats = (
        reference.groupBy(VERSION)
        .agg(F.array(*figures).alias("figures"))
        .select(VERSION, F.inline("figures"))
        .where("rows > 0")
        .select(
            VERSION,
            "feature",
            "rows",
            "sketch",
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
            F.greatest(F.ceil(F.coalesce(by_width, doane)), F.lit(1)).cast("int").alias("bins"),
        )
        .collect()
    )
    few = sorted({row["feature"] for row in stats if row["sketch"] <= 2 * CATEGORY_LIMIT})
    levels = {}
    if few:
        counted = long.where(F.col("feature").isin(few)).groupBy(VERSION, "feature")
        for row in counted.agg(F.count_distinct("value").alias("levels")).collect():
            levels[row[VERSION], row["feature"]] = row["levels"]
    rows = []
    for row in stats:
        found = levels.get((row[VERSION], row["feature"]))
        as_category = found is not None and found <= CATEGORY_LIMIT and found / row["rows"] <= CATEGORY_SHARE
        rows.append((row[VERSION], row["feature"], row["low"], row["high"], row["bins"], as_category))
    return spark.createDataFrame(
        rows,
        f"{VERSION} int, feature string, low double, high double, bins int, as_category boolean",
    )


def _bin_number(value: Column, found: Column) -> Column:
    """Bin of a number by its ``continuous_bins`` row, a struct; -1 outside the reference range."""
    low, high, bins = found["low"], found["high"], found["bins"]
    index = F.least(F.floor((value - low) / (high - low) * bins), bins - 1)
    binned = F.when(value.between(low, high), index.cast("double")).otherwise(F.lit(-1.0))
    # + 0.0 turns a negative zero into zero, so equal values share a bin
    return F.when(found["as_category"], value + F.lit(0.0)).otherwise(binned)


def bin_counts(
    cohorts: DataFrame, continuous: Sequence[str], categorical: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """(keys, feature, bin, n) of numeric and categorical features: one pass over the rows.

    A bin is a struct of a number and a word, one of them null. The table of numeric ranges has
    one row per version and goes to all tasks: a shuffle would put all rows of a version into
    one. A row meets it once, before it is taken apart by feature. The counts are written out because shares, totals and
    reference bins all start from them; without that each would scan the rows again.
    """
    cells = [
        F.struct(F.lit(n).alias("feature"), F.lit(None).cast("double").alias("number"), F.col(n).alias("word"))
        for n in categorical
    ]
    rows = cohorts
    if continuous:
        ranges = continuous_bins(cohorts.where(F.col(PERIOD) == REFERENCE), continuous)
        row = F.struct("low", "high", "bins", "as_category")
        by_version = ranges.groupBy(VERSION).agg(
            *[F.max(F.when(F.col("feature") == n, row)).alias(f"_range_{i}") for i, n in enumerate(continuous)]
        )
        rows = rows.join(F.broadcast(by_version), VERSION, "left")
    for i, n in enumerate(continuous):
        value = F.col(n).cast("double")
        number = F.when(~F.isnan(value), _bin_number(value, F.col(f"_range_{i}")))
        cells.append(F.struct(F.lit(n).alias("feature"), number.alias("number"), F.lit(None).cast("string").alias("word")))
    placed = rows.select(*keys, F.inline(F.array(*cells))).where(F.col("number").isNotNull() | F.col("word").isNotNull())
    counted = placed.groupBy(*keys, "feature", "number", "word").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.select(*keys, "feature", F.struct("number", "word").alias("bin"), "n"), "drift-bins")


def feature_distances(
    cohorts: DataFrame, continuous: Sequence[str], categorical: Sequence[str], time_column: str
) -> DataFrame:
    """Distance per (period, version, time, feature) to the reference period.

    Numeric values outside the reference range form one more bin without reference mass. The
    reference counts are the sum of the reference chunks.
    """
    keys = report_keys(time_column)
    chunk_bins = bin_counts(cohorts, continuous, categorical, keys)
    reference_bins = (
        chunk_bins.where(F.col(PERIOD) == REFERENCE)
        .groupBy(VERSION, "feature", "bin")
        .agg(F.sum("n").alias("n"))
    )
    return jensen_shannon(reference_bins, chunk_bins, keys)


def categorical_distances(cohorts: DataFrame, features: Sequence[str], time_column: str) -> DataFrame:
    return feature_distances(cohorts, [], features, time_column)


def continuous_distances(cohorts: DataFrame, features: Sequence[str], time_column: str) -> DataFrame:
    return feature_distances(cohorts, features, [], time_column)


def with_alert(distances: DataFrame, limit: float = JENSEN_SHANNON_LIMIT) -> DataFrame:
    return distances.withColumn("alert", F.col("distance") > limit)


def univariate_drift(
    cohorts: DataFrame,
    features: Sequence[str],
    time_column: str,
    limit: float = JENSEN_SHANNON_LIMIT,
) -> DataFrame:
    """(report keys, feature, distance, alert) for every feature, numeric and categorical.

    ``cohorts`` holds the reference period and the monitored ones.
    """
    continuous, categorical = feature_kinds(cohorts, features)
    if not continuous and not categorical:
        raise ValueError("No numeric or text feature to monitor.")
    return with_alert(feature_distances(cohorts, continuous, categorical, time_column), limit)


def alert_counts(alerts: DataFrame, time_column: str, calculator: str) -> DataFrame:
    """Number of alerting features per report key; a missing alert counts as none."""
    fired = F.coalesce(F.col("alert"), F.lit(False)).cast("long")
    return alerts.groupBy(*report_keys(time_column)).agg(
        F.sum(fired).alias(f"{calculator}_alert_count")
    )


def estimated_performance(
    df: DataFrame,
    time_column: str,
    cuts: Sequence[float] | None = None,
    prefix: str = "cbpe",
    calibrators: IsotonicMap | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Precision, recall and ROC AUC expected from the scores alone, per report key.

    A score p stands for p positives and 1 - p negatives, so the realised formulas apply with
    fractional counts. Rows collapse to distinct scores before ``calibrators`` map them.
    """
    keys = report_keys(time_column)
    p, hit = F.col("score"), F.col(PREDICTED) == 1
    cells = df.groupBy(*keys, F.col(PROBABILITY).alias("score")).agg(
        rows_where(hit, rows).alias("hits"), rows_where(~hit, rows).alias("misses")
    )
    if calibrators is not None:
        cells = materialize(
            apply_calibrators(cells, calibrators, "score")
            .groupBy(*keys, "score")
            .agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses")),
            "calibrated-cells",
        )
        cuts = quantile_cuts(cells, "score")
    n = F.col("hits") + F.col("misses")
    soft = cells.withColumns(
        {"pos": n * p, "neg": n * (1 - p), "tp": F.col("hits") * p, "fp": F.col("hits") * (1 - p)}
    )
    if cuts is None:
        cuts = quantile_cuts(df, PROBABILITY)
    tp, fp, pos = F.sum("tp"), F.sum("fp"), F.sum("pos")
    return (
        ranked(soft, cuts, keys)
        .groupBy(*keys)
        .agg(
            ratio(tp, tp + fp).alias(f"{prefix}_precision"),
            ratio(tp, pos).alias(f"{prefix}_recall"),
            roc_auc_value().alias(f"{prefix}_roc_auc"),
        )
    )


def _surrogates(reference: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """(model_version, feature, number, word): median or most frequent value, one row each."""
    parts = []
    if numeric:
        long = to_long(reference, numeric, [VERSION], "double")
        medians = grouped_percentiles(long, "value", {"number": 0.5}, [VERSION, "feature"])
        parts.append(medians.withColumn("word", F.lit(None).cast("string")))
    if text:
        counts = (
            to_long(reference, text, [VERSION], "string")
            .where(F.col("value").isNotNull())
            .groupBy(VERSION, "feature", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        modes = counts.groupBy(VERSION, "feature").agg(most_frequent().alias("word"))
        parts.append(modes.select(VERSION, "feature", F.lit(None).cast("double").alias("number"), "word"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


class ReconstructionDrift:
    """PCA reconstruction error of the inputs, fitted per model version on the reference.

    What reaches the driver: per version one surrogate, mean and deviation per feature and the
    feature correlation matrix. Rows stay on the executors. Leave ``impute`` off for cohorts
    that a contract check found complete; it saves the search for medians.
    """

    def __init__(
        self,
        features: Sequence[str],
        time_column: str,
        kept_variance: float = KEPT_VARIANCE,
        deviations: float = DEVIATIONS,
        impute: bool = True,
    ):
        self.features = list(features)
        self.time_column = time_column
        self.kept_variance = kept_variance
        self.deviations = deviations
        self.impute = impute

    def _filled(self, df: DataFrame) -> DataFrame:
        if not self.impute:
            return df.withColumns({name: F.col(name).cast("double") for name in self.numeric})
        fills = self.surrogates  # a local table: one row per model version
        filled = {
            name: F.coalesce(
                F.col(name).cast("double") if name in self.numeric else F.col(name),
                F.col(f"_fill_{name}"),
            )
            for name in self.features
        }
        drop = [f"_fill_{name}" for name in self.features]
        return df.join(F.broadcast(fills), VERSION).withColumns(filled).drop(*drop)

    def _encoded(self, df: DataFrame) -> DataFrame:
        """Numbers as they are, categories as their row count in the reference (0 if unseen)."""
        encoded = self._filled(df)
        for name in self.text:
            counts = self.category_counts[name]
            encoded = (
                encoded.join(counts, [VERSION, name], "left")
                .withColumn(name, F.coalesce(F.col("_n"), F.lit(0.0)))
                .drop("_n")
            )
        return encoded

    def _fitted_surrogates(self, reference: DataFrame) -> DataFrame:
        """One row per model version with a fill column per feature."""
        found = _surrogates(reference, self.numeric, self.text).collect()
        by_key = {
            (row[VERSION], row["feature"]): row["number"] if row["feature"] in self.numeric else row["word"]
            for row in found
        }
        fields = [T.StructField(VERSION, T.IntegerType())] + [
            T.StructField(f"_fill_{n}", T.DoubleType() if n in self.numeric else T.StringType())
            for n in self.features
        ]
        versions = sorted({row[VERSION] for row in found})
        rows = [(v, *[by_key.get((v, n)) for n in self.features]) for v in versions]
        return reference.sparkSession.createDataFrame(rows, T.StructType(fields))

    def fit(self, reference: DataFrame) -> ReconstructionDrift:
        spark = reference.sparkSession
        self.numeric, self.text = feature_kinds(reference, self.features)
        self.features = [name for name in self.features if name in {*self.numeric, *self.text}]
        if self.impute:
            self.surrogates = self._fitted_surrogates(reference)
        filled = self._filled(reference)
        self.category_counts = {
            # written, so that its size is known to the planner and it is counted once
            name: materialize(
                filled.groupBy(VERSION, name).agg(F.count(F.lit(1)).cast("double").alias("_n")), "categories"
            )
            for name in self.text
        }
        width = len(self.features)
        encoded = self._encoded(reference)
        moments = [F.avg(n).alias(f"mean_{i}") for i, n in enumerate(self.features)]
        moments += [F.stddev_pop(n).alias(f"dev_{i}") for i, n in enumerate(self.features)]
        moments += [
            F.covar_pop(self.features[i], self.features[j]).alias(f"cov_{i}_{j}")
            for i in range(width)
            for j in range(i + 1)
        ]
        fitted = []
        for row in encoded.groupBy(VERSION).agg(*moments).collect():
            mean = [row[f"mean_{i}"] for i in range(width)]
            deviation = [row[f"dev_{i}"] or 1.0 for i in range(width)]
            shared = np.zeros((width, width))
            for i in range(width):
                for j in range(i + 1):
                    shared[i, j] = shared[j, i] = row[f"cov_{i}_{j}"] / (deviation[i] * deviation[j])
            strength, axes = np.linalg.eigh(shared)
            order = np.argsort(strength)[::-1]
            share = np.cumsum(strength[order]) / strength.sum()
            kept = min(int(np.searchsorted(share, self.kept_variance, side="right")) + 1, width)
            flat = np.zeros((width, width))
            flat[:kept] = axes[:, order[:kept]].T
            fitted.append((row[VERSION], mean, deviation, kept, flat.ravel().tolist()))
        self.parameters = fitted
        self.kept = max(item[3] for item in fitted)
        self.model = spark.createDataFrame(
            fitted,
            f"{VERSION} int, _mean array<double>, _dev array<double>, _kept int, _axes array<double>",
        )
        return self

    def row_errors(self, df: DataFrame) -> DataFrame:
        """Euclidean distance of each standardised row to its projection on the kept axes."""
        width = len(self.features)
        # one row a version, which goes to all tasks: a shuffle would put all rows of a version into one
        standard = self._encoded(df).join(F.broadcast(self.model), VERSION)
        z = {
            f"_z{i}": (F.col(n) - F.col("_mean")[i]) / F.col("_dev")[i]
            for i, n in enumerate(self.features)
        }
        whole = F.lit(0.0)
        for i in range(width):
            whole = whole + F.col(f"_z{i}") * F.col(f"_z{i}")
        projected = F.lit(0.0)
        for k in range(self.kept):
            along = F.lit(0.0)
            for i in range(width):
                along = along + F.col(f"_z{i}") * F.col("_axes")[k * width + i]
            projected = projected + along * along
        return standard.withColumns(z).withColumn(
            "reconstruction_error", F.sqrt(F.greatest(whole - projected, F.lit(0.0)))
        )

    def _chunks(self, df: DataFrame) -> DataFrame:
        return (
            self.row_errors(df)
            .groupBy(*report_keys(self.time_column))
            .agg(F.avg("reconstruction_error").alias("reconstruction_error"))
        )

    def calculate(self, cohorts: DataFrame) -> DataFrame:
        """(report keys, reconstruction_error, lower, upper, alert) of all periods.

        ``cohorts`` holds the reference period too: its chunk errors set the limits. The chunk
        errors, one row per report key, are written out so that the rows are read once.
        """
        chunks = materialize(self._chunks(cohorts), "reconstruction")
        value = F.col("reconstruction_error")
        middle, spread = F.avg(value), F.stddev_pop(value)
        limits = (
            chunks.where(F.col(PERIOD) == REFERENCE)
            .groupBy(VERSION)
            .agg(
                F.greatest(middle - self.deviations * spread, F.lit(0.0)).alias("lower"),
                (middle + self.deviations * spread).alias("upper"),
            )
        )
        return join_on_keys(chunks, limits, [VERSION], "left").withColumn(
            "alert", (value < F.col("lower")) | (value > F.col("upper"))
        )
