"""Making scores agree with observed rates before they are used as probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohorta.operators.cohorts import PROBABILITY, VERSION
from cohorta.operators.isotonic import IsotonicMap, fit_isotonic_map
from cohorta.operators.metrics import calibration_error_value, score_counts
from cohorta.session import materialize

# Hold-out parts and bins of the check whether calibration helps.
PARTS, BINS = 3, 10


def fit_isotonic(df: DataFrame, target: str, score: str) -> IsotonicMap:
    """Isotonic map of labelled rows; rows collapse to distinct scores first."""
    return fit_isotonic_map(score_counts(df, target, score))


def held_out_part(time: str) -> Column:
    """Part of a row, from a hash of its time and score; it does not depend on partitioning."""
    row = F.concat_ws("|", F.unix_micros(F.col(time).cast("timestamp")), F.floor(F.col(PROBABILITY) * 1_000_000_000))
    return F.pmod(F.conv(F.substring(F.md5(row.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(PARTS)).cast("int")


def calibration_gains(counts: DataFrame) -> DataFrame:
    """Calibration error of each version before and after maps, on the parts these were not fitted on.

    ``counts`` holds (version, part, score, pos, neg). One map is fitted for each version and part, on the other parts.
    """
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: p != F.col("part")))
    maps = fit_isotonic_map(counts.withColumn("held", others).drop("part"), [VERSION, "held"])
    mapped = maps.transform(counts.withColumn("held", F.col("part"))).where("calibrated IS NOT NULL")
    return mapped.groupBy(VERSION).agg(
        calibration_error_value(BINS).alias("before"), calibration_error_value(BINS, "calibrated").alias("after")
    )


def fit_calibrators(reference: DataFrame, target: str, time: str, mode: str, rows: str | None = None) -> IsotonicMap:
    """Isotonic map of every model version; versions that need none are left out of it.

    ``mode`` is ``always`` or ``auto``. Reference rows collapse once to (version, part, score) counts;
    every fit and check starts from those, all versions at once. ``rows`` names how many rows a row stands for.
    """
    parted = reference.withColumn("part", held_out_part(time))
    counts = materialize(score_counts(parted, target, PROBABILITY, [VERSION, "part"], rows), "score-counts")
    if mode != "always":
        helped = calibration_gains(counts).where("after < before").select(VERSION)
        counts = counts.join(helped, VERSION, "left_semi")
    return fit_isotonic_map(counts, [VERSION])


def apply_calibrators(rows: DataFrame, maps: IsotonicMap, score: str = PROBABILITY) -> DataFrame:
    """Scores mapped by the map of their version; those of other versions stay."""
    mapped = maps.transform(rows, "_calibrated", score)
    return mapped.withColumn(score, F.coalesce("_calibrated", score)).select(*rows.columns)
