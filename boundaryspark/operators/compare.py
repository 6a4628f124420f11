"""Comparing two sources of boundaries on their overlap table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MATCH_THRESHOLD = 0.01  # fixed value: least equality of a match, least share of a relation
EQUALITY_DIGITS = 9     # equality is ranked on rounded values, then by id, so ties are stable


def best_matches(overlaps: DataFrame, left_units: DataFrame, left: str, right: str) -> DataFrame:
    """For each left unit the right unit of highest equality that has it as its own best; else null.

    Both rankings are aggregates, which combine before the shuffle.
    """
    rank = F.round("equality", EQUALITY_DIGITS)
    enough = overlaps.filter(F.col("equality") >= MATCH_THRESHOLD)
    of_left = enough.groupBy(left).agg(
        F.max_by(F.struct(right, "equality", "within", "contains"), F.struct(rank, -F.col(right))).alias("_b"))
    of_right = enough.groupBy(right).agg(F.max_by(left, F.struct(rank, -F.col(left))).alias("_back"))
    chosen = of_left.select(left, "_b.*").join(of_right, right).filter(F.col("_back") == F.col(left)).drop("_back")
    return left_units.select(left).join(chosen, left, "left")


def rank_relations(overlaps: DataFrame, metric: str, threshold: float, descending: bool = True, unit: str = "left_id",
                   other: str = "right_id") -> DataFrame:
    """Relations above the threshold with their `rank` among those of a unit; equal metrics go by the other unit's id."""
    value = F.round(metric, EQUALITY_DIGITS)
    order = Window.partitionBy(unit).orderBy(value.desc() if descending else value.asc(), other)
    return overlaps.filter(F.col(metric) >= threshold).withColumn("rank", F.row_number().over(order))


def significant_relations(overlaps: DataFrame, unit: str = "left_id", other: str = "right_id") -> DataFrame:
    """Relations of at least one percent of either unit, ranked for each unit by equality."""
    enough = overlaps.filter((F.col("within") >= MATCH_THRESHOLD) | (F.col("contains") >= MATCH_THRESHOLD))
    return rank_relations(enough, "equality", 0.0, unit=unit, other=other)


def total_agreement(overlaps: DataFrame, best: DataFrame, left_areas: DataFrame, right_areas: DataFrame, left: str) -> DataFrame:
    """Matched area against the union of both sources, in percent; one row."""
    matched = best.join(left_areas, left).agg(F.coalesce(F.sum(F.col("area") * F.col("within")), F.lit(0.0)).alias("v"))
    total = lambda df, c: df.agg(F.sum(c).alias("v"))
    sums = overlaps.agg(F.sum("isec").alias("isec_area"))
    out = sums.withColumn("left_area", total(left_areas, "area").scalar()) \
        .withColumn("right_area", total(right_areas, "area").scalar()).withColumn("match_area", matched.scalar())
    union = F.col("left_area") + F.col("right_area") - F.col("isec_area")
    return out.withColumn("union_area", union).withColumn(
        "percent", F.least(F.lit(100.0), F.col("match_area") / F.col("union_area") * 100))


def unmatched_units(right_units: DataFrame, best: DataFrame, right: str) -> DataFrame:
    return right_units.join(best.filter(F.col(right).isNotNull()).select(right), right, "left_anti")


def matched_units(left_units: DataFrame, best: DataFrame, left: str, right: str) -> DataFrame:
    return left_units.join(best.filter(F.col(right).isNotNull()).select(left), left, "left_semi")
