"""Design and calibration weights from the population frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import exact_sum, is_in, truthy
from tallyworks.functions.joins import by_merge
from tallyworks.settings import SurveySettings

CELL_PERIOD = (c.PERIOD, c.CELL)


def is_sampled(population: DataFrame, sample: DataFrame) -> DataFrame:
    """Population units, flagged where the sample holds them in that month."""
    picked = sample.select(*c.UNIT).withColumn("is_sampled", F.lit(True))
    return (population.join(by_merge(picked), list(c.UNIT), "left")
            .withColumn("is_sampled", truthy("is_sampled")))


def sampled_units(population: DataFrame, sample: DataFrame) -> DataFrame:
    """Sampled units with the cell and auxiliary of the population frame."""
    return sample.select(*c.UNIT).join(by_merge(population), list(c.UNIT))


def marked_population(population: DataFrame, sample: DataFrame) -> DataFrame:
    """Population units with the times the sample holds them in that month."""
    drawn = sample.groupBy(*c.UNIT).agg(F.count("*").alias("_drawn"))
    return population.join(by_merge(drawn), list(c.UNIT), "left").select(
        *c.UNIT, c.CELL, c.AUXILIARY, F.coalesce("_drawn", F.lit(0)).alias("_drawn"))


def cell_counts(marked: DataFrame) -> DataFrame:
    """Units and turnover of frame and sample per (period, cell), of marked units.

    One pass: frame and sample are conditional sums of one aggregate, partly added up before
    the shuffle.
    """
    drawn, turnover = F.col("_drawn"), F.col(c.AUXILIARY)
    return marked.groupBy(*CELL_PERIOD).agg(
        exact_sum(turnover).alias("population_turnover_sum"),
        F.count("*").alias("population_count"),
        exact_sum(F.when(drawn > 0, drawn * turnover)).alias("sample_turnover_sum"),
        F.sum("_drawn").alias("sample_count"))


def population_counts(population: DataFrame, sample: DataFrame) -> DataFrame:
    """Units and turnover of frame and sample per (period, cell)."""
    return cell_counts(marked_population(population, sample))


def design_weight(counts: DataFrame, settings: SurveySettings) -> DataFrame:
    """Population units per sampled unit; strata that are not sampled weigh 1."""
    weight = F.try_divide(F.col("population_count").cast("double"), F.col("sample_count"))
    return counts.withColumn(
        "design_weight",
        F.when(is_in(c.CELL, settings.non_sampled_strata), 1.0).otherwise(weight))


def calibration_factor(weighted: DataFrame) -> DataFrame:
    """Frame turnover per cell over the turnover its weighted sample stands for."""
    return weighted.withColumn("calibration_factor", F.try_divide(
        F.col("population_turnover_sum"),
        F.col("design_weight") * F.col("sample_turnover_sum")))


def cell_weights(population: DataFrame, sample: DataFrame,
                 settings: SurveySettings) -> DataFrame:
    return weigh_cells(population_counts(population, sample), settings)


def weigh_cells(counts: DataFrame, settings: SurveySettings) -> DataFrame:
    """Design weight, calibration factor and census mark of every counted cell."""
    weights = calibration_factor(design_weight(counts, settings))
    census = (F.col("design_weight") == 1) | is_in(c.CELL, settings.census_cells)
    return weights.select(
        *CELL_PERIOD, "design_weight", "calibration_factor",
        F.coalesce(census, F.lit(False)).alias("is_census"))


def estimate(panel: DataFrame, population: DataFrame, sample: DataFrame,
             settings: SurveySettings, keep=None) -> DataFrame:
    """The panel with the weights of each unit's population cell.

    ``keep`` stores the marked population by reference: it is read once, its cells are counted
    and its sampled units picked from what is stored, and those meet the panel where they lie.
    """
    marked = marked_population(population, sample)
    if keep is not None:
        marked = keep(marked.repartition(c.REFERENCE), "marked_population", by=c.REFERENCE)
    cells = weigh_cells(cell_counts(marked), settings)
    if keep is not None:
        cells = keep(cells, "cell_weights")
    units = (marked.where("_drawn > 0").select(*c.UNIT, c.CELL)
             .join(cells, list(CELL_PERIOD), "left").drop(c.CELL)
             .withColumn("is_sampled", F.lit(True)))
    return (panel.join(by_merge(units), list(c.UNIT), "left")
            .withColumn("is_sampled", truthy("is_sampled")))
