"""Plans and skew: what must hold when the data grows."""

import pytest
from pyspark.sql import functions as F
from rows import same

from tallyworks import constants as c
from tallyworks.operators import estimation, imputation, outliers, outputs, regions
from tallyworks.plans import stages
from tallyworks.settings import SurveySettings
from tallyworks.sources import order_survey as survey
from tallyworks.sources.store import RunStore

SF_DIR = "/root/testdata/sf0.001"
S = SurveySettings(202212, 12)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def panel_of(spark, units: int, hot_class: float = 1 / 3):
    """A synthetic staged panel; one class holds at least a third of the units."""
    months = [S.backdata_period, *S.periods]
    return (spark.range(units).withColumnRenamed("id", c.REFERENCE)
            .withColumn(c.PERIOD, F.explode(F.array(*[F.lit(p) for p in months])))
            .withColumn(c.QUESTION, F.lit(201))
            .withColumn(c.CELL, F.when(F.col(c.REFERENCE) < units * hot_class, 1)
                        .otherwise((F.col(c.REFERENCE) % 13 + 1) * 10 + 1).cast("int"))
            .withColumn(c.CLASS, F.floor(F.col(c.CELL) / 10).cast("double"))
            .withColumn(c.AUXILIARY, F.lit(10.0))
            .withColumn(c.MONTHLY_AUXILIARY, F.lit(5.0))
            .withColumn(c.TARGET, F.when(
                (F.col(c.REFERENCE) + F.col(c.PERIOD)) % 4 > 0,
                (F.col(c.REFERENCE) % 100).cast("double"))))


def test_links_of_a_hot_class_are_partly_summed_before_the_shuffle(spark):
    links = imputation.link_table(RunStore(spark).keep(panel_of(spark, 3000), "panel"))
    text = plan(links)
    assert "partial_sum" in text and "CartesianProduct" not in text
    # One shuffle for the windows, one for the partial sums.
    assert text.count("Exchange hashpartitioning") == 2
    total = links.agg(F.sum("flag_construction_matches_count")).first()[0]
    assert total == panel_of(spark, 3000).where(F.col(c.TARGET).isNotNull()).count()


def test_impute_and_trim_do_not_shuffle_a_kept_panel(spark):
    i = survey.inputs(spark, SF_DIR)
    store = RunStore(spark, "scale")
    staged = stages.stage_panel(i.responses, i.contributors, i.frame, survey.SETTINGS, i.manual)
    full = store.keep(staged.panel, "staged", by=c.REFERENCE)
    imputed = stages.impute_panel(full, survey.SETTINGS, None, keep=store.keep)
    assert "Exchange hashpartitioning" not in plan(imputed)
    for text in (plan(imputed), plan(staged.panel)):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Python" not in text


def test_staging_shuffles_each_table_once(spark):
    i = survey.inputs(spark, SF_DIR)
    responses = RunStore(spark).keep(i.responses, "r")
    contributors = RunStore(spark).keep(i.contributors, "c")
    frame = RunStore(spark).keep(i.frame, "f")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        staged = stages.stage_panel(responses, contributors, frame, survey.SETTINGS)
        text = plan(staged.panel)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Contributors and frame feed the lookup of statuses, the spine and the live values.
    kinds = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert all("hashpartitioning(reference" in line and "period" not in line.split("]")[0]
               for line in kinds)


def test_small_tables_are_broadcast_only_by_their_size(spark):
    panel = panel_of(spark, 500).withColumns({
        "design_weight": F.lit(2.0), "calibration_factor": F.lit(1.5),
        "is_census": F.lit(False), "l_value": F.lit(3.0)})
    keep = RunStore(spark).keep
    assert "BroadcastHashJoin" in plan(outliers.winsorise(panel, keep=keep))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        other = outliers.winsorise(panel, keep=RunStore(spark).keep)
        assert "BroadcastHashJoin" not in plan(other) and "SortMergeJoin" in plan(other)
        shuffled = other.select(*c.CELL_KEY, "outlier_weight").toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    broadcast = outliers.winsorise(panel, keep=RunStore(spark).keep).select(
        *c.CELL_KEY, "outlier_weight").toPandas()
    key = list(c.CELL_KEY)
    assert shuffled.sort_values(key).reset_index(drop=True).equals(
        broadcast.sort_values(key).reset_index(drop=True))


def test_same_result_whatever_the_partitioning(spark):
    """Sums do not depend on the order in which partial results arrive."""
    panel = panel_of(spark, 2000).withColumn(c.TARGET, F.col(c.TARGET) / 3 + 0.1)
    first = imputation.link_table(panel.repartition(3)).collect()
    second = imputation.link_table(panel.repartition(7, F.rand(1))).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))


def test_a_unit_with_a_third_of_the_local_units(spark):
    units = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias(c.REFERENCE),
        F.lit(202304).alias(c.PERIOD), F.lit(1).cast("bigint").alias("employment"),
        F.when(F.col("id") % 2 == 0, "XX").otherwise("WW").alias("region"))
    shares = regions.rm_percent(units)
    assert "partial_sum" in plan(shares)
    hot = shares.where(F.col(c.REFERENCE) == 1).first()
    assert hot["percentage_Scotland"] == pytest.approx(0.5, abs=1e-3)


def test_a_cell_with_most_of_the_population(spark):
    population = spark.range(20_000).select(
        F.col("id").alias(c.REFERENCE), F.lit(202201).alias(c.PERIOD),
        F.when(F.col("id") % 3 < 2, 1).otherwise((F.col("id") % 50 + 2)).cast("int")
        .alias(c.CELL), F.lit(2.0).alias(c.AUXILIARY))
    sample = population.where("reference % 4 = 0").select(*c.UNIT)
    counts = estimation.population_counts(population, sample)
    assert "partial_sum" in plan(counts)
    assert counts.agg(F.sum("population_count")).first()[0] == 20_000


def test_results_columns_are_pruned_at_the_scan(spark):
    store = RunStore(spark, "scan")
    names = outputs.results_columns()
    wide = spark.range(10).select(*[F.lit(1.0).alias(n) for n in names])
    kept = store.keep(wide.withColumns({
        c.PERIOD: F.lit(202304), c.QUESTION: F.lit(202), c.CELL: F.lit(11)}), "wide")
    table = outputs.sizeband(kept, (201, 202), ("2023Q2",))
    reads = [line for line in plan(table).splitlines() if "ReadSchema" in line]
    assert reads and all("runame1" not in line and "f_link" not in line for line in reads)
    assert any("In(questioncode" in line and "In(period" in line for line in reads)


def test_kept_and_direct_links_agree(spark):
    panel = panel_of(spark, 300)
    kept = imputation.ratio_of_means(panel, S, keep=RunStore(spark).keep)
    direct = imputation.ratio_of_means(panel, S)
    names = [*c.CELL_KEY, c.TARGET, c.MARKER]
    same(kept.select(*names), direct.select(*names))


def test_imputation_sorts_the_panel_once(spark):
    """Links, chains forward and backward and constructed values share one order of months."""
    full = RunStore(spark, "sorts").keep(panel_of(spark, 300), "panel", by=c.REFERENCE)
    links = RunStore(spark, "sorts").keep(imputation.link_table(full), "links")
    text = plan(imputation.ratio_of_means(full, S, keep=lambda df, name: links))
    assert text.count("Sort [") == 1 and "Exchange hashpartitioning" not in text
