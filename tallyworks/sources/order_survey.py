"""Survey tables derived from the order tables, for queries and benches.

Suppliers answer monthly; a line number stands for a question and line prices add up to the
answer.  Customers are local units and parts the population frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import int_array, period_of
from tallyworks.plans.stages import SurveyInputs
from tallyworks.settings import SurveySettings

FIRST_MONTH, LAST_MONTH = 199501, 200111
SETTINGS = SurveySettings(current_period=LAST_MONTH, revision_window=82)

_QUESTIONS = {1: 201, 2: 202, 3: 211, 4: 212, 5: 221, 6: 222}
_REGION_CODES = ("AA", "BA", "BB", "DC", "ED", "FE", "GF", "GG", "HH", "JG", "KJ", "WW", "XX")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _months(first: int, last: int = LAST_MONTH) -> Column:
    """One row per month of the calendar, without a join."""
    def index(period):
        return (period // 100) * 12 + period % 100
    return F.explode(F.sequence(F.lit(index(first)), F.lit(index(last))))


def _region(nation: Column) -> Column:
    codes = F.array(*[F.lit(code) for code in _REGION_CODES])
    return F.element_at(codes, (nation % 13 + 1).cast("int"))


def _question_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per unit and month with the pence of each question as columns.

    One shuffle, after map-side partial sums, whatever share of lines a supplier holds.
    """
    line = F.col("l_linenumber")
    month = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    pence = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    picks = {code: line == number for number, code in _QUESTIONS.items()}
    picks[232] = line > max(_QUESTIONS)
    return (_table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").cast("bigint").alias(c.REFERENCE),
                     month.cast("int").alias("m"))
            .agg(*[F.sum(F.when(pick, pence)).alias(str(code))
                   for code, pick in picks.items()]))


def _given(codes=(*_QUESTIONS.values(), 232)) -> Column:
    """The questions with lines, as an array of (questioncode, pence)."""
    pairs = F.array(*[F.struct(F.lit(code).alias(c.QUESTION), F.col(str(code)).alias("pence"))
                      for code in codes])
    return F.filter(pairs, lambda pair: pair["pence"].isNotNull())


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _question_sums(spark, sf_dir).select(
        c.REFERENCE, "m", F.explode(_given()).alias("_g"))
    return rows.select(c.REFERENCE, period_of(F.col("m")).alias(c.PERIOD), "m",
                       F.col("_g").getField(c.QUESTION).alias(c.QUESTION),
                       (F.col("_g.pence") / 100.0).alias("amount"))


def _unit_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, key = F.col("s_nationkey"), F.col("s_suppkey")
    turn = (key * 7 + F.col("m") * 3) % 20
    status = (F.when(turn == 0, "Form sent out").when(turn == 1, "Excluded from Results")
              .when(turn == 2, "Check needed").when(turn == 3, "Clear - overridden")
              .when(turn == 4, "Dormant (NIL5)").otherwise("Clear"))
    code = (F.when(turn <= 1, 100).when(turn == 2, 201).when(turn == 3, 211).otherwise(210))
    return _table(spark, sf_dir, "supplier").withColumn("m", _months(FIRST_MONTH)).select(
        key.cast("bigint").alias(c.REFERENCE), period_of(F.col("m")).alias(c.PERIOD), "m",
        status.alias("status"), code.alias("statusencoded"),
        (41000 + nation % 14 * 100).cast("string").alias(c.SIC),
        F.lit("0001").alias("formtype"),
        (nation % 14 * 10 + 1 + key % 7).cast("int").alias(c.CELL),
        (key % 90 + 10).cast("int").alias("froempment"),
        (F.floor(F.abs("s_acctbal")) + 1).cast("double").alias(c.AUXILIARY),
        _region(nation).alias("region"),
        F.col("s_name").alias("runame1"), F.col("s_name").alias("entname1"))


def contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unit_months(spark, sf_dir).select(*c.UNIT, "status", "statusencoded")


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unit_months(spark, sf_dir).drop("m", "status", "statusencoded")


def _unprocessed() -> Column:
    """Questions that are passed on as they come: a day, a word without a number, a mark that
    only some months have, and a routing answer."""
    m = F.col("m")
    answers = {11: ((F.col(c.REFERENCE) + m) % 28 + 1) * 100, 12: F.lit(None),
               146: F.when(m % 2 == 0, 100), 902: F.lit(100)}
    return F.array(*[F.struct(F.lit(code).alias(c.QUESTION), pence.cast("bigint").alias("pence"))
                     for code, pence in answers.items()])


def responses(spark: SparkSession, sf_dir: str, unprocessed: bool = False) -> DataFrame:
    """Answers: some units give the total alone, some a zero total, some no total."""
    kind = (F.col(c.REFERENCE) * 5 + F.col("m")) % 17
    units = _question_sums(spark, sf_dir).where(
        (F.col(c.REFERENCE) * 7 + F.col("m") * 3) % 20 != 0)
    given = _given()
    nothing = F.filter(given, lambda pair: F.lit(False))
    total = F.aggregate(given, F.lit(0).cast("bigint"), lambda so_far, pair: so_far + pair["pence"])
    total = F.array(F.struct(F.lit(c.TOTAL_QUESTION).alias(c.QUESTION),
                             F.when(kind == 1, F.lit(0)).otherwise(total).alias("pence")))
    lines = F.concat(F.when(kind > 1, given).otherwise(nothing),
                     F.when(kind != 2, total).otherwise(nothing))
    if unprocessed:
        lines = F.concat(lines, _unprocessed())
    return units.select(
        c.REFERENCE, period_of(F.col("m")).alias(c.PERIOD), F.explode(lines).alias("_l"),
    ).select(*c.UNIT, F.col("_l").getField(c.QUESTION).alias(c.QUESTION),
             (F.col("_l.pence") / 100.0).alias(c.TARGET))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses as a run reads them: text of the answer, marker in the back-data month."""
    backdata = F.col(c.PERIOD) == SETTINGS.backdata_period
    return responses(spark, sf_dir, unprocessed=True).select(
        "*", F.col(c.TARGET).cast("bigint").cast("string").alias("response"),
        F.when(backdata, "r").alias(c.MARKER))


def legacy_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in legacy columns.  Some units report their housing work as zero; routing
    answers (1 yes, 2 no) come along, 904 not from everybody."""
    given = responses(spark, sf_dir)
    month = F.floor(F.col(c.PERIOD) / 100) * 12 + F.col(c.PERIOD) % 100
    nothing = ((F.col(c.REFERENCE) + month) % 3 == 0) & F.col(c.QUESTION).isin(
        *c.ROUTES[902])
    rows = given.select(
        *c.UNIT, F.col(c.QUESTION).alias("question_no"),
        F.col(c.TARGET).alias("returned_value"),
        F.when(nothing, 0.0).otherwise(F.col(c.TARGET)).alias("adjusted_value"))
    reference = F.col(c.REFERENCE)
    routes = F.array(
        F.struct(F.lit(902).alias("q"), ((reference + month) % 2 + 1).alias("v")),
        F.struct(F.lit(903).alias("q"), ((reference + month) % 5 % 2 + 1).alias("v")),
        F.struct(F.lit(904).alias("q"),
                 F.when(month % 4 > 0, (reference + month) % 7 % 2 + 1).alias("v")))
    units = given.select(*c.UNIT).distinct().select(
        *c.UNIT, F.explode(routes).alias("_r")).where("_r.v IS NOT NULL")
    answers_to_routes = units.select(
        *c.UNIT, F.col("_r.q").alias("question_no"),
        F.col("_r.v").cast("double").alias("returned_value"),
        F.col("_r.v").cast("double").alias("adjusted_value"))
    return rows.unionByName(answers_to_routes).withColumn(
        "type", F.when(F.col("question_no") == 290, 2).when(
            F.col("question_no") == 211, 3).otherwise(1))


def legacy_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("status")
    return contributors(spark, sf_dir).select(
        *c.UNIT,
        F.when(status == "Check needed", "E").when(status == "Clear - overridden", "O")
        .otherwise("C").alias("error_mkr"),
        F.when(status == "Dormant (NIL5)", 5).otherwise(1).alias("response_type"))


def mixed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy answers in panel columns, without routing questions."""
    return (legacy_questions(spark, sf_dir)
            .where(~F.col("question_no").isin(*c.ROUTING_QUESTIONS))
            .select(*c.UNIT, F.col("question_no").alias(c.QUESTION),
                    F.col("adjusted_value").alias(c.TARGET)))


def local_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _table(spark, sf_dir, "supplier").agg(F.count("*") + 3).scalar()
    return _table(spark, sf_dir, "customer").withColumn("m", _months(FIRST_MONTH)).select(
        (F.col("c_custkey") % suppliers).cast("bigint").alias(c.REFERENCE),
        period_of(F.col("m")).alias(c.PERIOD),
        (F.floor(F.abs("c_acctbal")).cast("bigint") % 100).alias("employment"),
        _region(F.col("c_nationkey")).alias("region"))


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population frame of every published month.  A part in eleven is of a stratum that is not
    sampled by design."""
    key = F.col("p_partkey")
    cell = F.when(key % 11 == 0, c.NON_SAMPLED_STRATA[0]).otherwise(key % 14 * 10 + 1 + key % 7)
    return (_table(spark, sf_dir, "part")
            .withColumn("m", _months(SETTINGS.periods[0]))
            .select(key.cast("bigint").alias(c.REFERENCE), period_of(F.col("m")).alias(c.PERIOD),
                    cell.cast("int").alias(c.CELL),
                    F.floor("p_retailprice").cast("double").alias(c.AUXILIARY)))


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that were sent a form in a published month."""
    return contributors(spark, sf_dir).where(
        F.col(c.PERIOD) != SETTINGS.backdata_period).select(*c.UNIT)


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIC to published classification: at most 14 rows."""
    slot = F.col("n_nationkey") % 14
    return _table(spark, sf_dir, "nation").select(
        (41000 + slot * 100).cast("string").alias("sic_5_digit"),
        F.element_at(int_array(c.OUTPUT_CLASSIFICATIONS), (slot + 1).cast("int"))
        .alias("classification")).distinct()


def l_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L value per classification and component, some left out: at most 154 rows."""
    slot = F.col("n_nationkey") % 14
    q = F.col(c.QUESTION)
    return (_table(spark, sf_dir, "nation").select(slot.alias("k")).distinct()
            .withColumn(c.QUESTION, F.explode(int_array(c.COMPONENTS)))
            .where((F.col("k") + q) % 5 != 0)
            .select(F.element_at(int_array(c.OUTPUT_CLASSIFICATIONS),
                                 (F.col("k") + 1).cast("int")).alias("classification"), q,
                    ((F.col("k") * 37 + q) % 50 * 1000).cast("double").alias("l_value")))


def manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-set values for small units whose form did not come back."""
    return _unit_months(spark, sf_dir).where(
        (F.col("status") == "Form sent out") & (F.col("froempment") < 30)
        & (F.col(c.PERIOD) != SETTINGS.backdata_period)
    ).select(*c.UNIT, F.lit(201).alias(c.QUESTION), (F.col(c.AUXILIARY) * 10).alias(c.TARGET))


def manual_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-set outlier weights for large units whose form was overridden."""
    return _unit_months(spark, sf_dir).where(
        (F.col("status") == "Clear - overridden") & (F.col("froempment") >= 60)
    ).select(*c.UNIT, F.lit(201).alias(c.QUESTION), F.lit(0.5).alias("outlier_weight"))


def link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units to be left out of links: those whose form was overridden."""
    return contributors(spark, sf_dir).where(
        F.col("status") == "Clear - overridden").select(*c.UNIT)


def region_names(spark: SparkSession) -> DataFrame:
    rows = [(code, name) for name, codes in c.REGIONS.items() for code in codes]
    return spark.createDataFrame(rows, "region_code string, region_name string")


def inputs(spark: SparkSession, sf_dir: str, link_filtered: bool = False) -> SurveyInputs:
    return SurveyInputs(
        responses=answers(spark, sf_dir), contributors=contributors(spark, sf_dir),
        frame=frame(spark, sf_dir), population=population(spark, sf_dir),
        sample=sample(spark, sf_dir), classifications=classifications(spark, sf_dir),
        l_values=l_values(spark, sf_dir), manual=manual(spark, sf_dir),
        manual_weights=manual_weights(spark, sf_dir),
        link_filter=link_filter(spark, sf_dir) if link_filtered else None)
