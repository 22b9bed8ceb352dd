import pytest
from pyspark.sql import functions as F
from rows import same, table

from tallyworks.operators import panel, staging
from tallyworks.settings import SurveySettings

RESPONSES = "reference long, period int, questioncode int, adjustedresponse double"


def test_expected_questions(spark):
    contributors = table(spark, "reference long, period int", """
1,202502
1,202504
1,202503
1,202501
2,202502
2,202504
2,202503
2,202501
3,202502
3,202504
3,202503
3,202501
4,202503
5,202501
6,202501
6,202502""")
    schema = ("reference long, period int, questioncode int, target double, "
              "`290_flag` boolean, is_total_only_and_zero boolean")
    full = [(1, 202500 + m, q, 10000.0 + 100 * m + q, False, False)
            for m in range(1, 5) for q in (77, 88, 99)]
    full += [(1, 202500 + m, 290, 99999.0, False, False) for m in range(1, 5)]
    partly = [(2, 202501, 77, 20177.0), (2, 202501, 88, 20188.0), (2, 202501, 99, 20199.0),
              (2, 202501, 290, 99999.0), (2, 202503, 88, 20388.0), (2, 202503, 99, 20399.0),
              (2, 202503, 290, 99999.0), (3, 202501, 88, 30188.0), (3, 202501, 99, 30199.0),
              (3, 202501, 290, 99999.0)]
    total_only = [(5, 202501, 290, 23213.0, True, False), (6, 202501, 290, 0.0, True, True)]
    given = full + [(*row, False, False) for row in partly] + total_only
    created = [(2, 202502, q) for q in (77, 88, 99)] + [(2, 202504, q) for q in (88, 99)]
    created += [(3, m, q) for m in (202502, 202503, 202504) for q in (88, 99)]
    created += [(4, 202503, q) for q in (77, 88, 99)] + [(6, 202502, q) for q in (77, 88, 99)]
    expected = given + [(*row, None, False, False) for row in created]
    expected += [(5, 202501, q, None, True, False) for q in (77, 88, 99)]
    out = panel.expected_questions(
        spark.createDataFrame(given, schema), contributors, (77, 88, 99))
    assert len(expected) == 48
    same(out, spark.createDataFrame(expected, schema))


def test_answers_off_the_spine_or_list_vanish(spark):
    contributors = table(spark, "reference long, period int", "1,202501")
    rows = table(spark, RESPONSES + ", `290_flag` boolean, is_total_only_and_zero boolean", """
1,202501,290,50,true,false
1,202501,210,0,true,false
1,202412,201,7,false,false""")
    out = panel.expected_questions(rows, contributors, (201, 202))
    assert sorted(r.questioncode for r in out.collect()) == [201, 202, 290]


@pytest.mark.parametrize("statuses, flag, month, expected", [
    (("Clear", "Clear - overridden"), "skipped_question", 202501, True),
    (("Form sent out",), "derived_zeros", 202502, True),
])
def test_add_zero_questions(spark, statuses, flag, month, expected):
    rows = table(spark, "reference long, period int, questioncode int, status string, "
                        "adjustedresponse double, `290_flag` boolean", "\n".join(
        f"1,{p},{q},{s},{q}00,false" for p, s in ((202501, "Clear"), (202502, "Form sent out"))
        for q in (1, 2, 3, 7)))
    out = panel.add_zero_questions(rows, statuses, flag, range(1, 8))
    status = {202501: "Clear", 202502: "Form sent out"}[month]
    added = spark.createDataFrame(
        [(1, month, q, status, 0.0, False, True) for q in (4, 5, 6)],
        rows.withColumn(flag, F.lit(True)).schema)
    same(out, rows.withColumn(flag, F.lit(False)).union(added))


def test_flag_total_only(spark):
    responses = table(spark, RESPONSES, """
100,202401,290,10000
100,202401,201,0
100,202401,202,0
200,202401,290,10000
200,202401,221,100
200,202401,222,0
100,202301,290,0
100,202301,231,1500
300,202301,290,1000
500,202501,290,1000
600,202501,290,0""")
    contributors = table(spark, "reference long, period int, status string", """
200,202401,Clear - overridden
100,202401,Clear - overridden
300,202301,Clear - overridden
100,202301,Clear - overridden
500,202501,Form sent out
600,202501,Clear""")
    flagged = staging.flag_total_only(responses, contributors).where("`290_flag`")
    assert {(r.reference, r.period) for r in flagged.collect()} == {
        (100, 202401), (300, 202301), (600, 202501)}
    zero = staging.flag_total_zero(responses, contributors).where("is_total_only_and_zero")
    assert [r.reference for r in zero.collect()] == [600]


def test_total_zero_needs_every_value(spark):
    responses = table(spark, RESPONSES, """
1,202201,290,0
2,202201,290,
3,202201,290,0
3,202201,201,0""")
    contributors = table(spark, "reference long, period int, status string", """
1,202201,Clear
2,202201,Clear
3,202201,Clear""")
    rows = staging.flag_total_zero(responses, contributors).where("is_total_only_and_zero")
    assert [r.reference for r in rows.collect()] == [1]


def test_null_total_only_components(spark):
    rows = table(spark, RESPONSES + ", `290_flag` boolean, skipped_question boolean", """
100,202401,290,10000,true,false
100,202401,201,0,true,false
200,202401,290,10000,false,false
200,202401,222,0,false,false
100,202601,290,1000,true,true
100,202601,212,0,true,true
100,202601,211,1000,true,true""")
    out = staging.null_total_only_components(rows)
    changed = out.where("q290_component_set_null").collect()
    assert [(r.reference, r.questioncode, r.adjustedresponse) for r in changed] == [
        (100, 201, None)]
    assert out.where("adjustedresponse IS NULL").count() == 1


def test_frozen_split(spark):
    responses = table(spark, RESPONSES, """
1,202201,100,99
1,202201,101,99
1,202202,100,99
1,202202,101,99""")
    contributors = table(spark, "reference long, period int, statusencoded int", """
1,202201,210
1,202202,201""")
    kept, errors = staging.frozen_split(responses, contributors, SurveySettings(202202, 2))
    assert {r.period for r in kept.collect()} == {202201}
    assert [(r.period, r.live_adjustedresponse) for r in errors.collect()] == [
        (202202, 99.0)] * 2
    kept, errors = staging.frozen_split(
        responses, contributors, SurveySettings(202202, 2, state="live"))
    assert (kept.count(), errors.count()) == (4, 0)
    with pytest.raises(ValueError):
        SurveySettings(202202, 2, state="thawed")


def test_error_in_back_data_month_is_kept(spark):
    responses = table(spark, RESPONSES, "1,202112,100,99")
    contributors = table(spark, "reference long, period int, statusencoded int", "1,202112,201")
    kept, errors = staging.frozen_split(responses, contributors, SurveySettings(202202, 2))
    assert (kept.count(), errors.count()) == (1, 0)


def test_nonresponse_units_with_answers(spark):
    contributors = table(spark, "reference long, period int, status string", """
1,202201,Clear
1,202202,Excluded from Results
2,202203,Form sent out""")
    responses = table(spark, RESPONSES, """
1,202201,1,5
1,202202,1,6
2,202203,1,7""")
    found = staging.check_nonresponse_in_responses(responses, contributors).collect()
    assert {(r.reference, r.period) for r in found} == {(1, 202202), (2, 202203)}
    assert staging.exclude_nonresponse(responses, contributors).count() == 1
    report = staging.excluded_report(responses, contributors)
    assert report.columns == [
        "reference", "period", "questioncode", "status", "adjustedresponse"]
    assert report.count() == 2


def test_imputation_class(spark):
    values = [v for k in range(14) for v in range(10 * k + 1, 10 * k + 8)]
    rows = spark.createDataFrame([(v,) for v in values], "cell_no int")
    bands = SurveySettings(202501, 1).bands
    out = staging.imputation_class(rows, bands)
    assert {r.cell_no: r.imputation_class for r in out.collect()} == {
        v: float(v // 10) for v in values}
    with pytest.raises(ValueError):
        staging.imputation_class(rows, {0: (1, 7, 9)})
    for outside in (8, None):
        odd = spark.createDataFrame([(outside,)], "cell_no int")
        with pytest.raises(Exception, match="outside the bands"):
            staging.imputation_class(odd, bands).collect()


def test_masked_replace_wants_a_condition(spark):
    rows = table(spark, RESPONSES, "1,202201,1,5")
    with pytest.raises(ValueError):
        staging.masked_replace(rows, "adjustedresponse", F.col("questioncode") + 1)
    out = staging.masked_replace(rows, "adjustedresponse", F.col("questioncode") == 1)
    assert out.first().adjustedresponse is None


def test_enforce_types_reads_text_as_missing(spark):
    rows = table(spark, "a string, b string, period string", """
12,1.5,202201
x,y,z""")
    out = staging.enforce_types(rows, ["a", "b", "period"],
                                {"a": "int", "b": "float", "period": "date"})
    assert [tuple(r) for r in out.collect()] == [(12, 1.5, 202201), (None, None, None)]
