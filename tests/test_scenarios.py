"""Small returns through staging and imputation: markers and flags of every row."""

import pytest

from tallyworks.plans import stages
from tallyworks.settings import SurveySettings, shift_period

COMPONENTS = (1, 2, 3, 4, 5, 6)
CLEAR, OVER = ("Clear", 210), ("Clear - overridden", 211)
OUT, ERROR = ("Form sent out", 100), ("Check needed", 201)
EXCLUDED = ("Excluded from Results", 100)

# name: (statuses by month, answered questions by month, markers of questions 1-6 and 290 by
# month, questions added as zeros by month, months with the total-only flag)
ANSWERED = "r r r r r r r"
CARRIED = "fir fir fir d d d d"
SCENARIOS = {
    "non response": (
        (CLEAR, OUT), ((1, 2, 3, 290), ()), (ANSWERED, CARRIED), ((4, 5, 6), (4, 5, 6)), ()),
    "in error, same questions": (
        (CLEAR, ERROR), ((1, 2, 3, 290), (1, 2, 3, 290)), (ANSWERED, CARRIED),
        ((4, 5, 6), (4, 5, 6)), ()),
    "in error, other questions": (
        (CLEAR, ERROR), ((1, 2, 3, 290), (4, 5, 6, 290)), (ANSWERED, CARRIED),
        ((4, 5, 6), (4, 5, 6)), ()),
    "excluded": (
        (CLEAR, EXCLUDED), ((1, 2, 3, 290), (1, 2, 3, 290)), (ANSWERED, CARRIED),
        ((4, 5, 6), (4, 5, 6)), ()),
    "paper form": (
        (CLEAR, CLEAR), ((1, 2, 290), (3, 4, 290)), (ANSWERED, ANSWERED),
        ((3, 4, 5, 6), (1, 2, 5, 6)), ()),
    "total only, then nothing": (
        (OVER, OUT), ((290,), ()), ("c c c c c c r", "fic fic fic fic fic fic d"),
        ((), ()), (0,)),
    "total only twice": (
        (OVER, OVER), ((290,), (290,)), ("c c c c c c r", "fic fic fic fic fic fic r"),
        ((), ()), (0, 1)),
    "total only, then answers": (
        (OVER, OVER), ((290,), (1, 2, 3, 290)), ("bir bir bir bir bir bir r", ANSWERED),
        ((), (4, 5, 6)), (0,)),
    "answers, then total only in error": (
        (OVER, ERROR), ((1, 2, 3, 290), (290,)), (ANSWERED, CARRIED),
        ((4, 5, 6), (4, 5, 6)), ()),
    "by hand over an earlier answer": (
        (CLEAR, OUT, OUT), ((1, 2, 290), (), ()),
        (ANSWERED, "mc fir d d d d d", "fimc fir d d d d d"),
        ((3, 4, 5, 6), (3, 4, 5, 6), (3, 4, 5, 6)), ()),
    "by hand for a question not answered": (
        (CLEAR, OUT, OUT), ((2, 3, 290), (), ()),
        (ANSWERED, "mc fir fir d d d d", "fimc fir fir d d d d"),
        ((1, 4, 5, 6), (4, 5, 6), (4, 5, 6)), ()),
}


def run(spark, statuses, answers, by_hand=False, value=99999.0):
    settings = SurveySettings(
        shift_period(202500, len(statuses)), len(statuses), components=COMPONENTS)
    months = settings.periods
    contributors = spark.createDataFrame(
        [(1, p, *s) for p, s in zip(months, statuses)],
        "reference long, period int, status string, statusencoded int")
    frame = spark.createDataFrame(
        [(1, p, "40000", "9999", 6, 999, 999.0, "ZZZ", "ZZ", "ZZ") for p in months],
        "reference long, period int, frosic2007 string, formtype string, cell_no int, "
        "froempment int, frotover double, region string, runame1 string, entname1 string")
    responses = spark.createDataFrame(
        [(1, p, q, value, str(value), None) for p, qs in zip(months, answers) for q in qs],
        "reference long, period int, questioncode int, adjustedresponse double, "
        "response string, imputation_flags_adjustedresponse string")
    manual = spark.createDataFrame(
        [(1, 202502, 1, 1000000.0)],
        "reference long, period int, questioncode int, adjustedresponse double",
    ) if by_hand else None
    staged = stages.stage_panel(responses, contributors, frame, settings, manual)
    rows = stages.impute_panel(staged.panel, settings, manual).collect()
    return months, {(r.period, r.questioncode): r for r in rows}, len(rows)


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenario(spark, name):
    statuses, answers, markers, zeros, total_only = SCENARIOS[name]
    months, rows, n = run(spark, statuses, answers, by_hand=name.startswith("by hand"))
    assert n == len(rows) == 7 * len(months)
    for at, p in enumerate(months):
        got = [rows[(p, q)] for q in (*COMPONENTS, 290)]
        assert " ".join(r.imputation_flags_adjustedresponse for r in got) == markers[at]
        for r in got:
            added = r.questioncode in zeros[at]
            assert r["290_flag"] == (at in total_only)
            if r.questioncode == 290:
                continue
            if added and r.imputation_flags_adjustedresponse == "r":
                assert r.skipped_question and not r.derived_zeros
            elif added:
                assert r.skipped_question is None and r.derived_zeros
            else:
                assert r.skipped_question is False and r.derived_zeros is False
            assert (r.is_total_only_and_zero is None) == added


def test_zero_total_only(spark):
    months, rows, _ = run(spark, (CLEAR, OUT), ((290,), ()), value=0.0)
    first = [rows[(months[0], q)] for q in (*COMPONENTS, 290)]
    assert all(r.imputation_flags_adjustedresponse == "r" for r in first)
    assert all(r.skipped_question and not r["290_flag"] for r in first[:6])
    assert first[6]["290_flag"] and first[6].is_total_only_and_zero
    second = [rows[(months[1], q)] for q in (*COMPONENTS, 290)]
    assert [r.imputation_flags_adjustedresponse for r in second] == ["fir"] * 6 + ["d"]


def test_components_add_up_to_the_total(spark):
    for name in ("total only, then nothing", "total only, then answers", "non response"):
        statuses, answers = SCENARIOS[name][:2]
        months, rows, _ = run(spark, statuses, answers)
        for p in months:
            if rows[(p, 290)].imputation_flags_adjustedresponse == "d" or rows[
                    (p, 290)]["290_flag"]:
                parts = sum(rows[(p, q)].adjustedresponse for q in COMPONENTS)
                assert parts == pytest.approx(rows[(p, 290)].adjustedresponse)
