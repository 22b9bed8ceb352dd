"""The jobs over files, from returns to written outputs."""

import json

import pytest

from tallyworks import constants as c
from tallyworks.plans import additional, jobs
from tallyworks.settings import SurveySettings
from tallyworks.sources import frames, snapshot

MONTHS = (202301, 202302, 202303)
SETTINGS = SurveySettings(202303, 3)


def colon(folder, prefix, month, columns, rows):
    (folder / f"{prefix}_{month}").write_text("".join(
        ":".join(f"{row.get(name, ''):>8}" for name in columns) + "\n" for row in rows))


def frame_row(ref):
    return {"reference": str(ref), "frosic2007": "41200", "cell_no": "11", "formtype": "1",
            "frotover": "120", "froempment": "3", "froempees": "3", "region": "XX",
            "runame1": "N", "entname1": "E", "ruref": str(ref), "employment": "4"}


@pytest.fixture
def folder(tmp_path):
    for month in (202212, *MONTHS):
        colon(tmp_path, "sample", month, frames.SAMPLE_COLUMNS, [frame_row(r) for r in (1, 2)])
        colon(tmp_path, "units", month, frames.LOCAL_UNIT_COLUMNS, [frame_row(1)])
    for month in MONTHS:
        colon(tmp_path, "universe", month, frames.POPULATION_COLUMNS,
              [frame_row(r) for r in (1, 2, 3, 4)])
    answers = {(1, 202301): 100, (1, 202302): 200, (2, 202301): 50}
    (tmp_path / "snapshot.json").write_text(json.dumps({
        "snapshot_id": "s",
        "contributors": [{"reference": str(r), "period": str(p),
                          "status": "Clear" if (r, p) in answers else "Form sent out",
                          "statusencoded": "210" if (r, p) in answers else "100"}
                         for r in (1, 2) for p in MONTHS],
        "responses": [{"reference": str(r), "period": str(p), "questioncode": str(q),
                       "response": str(v), "adjustedresponse": str(v)}
                      for (r, p), v in answers.items() for q in (202, 290)]
        + [{"reference": "1", "period": "202301", "questioncode": "11",
            "response": "31", "adjustedresponse": None}]}))
    (tmp_path / "qv_228_202212.csv").write_text(
        "period,reference,question_no,returned_value,adjusted_value,instance,type\n"
        "202212,1,202,80,80,0,1\n202212,1,290,80,80,0,1\n")
    (tmp_path / "cp_228_202212.csv").write_text(
        "period, reference,form_type,sic92,error_mkr,response_type\n202212,1,T,4,C,1\n")
    (tmp_path / "sic.csv").write_text("sic_5_digit,classification\n41200,41200\n")
    (tmp_path / "l.csv").write_text("classification,questioncode,l_value\n" + "".join(
        f"41200,{q},100000\n" for q in c.COMPONENTS))
    (tmp_path / "manual.csv").write_text(
        "reference,period,questioncode,adjustedresponse\n2,202303,202,7000\n")
    return tmp_path


def test_run_and_additional_outputs(spark, folder):
    paths = jobs.SurveyPaths(
        snapshot=f"{folder}/snapshot.json", frames=str(folder), sample_prefix="sample",
        population_prefix="universe", classifications=f"{folder}/sic.csv",
        l_values=f"{folder}/l.csv", back_questions=f"{folder}/qv_228_202212.csv",
        back_contributors=f"{folder}/cp_228_202212.csv", manual=f"{folder}/manual.csv")
    out = str(folder / "out")
    results = jobs.run_survey(spark, paths, SETTINGS, out, f"{out}/copy")
    rows = {(r.reference, r.period, r.questioncode): r for r in results.collect()}
    assert len(rows) == 2 * 3 * 12 + 1
    value = {k: (r.adjustedresponse, r.imputation_flags_adjustedresponse)
             for k, r in rows.items() if k[2] in (202, 290)}
    assert value[(1, 202301, 202)] == (100.0, "r") and value[(1, 202302, 202)] == (200.0, "r")
    assert value[(2, 202302, 202)] == (100.0, "fir")       # 50 times a link of 200 / 100
    assert value[(1, 202303, 202)] == (200.0, "fir")
    assert value[(2, 202303, 202)] == (7000.0, "mc")
    assert value[(2, 202303, 290)] == (7000.0, "d")
    assert rows[(1, 202303, 202)].design_weight == 2.0
    assert rows[(1, 202301, 11)].response == "31"
    # The unprocessed question of January has no marker and is not of the current month.
    copied = spark.read.option("header", True).csv(
        f"{out}/copy/imputes_and_constructed_output").collect()
    assert {r.imputationmarker for r in copied} == {"fir", "mc", "d"}
    counts = spark.read.option("header", True).csv(f"{out}/population_counts").collect()
    assert {(r.population_count, r.sample_count) for r in counts} == {("4", "2")}
    assert spark.read.option("header", True).csv(f"{out}/check_totals").count() == 0

    written = jobs.run_additional_outputs(
        spark, f"{out}/results", SETTINGS, f"{out}/more", f"{out}/more_copy",
        additional.OutputOptions(sizeband_quarters=("2023Q1",), repair_output=True),
        ("quarterly_by_sizeband_output", "r_m_output", "imputation_contribution_output"),
        str(folder), "units")
    band = spark.read.csv(written["quarterly_by_sizeband_output"]).collect()
    # (100 + 200 + 200 + 50 + 100 + 7000) pounds, in thousands, times a weight of 2.
    assert len(band) == 1 and float(band[0][3]) == pytest.approx(15.3)
    regions = {r[1]: float(r[2]) for r in spark.read.csv(written["r_m_output"]).collect()}
    assert regions["Scotland"] == pytest.approx(15.3) and regions["London"] == 0.0
    share = {r.questioncode: r for r in spark.read.option("header", True).csv(
        written["imputation_contribution_output"]).collect()}
    assert float(share["202"].returned) == pytest.approx(0.0007)


def test_legacy_conversion(spark, folder):
    for month in MONTHS:
        (folder / f"qv_228_{month}.csv").write_text(
            "period,reference,question_no,returned_value,adjusted_value,instance,type\n"
            + "".join(f"{month},{r},{q},{v},{v},0,1\n" for r in (1, 2) for q, v in (
                (201, 0), (202, 0), (290, 5), (221, 5), (902, 2), (903, 1))))
        (folder / f"cp_228_{month}.csv").write_text(
            "period, reference,form_type,sic92,error_mkr,response_type\n"
            f"{month},1,T,4,C,1\n{month},2,T,4,E,{5 if month == 202303 else 1}\n")
    out = str(folder / "converted")
    jobs.run_legacy_conversion(spark, str(folder), out, "id", 202303, 3, (2,),
                               "qv_228", "cp_228", "sample")
    units, answers = snapshot.read_snapshot_columnar(
        spark, out, lines=True, contributor_fields=(
            "reference", "period", "status", "statusencoded", "cellnumber", "formtype"))
    got = {(r.reference, r.period, r.questioncode) for r in answers.collect()}
    assert got == {(r, p, q) for r in (1, 2) for p in MONTHS for q in (290, 221)
                   if (r, p) != (2, 202303)}
    rows = {(r.reference, r.period): r for r in units.collect()}
    assert len(rows) == 6 and rows[(2, 202301)].status == "Check needed"
    assert (rows[(1, 202301)].cellnumber, rows[(1, 202301)].formtype) == (11, "01")
