import pytest
from pyspark.sql import functions as F
from rows import same, table

from tallyworks import constants as c
from tallyworks.operators import outputs, regions
from tallyworks.settings import SurveySettings

WEIGHTS = "design_weight double, outlier_weight double, calibration_factor double"


def test_imputation_contribution(spark):
    lines = []
    for p in (202302, 202303):
        for ref, markers in ((1, "r r r fir"), (2, "r fir bir bir")):
            for q, v, m in zip((201, 202, 211, 221), (1000, 2000, 10000, 10000), markers.split()):
                lines.append(f"{ref},{p},{q},{v},2,2,2,{m}")
    lines.append("3,202303,201,5000,2,2,2,d")
    rows = table(spark, "reference long, period int, questioncode int, adjustedresponse double, "
                 + WEIGHTS + ", imputation_flags_adjustedresponse string", "\n".join(lines))
    out = [tuple(r) for r in outputs.imputation_contribution(
        rows, (201, 202, 211, 221), (202302,)).collect()]
    assert out == [(290, 112.0, 368.0, 256.0),
                   (201, 16.0, 16.0, 0.0), (211, 80.0, 160.0, 80.0),
                   (221, 0.0, 160.0, 160.0), (202, 16.0, 32.0, 16.0)]
    both = outputs.imputation_contribution(rows, (201, 202, 211, 221)).first()
    assert (both.questioncode, both.returned) == (290, 224.0)


def test_contribution_without_imputed_rows(spark):
    rows = table(spark, "reference long, period int, questioncode int, adjustedresponse double, "
                 + WEIGHTS + ", imputation_flags_adjustedresponse string",
                 "1,202302,201,1000,1,1,1,r")
    assert [tuple(r) for r in outputs.imputation_contribution(rows).collect()] == [
        (290, 1.0, 1.0, 0.0), (201, 1.0, 1.0, 0.0)]


def test_constructed(spark):
    rows = table(spark, "period int, reference long, questioncode int, adjustedresponse double, "
                        "imputation_flags_adjustedresponse string, derived_zeros boolean", """
202201,1,201,0,fir,false
202202,3,203,0,r,false
202202,4,204,20000,fimc,false
202202,5,204,2000,d,true
202202,6,11,7,,""")
    out = outputs.constructed(rows, SurveySettings(202202, 1))
    same(out, table(spark, "reference long, questioncode int, constructedresponse double, "
                           "imputationmarker string", """
4,204,20000,fimc
5,204,2000,fir
6,11,7,"""))
    assert outputs.constructed(rows, SurveySettings(202202, 1, state="live")) is None


def test_qa_suffix(spark):
    schema = ("reference long, period int, questioncode int, `290_flag` boolean, "
              "imputation_flags_adjustedresponse string")
    rows = table(spark, schema, """
1,202501,290,true,r
1,202501,211,false,fir
1,202501,212,false,bir
1,202501,221,false,c
1,202501,222,false,r
1,202501,231,false,
1,202502,211,false,fir
2,202501,290,false,r
2,202501,211,false,fir""")
    out = outputs.qa_suffix(rows)
    changed = {(1, 202501, 211): "fir_c", (1, 202501, 212): "bir_c"}
    for r in out.collect():
        key = (r.reference, r.period, r.questioncode)
        before = rows.where((F.col("reference") == key[0]) & (F.col("period") == key[1])
                            & (F.col("questioncode") == key[2])).first()
        assert r.imputation_flags_adjustedresponse == changed.get(
            key, before.imputation_flags_adjustedresponse)


def test_qa_output(spark):
    rows = table(spark, "reference long, questioncode int, adjustedresponse double, "
                        "adjustedresponse_pounds_thousands double, "
                        "imputation_flags_adjustedresponse string, period int, cell_no int, "
                        "frotover double, " + WEIGHTS + ", froempment int, frosic2007 string, "
                        "runame1 string, status string, `290_flag` boolean, "
                        "derived_zeros boolean", """
101,1,100,10,r,202301,1,100,1,1,1,3,100,A,N,false,false
101,2,200,20,i,202301,1,100,1,1,1,3,100,A,N,false,false
102,2,400,40,i,202301,2,200,2,2,2,4,200,B,Y,false,true
103,1,500,50,r,202302,3,200,1,1,1,5,200,C,N,false,true
104,1,600,60,c,202302,4,300,1,1,1,6,200,,Y,false,false
101,11,600,60,r,202301,1,100,1,1,1,3,100,A,N,false,false
101,290,600,60,r,202301,1,100,1,1,1,3,100,A,N,false,false""")
    settings = SurveySettings(202302, 2, components=(1, 2))
    out = {r.reference: r for r in outputs.qa_output(rows, settings).collect()}
    assert set(out) == {101, 102, 103}        # 104 lacks an identifying column
    assert out[102]["2__weighted_adjusted_value"] == 320
    assert out[102]["2__imputation_flags_adjustedresponse"] == "fir"
    assert out[102]["1__adjustedresponse"] is None
    assert (out[101]["1__adjustedresponse"], out[101]["2__adjustedresponse"]) == (10, 20)
    assert (out[102].design_weight, out[102].status) == (2.0, "Y")


def test_cord(spark):
    rows = table(spark, "classification string, questioncode int, cell_no int, period int, "
                        "adjustedresponse double, " + WEIGHTS, """
1,201,2341,202301,453.1,100,1,3.776
1,201,5831,202301,34,50,1,1.36
1,202,3492,202301,5763,800,1,3.602
1,202,4383,202301,345,100,1,3.45
2,202,4394,202302,38.2,20,1,3.82
2,202,2094,202301,6354,800,1,3.9675
3,201,3045,202301,658769,20000,1,6.586
3,290,3045,202301,658769,20000,1,6.586""")
    settings = SurveySettings(202302, 2, components=(201, 202), classifications=(1, 2, 3))
    out = outputs.cord(rows, settings.periods, settings)
    got = {(r.classification, r.questioncode, r.sizeband): (r["2023JAN"], r["2023FEB"])
           for r in out.collect()}
    known = {(1, 201, "A"): (173402.56, 0), (1, 202, "B"): (16606660.8, 0),
             (1, 202, "C"): (119025, 0), (2, 202, "D"): (20167596, 2918.48),
             (3, 201, "E"): (86773052680, 0)}
    assert len(got) == 42
    for k in (1, 2, 3):
        for q in (201, 202):
            for letter in "ABCDEFG":
                assert got[(k, q, letter)] == pytest.approx(known.get((k, q, letter), (0, 0)))


def test_sizeband(spark):
    lines = []
    for n, p in enumerate(range(202301, 202309)):
        for q, extra in ((40, 0), (49, 100)):
            cell = {40: (1, 101, 2, 102), 49: (11, 1001, 12, 1002)}[q]
            lines.append(f"{q},{cell[n % 4]},{p},{100 + 200 * (n // 2) + 50 * (n % 2) + extra},2,2,2")
    rows = table(spark, "questioncode int, cell_no int, period int, adjustedresponse double, "
                 + WEIGHTS, "\n".join(lines))
    out = outputs.sizeband(rows, (40, 49), ("2023Q2",)).collect()
    assert [tuple(r) for r in out] == [
        ("2023Q2", 1, 8400.0, 10000.0), ("2023Q2", 2, 2800.0, 3600.0)]
    for wrong in ("2023Q5", "", "23Q1"):
        with pytest.raises(ValueError, match="quarter"):
            outputs.sizeband(rows, (40, 49), (wrong,))


def test_standard_errors(spark):
    rows = table(spark, "period int, classification int, cell_no int, questioncode int, "
                        "adjustedresponse double", """
202401,1,1,202,2
202401,1,1,202,3
202401,1,1,202,2
202401,2,3,201,6
202401,2,3,201,2
202402,2,3,290,2""")
    out = {(r.period, r.questioncode): (r.sample_var, r.std_error, r["cov"])
           for r in outputs.standard_errors(rows).collect()}
    assert out == {(202401, 202): (0.333, 0.333, 24.744), (202401, 201): (8.0, 2.0, 70.711),
                   (202402, 290): (None, None, None)}


UNIT_REGIONS = "XX WW AA BB DC ED FE GF HH JG KJ"
RM = ("reference long, period int, questioncode int, adjustedresponse_pounds_thousands double, "
      "region string, design_weight double, calibration_factor double, outlier_weight double")


def rm_tables(spark):
    rows = table(spark, RM, """
1,202303,202,40,XX,0.01,1,1
1,202304,202,99990,XX,1,1,1
2,202304,212,20,WW,101,1,1
2,202304,290,20,WW,101,1,1""")
    units = table(spark, "reference long, period int, employment long, region string",
                  "\n".join([f"1,202304,1,{r}" for r in UNIT_REGIONS.split()]
                            + ["8888,202303,88,ZZ"]))
    return rows, units


def test_regional_shares(spark):
    rows, units = rm_tables(spark)
    employment = {r.reference: r for r in regions.rm_regional_employment(units).collect()}
    assert employment[1]["employment_Scotland"] == 1
    assert employment[8888]["employment_Scotland"] is None
    totals = {r.reference: r.total_employment
              for r in regions.rm_total_employment(units).collect()}
    assert totals == {1: 11, 8888: 88}
    split = regions.rm_turnover(regions.rm_rows(rows), regions.rm_percent(units))
    got = {(r.reference, r.period): r for r in split.collect()}
    assert got[(1, 202303)]["turnover_Scotland"] == pytest.approx(0.4)
    assert got[(1, 202304)]["turnover_Scotland"] == pytest.approx(9090)
    assert got[(2, 202304)]["turnover_Scotland"] is None
    assert got[(2, 202304)]["percentage_Wales"] == 1.0


def test_rm_output(spark):
    rows, units = rm_tables(spark)
    split = regions.rm_turnover(regions.rm_rows(rows), regions.rm_percent(units))
    out = regions.rm_output(split).collect()
    assert [r.region for r in out] == list(c.REGIONS)
    for r in out:
        assert r.quarter == "2023Q2" and r.public_housing == pytest.approx(9090)
        assert r.private_housing == (2020.0 if r.region == "Wales" else 0.0)
    first = {r.region: r.public_housing for r in regions.rm_output(split, "2023Q1").collect()}
    assert first["Scotland"] == pytest.approx(0.4) and first["Wales"] == 0.0


def test_quarterly_extract(spark):
    rows = table(spark, "period int, region string, questioncode int, adjustedresponse double, "
                 + WEIGHTS, """
202301,AA,202,200,1,1,1
202301,AA,202,100,1,1,1
202301,AA,222,200,1,1,1
202303,AA,222,50,1,1,1
202303,BA,243,200,1,1,1
202303,BA,210,20,1,1,1
202303,BB,222,0,1,1,1
202302,DC,232,200,1,1,1
202302,ED,212,300,1,1,1
202301,XX,210,200,1,1,1
202301,WW,222,450,1,1,1
202201,WW,222,100,1,1,1""")
    names = spark.createDataFrame(
        [(code, name) for name, codes in c.REGIONS.items() for code in codes],
        "region_code string, region_name string")
    out = [tuple(r) for r in regions.quarterly_extract(rows, names, "2023Q1").collect()]
    assert out == [
        ("2023Q1", "North East", 300.0, None, 250.0, None, None),
        ("2023Q1", "Yorkshire and The Humber", None, None, None, 200.0, None),
        ("2023Q1", "East Midlands", None, 300.0, None, None, None),
        ("2023Q1", "Wales", None, None, 450.0, None, None),
        ("2023Q1", "North West", None, None, 0.0, None, 200.0)]
