import pytest
from rows import same, table

from tallyworks.operators import imputation, outliers, panel, reconcile
from tallyworks.settings import SurveySettings, shift_period

UNIT = "period int, reference long, questioncode int, adjustedresponse double"


def test_rescale_total_only(spark):
    rows = table(spark, UNIT + ", `290_flag` boolean", """
202401,100,290,10000,true
202401,100,201,50,true
202401,100,202,2000,true
202401,100,211,450,true
202401,100,212,5500,true
202401,200,290,10000,false
202401,200,221,100,false
202201,300,290,100,true
202201,300,211,0,true
202101,400,290,0,true
202101,400,211,0,true""")
    out = {(r.reference, r.questioncode): r for r in
           reconcile.rescale_total_only(rows).collect()}
    values = {key: row.adjustedresponse for key, row in out.items()}
    assert values[(100, 201)] == 62.5 and values[(100, 202)] == 2500
    assert values[(100, 211)] == 562.5 and values[(100, 212)] == 6875
    assert values[(200, 221)] == 100 and out[(100, 201)].adjustedresponse_pre_rescale == 50
    assert {key[0] for key, row in out.items() if row.failed_rescale} == {300}


def test_create_and_derive_total(spark):
    schema = UNIT + (", imputation_flags_adjustedresponse string, froempment int, "
                     "frotover double, status string, `290_flag` boolean")
    rows = table(spark, schema, """
202203,1,201,30,fir,100,50,clear,false
202203,1,221,30,fir,100,50,clear,false
202203,1,222,30,fir,100,50,clear,false
202203,2,201,40,fir,10,60,clear,false
202206,2,201,60,r,400,70,clear,false
202209,3,290,180,r,500,100,clear,false
202209,3,221,60,r,500,100,clear,false""")
    out = panel.create_total(rows)
    added = table(spark, schema, """
202203,1,290,0,d_create,100,50,clear,false
202203,2,290,0,d_create,10,60,clear,false
202206,2,290,0,d_create,400,70,clear,false""")
    same(out, rows.union(added))
    totals = {(r.period, r.reference): (r.adjustedresponse, r.imputation_flags_adjustedresponse)
              for r in reconcile.derive_total(out).where("questioncode = 290").collect()}
    assert totals == {(202203, 1): (90.0, "d"), (202203, 2): (40.0, "d"),
                      (202206, 2): (0.0, "d"), (202209, 3): (180.0, "r")}


def test_check_totals(spark):
    rows = table(spark, UNIT + ", failed_rescale boolean", """
202203,1,290,90,false
202203,1,201,30,false
202203,1,221,60,false
202206,2,290,200,false
202206,2,201,180,false
202209,1,290,100,true
202209,1,211,0,true
202212,1,290,5,false""")
    found = reconcile.check_totals(rows).collect()
    assert sorted(tuple(r) for r in found) == [
        (202206, 2, 200.0, 180.0, False), (202209, 1, 100.0, 0.0, True)]


def test_r_before_d(spark):
    series = {1: "r d", 2: "r d d", 3: "fir fir", 5: "r d d d", 6: "r d", 7: "fir d",
              8: "d r", 9: "d d r d", 10: "r fir d", 11: "r d fir d", 12: "fir d r d"}
    data = [(ref, 202601 + k, 200, m) for ref, text in series.items()
            for k, m in reversed(list(enumerate(text.split())))]
    data += [(4, 202601, 290, "d"), (4, 202602, 290, "d")]
    rows = spark.createDataFrame(
        data, "reference long, period int, questioncode int, "
              "imputation_flags_adjustedresponse string")
    assert {r.reference for r in reconcile.check_r_before_d(rows).collect()} == {
        7, 8, 9, 10, 11, 12}
    top = reconcile.check_r_before_d_top5(rows).collect()
    assert [r.reference for r in top] == [7, 8, 9, 10, 11]


def test_total_outlier_weight(spark):
    rows = table(spark, "reference long, period int, questioncode int, "
                        "adjustedresponse double, outlier_weight double", """
1,202201,201,4,0.5
1,202201,202,5,0.2
1,202201,290,9,
2,202202,212,10,0.9
2,202202,211,15,0.9
2,202202,290,25,
3,202202,221,30,1
3,202202,222,45,1
3,202202,-1,100,0.5
3,202202,290,75,
4,202201,211,0,1
4,202201,290,0,""")
    out = outliers.total_outlier_weight(rows).where("questioncode = 290").collect()
    weights = {r.reference: r.outlier_weight for r in out}
    assert weights == pytest.approx({1: 3 / 9, 2: 0.9, 3: 1.0, 4: 1.0})


def test_winsorise_trims_above_the_threshold(spark):
    schema = ("reference long, period int, questioncode int, cell_no int, "
              "adjustedresponse double, frotover double, design_weight double, "
              "calibration_factor double, is_census boolean, l_value double")
    rows = table(spark, schema, """
1,202201,201,1,100,10,2,2,false,30
2,202201,201,1,20,10,2,2,false,30
3,202201,201,1,0,10,2,2,false,
4,202201,201,1,40,10,2,2,false,
5,202201,201,2,500,10,1,1,true,
6,202201,290,1,160,10,2,2,false,30""")
    out = {r.reference: r for r in outliers.winsorise(rows).collect()}
    # The ratio is (100 + 20 + 0 + 40) / 40 = 4, the prediction 40, the threshold 40 + 30 / 3.
    assert out[1].ratio_estimation_treshold == pytest.approx(50)
    assert out[1].new_target_variable == pytest.approx(100 / 4 + 3 / 4 * 50)
    assert out[1].outlier_weight == pytest.approx(0.625)
    assert out[2].outlier_weight == 1.0
    assert out[3].outlier_weight == 1.0          # zero needs no L value
    assert out[4].outlier_weight is None         # no L value
    assert out[5].nw_ag_flag and out[5].outlier_weight == 1.0
    assert out[6].outlier_weight is None         # totals are derived later


def brute_force(rows, manual, settings):
    """Ratio-of-means over dictionaries, month by month."""
    value = {(r["ref"], r["p"]): r["y"] for r in rows}
    aux = {(r["ref"], r["p"]): r["x"] for r in rows}
    cls = {(r["ref"], r["p"]): r["cls"] for r in rows}

    def link(period, group, other):
        pairs = [(value[k], value[(k[0], other)]) for k in value
                 if k[1] == period and cls[k] == group and value[k] is not None
                 and value.get((k[0], other)) is not None]
        bottom = sum(b for _, b in pairs)
        return sum(a for a, _ in pairs) / bottom if bottom else 1.0

    def construction(period, group):
        ks = [k for k in value if k[1] == period and cls[k] == group and value[k] is not None]
        bottom = sum(aux[k] for k in ks)
        return sum(value[k] for k in ks) / bottom if bottom else 1.0

    out = {}
    for ref in {k[0] for k in value}:
        months = sorted(p for r, p in value if r == ref)
        last, kind = None, None
        for at, p in enumerate(months):
            k = (ref, p)
            forward = link(p, cls[k], shift_period(p, -1))
            if value[k] is not None:
                last, kind = value[k], "fir"
                out[k] = (value[k], "r")
                continue
            if k in manual:
                last, kind = manual[k], "fimc"
                out[k] = (manual[k], "mc")
                continue
            later = [q for q in months[at + 1:] if value[(ref, q)] is not None]
            if last is not None and kind != "fic":
                last *= forward
                out[k] = (last, kind)
            elif later:
                amount = value[(ref, later[0])]
                for q in reversed([q for q in months[at:] if q < later[0]]):
                    amount *= link(q, cls[(ref, q)], shift_period(q, 1))
                out[k] = (amount, "bir")
            elif p != settings.backdata_period:
                if last is None:
                    last, kind = aux[k] * construction(p, cls[k]), "fic"
                    out[k] = (last, "c")
                else:
                    last *= forward
                    out[k] = (last, "fic")
    return out


def test_chains_against_brute_force(spark):
    """Gaps, several classes, zero links, all markers."""
    settings = SurveySettings(202212, 12)
    months = [settings.backdata_period, *settings.periods]
    rows, manual = [], {}
    for ref in range(1, 41):
        for n, p in enumerate(months):
            if (ref * 7 + n * 5) % 23 == 0:
                continue                                     # month off the panel
            y = None
            if ref % 10 and (ref * ref + n * n * 3) % 7 < 4 and not (ref % 5 == 1 and n < 6):
                y = float((ref * 31 + n * 17) % 50 * (0 if ref % 13 == 0 else 1))
            rows.append({"ref": ref, "p": p, "y": y, "x": 10.0 + ref,
                         "cls": (ref + (n > 8)) % 3})
            if y is None and (ref + n) % 29 == 0 and n:
                manual[(ref, p)] = 777.0 + ref
    columns = ("reference long, period int, questioncode int, adjustedresponse double, "
               "converted_frotover double, imputation_class double")
    panel_rows = spark.createDataFrame(
        [(r["ref"], r["p"], 201, r["y"], r["x"], float(r["cls"])) for r in rows], columns)
    by_hand = spark.createDataFrame(
        [(*k, 201, v) for k, v in manual.items()],
        "reference long, period int, questioncode int, adjustedresponse double")
    out = imputation.ratio_of_means(panel_rows, settings, by_hand)
    got = {(r.reference, r.period): (r.adjustedresponse, r.imputation_flags_adjustedresponse)
           for r in out.where("imputation_flags_adjustedresponse IS NOT NULL").collect()}
    want = brute_force(rows, manual, settings)
    assert got.keys() == want.keys()
    assert {v[1] for v in want.values()} == {"r", "mc", "fir", "fimc", "bir", "c", "fic"}
    for key, (amount, marker) in want.items():
        assert got[key][1] == marker, key
        assert got[key][0] == pytest.approx(amount, rel=1e-9, abs=1e-6), key


def test_imputed_back_data_starts_a_chain_but_no_link(spark):
    settings = SurveySettings(202202, 2)
    rows = table(spark, "reference long, period int, questioncode int, adjustedresponse double, "
                        "converted_frotover double, imputation_class double, "
                        "imputation_flags_adjustedresponse string", """
1,202112,201,50,1,0,c
1,202201,201,,1,0,
2,202112,201,10,1,0,r
2,202201,201,30,1,0,
3,202112,201,40,1,0,mc
3,202201,201,,1,0,""")
    out = {r.reference: r for r in imputation.ratio_of_means(rows, settings)
           .where("period = 202201").collect()}
    assert out[2].f_link_adjustedresponse == 3.0
    assert (out[1].adjustedresponse, out[1].imputation_flags_adjustedresponse) == (150.0, "fic")
    assert (out[3].adjustedresponse, out[3].imputation_flags_adjustedresponse) == (120.0, "fimc")


def test_link_filter_leaves_units_out(spark):
    rows = table(spark, "reference long, period int, questioncode int, adjustedresponse double, "
                        "converted_frotover double, imputation_class double", """
1,202201,201,10,1,0
1,202202,201,20,1,0
2,202201,201,10,1,0
2,202202,201,90,1,0""")
    listed = table(spark, "reference long", "2")
    links = {r.period: r for r in imputation.link_table(rows, listed).collect()}
    assert links[202202].f_link_adjustedresponse == 2.0
    assert links[202202].f_match_adjustedresponse_count == 1
    assert links[202201].default_link_f_match_adjustedresponse


def test_a_missing_link_leaves_a_chain_as_it_is(spark):
    """Chains start at the anchor, count its own link as 1 and skip links that are missing."""
    rows = table(spark, "reference long, period int, questioncode int, adjustedresponse double, "
                        "adjustedresponse_man double, f_link_adjustedresponse double, "
                        "b_link_adjustedresponse double", """
1,202201,201,,,3,5
1,202202,201,10,,9,9
1,202203,201,,,,2
1,202204,201,,,2,
1,202205,201,,7,9,4
1,202206,201,,,0.5,3
1,202207,201,100,,9,9
1,202208,201,,,3,
2,202201,201,,,,""")
    out = imputation.backward_impute(imputation.forward_impute(rows)).collect()
    got = {(r.reference, r.period % 100): (r.forward_value, r.forward_kind, r.backward_value)
           for r in out}
    assert got == {
        (1, 1): (None, None, 50.0), (1, 2): (10.0, "fir", 10.0), (1, 3): (10.0, "fir", 2400.0),
        (1, 4): (20.0, "fir", 1200.0), (1, 5): (7.0, "fimc", 1200.0), (1, 6): (3.5, "fimc", 300.0),
        (1, 7): (100.0, "fir", 100.0), (1, 8): (300.0, "fir", None), (2, 1): (None, None, None)}
