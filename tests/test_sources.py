import json

import pytest
from rows import same, table

from tallyworks.functions.expressions import exact_sum
from tallyworks.operators import estimation, legacy
from tallyworks.operators.staging import enforce_types
from tallyworks.settings import SurveySettings, shift_period
from tallyworks.sources import frames, sinks, snapshot
from tallyworks.sources.store import RunStore

CONTRIBUTORS = [("10000000000", "202303", "Clear", "210"),
                ("10000000001", "202303", "Form sent out", "100")]
RESPONSES = [("10000000000", "202303", "211", "99999", "99999"),
             ("10000000000", "202303", "290", None, "0.5"),
             ("10000000001", "202303", "11", "yes", None)]


def expected(spark):
    return (table(spark, "reference long, period int, status string, statusencoded int", """
10000000000,202303,Clear,210
10000000001,202303,Form sent out,100"""),
            table(spark, "reference long, period int, questioncode int, response string, "
                         "adjustedresponse double", """
10000000000,202303,211,99999,99999
10000000000,202303,290,,0.5
10000000001,202303,11,yes,"""))


def test_snapshot_document(spark, tmp_path):
    path = tmp_path / "snapshot.json"
    path.write_text(json.dumps({
        "snapshot_id": "x",
        "contributors": [{**dict(zip(snapshot.CONTRIBUTOR_FIELDS, r)), "lockedby": None}
                         for r in CONTRIBUTORS],
        "responses": [{**dict(zip(snapshot.RESPONSE_FIELDS, r)), "instance": 0}
                      for r in RESPONSES]}, indent=4))
    for got, want in zip(snapshot.read_snapshot_records(spark, str(path)), expected(spark)):
        same(got, want)


def test_snapshot_columns_with_nan(spark, tmp_path):
    path = tmp_path / "snapshot.json"
    part = {name: [r[i] for r in RESPONSES] for i, name in enumerate(snapshot.RESPONSE_FIELDS)}
    part["adjustedresponse"] = [99999, 0.5, float("nan")]
    part["questioncode"] = [211, 290, 11]
    path.write_text(json.dumps({
        "contributors": {name: [r[i] for r in CONTRIBUTORS]
                         for i, name in enumerate(snapshot.CONTRIBUTOR_FIELDS)},
        "responses": part}))
    for got, want in zip(snapshot.read_snapshot_columnar(spark, str(path)), expected(spark)):
        same(got, want)


@pytest.mark.parametrize("columnar", [True, False])
def test_written_snapshot_splits_into_bounded_objects(spark, columnar):
    units, answers = expected(spark)
    many = answers.unionByName(spark.range(1, 500).selectExpr(
        "id reference", "202303 period", "201 questioncode", "cast(null as string) response",
        "cast(id as double) adjustedresponse"))
    path = RunStore(spark, "snap").path("s")
    snapshot.write_snapshot(units, many, path, "id", columnar, rows_per_object=50)
    assert spark.read.text(path).count() > 10
    read = snapshot.read_snapshot_columnar if columnar else snapshot.read_snapshot_records
    for got, want in zip(read(spark, path, lines=True), (units, many)):
        same(got, want)


def colon_line(values, columns):
    return ":".join(f"{values.get(name, ''):>6}" for name in columns)


def test_frame_files_in_the_window(spark, tmp_path):
    for month in (202212, 202301, 202302, 202303):
        text = "\n".join(colon_line(
            {"reference": str(ref), "frosic2007": "40000", "cell_no": "6", "formtype": "0012",
             "frotover": "999.5", "froempment": "9", "region": "ZZZ", "runame1": 'A "B"',
             "entname1": "C"}, frames.SAMPLE_COLUMNS) for ref in (1, 2))
        (tmp_path / f"finalsel_dummy_{month}").write_text(text + "\n")
    (tmp_path / "universe_202303").write_text("1:2\n")
    out = frames.read_frame_window(
        spark, str(tmp_path), "finalsel", frames.SAMPLE_COLUMNS, 202303, 3, frames.SAMPLE_KEEP)
    rows = out.collect()
    assert sorted({r.period for r in rows}) == [202301, 202302, 202303] and len(rows) == 6
    assert (rows[0].formtype, rows[0].frotover, rows[0].cell_no) == ("0012", 999.5, 6)
    assert rows[0].runame1 == 'A "B"'
    assert frames.window_months(202302, 3) == [202212, 202301, 202302]


def test_column_lists():
    assert (len(frames.SAMPLE_COLUMNS), len(frames.POPULATION_COLUMNS),
            len(frames.LOCAL_UNIT_COLUMNS)) == (50, 30, 22)


def test_local_units(spark, tmp_path):
    line = colon_line({"ruref": "77", "employment": "5", "region": "XX"},
                      frames.LOCAL_UNIT_COLUMNS)
    (tmp_path / "ludets_202304").write_text(line + "\n")
    (tmp_path / "ludets_202303").write_text("")
    out = frames.read_local_units(spark, str(tmp_path), "ludets", 202304, 2)
    assert [tuple(r) for r in out.select(
        "reference", "period", "employment", "region").collect()] == [(77, 202304, 5, "XX")]


def test_csv_with_padded_header(spark, tmp_path):
    (tmp_path / "cp.csv").write_text("period, reference ,error_mkr, response_type\n"
                                     "202212, 5 , E ,1\n")
    out = frames.read_csv(spark, str(tmp_path / "cp.csv"),
                          ["period", " reference ", "error_mkr", " response_type"])
    assert tuple(out.first()) == (202212, 5, "E", 1)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "m.csv").write_text("questioncode,reference,period,adjustedresponse\n201,7,202301,5\n")
    names = ["reference", "period", "questioncode", "adjustedresponse"]
    assert tuple(frames.read_csv(spark, str(tmp_path / "m.csv"), names).first()) == (
        7, 202301, 201, 5.0)
    with pytest.raises(ValueError, match="no column missing"):
        frames.read_csv(spark, str(tmp_path / "m.csv"), [*names, "missing"])


def test_a_month_without_a_file_raises(spark, tmp_path):
    for month in (202301, 202303):
        (tmp_path / f"f_{month}").write_text("")
    with pytest.raises(FileNotFoundError, match="202302"):
        frames.read_frame_window(spark, str(tmp_path), "f", ("reference",), 202303, 3)


def test_nan_is_missing_and_infinity_raises(spark):
    rows = spark.createDataFrame([("NaN",), ("1.5",), ("x",), (None,)], "v string")
    assert [r.v for r in enforce_types(rows, ["v"], {"v": "float"}).collect()] == [
        None, 1.5, None, None]
    with pytest.raises(Exception, match="infinity in column v"):
        enforce_types(spark.createDataFrame([("inf",)], "v string"), ["v"],
                      {"v": "float"}).collect()


def test_a_broken_object_fails_the_read(spark, tmp_path):
    good = '{"contributors": [{"reference": "1", "period": "202301"}], "responses": []}'
    (tmp_path / "s.json").write_text(good + "\n" + good[:-9] + "\n")
    with pytest.raises(Exception):
        snapshot.read_snapshot_records(spark, str(tmp_path / "s.json"), lines=True)[0].collect()


def test_snapshot_keeps_all_rows_in_any_layout(spark, tmp_path):
    rows = spark.range(500).selectExpr(
        "id % 97 reference", "cast(202301 as int) period", "'Clear' status",
        "cast(210 as int) statusencoded")
    for parts in (1, 7):
        path = str(tmp_path / str(parts))
        snapshot.write_snapshot(rows.repartition(parts), rows.select(
            "reference", "period", rows.statusencoded.alias("questioncode"),
            rows.status.alias("response")).limit(0), path, "s", rows_per_object=20)
        back = snapshot.read_snapshot_columnar(spark, path, lines=True)[0]
        assert back.exceptAll(rows).count() == 0 and back.count() == 500


def test_sums_are_exact_or_raise(spark):
    def total(*values):
        rows = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
        return rows.agg(exact_sum(rows.v)).first()[0]
    assert total(1e-7, 2e-7) == 3e-7
    assert total(-1e-7) == -1e-7 and total(-2.5, 1.25) == -1.25
    assert total(0.1, 0.2, 0.3) == 0.6 and total(1e15, 1e15, 0.5) == 2e15 + 0.5
    for broken in (float("nan"), float("inf"), 1e19):
        with pytest.raises(Exception, match="cannot be added"):
            total(5.0, broken)
    with pytest.raises(Exception, match="(?i)overflow"):
        total(8e18, 8e18)


def test_contributors_are_kept_once(spark):
    contributors = spark.createDataFrame(
        [(1, 202301, "Clear", 210)] * 2, "reference long, period int, status string, statusencoded int")
    responses = spark.createDataFrame([], "reference long, period int, questioncode long, "
                                      "response string, adjustedresponse double")
    back = spark.createDataFrame([], "reference long, period int, question_no long, "
                                 "returned_value double, adjusted_value double, type long")
    units = spark.createDataFrame([(1, 202301, "C")] * 2, "reference long, period int, error_mkr string")
    assert legacy.append_back_data(responses, contributors, back, units)[1].count() == 1


def test_repeated_route_answers_are_reported(spark):
    rows = spark.createDataFrame([(1, 202301, 902), (1, 202301, 902), (1, 202301, 201),
                                  (2, 202301, 903)], "reference long, period int, questioncode int")
    assert [tuple(r) for r in legacy.repeated_routes(rows).collect()] == [(1, 202301, 902, 2)]


def test_store_leaves_nothing_and_saves_on_request(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 50 reference", "id v")
    found = []
    for buckets in (2, 9):
        store = RunStore(spark, "c", buckets, str(tmp_path / str(buckets)))
        kept = store.keep(rows.repartition("reference"), "rows", by="reference")
        found.append(sorted(map(tuple, kept.groupBy("reference").sum("v").collect())))
        table = store.tables[0]
        store.close()
        assert not spark.catalog.tableExists(table)
        assert spark.read.parquet(str(tmp_path / str(buckets) / "rows")).count() == 1000
    assert found[0] == found[1]


def test_by_period_sink(spark):
    rows = spark.range(100).selectExpr("cast(202300 + id % 2 + 1 as int) period", "id v")
    path = RunStore(spark, "sink").path("x")
    sinks.write_by_period(rows, path)
    back = spark.read.csv(path).groupBy("_period").count().collect()
    assert {(r[0], r[1]) for r in back} == {(202301, 50), (202302, 50)}


def test_store_needs_a_shared_folder(spark):
    store = RunStore(spark, "t")
    assert store.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = store.keep(spark.range(5), "r")
    assert kept.count() == 5
    with pytest.raises(Exception, match="exists"):
        store.keep(spark.range(5), "r")


def test_kept_by_reference_needs_no_shuffle(spark):
    from pyspark.sql import Window, functions as F
    rows = spark.range(1000).selectExpr("id % 50 reference", "id period", "id % 3 questioncode")
    kept = RunStore(spark, "b").keep(rows.repartition("reference"), "rows", by="reference")
    out = kept.withColumn("n", F.count("*").over(Window.partitionBy("reference", "period")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and out.count() == 1000


LEGACY = "period int, reference long, questioncode int, adjusted_value string"


def form(reference, housing, answer, rest="9"):
    lines = [f"202205,{reference},290,9999"]
    lines += [f"202205,{reference},{q},{answer}" for q in (902, 903, 904)]
    lines += [f"202205,{reference},{q},{v}" for q, v in zip((201, 202, 211, 212), housing)]
    lines += [f"202205,{reference},{q},{rest}" for q in (221, 222, 231, 232, 241, 242, 243)]
    return lines


@pytest.mark.parametrize("answer, no_values", [("2", (2,)), ("no", ("no", None)), ("", (2, None))])
def test_routing(spark, answer, no_values):
    lines = form(1, "0000", answer) + form(2, "9000", answer)
    out = legacy.routing(table(spark, LEGACY, "\n".join(lines)), no_values,
                         value="adjusted_value")
    left = {(r.reference, r.questioncode) for r in out.collect()}
    assert len(left) == 26 and not {(1, q) for q in (201, 202, 211, 212)} & left
    yes = table(spark, LEGACY, "\n".join(form(1, "0000", "1")))
    assert legacy.routing(yes, no_values, value="adjusted_value").count() == 15


def test_nil_contributors_and_status(spark):
    rows = table(spark, "reference long, period int, question_no int", """
1,202201,201
2,202201,201""")
    units = table(spark, "reference long, period int, error_mkr string, response_type int", """
1,202201,E,5
2,202201,O,1
3,202201,C,1""")
    assert [r.reference for r in legacy.drop_nil(rows, units).collect()] == [2]
    status = {r.reference: (r.status, r.statusencoded)
              for r in legacy.legacy_contributors(units).collect()}
    assert status == {1: ("Check needed", 201), 2: ("Clear - overridden", 211),
                      3: ("Clear", 210)}


def test_weights(spark):
    population = table(spark, "reference long, period int, cell_no int, frotover double", """
1,202201,1,10
2,202201,1,20
3,202201,1,30
4,202201,2,5
5,202201,5141,8
6,202201,5141,8""")
    sample = table(spark, "reference long, period int", """
1,202201
2,202201
4,202201
5,202201""")
    out = {r.cell_no: r for r in estimation.cell_weights(
        population, sample, SurveySettings(202201, 1)).collect()}
    assert out[1].design_weight == 1.5
    assert out[1].calibration_factor == pytest.approx(60 / (1.5 * 30))
    assert (out[2].design_weight, out[2].is_census) == (1.0, True)
    assert out[5141].design_weight == 1.0
    counts = {r.cell_no: r for r in estimation.population_counts(population, sample).collect()}
    assert (counts[1].population_count, counts[1].sample_count) == (3, 2)


def test_periods():
    assert shift_period(202301, -1) == 202212 and shift_period(202211, 3) == 202302
    settings = SurveySettings(202303, 3)
    assert settings.backdata_period == 202212
    assert settings.periods == [202301, 202302, 202303]
