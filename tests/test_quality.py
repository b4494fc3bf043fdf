import pytest

from snapweave.operators import quality as dq
from snapweave.plans.runlog import counted, run_logged


@pytest.fixture
def snap(spark):
    return spark.createDataFrame(
        [(2026, 29, "A|10", "2026-07-13", "EUR"), (2026, 29, "A|20", "2026-07-13", "CHF"),
         (2026, 30, "A|10", "2026-07-20", None)],
        "report_year int, report_week int, key string, report_date string, currency string")


def lines(report):
    return {r.check: (r.rows, r.bad_rows) for r in report.collect()}


def test_all_rules_of_a_table_in_one_report(spark, snap):
    key = ["report_year", "report_week", "key"]
    assert lines(dq.table_report(snap, key, ["key", "currency"], dated=True)) == {
        "rows": (3, 0), "not_null(key)": (3, 0), "not_null(currency)": (3, 1), "report_date": (3, 0),
        "unique(report_year, report_week, key)": (3, 0)}
    twice = snap.unionByName(snap.filter("currency = 'EUR'"))
    assert lines(dq.table_report(twice, key))["unique(report_year, report_week, key)"] == (4, 2)
    assert lines(dq.table_report(snap.limit(0), key, key)) == {
        "rows": (0, 0), **{f"not_null({c})": (0, 0) for c in key}, "unique(report_year, report_week, key)": (0, 0)}


def test_null_keys_repeat_or_are_left_out(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "key string")
    assert lines(dq.table_report(df, ["key"]))["unique(key)"] == (3, 2)
    assert lines(dq.table_report(df, ["key"], nulls_equal=False))["unique(key)"] == (3, 0)


def test_enforce_names_what_failed(spark, snap):
    assert dq.enforce(dq.table_report(snap, not_null=["key"]), "t")[0].rows == 3
    with pytest.raises(dq.QualityError, match=r"t does not pass: check not_null\(currency\), rows 3, bad_rows 1"):
        dq.enforce(dq.table_report(snap, not_null=["key", "currency"]), "t")
    with pytest.raises(dq.QualityError, match="report_week 30"):
        dq.enforce(dq.row_count_delta_report(snap, max_pct=0.4), "weeks")


def test_row_count_delta_report(spark, snap):
    rows = dq.row_count_delta_report(snap).orderBy("report_week").collect()
    assert [(r.rows, r.prev_rows, r.pct, r.passed) for r in rows] == [(2, None, 0.0, True), (1, 2, 0.5, True)]


def test_freshness(spark, snap):
    w29 = snap.filter("report_week = 29")
    assert dq.freshness_report(w29, expected="2026-07-13").first().passed
    for stale in (snap, snap.limit(0)):
        with pytest.raises(dq.QualityError):
            dq.enforce(dq.freshness_report(stale, expected="2026-07-13"), "snapshot")
    assert all(r.passed for r in dq.freshness_report(snap).collect())


def test_relationships(spark, snap):
    from snapweave.sources.seeds import load_rates

    rows = dq.relationships_report(snap, load_rates(spark)).collect()
    assert [(r.currency, r.rows) for r in rows] == [("CHF", 1)]


def test_run_log_keeps_passed_and_failed_runs(spark, snap, tmp_path):
    log = str(tmp_path / "log")
    seen, rows_in = counted(snap)

    def load():
        seen.write.format("noop").mode("overwrite").save()
        return 2

    assert run_logged(spark, log, "load", "write", load, rows_in) == 2
    with pytest.raises(RuntimeError, match="boom"):
        run_logged(spark, log, "load", "upsert", lambda: (_ for _ in ()).throw(RuntimeError("boom")))
    rows = {r.stage: r for r in spark.read.parquet(log).collect()}
    assert (rows["write"].status, rows["write"].rows_in, rows["write"].rows_out) == ("PASSED", 3, 2)
    assert rows["upsert"].status == "FAILED" and rows["write"].duration_s >= 0


def test_date_counts_lists_every_date(spark):
    df = spark.range(60).selectExpr("cast(date_add(date'2026-01-01', cast(id as int)) as string) as report_date")
    assert dq.date_counts(df, "report_date").count() == 60
