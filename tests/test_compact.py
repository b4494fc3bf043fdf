import pytest

from snapweave.operators.compact import compact_rows


def test_keeps_latest_after_sort(spark):
    df = spark.createDataFrame([("A", 25, 10), ("A", 26, 99), ("B", 25, 5)], "po string, week int, qty int")
    out = {r.po: r.qty for r in compact_rows(df, ["po"], ["week"], keep="last").collect()}
    assert out == {"A": 99, "B": 5}
    first = {r.po: r.qty for r in compact_rows(df, ["po"], ["week"], keep="first").collect()}
    assert first == {"A": 10, "B": 5}


def test_composite_key(spark):
    df = spark.createDataFrame([("A", 1, 10), ("A", 1, 20), ("A", 2, 30)], "po string, item int, qty int")
    assert compact_rows(df, ["po", "item"]).count() == 2


def test_ties_follow_row_order(spark):
    df = spark.createDataFrame([("A", 1, 0, "x"), ("A", 1, 1, "y"), ("A", 1, 2, "z")],
                               "k string, s int, pos int, v string")
    assert compact_rows(df, ["k"], ["s"], "last", ["pos"]).first().v == "z"
    assert compact_rows(df, ["k"], ["s"], "first", ["pos"]).first().v == "x"


def test_null_sort_value_wins_last_and_null_keys_group(spark):
    df = spark.createDataFrame([("A", 5, 0), ("A", None, 1), ("A", 7, 2), (None, 1, 3), (None, 2, 4)],
                               "k string, s int, pos int")
    rows = {r.k: r for r in compact_rows(df, ["k"], ["s"], "last", ["pos"]).collect()}
    assert rows["A"].s is None and rows["A"].pos == 1
    assert rows[None].pos == 4 and len(rows) == 2


def test_rejects_bad_keep(spark):
    with pytest.raises(ValueError):
        compact_rows(spark.createDataFrame([(1,)], "k int"), ["k"], keep="middle")


def test_input_not_mutated(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    compact_rows(df, ["k"])
    assert df.count() == 2
