"""Expectations and the gate."""

import pytest
from pyspark.sql import Row

from retail_lake.operators import expect


def verdicts(df, *expectations):
    return {r["check"]: (r["passed"], r["detail"]) for r in expect.evaluate(df, *expectations).collect()}


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def test_unique(spark):
    assert verdicts(ids(spark, 7, 8, 7, 9, 7), expect.unique("id")) == {
        "unique[id]": (False, "5 rows / 3 distinct")
    }
    assert verdicts(ids(spark, 40, -40), expect.unique("id"))["unique[id]"][0] is True


@pytest.mark.parametrize("values, passed", [((1, None), True), ((1, None, None), False), ((None, None), False)])
def test_unique_takes_null_for_a_value(spark, values, passed):
    assert verdicts(ids(spark, *values), expect.unique("id"))["unique[id]"][0] is passed


def test_not_null(spark):
    got = verdicts(ids(spark, 1, None, 3, 4), expect.not_null("id", 0.25))
    assert got == {"not_null[id]": (True, "null ratio 0.2500 <= 0.25")}
    assert verdicts(ids(spark, 1, None, 3, 4), expect.not_null("id", 0.2))["not_null[id]"][0] is False


def test_empty_table(spark):
    got = verdicts(
        ids(spark), expect.unique("id"), expect.not_null("id", 0.0), expect.min_rows(1, "t"), expect.non_negative("id")
    )
    assert {check: passed for check, (passed, _) in got.items()} == {
        "unique[id]": True,
        "not_null[id]": True,
        "min_rows[t]": False,
        "non_negative[id]": True,
    }


def test_min_rows(spark):
    assert verdicts(ids(spark, 6, 6, 6), expect.min_rows(3, "t")) == {"min_rows[t]": (True, "3 >= 3")}


def test_non_negative(spark):
    amounts = spark.createDataFrame([(0.0,), (-0.25,), (None,), (-80.0,)], "amount double")
    assert verdicts(amounts, expect.non_negative("amount")) == {
        "non_negative[amount]": (False, "2 negative values")
    }


def test_all_checks_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    ids(spark, 1, 2).write.parquet(path)
    df = expect.evaluate(
        spark.read.parquet(path), expect.unique("id"), expect.not_null("id", 0.1), expect.min_rows(1, "t")
    )
    assert df._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1


def test_gate_raises_naming_the_failures():
    failed = Row(check="min_rows[t]", passed=False, detail="0 >= 4")
    with pytest.raises(ValueError, match=r"min_rows\[t\] \(0 >= 4\)"):
        expect.gate([failed], fail_on_error=True)
    assert expect.gate([failed], fail_on_error=False) == [failed]


def test_gate_is_silent_when_all_pass():
    assert expect.gate([Row(check="x", passed=True, detail="ok")]) == []
