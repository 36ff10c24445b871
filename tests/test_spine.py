"""Spines, slices, completeness and checks."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from finlake.operators import quality, spine


def months(spark, start, end):
    frame = spine.month_spine(spine.spine_frame(spark, start, end), "start", "end")
    return [r.month for r in frame.orderBy("month").collect()]


def test_month_spine_edges(spark):
    assert months(spark, date(2023, 11, 30), date(2024, 2, 1)) == [
        date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1),
    ]
    assert months(spark, date(2024, 1, 31), date(2024, 1, 1)) == [date(2024, 1, 1)]
    assert months(spark, date(2024, 2, 1), date(2024, 1, 31)) == []


def test_day_and_year_spines(spark):
    frame = spine.spine_frame(spark, date(2024, 2, 28), date(2024, 3, 1))
    assert [r.day.day for r in spine.day_spine(frame, "start", "end").collect()] == [28, 29, 1]
    runs = spark.createDataFrame([(1, date(2021, 5, 1), True), (2, date(2021, 5, 1), False)], "i int, d date, f boolean")
    years = spine.year_spine(runs, "d", F.col("f"))
    assert sorted((r.i, r.ref_year) for r in years.collect()) == [(1, 2019), (1, 2020), (1, 2021), (2, 2021)]


def test_slices_leave_out_rows_without_segment(spark):
    rows = spark.createDataFrame([("I", "S1"), ("C", "S5"), ("X", "S1"), ("I", "S6"), ("I", None)], "td string, sr string")
    assert spine.in_slices(rows, "td", "sr").count() == 2
    assert spine.in_slices(rows, "td", "sr", keep_unsegmented=True).count() == 3


def test_frequency(spark):
    rows = spark.createDataFrame([("a", "monthly"), ("b", "daily")], "e string, frequency string")
    assert spine.by_frequency(rows, "all").count() == 2
    assert [r.e for r in spine.by_frequency(rows, "daily").collect()] == ["b"]
    assert spine.by_frequency(rows, "weekly").count() == 0


AS_OF = date(2024, 7, 15)


def runs(spark, answered):
    """answered: one flag per month of 2024, None for a month not tried."""
    expected = spine.month_spine(
        spine.spine_frame(spark, date(2024, 1, 1), date(2024, len(answered), 1)), "start", "end"
    ).select(F.lit("e").alias("entity"), "month")
    tries = [("e", date(2024, i + 1, 1), a) for i, a in enumerate(answered) if a is not None]
    answers = spark.createDataFrame(tries, "entity string, month date, answered boolean")
    status = spine.month_status(expected, answers, "entity", "month")
    return spine.gap_runs(status, "entity", "month", AS_OF)


@pytest.mark.parametrize(
    "answered, longest, fails",
    [
        ([True] * 7, 0, False),
        ([False, False, True, True, True, True, True], 2, False),
        ([False, False, False, True, True, True, True], 3, True),
        ([None, None, None, True, True, True, True], 3, True),
        ([False, False, True, False, True, True, True], 2, False),
        ([True, True, True, True, False, False, False], 0, False),  # recent months do not count
        ([True, False, False, False, False, False, False], 3, True),  # and do not end a run
    ],
)
def test_gap_guard(spark, answered, longest, fails):
    found = runs(spark, answered)
    assert max((r.old_gaps for r in found.collect()), default=0) == longest
    if fails:
        with pytest.raises(RuntimeError, match="'e'"):
            spine.require_complete(found, "entity")
    else:
        spine.require_complete(found, "entity")


def test_age_limit_is_exclusive(spark):
    """A month exactly 90 days old does not count yet."""
    status = spark.createDataFrame([("e", date(2024, 4, 16), False), ("e", date(2024, 4, 15), False)],
                                   "entity string, month date, answered boolean")
    assert spine.gap_runs(status, "entity", "month", AS_OF).first().old_gaps == 1


def test_several_tries_of_a_month(spark):
    expected = spark.createDataFrame([("e", date(2024, 1, 1))], "entity string, month date")
    answers = spark.createDataFrame([("e", date(2024, 1, 1), False), ("e", date(2024, 1, 1), True)],
                                    "entity string, month date, answered boolean")
    assert spine.month_status(expected, answers, "entity", "month").first().answered is True


def test_quality_checks(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b"), (None, "b")], "k bigint, v string")
    assert {r.column_name: r.failures for r in quality.null_counts(rows, ["k", "v"]).collect()} == {"k": 2, "v": 1}
    assert quality.rows_with_null(rows, ["k", "v"]).count() == 3
    assert [tuple(r) for r in quality.duplicate_keys(rows, ["k"]).collect()] == [(1, 2)]
    combos = quality.duplicate_keys(rows, ["k", "v"]).collect()
    assert sorted(map(tuple, combos), key=repr) == [(1, "a", 2), (None, "b", 2)]
    with pytest.raises(ValueError, match=r"not_null:v \(1\), unique:k \(1\)"):
        quality.require(rows, quality.Checks(not_null=("v",), unique=(("k",),)), "t")
    quality.require(rows.where("k = 2").fillna("x"), quality.Checks(("k", "v"), (("k",), ("k", "v"))), "t")
