import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from saldoflow.functions.dates import cut_table
from saldoflow.operators.calendar import CutCalendar
from tests.brute import as_frame, backward, buckets, forward, make_calendar

D = dt.date


def rows_by_cut(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["fecha_corte"], []).append((r["proyeccion"], r["fecha"], r["columna"]))
    return {cut: sorted(rows, key=str) for cut, rows in found.items()}


def assert_matches(spark, rows, cuts):
    calendar = CutCalendar(as_frame(spark, rows), cut_table(spark, *cuts))
    found = rows_by_cut(calendar.bucket_calendar())
    for cut in cuts:
        assert found.get(cut, []) == buckets(rows, cut), cut


def days(found, bucket):
    return sorted(day for _, day, columna in found if columna == bucket)


HOLIDAYS = {D(2025, 11, 3), D(2025, 12, 25), D(2026, 1, 1)}


@pytest.fixture(scope="module")
def worked(spark):
    rows = make_calendar(D(2025, 10, 1), D(2027, 2, 1), HOLIDAYS)
    cuts = [D(2025, 11, 7), D(2026, 1, 2), D(2025, 11, 11), D(2025, 11, 9)]
    return rows_by_cut(CutCalendar(as_frame(spark, rows), cut_table(spark, *cuts)).bucket_calendar())


def test_plain_friday(worked):
    found = worked[D(2025, 11, 7)]
    assert days(found, 1) == [D(2025, 11, d) for d in (1, 2, 3, 4)]
    assert days(found, 2) == [D(2025, 11, 5)]
    assert days(found, 3) == [D(2025, 11, 6)]
    assert days(found, 5) == [D(2025, 11, 7)]
    assert days(found, 8) == [D(2025, 11, 8), D(2025, 11, 9), D(2025, 11, 10)]
    assert ("1", D(2025, 11, 10), 8) in found


def test_holiday_thursday_shares_the_cut_bucket_and_the_bridge_is_left_out(worked):
    found = worked[D(2026, 1, 2)]
    assert days(found, 1) == [D(2025, 12, 27), D(2025, 12, 28), D(2025, 12, 29)]
    assert days(found, 5) == [D(2026, 1, 1), D(2026, 1, 2)]


def test_working_saturday_uses_up_a_number(worked):
    found = worked[D(2025, 11, 11)]
    assert days(found, 1) == [D(2025, 11, 3), D(2025, 11, 7)]
    assert days(found, 2) == [D(2025, 11, 8), D(2025, 11, 9)]
    assert days(found, 3) == [D(2025, 11, 10)]


def test_saturday_off_shares_the_number_of_the_next_business_day(spark):
    rows = make_calendar(D(2025, 10, 1), D(2025, 12, 31), HOLIDAYS, saturday_flag=0)
    found = rows_by_cut(CutCalendar(as_frame(spark, rows), cut_table(spark, D(2025, 11, 11))).bucket_calendar())
    assert days(found[D(2025, 11, 11)], 2) == [D(2025, 11, 8), D(2025, 11, 9), D(2025, 11, 10)]


def test_forward_labels_and_buckets(worked):
    found = worked[D(2025, 11, 7)]
    labels = {int(p): c for p, _, c in found if p.isdigit() and p != "1"}
    assert sorted(labels) == list(range(2, 366))
    assert [labels[n] for n in (2, 7, 8, 15, 16, 30, 31, 90, 91, 365)] == [9, 14, 16, 16, 17, 17, 19, 19, 20, 20]
    assert {c for _, _, c in found}.isdisjoint({6, 7, 15, 18})


def test_non_working_cut_has_no_cut_bucket(worked):
    assert days(worked[D(2025, 11, 9)], 5) == []
    assert D(2025, 11, 9) in days(worked[D(2025, 11, 9)], 8)


def test_every_date_has_one_bucket(worked):
    for found in worked.values():
        dates = [day for _, day, _ in found]
        assert len(dates) == len(set(dates))


def test_all_cuts_of_a_year_match_the_row_by_row_form(spark):
    rows = make_calendar(D(2025, 1, 1), D(2026, 12, 31), HOLIDAYS | {D(2025, 4, 17), D(2025, 4, 18), D(2025, 5, 1)})
    assert_matches(spark, rows, [D(2025, 3, 1) + dt.timedelta(days=k) for k in range(0, 330, 3)])


@pytest.mark.parametrize("seed", [1, 2])
def test_calendars_with_missing_days_and_random_holidays(spark, seed):
    rng = random.Random(seed)
    first = D(2024, 1, 1)
    every = [first + dt.timedelta(days=k) for k in range(500)]
    holidays = set(rng.sample(every, 80)) | {d for d in every if d.weekday() == 3 and rng.random() < 0.4}
    missing = set(rng.sample(every, 60)) | set(every[200:245])
    unnamed = set(rng.sample(every, 50))
    rows = make_calendar(first, every[-1], holidays, saturday_flag=seed % 2, missing=missing, unnamed=unnamed)
    assert_matches(spark, rows, every[::7] + [first, D(2020, 1, 1), D(2030, 1, 1)])


def test_holiday_thursday_at_the_end_of_the_prior_rows_is_dropped(spark):
    rows = make_calendar(D(2025, 1, 1), D(2025, 3, 31), {D(2025, 2, 6)})
    cut = D(2025, 2, 11)  # the window is Fri 7 to Mon 10, the prior rows end on the holiday Thursday
    assert (("jueves", D(2025, 2, 6), 1)) not in backward(rows, cut)
    found = rows_by_cut(CutCalendar(as_frame(spark, rows), cut_table(spark, cut)).backward_buckets())
    assert found[cut] == sorted(backward(rows, cut), key=str)


def test_a_working_day_without_a_name_is_numbered(spark):
    rows = make_calendar(D(2025, 10, 1), D(2025, 12, 31), HOLIDAYS, unnamed={D(2025, 10, 31)})
    found = rows_by_cut(CutCalendar(as_frame(spark, rows), cut_table(spark, D(2025, 11, 4))).backward_buckets())
    assert days(found[D(2025, 11, 4)], 2) == [D(2025, 11, d) for d in (1, 2, 3)]


def test_gap_after_the_next_business_day_keeps_labels_consecutive_inside_a_band(spark):
    missing = {D(2025, 11, 13), D(2025, 11, 19)}
    rows = make_calendar(D(2025, 10, 1), D(2026, 12, 31), HOLIDAYS, missing=missing)
    cut = D(2025, 11, 7)
    found = rows_by_cut(CutCalendar(as_frame(spark, rows), cut_table(spark, cut)).forward_bands())[cut]
    assert sorted(int(p) for p, _, c in found if c in range(9, 15)) == [2, 3, 4, 5, 6, 7]
    # the first band counts one row further because a day is missing, so two bands share 2025-11-17
    assert [p for p, day, _ in found if day == D(2025, 11, 17)] == ["7", "8"]
    expected = [r for r in forward(rows, cut) if r[2] != 8]
    assert found == sorted(expected, key=str)


def test_repeated_and_null_cuts_count_once(spark):
    rows = make_calendar(D(2025, 10, 1), D(2025, 12, 31))
    cuts = spark.createDataFrame([(D(2025, 11, 7),), (D(2025, 11, 7),), (None,)], "fecha_corte date")
    found = CutCalendar(as_frame(spark, rows), cuts).backward_buckets()
    assert found.count() == len(backward(rows, D(2025, 11, 7)))


def test_single_cut_equals_its_share_of_many(spark):
    rows = make_calendar(D(2025, 1, 1), D(2026, 12, 31), HOLIDAYS)
    cut = D(2025, 11, 7)
    many = CutCalendar(as_frame(spark, rows), cut_table(spark, cut, D(2025, 11, 10), D(2025, 6, 2)))
    one = CutCalendar(as_frame(spark, rows), cut_table(spark, cut))
    left = many.bucket_calendar().filter(F.col("fecha_corte") == cut)
    assert rows_by_cut(left) == rows_by_cut(one.bucket_calendar())


def test_release_drops_the_persisted_timeline(spark):
    rows = make_calendar(D(2025, 10, 1), D(2025, 12, 31))
    calendar = CutCalendar(as_frame(spark, rows), cut_table(spark, D(2025, 11, 7)))
    line = calendar._line
    assert line.is_cached
    calendar.release()
    assert not line.is_cached
