from datetime import date, datetime, timezone

import pytest

from kerbside.period import ReportPeriod


def test_previous_month_over_new_year():
    period = ReportPeriod.for_previous_month(datetime(2021, 1, 5, 12))
    assert (period.start, period.end, period.last_day) == (date(2020, 12, 1), date(2021, 1, 1), date(2020, 12, 31))
    assert period.label == "2020-12"


def test_label_names_another_month_from_the_fifteenth_on():
    late = datetime(2020, 10, 20)
    assert ReportPeriod.for_previous_month(late).label == "2020-10"
    assert ReportPeriod.for_previous_month(late, "corrected").label == "2020-09"


def test_cutoff_is_the_last_days_midnight_unless_corrected():
    period = ReportPeriod.for_previous_month(datetime(2020, 10, 5))
    assert period.cutoff() == date(2020, 9, 30)
    assert period.cutoff("corrected") == date(2020, 10, 1)


def test_epoch_bounds_are_utc():
    period = ReportPeriod.for_previous_month(datetime(2020, 10, 5))
    assert period.start_ms == 1598918400000
    assert period.end_ms == 1601510400000


def test_zoned_as_of_becomes_utc():
    period = ReportPeriod(date(2020, 9, 1), date(2020, 10, 1), datetime(2020, 10, 5, tzinfo=timezone.utc), "x")
    assert period.as_of == datetime(2020, 10, 5)


def test_rejects_empty_period_and_unknown_semantics():
    with pytest.raises(ValueError):
        ReportPeriod(date(2020, 9, 1), date(2020, 9, 1), datetime(2020, 10, 5), "x")
    with pytest.raises(ValueError):
        ReportPeriod.for_previous_month(datetime(2020, 10, 5), "other")
