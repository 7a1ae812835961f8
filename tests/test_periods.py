import datetime as dt
import random

import pytest

from lakeops.functions.periods import (default_months, month_bounds, month_bounds_text,
                                       parse_months, validate_months)


@pytest.mark.parametrize("given, kept", [
    ((), []),
    (iter(["2019-06"]), ["2019-06"]),
    (["2024-10", "2024-02", "2024-10", "1999-12", "2024-02"], ["2024-10", "2024-02", "1999-12"]),
])
def test_distinct_months_in_the_order_given(given, kept):
    assert validate_months(given) == kept


@pytest.mark.parametrize("item", ["", "2024", "2024-2", "202402", "2024/02", "2024-00", "2024-99", " 2024-02", "2024-02-01",
                                  "2024-02\n", None, 202402, ("2024-02",)])
def test_what_is_no_month_is_named(item):
    with pytest.raises(ValueError) as error:
        validate_months(["2031-07", item])
    assert repr(item) in str(error.value) and "2031-07" not in str(error.value)


def test_argument_text_is_split_and_checked():
    assert parse_months("2024-10,2024-09 , ,2024-10") == ["2024-10", "2024-09"]
    with pytest.raises(ValueError):
        parse_months("2024-10;2024-11")


def test_bounds_cover_first_to_last_month():
    rnd = random.Random(3)
    for _ in range(50):
        months = [f"{rnd.randint(1990, 2040)}-{rnd.randint(1, 12):02d}" for _ in range(rnd.randint(1, 6))]
        first, end = month_bounds(months)
        year, month = map(int, min(months).split("-"))
        assert first == dt.date(year, month, 1)
        assert end.day == 1 and (end - dt.timedelta(days=1)).strftime("%Y-%m") == max(months)
        assert month_bounds_text(months[::-1]) == (first.isoformat(), end.isoformat())
    with pytest.raises(ValueError):
        month_bounds([])


def test_default_scope_is_two_months_back():
    assert default_months(dt.date(2024, 3, 15)) == ["2024-01"]
    assert default_months(dt.date(2024, 1, 5)) == ["2023-11"]
    assert default_months(dt.date(2024, 2, 1)) == ["2023-12"]
