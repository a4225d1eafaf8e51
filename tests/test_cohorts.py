"""The stored cohort matrix against retention of all growth rows."""

import random
from datetime import date, timedelta

import pytest
from conftest import rows_of

from tidemark.operators.cohorts import cohort_curve, cohort_step, cohorts_through
from tidemark.operators.growth import growth_backfill, retention

START = date(2024, 1, 1)
ACTIVE = "user_id string, date_active date"
FIRSTS, DAYS = (
    "user_id string, first_active_date date",
    "first_active_date date, date date, active_users bigint, total_users bigint",
)


def day(n):
    return START + timedelta(n)


def drawn(seed):
    made = random.Random(seed)
    rows = {(f"u{u}", day(made.randrange(u % 5, 9))) for u in range(12) for _ in range(4)}
    # Nobody is active on day 4.
    return sorted(r for r in rows if r[1] != day(4))


@pytest.mark.parametrize("seed", [1, 2])
def test_steps_and_one_pass_equal_retention(frame, seed):
    rows = drawn(seed)
    active = frame(ACTIVE, rows)
    firsts, matrix = frame(FIRSTS, []), frame(DAYS, [])
    for n in (*range(6), 5, 6, 7, 8):
        new, column = cohort_step(firsts, matrix, active, day(n))
        told = [tuple(r) for r in new.select("user_id", "first_active_date").collect()]
        made = [tuple(r) for r in column.select("first_active_date", "date", "active_users", "total_users").collect()]
        # A day given again replaces what it wrote.
        kept = [r for r in rows_of(firsts) if r[1] != day(n)]
        past = [r for r in rows_of(matrix) if r[1] != day(n)]
        firsts, matrix = frame(FIRSTS, kept + told), frame(DAYS, past + made)
    want = rows_of(retention(growth_backfill(active, day(8))))
    assert rows_of(cohort_curve(matrix)) == want
    first_days, whole = cohorts_through(active, day(8))
    assert rows_of(cohort_curve(whole)) == want
    assert rows_of(first_days.select("user_id", "first_active_date")) == rows_of(firsts)


def test_nobody(frame):
    none = frame(ACTIVE, [])
    new, column = cohort_step(frame(FIRSTS, []), frame(DAYS, []), none, START)
    assert new.count() == column.count() == 0
    assert cohorts_through(none, START)[1].count() == 0
