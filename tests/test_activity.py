"""Date lists, bit words, monthly arrays, growth accounting."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import datelist, growth, monthly
from tidemark.sources.schemas import (
    HOST_ACTIVITY_CALENDAR,
    HOSTS_CUMULATED,
    USERS_CUMULATED,
    USERS_GROWTH_ACCOUNTING,
)
from tidemark.sources.store import upsert_rows

EVENTS = "user_id bigint, device_id int, host string, event_time timestamp_ntz"


def day(n):
    return date(2024, 1, 1) + timedelta(days=n - 1)


def event(user, n, host="h1", device=1, hour=5):
    return (user, device, host, datetime(2024, 1, 1, hour) + timedelta(days=n - 1))


VISITS = [event(1, n) for n in (1, 2, 2, 5, 13, 30)] + [
    event(2, 3),
    event(2, 30, "h2"),
    event(3, 30),
    event(None, 1),
    event(4, 4, None),
]


def active_on(events, keys, n):
    return datelist.active_days(events, keys, day(n), day(n))


def test_day_filter_takes_the_whole_day_only(frame):
    moments = [
        datetime(2024, 1, 2),
        datetime(2024, 1, 2, 23, 59, 59, 999999),
        datetime(2024, 1, 3),
    ]
    events = frame("user_id int, event_time timestamp_ntz", list(enumerate(moments)))
    got = datelist.active_days(events, ["user_id"], day(2), day(2))
    assert rows_of(got) == [("0", day(2)), ("1", day(2))]
    assert datelist.events_on(events, day(2)).count() == 2


@pytest.mark.parametrize("keys", [["user_id"], ["user_id", "host"]])
def test_date_list_steps_equal_one_pass(spark, frame, keys):
    events = frame(EVENTS, VISITS)
    table = USERS_CUMULATED if len(keys) == 1 else HOSTS_CUMULATED
    dates = "dates_active" if len(keys) == 1 else "host_activity_datelist"
    lists = spark.createDataFrame([], table.schema)
    for n in range(1, 6):
        lists = datelist.datelist_step(lists, active_on(events, keys, n), keys, dates)
    active = datelist.active_days(events, keys)
    assert rows_of(lists) == rows_of(datelist.datelist_through(active, keys, dates, day(5)))
    # An earlier snapshot can be cut from a later one.
    later = datelist.datelist_through(active, keys, dates, day(30))
    assert rows_of(datelist.datelist_as_of(later, dates, day(5))) == rows_of(lists)
    if len(keys) == 1:
        assert lists.where("user_id = '1'").first().dates_active == [day(5), day(2), day(1)]


def test_greatest_browser_per_event_time(frame):
    events = frame(EVENTS, [event(1, 1, device=1), event(1, 1, device=2), event(None, 1)])
    devices = frame(
        "device_id int, browser_type string", [(1, "alpha"), (2, "beta"), (3, None)]
    )
    got = datelist.browser_events(events, devices)
    assert rows_of(got, "user_id", "browser_type") == [(1, "beta")]


def bits_of(frame, rows, **options):
    lists = frame("user_id string, dates array<date>, date date", rows)
    got = datelist.activity_bits(lists, ["user_id"], "dates", day(1), day(31), **options)
    return {r.user_id: tuple(r)[1:] for r in got.collect()}


def test_as_of_day_falls_outside_the_word(frame):
    rows = [
        ("today", [day(31)], day(31)),
        ("yesterday", [day(30)], day(31)),
        ("month", [day(n) for n in range(31, 0, -1)], day(31)),
        ("none", [], day(31)),
    ]
    zero = "0" * 32
    got = bits_of(frame, rows)
    assert got["today"] == (zero, 0, 0, 0)
    assert got["yesterday"] == ("1" + "0" * 31, 1, 1, 1)
    assert got["month"] == ("1" * 30 + "00", 30, 7, 1)
    assert got["none"] == (zero, 0, 0, 0)
    kept = bits_of(frame, rows, keep_today=True)
    assert kept["today"] == ("1" + "0" * 31, 1, 1, 1)
    assert kept["month"] == ("1" * 31 + "0", 31, 7, 1)


def test_dates_outside_series_or_word_add_nothing(frame):
    old = date(2023, 12, 1)
    rows = [("u", [day(31), day(30), old, day(30)], day(31))]
    assert bits_of(frame, rows)["u"] == ("1" + "0" * 31, 1, 1, 1)
    # A snapshot of the first day can hold the first day only, which is lost.
    assert bits_of(frame, [("u", [day(1)], day(1))])["u"][1] == 0


def test_two_rows_on_one_day_carry_unless_united(frame):
    rows = [("u", [day(29)], day(31)), ("u", [day(29)], day(31))]
    assert bits_of(frame, rows)["u"][0] == "1" + "0" * 31
    assert bits_of(frame, rows, combine="or")["u"][0] == "01" + "0" * 30


def test_bit_count_is_number_of_listed_days(frame):
    active = datelist.active_days(frame(EVENTS, VISITS), ["user_id"])
    lists = datelist.datelist_through(active, ["user_id"], "dates", day(30))
    bits = datelist.activity_bits(
        lists, ["user_id"], "dates", day(1), day(30), keep_today=True
    )
    sizes = lists.select("user_id", F.size("dates").alias("n"))
    assert bits.join(sizes, "user_id").where("n != monthly_active").count() == 0


COUNTS = "host string, date date, num_hits int, unique_users int"
USER_HOST = ["user_id", "host"]


def empty_calendar(spark):
    return spark.createDataFrame([], HOST_ACTIVITY_CALENDAR.schema)


def upserted(spark, calendar, changed):
    """The calendar after an upsert, as a table of its own."""
    merged = upsert_rows(calendar, changed, HOST_ACTIVITY_CALENDAR.key)
    return spark.createDataFrame(merged.collect(), HOST_ACTIVITY_CALENDAR.schema)


def stepped(spark, active, calendar, n):
    """One day written from the snapshot of it."""
    hosts = datelist.datelist_through(active, USER_HOST, "host_activity_datelist", day(n))
    changed = monthly.write_days(calendar, monthly.host_day(hosts, day(n)), [day(n)])
    return upserted(spark, calendar, changed)


def test_month_arrays(spark, frame):
    events = frame(
        EVENTS,
        [event(1, 1, "a"), event(2, 1, "a"), event(1, 2, "a"), event(1, 2, "b"), event(3, 3, "c")],
    )
    active = datelist.active_days(events, USER_HOST)
    calendar = empty_calendar(spark)
    for n in (1, 2, 3):
        calendar = stepped(spark, active, calendar, n)
    assert rows_of(monthly.month_arrays(calendar)) == [
        (1, "a", [0, 1, 2], [0, 1, 2]),
        (1, "b", [0, 1], [0, 1]),
        (1, "c", [1], [1]),
    ]
    row = calendar.where("host = 'b'").first()
    assert (row.month, row.days, row.hits[:4], len(row.hits)) == (202401, 6, [None, 1, 0, None], 31)


def two_years(frame):
    days = [28, 29, 30, 33, 35, 60]
    visits = [event(u, n, h) for n in days for u, h in ((1, "a"), (n, "a"), (2, f"h{n % 3}"))]
    again = [(u, d, h, m + timedelta(days=366)) for u, d, h, m in visits[-9:]]
    return datelist.active_days(frame(EVENTS, visits + again), USER_HOST).cache()


@pytest.mark.parametrize("by_year", [False, True])
@pytest.mark.parametrize("first,last", [(28, 34), (425, 428)])
def test_days_in_any_order_and_again_equal_one_pass(spark, frame, by_year, first, last):
    """Over the end of a month, and over the same month of two years."""
    active = two_years(frame)
    start = monthly.calendar_through(active, day(first - 1), day(1))
    start = spark.createDataFrame(start.collect(), HOST_ACTIVITY_CALENDAR.schema)
    order = list(range(first, last + 1))
    random.Random(first).shuffle(order)
    calendar = start
    for n in [*order, order[0], first, last]:
        calendar = stepped(spark, active, calendar, n)
    whole = monthly.calendar_through(active, day(last), day(1))
    assert rows_of(calendar) == rows_of(whole)
    got = monthly.month_arrays(calendar, by_year)
    assert rows_of(got) == rows_of(monthly.month_arrays(whole, by_year))
    months = {r.month for r in got.collect()}
    assert min(months) > 202400 if by_year else max(months) <= 12
    longest = max(len(r.hit_array) for r in got.collect())
    assert longest > 31 if first == 425 and not by_year else longest <= 31


def test_a_gap_stays_a_gap(spark, frame):
    active = datelist.active_days(frame(EVENTS, [event(1, n, "a") for n in (1, 2, 3, 5)]), USER_HOST)
    calendar = empty_calendar(spark)
    for n in (1, 3, 3, 5, 1):
        calendar = stepped(spark, active, calendar, n)
    assert rows_of(monthly.month_arrays(calendar)) == [(1, "a", [1, 1, 1], [1, 1, 1])]
    assert calendar.first().days == 0b10101
    calendar = stepped(spark, active, calendar, 4)
    assert rows_of(monthly.month_arrays(calendar)) == [(1, "a", [1, 0, 1, 1], [1, 1, 1, 1][:1] + [0, 1, 1])]


def test_a_rewritten_day_takes_slots_back(spark, frame):
    """A day told in full clears hosts it does not name; a part of a day does not."""
    before = frame(COUNTS, [("a", day(1), 4, 3), ("b", day(1), 2, 2), ("b", day(2), 1, 1)])
    calendar = spark.createDataFrame(
        monthly.calendar_of(before).collect(), HOST_ACTIVITY_CALENDAR.schema
    )
    again = frame(COUNTS, [("a", day(1), 9, 8)])
    part = monthly.write_days(calendar, again)
    assert [r.host for r in part.collect()] == ["a"]
    full = monthly.write_days(calendar, again, [day(1)])
    assert sorted(r.host for r in full.collect()) == ["a", "b"]
    assert rows_of(monthly.month_arrays(upserted(spark, calendar, full))) == [
        (1, "a", [9], [8]),
        (1, "b", [1], [1]),
    ]
    # The last slot of a host can go; its row then has no arrays.
    none = monthly.write_days(calendar, frame(COUNTS, []), [day(1), day(2)])
    left = upserted(spark, calendar, none)
    assert {r.days for r in left.collect()} == {0} and monthly.month_arrays(left).count() == 0


def test_months_untouched_are_not_rewritten(frame):
    calendar = monthly.calendar_of(
        frame(COUNTS, [("a", day(1), 1, 1), ("a", day(40), 2, 2), ("gone", day(41), 3, 3)])
    )
    changed = monthly.write_days(calendar, frame(COUNTS, [("new", day(2), 5, 4)]), [day(2)])
    assert [(r.month, r.host) for r in changed.collect()] == [(202401, "new")]


@pytest.mark.parametrize("n", [1, 15, 31])
def test_every_day_of_a_month_has_its_slot(frame, n):
    row = monthly.calendar_of(frame(COUNTS, [("a", day(n), 7, 6)])).first()
    assert row.days == 1 << n - 1
    assert [i for i, x in enumerate(row.hits, 1) if x is not None] == [n]
    again = monthly.month_arrays(monthly.calendar_of(frame(COUNTS, [("a", day(n), 7, 6)])))
    assert rows_of(again) == [(1, "a", [7], [6])]


@pytest.mark.parametrize("corrected", [False, True])
def test_growth_steps_equal_one_pass(spark, frame, corrected):
    events = frame(EVENTS, [e for e in VISITS if e[3].day <= 15])
    active = datelist.active_days(events, ["user_id"])
    table = spark.createDataFrame([], USERS_GROWTH_ACCOUNTING.schema)
    every = None
    for n in range(1, 16):
        step = growth.growth_step(table, active_on(events, ["user_id"], n), corrected)
        # Collecting each day cuts the plan, as a write does in daily use.
        table = spark.createDataFrame(step.collect(), USERS_GROWTH_ACCOUNTING.schema)
        every = table if every is None else every.unionByName(table)
    assert rows_of(every) == rows_of(growth.growth_backfill(active, day(15), corrected))


def states(frame, prev, today, **options):
    """Daily and weekly state from (first, last) active before day 20 and activity on it."""
    schema = USERS_GROWTH_ACCOUNTING.schema
    before = [("u", day(f), day(x), "", "", [day(x)], day(19)) for f, x in prev]
    active = [("u", day(20))] if today else []
    got = growth.growth_step(
        frame(schema, before), frame("user_id string, date_active date", active), **options
    )
    row = got.first()
    return row.daily_active_state, row.weekly_active_state


def test_growth_branches(frame):
    assert states(frame, [], True) == ("New", "New")
    assert states(frame, [(1, 19)], True) == ("Retained", "Retained")
    assert states(frame, [(1, 18)], True) == ("Resurrected", "Retained")
    assert states(frame, [(1, 12)], True) == ("Resurrected", "Resurrected")
    assert states(frame, [(1, 13)], True) == ("Resurrected", "Retained")
    assert states(frame, [(1, 19)], False) == ("Churned", "Retained")
    assert states(frame, [(1, 12)], False) == ("Stale", "Retained")
    assert states(frame, [(1, 11)], False) == ("Stale", "Stale")


def test_growth_corrected_weeks(frame):
    def weekly(prev, today):
        return states(frame, prev, today, corrected=True)[1]

    assert weekly([(1, 14)], False) == "Retained"
    assert weekly([(1, 13)], False) == "Churned"
    assert weekly([(1, 12)], False) == "Stale"
    assert weekly([(1, 12)], True) == "Resurrected"
    assert weekly([(1, 13)], True) == "Retained"


def test_growth_reports(frame):
    active = datelist.active_days(frame(EVENTS, VISITS), ["user_id"])
    table = growth.growth_backfill(active, day(30))
    counts = {(r.date, r.daily_active_state): r.users for r in growth.state_counts(table).collect()}
    assert counts[day(30), "New"] == 1
    assert counts[day(30), "Resurrected"] == 2
    curve = {
        (r.date, r.days_since_first_active): (r.active_users, r.total_users, r.pct_active)
        for r in growth.retention(table).collect()
    }
    assert curve[day(30), 0] == (1, 1, 100.0)
    assert curve[day(6), 5] == (0, 1, 0.0)
    only = growth.retention(table, day(3))
    assert {r.total_users for r in only.collect()} == {1}
    assert rows_of(growth.activity_count(table, day(30))) == [
        ("1", 1),
        ("2", 1),
        ("3", 1),
        ("4", 1),
    ]
